"""What must hold on skewed and large inputs: hot keys, plans, stored tables."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from revlens.operators import calibrate, distribution, skew, words
from revlens.queries import QUERIES
from revlens.session import materialise, remove_stored, shared_folder
from revlens.sources.views import table

FOLDER = "/root/testdata/sf0.001"


def plan_of(df, capsys):
    df.collect()
    df.explain()
    return capsys.readouterr().out


@pytest.fixture
def hot_reviews(spark):
    """A third of all rows belong to one user and a sixth to nobody."""
    ids = spark.range(0, 60_000, 1, 12)
    user = (
        F.when(F.col("id") % 6 < 2, "hot")
        .when(F.col("id") % 6 == 2, None)
        .otherwise(F.concat(F.lit("u"), (F.col("id") % 5000).cast("string")))
    )
    return ids.select(
        user.alias("user_id"),
        (F.col("id") % 97).cast("string").alias("asin"),
        (1 + F.col("id") % 5).cast("double").alias("rating"),
    )


@pytest.fixture
def shuffled_joins(spark):
    """Neither broadcast nor merge partitions, as if every table were large."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def largest_share(df):
    """Share of the rows that the fullest task of the last stage holds."""
    tasks = df.groupBy(F.spark_partition_id().alias("task")).count().collect()
    return max(t["count"] for t in tasks) / sum(t["count"] for t in tasks)


def test_hot_keys_are_spread_and_results_unchanged(spark, hot_reviews, shuffled_joins):
    totals = materialise(calibrate.user_averages(hot_reviews))
    joined = skew.join_totals(hot_reviews, totals, "user_id", "user_rows", 100, 1000)
    plain = hot_reviews.join(totals, "user_id", "left")
    columns = ["user_id", "asin", "rating", "user_avg", "user_reviews"]
    got, expected = joined.groupBy(*columns).count(), plain.groupBy(*columns).count()
    assert got.exceptAll(expected).count() == 0
    assert expected.exceptAll(got).count() == 0
    assert largest_share(plain) > 0.33
    assert largest_share(joined) < 0.25


def test_hot_user_without_ratings_is_spread_too(spark, hot_reviews, shuffled_joins):
    unrated = hot_reviews.withColumn("rating", F.when(F.col("user_id") != "hot", F.col("rating")))
    totals = materialise(calibrate.user_averages(unrated))
    joined = skew.join_totals(unrated, totals, "user_id", "user_rows", 100, 1000)
    assert largest_share(joined) < 0.25
    assert joined.filter("user_id = 'hot' AND user_reviews = 0 AND user_avg IS NULL").count() == 20_000


def test_hot_user_at_production_settings(spark, shuffled_joins):
    """One user has more rows than the floor of 100,000 and far more than 1/10,000 of all."""
    ids = spark.range(0, 400_000, 1, 12)
    user = F.when(F.col("id") % 8 < 3, "hot").otherwise(F.concat(F.lit("u"), (F.col("id") % 9000).cast("string")))
    reviews = ids.select(
        user.alias("user_id"), (F.col("id") % 31).cast("string").alias("asin"), (1 + F.col("id") % 5).cast("double").alias("rating")
    )
    totals = materialise(calibrate.user_averages(reviews))
    joined = calibrate.with_user_averages(reviews, totals)
    columns = ["user_id", "asin", "rating", "user_avg", "user_reviews"]
    got = joined.groupBy(*columns).count()
    expected = reviews.join(totals, "user_id", "left").groupBy(*columns).count()
    assert got.exceptAll(expected).isEmpty() and expected.exceptAll(got).isEmpty()
    assert joined.filter("user_id = 'hot' AND user_reviews = 150000").count() == 150_000
    assert largest_share(joined) < 0.25


def test_products_are_calibrated_from_one_read(spark, hot_reviews, tmp_path):
    """What is left to do after the reviews were read once starts from stored tables only."""
    hot_reviews.write.parquet(str(tmp_path / "reviews"))
    reviews = spark.read.parquet(str(tmp_path / "reviews"))
    deltas = calibrate.product_delta(reviews)
    assert deltas.inputFiles()
    assert all("/revlens-" in name for name in deltas.inputFiles())
    assert deltas.count() == 97


def test_stored_tables_are_removed(spark):
    folders = [materialise(spark.range(n)).inputFiles()[0].rsplit("/", 1)[0].removeprefix("file:") for n in (3, 4)]
    assert all(os.path.isdir(folder) for folder in folders)
    remove_stored()
    assert not any(os.path.isdir(folder) for folder in folders)


def test_at_most_max_hot_keys_are_broadcast(spark, hot_reviews):
    totals = calibrate.user_averages(hot_reviews).filter("user_id IS NOT NULL")
    n = totals.agg(F.sum("user_rows")).first()[0]
    for most in (2, 10, 100):
        assert totals.filter(F.col("user_rows") > n / most).count() < most


def test_words_are_cut_before_the_shuffle_and_counted_once(spark, capsys):
    reviews = table(spark, FOLDER, "documents").select((F.col("doc_id") % 5 + 1.0).alias("rating"), "text")
    plan = plan_of(words.top_words(reviews), capsys)
    assert "row_number(), 10, Partial" in plan
    assert "ReusedExchange" in plan


def test_quartiles_window_runs_over_lengths_not_rows(spark, capsys):
    reviews = table(spark, FOLDER, "documents").select(F.col("lang").alias("category"), "text")
    plan = plan_of(distribution.length_quartiles(reviews), capsys)
    below_windows = plan.split("Initial Plan")[0].rsplit("Window [", 1)[1]
    counted = [line for line in below_windows.splitlines() if "partial_count(1)" in line]
    assert len(counted) == 1
    assert "keys=[category#" in counted[0] and "text_length#" in counted[0]


def test_histogram_counts_are_computed_once(spark, capsys):
    reviews = table(spark, FOLDER, "lineitem").select((F.col("l_quantity") % 5).alias("rating"))
    assert "ReusedExchange" in plan_of(distribution.equal_width_histogram(reviews), capsys)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plans_stay_in_the_engine(spark, capsys, name):
    contract.queries()[name](spark, FOLDER).explain()
    plan = capsys.readouterr().out
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython",
                     "MapInPandas", "FlatMapGroupsInPandas", "Scan ExistingRDD"):
        assert operator not in plan


def test_trend_scans_only_its_columns(spark, capsys):
    contract.queries()["yearly_trend"](spark, FOLDER).explain("formatted")
    plan = capsys.readouterr().out
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in plan
    assert "text" not in plan


def test_fraction_and_head_filters_reach_the_scan(spark, capsys):
    contract.queries()["length_by_star"](spark, FOLDER).explain("formatted")
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in capsys.readouterr().out


def test_stored_tables_go_to_the_shared_folder(spark):
    stored = materialise(spark.range(5))
    assert sorted(r.id for r in stored.collect()) == list(range(5))
    location = stored.inputFiles()[0].replace("file://", "file:").replace("file:", "")
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert shared_folder(spark) == named.rstrip("/")
        assert location.startswith(named.replace("file://", "").replace("file:", ""))

