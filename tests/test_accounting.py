"""What jobs say about their rows: rejected lines, strict errors, counts between steps."""

import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from revlens.operators import calibrate
from revlens.operators.steps import StepCounts
from revlens.session import materialise
from revlens.sources import jsonl, rejects

GOOD = '{"rating": 4.0, "title": "t", "asin": "B", "verified_purchase": true}'
FIELDS = {"rating": "int", "title": "str", "timestamp": "date", "score": "float", "verified_purchase": "bool"}
LINES = {
    GOOD: None,
    '{"rating": "many", "score": "x", "timestamp": 1400000000000, "verified_purchase": "perhaps"}': None,
    '{"rating": "", "score": "inf", "timestamp": 1e300}': None,
    "{}": None,
    "": rejects.BLANK,
    " \t ": rejects.BLANK,
    "not json": rejects.BROKEN,
    '{"rating": 1': rejects.BROKEN,
    '{"rating": 1} {"rating": 2}': rejects.BROKEN,
    "1, 2": rejects.BROKEN,
    "{'rating': 1}": rejects.BROKEN,
    "[1]": rejects.NO_OBJECT,
    '"text"': rejects.NO_OBJECT,
    "null": rejects.NO_OBJECT,
    "17": rejects.NO_OBJECT,
}


@pytest.fixture
def two_files(tmp_path):
    lines = list(LINES)
    (tmp_path / "a.jsonl").write_text("\n".join(lines[:8]) + "\n")
    (tmp_path / "b.jsonl").write_text("\n".join(lines[8:]) + "\n")
    return str(tmp_path)


def test_each_line_is_a_record_or_a_reject(spark, two_files):
    found = rejects.read_accounted(spark, two_files, FIELDS)
    given = {r.value: r for r in found.rejects.collect()}
    assert {v: r.reason for v, r in given.items()} == {k: v for k, v in LINES.items() if v}
    assert os.path.basename(given["[1]"].file) == "b.jsonl" and os.path.basename(given["not json"].file) == "a.jsonl"
    assert [given[v].row for v in ("", " \t ", "not json")] == sorted(given[v].row for v in ("", " \t ", "not json"))
    assert sorted(map(str, found.records.drop("file", "block", "row").collect())) == sorted(map(str, jsonl.read_lenient(spark, two_files, FIELDS).collect()))
    assert found.counts == {
        "lines": 15, "records": 4, "blank": 2, "broken": 5, "not an object": 4,
        "failed_rating": 1, "failed_timestamp": 1, "failed_score": 1,
    }


def test_accounts_of_columns_with_clashing_names_and_nulls(spark):
    lines = spark.createDataFrame([(GOOD, 1, "x"), (None, 2, "y"), ("oops", None, None)], "value string, rating int, reason string")
    found = rejects.accounted(lines, FIELDS)
    assert [(r.rating, r.title) for r in found.records.collect()] == [(1, "t")]
    assert found.counts["lines"] == 3 and found.counts["blank"] == 1 and found.counts["broken"] == 1
    assert rejects.accounted(lines.limit(0), FIELDS).counts["lines"] == 0


def test_account_needs_one_scan(spark, two_files, capsys):
    rejects.sorted_out(jsonl.read_lines(spark, two_files), FIELDS).explain()
    assert capsys.readouterr().out.count("FileScan") == 1


@pytest.mark.parametrize(
    "bad",
    [
        '{"rating": 1.0, "title": "cut',
        '{"rating": 1.0, "title": {"a": }}',
        '{"rating": 1.0, "verified_purchase": "perhaps"}',
        '{"rating": 1.0, "helpful_vote": "three"}',
        '{"rating": 1.0} {"rating": 2.0}',
        '{"rating": 1.0} trailing',
        "17",
        "[1]",
        "null",
    ],
)
def test_strict_checks_all_fields_and_names_the_place(spark, tmp_path, bad):
    (tmp_path / "good.jsonl").write_text(f"{GOOD}\n\n[{GOOD}, {GOOD}]\n")
    assert jsonl.read_strict(spark, str(tmp_path)).select("rating").count() == 3
    (tmp_path / "bad.jsonl").write_text(f"{GOOD}\n{bad}\n")
    for action in (lambda r: r.select("rating").collect(), lambda r: r.count(), lambda r: r.agg(F.max("asin")).collect()):
        with pytest.raises(PySparkException) as error:
            action(jsonl.read_strict(spark, str(tmp_path)))
        assert "bad.jsonl block 0 row" in str(error.value) and bad[:20] in str(error.value)


@pytest.fixture
def reviews(spark):
    user = F.when(F.col("id") % 10 > 0, (F.col("id") % 40).cast("string"))
    rating = F.when(F.col("id") % 7 > 0, (1 + F.col("id") % 5).cast("double"))
    return spark.range(0, 2000, 1, 4).select(user.alias("user_id"), (F.col("id") % 333).cast("string").alias("asin"), rating.alias("rating"))


def test_steps_are_counted_by_the_job_that_runs_anyway(spark, reviews, capsys):
    counts = StepCounts()
    plain, counted = calibrate.product_delta(reviews), calibrate.product_delta(reviews, steps=counts)
    plans = []
    for df in (plain, counted):
        df.explain()
        plans.append(capsys.readouterr().out)
    assert plans[0].count("FileScan") == plans[1].count("FileScan") and plans[0].count("Exchange") == plans[1].count("Exchange")
    rows = materialise(counted).count()
    left = counts.read()
    known = reviews.groupBy("user_id").agg(F.count("rating").alias("n")).where("user_id is not null and n >= 3").select("user_id")
    assert left["joined"] == 2000 and left["rated"] == reviews.where("rating is not null").count()
    assert left["of_known_users"] == reviews.join(known, "user_id").count()
    assert left["products"] == 333 and left["chosen"] == rows <= left["calibrated"] <= 333
    assert [tuple(r) for r in counts.table(spark).collect()] == list(left.items())


def test_steps_of_an_empty_plan_and_repeated_names(spark, reviews):
    counts = StepCounts()
    counts.after("all", reviews.where("asin = 'none'"), bad=F.col("rating") < 3).collect()
    assert counts.read() == {"all": 0, "bad": 0}
    with pytest.raises(ValueError):
        counts.after("bad", reviews)
