"""Samples and heads: exact sizes, stable choices, any distribution of keys."""

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from revlens.operators import sampling
from revlens.operators.sampling import head_n, sample_exact, sample_fraction, sample_repeated

from revlens.sources.jsonl import PLACE, read_lines


@pytest.fixture
def narrow_cuts(monkeypatch):
    """Force several rounds of narrowing on small tables."""
    monkeypatch.setattr(sampling, "_BUCKETS", 16)
    monkeypatch.setattr(sampling, "_PREFIX", 1)


def digest(key, seed=42):
    return hashlib.md5(f"{key}|{seed}".encode()).hexdigest()


@pytest.mark.parametrize("n", [0, 1, 7, 500, 2000])
def test_exact_sample_is_the_n_smallest_digests(spark, narrow_cuts, n):
    rows = spark.range(2000).withColumn("payload", F.col("id") * 2)
    got = sorted(r.id for r in sample_exact(rows, n, ["id"]).collect())
    assert got == sorted(sorted(range(2000), key=digest)[:n])


def test_exact_sample_refuses_too_many(spark):
    with pytest.raises(ValueError):
        sample_exact(spark.range(10), 11, ["id"])


def test_exact_sample_ignores_the_layout(spark, narrow_cuts):
    rows = spark.range(3000)
    first = {r.id for r in sample_exact(rows.repartition(1), 100, ["id"]).collect()}
    second = {r.id for r in sample_exact(rows.repartition(13), 100, ["id"]).collect()}
    other_seed = {r.id for r in sample_exact(rows, 100, ["id"], seed=7).collect()}
    assert first == second
    assert other_seed != first


def test_size_is_exact_even_if_keys_repeat(spark, narrow_cuts):
    rows = spark.range(900).withColumn("key", F.col("id") % 3)
    assert sample_exact(rows, 450, ["key"]).count() == 450


@pytest.mark.parametrize("n", [1, 10, 299, 300, 301, 5000])
def test_head_of_uneven_keys(spark, narrow_cuts, n):
    keys = [3, 10**15, -5] + [2**k for k in range(60)] + list(range(1000, 1237))
    rows = spark.createDataFrame([(k,) for k in keys], "key long").repartition(5)
    assert [r.key for r in head_n(rows, n, "key").collect()] == sorted(keys)[:n]


def test_head_with_one_hot_key(spark, narrow_cuts):
    rows = spark.range(1000).withColumn("place", F.when(F.col("id") < 10, F.col("id")).otherwise(500))
    got = head_n(rows, 400, "place")
    assert got.count() == 400
    assert got.filter("place < 500").count() == 10
    assert head_n(rows.withColumn("place", F.lit(None).cast("long")), 5, "place").count() == 0
    assert head_n(rows, 0, "place").count() == 0


def test_rows_are_read_once_by_a_pushed_filter(spark, capsys):
    events = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    head_n(events, 5000, "event_id").explain("formatted")
    plan = capsys.readouterr().out
    assert plan.count("Location: InMemoryFileIndex") == 1
    assert "LessThanOrEqual(event_id," in plan
    assert "TakeOrderedAndProject" not in plan
    sample_exact(events, 500, ["event_id"]).explain("formatted")
    plan = capsys.readouterr().out
    assert plan.count("Location: InMemoryFileIndex") == 1
    assert "events.parquet" not in plan


def test_ties_do_not_depend_on_the_layout(spark):
    rows = spark.range(4000).withColumn("key", F.col("id") % 2)
    first = {r.id for r in sample_exact(rows.repartition(1), 1500, ["key"]).collect()}
    assert first == {r.id for r in sample_exact(rows.repartition(9), 1500, ["key"]).collect()}
    heads = {r.id for r in head_n(rows.repartition(1), 2500, "key").collect()}
    assert heads == {r.id for r in head_n(rows.repartition(7), 2500, "key").collect()}
    assert len(first) == 1500 and len(heads) == 2500


def test_lines_do_not_depend_on_the_splits(spark, tmp_path):
    (tmp_path / "lines.txt").write_text("".join(f"line {i % 4000}\n" for i in range(5000)))
    found = []
    for size in ("1m", "4k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        lines = sample_repeated(read_lines(spark, str(tmp_path)), 700, PLACE)
        found.append(sorted(r.value for r in lines.collect()))
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found[0] == found[1] and len(found[0]) == 700


def test_fraction_by_key(spark):
    rows = spark.range(20_000)
    got = {r.id for r in sample_fraction(rows, 0.01, 42, ["id"]).collect()}
    assert got == {i for i in range(20_000) if digest(i)[:8] < "028f5c28"}
    assert sample_fraction(rows, 1.0, 42, ["id"]).count() == 20_000
    assert sample_fraction(rows, 0.0, 42, ["id"]).count() == 0


def test_fraction_by_position_is_repeatable(spark):
    rows = spark.range(20_000)
    first = sample_fraction(rows, 0.05).collect()
    assert first == sample_fraction(rows, 0.05).collect()
    assert 700 < len(first) < 1300


@pytest.mark.parametrize("n", [700, 4990, 5000])
def test_draws_of_repeated_rows_take_each_copy_once(spark, narrow_cuts, monkeypatch, n):
    monkeypatch.setattr(sampling, "_PIECE", 7)
    copies = {f"v{k}": 1 + (k * k) % 40 for k in range(253)}
    copies["hot"] = 5000 - sum(copies.values())
    values = [v for v, c in copies.items() for _ in range(c)]
    rows = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "value string, at int").repartition(7)
    for few in (100_000, 0):
        monkeypatch.setattr(sampling, "_FEW", few)
        got = sample_repeated(rows, n, ["at"]).collect()
        assert len(got) == n
        taken = Counter(r.value for r in got)
        assert all(c <= copies[v] for v, c in taken.items())
        assert {(r.value, r.at) for r in got} == {(v, values.index(v)) for v in taken}


def test_draws_of_a_content_with_a_billion_copies(spark):
    codes = [hashlib.md5(str(i).encode()).hexdigest() for i in range(1000)]
    counted = spark.createDataFrame([(c, 10**9 if i == 7 else 10**6) for i, c in enumerate(codes)], "code string, copies bigint")
    got = Counter(r.code for r in sampling.sample_counted(counted, 10_000).collect())
    assert sum(got.values()) == 10_000
    assert 4700 < got[codes[7]] < 5300  # 5003 expected, standard deviation 50
    assert len(got) > 950
    with pytest.raises(ValueError):
        sampling.sample_counted(counted, 2 * 10**9)


def test_draws_are_uniform(spark):
    counted = spark.createDataFrame([(f"{i:04x}" + "0" * 28, 1 + i % 4) for i in range(400)], "code string, copies int")
    total = Counter()
    for seed in range(6):
        total.update(int(r.code[:4], 16) for r in sampling.sample_counted(counted, 300, seed).collect())
    by_copies = [sum(c for i, c in total.items() if i % 4 == k) for k in range(4)]
    assert all(abs(c - 180 * (k + 1)) < 6 * (180 * (k + 1) * 0.7) ** 0.5 for k, c in enumerate(by_copies))
