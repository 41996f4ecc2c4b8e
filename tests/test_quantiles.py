"""Exact quartiles of values that are nearly all different."""

import random

import pytest
from pyspark.sql import functions as F

from revlens.operators import quantiles


def expected(rows):
    groups = {}
    for g, v in rows:
        if v is not None and v == v:
            groups.setdefault(g, []).append(v)
    out = {}
    for g, vs in groups.items():
        vs.sort()
        n = len(vs)
        out[g] = (n, vs[0], vs[n // 4], vs[n // 2], vs[3 * n // 4], vs[-1])
    return out


def got(df):
    return {r[0]: tuple(r[1:]) for r in df.collect()}


@pytest.mark.parametrize("buckets", [64, 65_536])
def test_doubles_of_any_size(spark, monkeypatch, buckets):
    monkeypatch.setattr(quantiles, "_BUCKETS", buckets)
    pick = random.Random(buckets)
    makers = [lambda: pick.random(), lambda: 10.0 ** pick.randint(-300, 300), lambda: pick.choice([-1.7e308, 1.7e308, 0.0, 5e-324]), lambda: float(pick.randint(0, 3))]
    rows = [(pick.choice(["a", "b", None]), pick.choice(makers)()) for _ in range(400)]
    rows += [("one", 3.5), ("two", -1.0), ("two", 2.0), ("same", 7.0), ("same", 7.0), ("none", None), ("nan", float("nan")), ("a", float("nan")), ("b", None)]
    frame = spark.createDataFrame(rows, "g string, v double").repartition(5)
    assert got(quantiles.quartiles(frame, "g", "v")) == expected(rows)


def test_whole_numbers_keep_all_digits(spark):
    pick = random.Random(1)
    rows = [(k % 3, pick.choice([2**63 - 1, -(2**63), 2**53 + pick.randint(0, 9), pick.randint(-(2**62), 2**62)])) for k in range(300)]
    frame = spark.createDataFrame(rows, "g int, v bigint")
    assert got(quantiles.quartiles(frame, "g", "v")) == expected(rows)
    assert got(quantiles.quartiles(frame.withColumn("v", (F.col("v") % 50).cast("int")), "g", "v")) == expected([(g, int(abs(v) % 50 * (1 if v >= 0 else -1))) for g, v in rows])


def test_one_group_with_most_rows_and_many_small_ones(spark):
    rows = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 5000).alias("g"), (F.col("id") * 7919 % 60_013 / 8).alias("v"))
    assert got(quantiles.quartiles(rows, "g", "v")) == expected([tuple(r) for r in rows.collect()])


def test_empty_table(spark):
    assert quantiles.quartiles(spark.createDataFrame([], "g string, v double"), "g", "v").collect() == []
