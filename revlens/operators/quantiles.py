"""Exact quartiles of values that are nearly all different, for all groups at once.

The range of each group is cut into equal buckets, rows are counted per bucket, and the bucket in
which a quartile falls becomes the next range, until it holds one value. A round costs one pass
over groups and values and a shuffle of counts; no task sorts a group or holds more than the
counts of one range. Prices take two or three rounds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.session import materialise

_BUCKETS = 65_536
# The quartiles: their names, and the index of their element among n sorted ones.
_QUARTILES = (("q1", "n div 4"), ("median", "n div 2"), ("q3", "3 * n div 4"))


def _bucket(value: Column, low: Column, high: Column, whole: bool) -> Column:
    """Number of the equal part of the range that a value is in; never less for a larger value."""
    if whole:
        # The difference of two bigints needs one more bit than they have.
        wide = [c.cast("decimal(20,0)") for c in (value, low, high)]
        return F.floor((wide[0] - wide[1]).cast("double") / ((wide[2] - wide[1]).cast("double") + 1) * _BUCKETS).cast("int")
    # Halves, where the width of the range is beyond the largest number.
    half = F.when(high - low == float("inf"), 0.5).otherwise(1.0)
    share = (value * half - low * half) / (high * half - low * half)
    return F.least(F.floor(share * _BUCKETS), F.lit(_BUCKETS - 1)).cast("int")


def quartiles(rows: DataFrame, group: str, value: str) -> DataFrame:
    """``group, n, min, q1, median, q3, max`` of a numeric column (starts jobs).

    A quartile is the element at index ``n/4``, ``n/2`` or ``3n/4`` (rounded down) of the sorted
    values. NULL and NaN values don't count; a group without others is not listed. A NULL group is
    a group. Whole numbers stay bigints; others become doubles.
    """
    whole = isinstance(rows.schema[value].dataType, T.IntegralType)
    kind = "bigint" if whole else "double"
    values = rows.select(F.col(f"`{group}`").alias("g"), F.col(f"`{value}`").cast(kind).alias("v")).filter("v IS NOT NULL AND NOT isnan(v)")
    values = materialise(values)
    spans = values.groupBy("g").agg(F.count("v").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
    spans = materialise(spans)
    wanted = F.array(*(F.struct(F.lit(name).alias("name"), F.expr(index).alias("at")) for name, index in _QUARTILES))
    ranges = spans.select("g", F.inline(wanted), "low", "high")
    found = []
    while True:
        found.append(ranges.filter("low = high").select("g", "name", F.col("low").alias("v")))
        ranges = materialise(ranges.filter("low < high"))
        if ranges.isEmpty():
            break
        ranges = materialise(_narrowed(values, ranges, whole))
    done = found[0]
    for more in found[1:]:
        done = done.union(more)
    picked = done.groupBy("g").agg(*(F.max(F.when(F.col("name") == name, F.col("v"))).alias(name) for name, _ in _QUARTILES))
    return spans.join(picked.withColumnRenamed("g", "h"), F.col("g").eqNullSafe(F.col("h"))).select(
        F.col("g").alias(group), "n", F.col("low").alias("min"), *(name for name, _ in _QUARTILES), F.col("high").alias("max")
    )


def _narrowed(values: DataFrame, ranges: DataFrame, whole: bool) -> DataFrame:
    """Each range (g, name, at, low, high) cut down to the bucket that holds its element ``at``."""
    spans = ranges.select(F.col("g").alias("h"), "low", "high").distinct()
    inside = values.join(spans, F.col("g").eqNullSafe(F.col("h")) & F.col("v").between(F.col("low"), F.col("high")))
    bucket = _bucket(F.col("v"), F.col("low"), F.col("high"), whole)
    counts = inside.groupBy("h", "low", "high", bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("least"), F.max("v").alias("most"))
    up_to = F.sum("n").over(Window.partitionBy("h", "low", "high").orderBy("bucket"))
    placed = counts.select("h", F.col("low").alias("l"), F.col("high").alias("m"), (up_to - F.col("n")).alias("before"), up_to.alias("up_to"), "least", "most")
    same = F.col("g").eqNullSafe(F.col("h")) & (F.col("low") == F.col("l")) & (F.col("high") == F.col("m"))
    met = ranges.join(placed, same & (F.col("at") >= F.col("before")) & (F.col("at") < F.col("up_to")))
    return met.select("g", "name", (F.col("at") - F.col("before")).alias("at"), F.col("least").alias("low"), F.col("most").alias("high"))
