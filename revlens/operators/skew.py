"""Joining rows to per-key totals when a few keys hold much of the data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_HOT_KEYS = 10_000
MIN_HOT_ROWS = 100_000
_LANES = 1024


def join_totals(
    rows: DataFrame,
    totals: DataFrame,
    key: str,
    size: str,
    max_hot_keys: int = MAX_HOT_KEYS,
    min_hot_rows: int = MIN_HOT_ROWS,
) -> DataFrame:
    """Left join ``rows`` to ``totals``, a stored table with one row per key of these rows.

    ``size`` is the column of ``totals`` that says how many rows a key has. A key is hot
    when it has more than ``1/max_hot_keys`` of all rows (and more than
    ``min_hot_rows``): there are fewer than ``max_hot_keys`` of them however large the
    data, so their totals are broadcast. All other keys meet their totals in an ordinary
    join, in which hot rows and rows without a key only pass through, spread by the task
    that read them. A task that runs again has the same number, so retries change nothing.
    """
    values = [c for c in totals.columns if c != key]
    row_count = totals.agg(F.sum(size).alias("n")).scalar()
    cut = F.greatest(row_count / max_hot_keys, F.lit(float(min_hot_rows)))
    packed = totals.filter(F.col(key).isNotNull()).select(
        key, F.struct(*values).alias("_cold"), F.pmod(F.xxhash64(key), F.lit(_LANES)).alias("_lane")
    )
    hot = packed.filter(F.col(f"_cold.{size}") > cut).select(key, F.col("_cold").alias("_hot"))
    is_cold = F.col("_hot").isNull() & F.col(key).isNotNull()
    lane = F.when(is_cold, F.pmod(F.xxhash64(key), F.lit(_LANES))).otherwise(
        F.spark_partition_id() + _LANES
    )
    return (
        rows.join(F.broadcast(hot), key, "left")
        .withColumn("_lane", lane)
        .join(packed, [key, "_lane"], "left")
        .withColumn("_totals", F.coalesce("_hot", "_cold"))
        .select(*rows.columns, "_totals.*")
    )
