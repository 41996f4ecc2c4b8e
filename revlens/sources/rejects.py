"""Lenient reading that accounts for every line: records, rejected lines, and counts of both.

The lines are parsed once. That pass writes records and rejected lines side by side and counts
them on its way, by reason, and by field whose value could not be cast. Its tasks write their
results themselves, so a task that runs again after a lost executor counts once.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from revlens.functions.casts import cast_to, has_value
from revlens.operators.steps import rows_of
from revlens.schema import REVIEW_FIELDS
from revlens.session import materialise
from revlens.sources.jsonl import is_json, read_lines, unpacked

BLANK, BROKEN, NO_OBJECT = "blank", "broken", "not an object"
# Casts that a value can fail; any other text is a text or a flag.
_FALLIBLE = ("int", "float", "date")


class Accounted(NamedTuple):
    """``records`` and ``rejects`` are stored tables; ``counts`` has lines = records + rejects by reason.

    ``failed_<field>`` counts the records in which a value is there but could not be cast.
    """

    records: DataFrame
    rejects: DataFrame
    counts: dict[str, int]


def sorted_out(lines: DataFrame, fields: Mapping[str, str], column: str = "value") -> DataFrame:
    """Every line once: the other columns, the line if it is rejected, ``reason``, ``failed``, and the typed fields.

    ``reason`` is NULL for a record; ``failed`` lists its fields whose value could not be cast.
    """
    kept = [c for c in lines.columns if c != column]
    found, one = unpacked(lines, fields, column, [*kept, column])
    raw = found.select(*kept, F.col(column).alias("_line"), F.coalesce(one, F.lit(False)).alias("_one"), F.get("r", F.lit(0)).alias("_raw"))
    line = F.col("_line")
    reason = (
        F.when(F.col("_one"), F.lit(None).cast("string"))
        .when(~F.coalesce(line.rlike(r"\S"), F.lit(False)), BLANK)
        .when(is_json(line), NO_OBJECT)
        .otherwise(BROKEN)
    )
    value = {name: F.when(F.col("_one"), F.col(f"_raw.`{name}`")) for name in fields}
    failed = [F.when(has_value(value[n]) & cast_to(value[n], kind).isNull(), F.lit(n)) for n, kind in fields.items() if kind in _FALLIBLE]
    return raw.select(
        *kept,
        F.when(~F.col("_one"), line).alias(column),
        reason.alias("reason"),
        F.array_compact(F.array(*failed)).cast("array<string>").alias("failed"),
        *(cast_to(value[name], kind).alias(name) for name, kind in fields.items()),
    )


def accounted(lines: DataFrame, fields: Mapping[str, str], column: str = "value") -> Accounted:
    """Records, rejected lines with their places, and counts, from one pass over ``lines`` (starts a job)."""
    kept = [c for c in lines.columns if c != column]
    taken = {c: f"_kept_{c}" for c in kept}  # a place may be called like a field
    marked = sorted_out(lines.withColumnsRenamed(taken).withColumnRenamed(column, "_kept_line"), fields, "_kept_line")
    reason = F.col("reason")
    counting = Observation()
    observed = marked.observe(
        counting,
        F.count(F.lit(1)).alias("lines"),
        F.count_if(reason.isNull()).alias("records"),
        *(F.count_if(reason == r).alias(r) for r in (BLANK, BROKEN, NO_OBJECT)),
        *(F.count_if(F.array_contains("failed", n)).alias(f"failed_{n}") for n, kind in fields.items() if kind in _FALLIBLE),
    )
    stored = materialise(observed.withColumn("_is_record", reason.isNull()), ["_is_record"])
    places = [F.col(c).alias(name) for name, c in taken.items()]
    named = [F.col(f"`{name}`") for name in fields if name not in kept]
    return Accounted(
        stored.filter("_is_record").select(*places, *named),
        stored.filter("NOT _is_record").select(*places, F.col("_kept_line").alias(column), "reason"),
        counting.get,
    )


def read_accounted(spark: SparkSession, path: str | list[str], fields: Mapping[str, str] = REVIEW_FIELDS) -> Accounted:
    """``read_lenient`` with an account of what it drops; rejected lines come with file, block and row."""
    return accounted(read_lines(spark, path), fields)


def counts_table(spark: SparkSession, counts: Mapping[str, int]) -> DataFrame:
    """The counts as rows ``what, n``, in their order."""
    return rows_of(spark, counts, "what")
