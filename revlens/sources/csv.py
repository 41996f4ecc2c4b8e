"""CSV output of summary tables, and reading them back."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.schema import YEARLY_SCHEMA
from revlens.sources.whole import put_whole


def write_csv(
    table: DataFrame, path: str, order_by: list[str] | None = None, mode: str = "overwrite", one_file: bool = False
) -> None:
    """Write a table with a header line (starts a job), sorted by ``order_by`` if given.

    With ``one_file`` everything passes through one task: use it only for summaries
    whose size does not follow the data, such as one row per year. Otherwise the
    part files are sorted by name. ``mode="errorifexists"`` refuses an existing path.
    The path holds the whole table or what it held before, see ``whole.put_whole``.
    """
    ordered = table.orderBy(*order_by) if order_by else table
    if one_file:
        ordered = ordered.coalesce(1)

    def write(df: DataFrame, place: str) -> None:
        df.write.option("header", True).csv(place)

    def read(spark: SparkSession, place: str) -> DataFrame:
        return spark.read.schema(table.schema).option("header", True).option("multiLine", True).csv(place)

    # A NULL that is alone in its row is a blank line, which is no row when it is read.
    alone = F.col(f"`{table.columns[0]}`") if len(table.columns) == 1 else None
    put_whole(ordered, path, write, read, mode, alone)


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType = YEARLY_SCHEMA, order_by: list[str] | None = None
) -> DataFrame:
    """Read a table with a header line back, sorted by its first column by default."""
    table = spark.read.schema(schema).option("header", True).csv(path)
    return table.orderBy(*(order_by or [schema.names[0]]))


def stamped_path(base: str, name: str, when: datetime | None = None) -> str:
    """``base/name_YYYYmmdd_HHMMSS`` with the UTC time of the run."""
    moment = (when or datetime.now(timezone.utc)).astimezone(timezone.utc)
    return f"{base.rstrip('/')}/{name}_{moment:%Y%m%d_%H%M%S}"
