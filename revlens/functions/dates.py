"""UTC calendar dates that do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MILLIS_PER_DAY = 86_400_000
# First and last day of the years 1 to 9999; times outside of them have no date.
_DAYS = (-719_162, 2_932_896)


def date_of_millis(millis: Column) -> Column:
    """UTC date of an epoch-millisecond value; NULL outside of the years 1 to 9999."""
    days = F.floor(millis / F.lit(MILLIS_PER_DAY))
    return F.date_from_unix_date(F.when(days.between(*_DAYS), days).cast("int"))


def utc_date(df: DataFrame, column: str) -> Column:
    """UTC date of ``column``: epoch milliseconds, an instant, or a zone-less time."""
    kind = df.schema[column].dataType
    value = F.col(column)
    if isinstance(kind, (T.DateType, T.TimestampNTZType)):
        return value.cast("date")
    if isinstance(kind, T.TimestampType):
        return date_of_millis(F.unix_millis(value))
    return date_of_millis(value)


def millis_of(zoneless: Column) -> Column:
    """Epoch milliseconds of a zone-less timestamp read as UTC."""
    days = F.unix_date(zoneless.cast("date")).cast("bigint")
    minutes_of_day = F.hour(zoneless) * 60 + F.minute(zoneless)
    millis_of_minute = F.floor(F.extract(F.lit("SECOND"), zoneless) * 1000).cast("bigint")
    return days * MILLIS_PER_DAY + minutes_of_day * 60_000 + millis_of_minute
