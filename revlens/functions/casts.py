"""Casts from raw JSON text to typed values; what cannot be cast becomes NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from revlens.functions.dates import date_of_millis

# Texts that count as true, compared in lower case.
TRUE_TEXTS = ("1", "true", "t", "yes", "y")

# A failed cast is far slower than a pattern test, so dirty values are sorted out first.
WHOLE_NUMBER = r"^\s*[+-]?\d+\s*$"
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
NOT_FINITE = r"(?i)^\s*([+-]?inf(inity)?|nan)\s*$"


def has_value(raw: Column) -> Column:
    """True where the raw text is neither missing nor empty."""
    return raw.isNotNull() & (raw != "")


def to_int(raw: Column) -> Column:
    """Whole number; a fraction is cut towards zero (``4.5`` and ``"4.0"`` give 4)."""
    return F.when(raw.rlike(WHOLE_NUMBER), raw.try_cast("bigint")).when(
        raw.rlike(NUMBER), raw.try_cast("double").try_cast("bigint")
    )


def to_float(raw: Column) -> Column:
    return F.when(raw.rlike(NUMBER) | raw.rlike(NOT_FINITE), raw.try_cast("double"))


def to_str(raw: Column) -> Column:
    return F.coalesce(raw, F.lit(""))


def to_bool(raw: Column) -> Column:
    return F.when(has_value(raw), F.lower(raw).isin(*TRUE_TEXTS))


def to_date(raw: Column) -> Column:
    """UTC date of an epoch-millisecond text."""
    return date_of_millis(to_int(raw))


CASTS = {
    "int": to_int,
    "float": to_float,
    "str": to_str,
    "bool": to_bool,
    "date": to_date,
}


def cast_to(raw: Column, kind: str) -> Column:
    """Cast a raw text column to one of ``int float str bool date``."""
    if kind not in CASTS:
        raise ValueError(f"unknown field type {kind!r}; expected one of {sorted(CASTS)}")
    return CASTS[kind](raw)
