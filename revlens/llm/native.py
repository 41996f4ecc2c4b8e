"""Word arrays and n-gram hashes as plain Spark expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the white space that separates words.
BLANK = "[\\x20\\x09-\\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, though lambdas in it use it often."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The words of a text; NULL has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANK), lambda w: w != "")


def shingles(tokens: Column, size: int) -> Column:
    """Hashes of all windows of ``size`` tokens, in order; of fewer tokens, of them all as one."""

    def hashes(codes: Column) -> Column:
        windows = F.transform(F.sequence(F.lit(0), F.size(codes) - size), lambda i: F.xxhash64(*[F.get(codes, i + j) for j in range(size)]))
        return F.when(F.size(codes) >= size, windows).when(F.size(codes) > 0, F.array(F.xxhash64(codes))).otherwise(F.array().cast("array<bigint>"))

    return let(F.transform(tokens, lambda w: F.xxhash64(w)), hashes)
