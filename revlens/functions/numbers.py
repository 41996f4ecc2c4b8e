"""Rounding, ratios and spread, written so that results do not depend on partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def scaled(value: Column, digits: int) -> Column:
    """``value * 10^digits`` rounded to the nearest whole number, ties upwards (BIGINT)."""
    return F.floor(value * F.lit(float(10**digits)) + F.lit(0.5))


def round_half_up(value: Column, digits: int) -> Column:
    """``value`` rounded to ``digits`` decimals, ties upwards.

    Differs from a half-even rounding only where the value is an exact tie.
    """
    return scaled(value, digits) / F.lit(float(10**digits))


def mean(total: Column, n: Column) -> Column:
    """``total / n`` as a double; NULL for an empty group."""
    return F.when(n > 0, total.cast("double") / n)


def exact_avg(value: Column) -> Column:
    """Average as sum over count.

    The sum of whole or half ratings, lengths and votes is exact in a double up to
    2^53, so the result is the same for every partitioning of the input.
    """
    return mean(F.sum(value), F.count(value))


def population_stddev(total: Column, total_sq: Column, n: Column) -> Column:
    """Population standard deviation from a sum, a sum of squares and a count."""
    total, total_sq = total.cast("double"), total_sq.cast("double")  # rounded once, at the end
    spread = n * total_sq - total * total
    return F.when(n > 0, F.sqrt(F.greatest(spread, F.lit(0.0))) / n)


def sum_of_squares(value: Column) -> Column:
    """Sum of squares in double: for ratings, whose squares are small."""
    as_double = value.cast("double")
    return F.sum(as_double * as_double)


def sum_of_whole(*factors: Column) -> Column:
    """Sum of a product of whole numbers, exact up to 38 digits whatever the order of rows."""
    product = factors[0].cast("decimal(38,0)")
    for factor in factors[1:]:
        product = (product * factor.cast("decimal(38,0)")).cast("decimal(38,0)")
    return F.sum(product)


def clamp(value: Column, low: float, high: float) -> Column:
    """``value`` held within [low, high]; NULL stays NULL."""
    held = F.greatest(F.lit(low), F.least(F.lit(high), value))
    return F.when(value.isNotNull(), held)
