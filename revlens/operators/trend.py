"""Ratings over time, by UTC year and month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.functions.dates import utc_date
from revlens.functions.numbers import exact_avg, mean
from revlens.operators.transform import dated_and_rated


def _trend_columns() -> list[Column]:
    rating = F.col("rating")
    return [
        exact_avg(rating).alias("avg_rating"),
        F.count(rating).alias("num_ratings"),
        F.sum(rating).alias("rating_sum"),
    ]


def yearly(reviews: DataFrame, time: str = "timestamp") -> DataFrame:
    """Average rating and number of ratings per year."""
    year = F.year(utc_date(reviews, time)).alias("year")
    dated = dated_and_rated(reviews, time).select(year, "rating")
    return dated.groupBy("year").agg(*_trend_columns()).drop("rating_sum")


def monthly(reviews: DataFrame, time: str = "timestamp") -> DataFrame:
    """Average rating, number and sum of ratings per month.

    ``label`` is ``YYYY-MM`` and ``month_start`` the first day of the month.
    """
    day = utc_date(reviews, time)
    dated = dated_and_rated(reviews, time).select(
        F.year(day).alias("year"), F.month(day).alias("month"), "rating"
    )
    return (
        dated.groupBy("year", "month")
        .agg(*_trend_columns())
        .withColumns(
            {
                "label": F.format_string("%d-%02d", "year", "month"),
                "month_start": F.make_date("year", "month", F.lit(1)),
            }
        )
    )


def yearly_of_months(months: DataFrame) -> DataFrame:
    """The yearly trend from a monthly one, without reading the reviews again."""
    return (
        months.groupBy("year")
        .agg(
            mean(F.sum("rating_sum"), F.sum("num_ratings")).alias("avg_rating"),
            F.sum("num_ratings").alias("num_ratings"),
        )
    )


def total(trend: DataFrame) -> DataFrame:
    """Number of ratings over the whole trend."""
    return trend.agg(F.sum("num_ratings").alias("total_ratings"))
