"""Ratings of a category over the years, kept as a CSV file."""

from __future__ import annotations

from pyspark.sql import DataFrame

from revlens.operators import trend
from revlens.session import materialise
from revlens.sources.csv import write_csv


def describe_trend(reviews: DataFrame, time: str = "timestamp") -> dict[str, DataFrame]:
    """Yearly and monthly trend and the total, from one pass (starts a job).

    The monthly table, one row per month, is stored; years and total come from it.
    """
    months = materialise(trend.monthly(reviews, time))
    years = trend.yearly_of_months(months)
    return {"yearly": years.orderBy("year"), "monthly": months.orderBy("year", "month"), "total": trend.total(years)}


def save_yearly(reviews: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write the yearly trend as one sorted CSV file with a header (starts a job)."""
    write_csv(trend.yearly(reviews), path, ["year"], mode, one_file=True)
