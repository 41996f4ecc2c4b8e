"""Labels, unions, derived columns and row filters."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.functions.text import length_or_zero


def labelled(reviews: DataFrame, category: str) -> DataFrame:
    """Add the category as a constant column."""
    return reviews.withColumn("category", F.lit(category))


def union_labelled(by_category: Mapping[str, DataFrame]) -> DataFrame:
    """All rows of several datasets, each labelled; missing columns become NULL."""
    parts = [labelled(reviews, category) for category, reviews in by_category.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def with_lengths(reviews: DataFrame) -> DataFrame:
    """Add ``text_length`` and ``title_length``; 0 for a missing or empty string."""
    return reviews.withColumns(
        {
            "text_length": length_or_zero(F.col("text")),
            "title_length": length_or_zero(F.col("title")),
        }
    )


def verified_only(reviews: DataFrame) -> DataFrame:
    return reviews.filter(F.col("verified_purchase"))


def with_star(reviews: DataFrame) -> DataFrame:
    """Add ``star``, the rating cut to a whole number, and keep stars 1 to 5."""
    rating = F.col("rating")
    star = F.when((rating >= 1) & (rating < 6), rating).cast("int")
    return reviews.withColumn("star", star).filter(F.col("star").isNotNull())


def dated_and_rated(reviews: DataFrame, time: str = "timestamp") -> DataFrame:
    """Drop rows without a time or a rating."""
    return reviews.dropna(subset=[time, "rating"])


def step_counts(reviews: DataFrame, steps: Mapping[str, Column]) -> DataFrame:
    """Rows that pass each named condition, counted in one pass: ``step, n``."""
    counted = reviews.agg(*(F.count_if(condition).alias(step) for step, condition in steps.items()))
    pairs = F.array(*(F.struct(F.lit(s).alias("step"), F.col(f"`{s}`").alias("n")) for s in steps))
    return counted.select(F.inline(pairs))
