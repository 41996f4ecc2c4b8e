"""Side-by-side comparison of product categories from a single pass over the reviews."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.functions.numbers import mean, population_stddev, sum_of_whole
from revlens.operators.distribution import quartiles_of_counts
from revlens.operators.summary import verified_columns
from revlens.operators.transform import union_labelled, with_lengths
from revlens.session import materialise
from revlens.sources.jsonl import image_count


def profile(reviews: DataFrame) -> DataFrame:
    """Counts and sums for each category, rating and text length.

    Its size follows the number of distinct ratings and lengths, not the number of
    reviews, and every report below can be computed from it.
    """
    sized = with_lengths(reviews).withColumn("n_images", image_count(F.col("images")))
    return sized.groupBy("category", "rating", "text_length").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("title_length").alias("title_length"),
        F.count("helpful_vote").alias("n_votes"),
        F.sum("helpful_vote").alias("votes"),
        F.max("helpful_vote").alias("max_votes"),
        F.count_if(F.col("helpful_vote") > 0).alias("with_votes"),
        F.count_if("verified_purchase").alias("verified"),
        F.sum("n_images").alias("images"),
    )


def summary_of(counted: DataFrame) -> DataFrame:
    n, count, length = F.col("n").cast("double"), F.col("n"), F.col("text_length")
    rated = F.when(F.col("rating").isNotNull(), F.col("n"))
    rating_sum, rating_sq = F.sum(F.col("rating") * n), F.sum(F.col("rating") * F.col("rating") * n)
    length_sum, length_sq = sum_of_whole(length, count), sum_of_whole(length, length, count)
    return counted.groupBy("category").agg(
        F.sum("n").alias("total_reviews"),
        mean(rating_sum, F.sum(rated)).alias("avg_rating"),
        population_stddev(rating_sum, rating_sq, F.sum(rated)).alias("stddev_rating"),
        mean(length_sum, F.sum("n")).alias("avg_review_length"),
        population_stddev(length_sum, length_sq, F.sum("n")).alias("stddev_review_length"),
        mean(F.sum("title_length"), F.sum("n")).alias("avg_title_length"),
        mean(F.sum("votes"), F.sum("n_votes")).alias("avg_helpful_votes"),
        F.sum("votes").alias("total_helpful_votes"),
        F.sum("verified").alias("verified_purchases"),
        mean(F.sum("images"), F.sum("n")).alias("avg_images_per_review"),
    )


def pivot_of(counted: DataFrame, categories: list[str]) -> DataFrame:
    def count_of(category: str):
        return F.sum(F.when(F.col("category") == category, F.col("n")).otherwise(0))

    return counted.groupBy("rating").agg(*(count_of(c).alias(c) for c in categories))


def quartiles_of(counted: DataFrame) -> DataFrame:
    per_length = counted.groupBy("category", "text_length").agg(F.sum("n").alias("n"))
    return quartiles_of_counts(per_length, "category", "text_length")


def helpful_of(counted: DataFrame) -> DataFrame:
    return counted.groupBy("category").agg(
        F.max("max_votes").alias("max_votes"), F.sum("with_votes").alias("reviews_with_votes")
    )


def verified_of(counted: DataFrame) -> DataFrame:
    totals = counted.groupBy("category").agg(
        F.sum("n").alias("total"), F.sum("verified").alias("verified")
    )
    return totals.select("*", *verified_columns())


def compare(by_category: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """All comparison reports. The reviews are read once (starts a job)."""
    counted = materialise(profile(union_labelled(by_category)))
    return {
        "summary": summary_of(counted).orderBy("category"),
        "ratings": pivot_of(counted, sorted(by_category)).orderBy("rating"),
        "length_quartiles": quartiles_of(counted).orderBy("category"),
        "helpfulness": helpful_of(counted).orderBy("category"),
        "verified": verified_of(counted).orderBy("category"),
    }
