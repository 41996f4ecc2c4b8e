"""Descriptive statistics: one grouped aggregate each, combined before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.functions.numbers import (
    exact_avg,
    mean,
    population_stddev,
    round_half_up,
    sum_of_squares,
    sum_of_whole,
)
from revlens.functions.text import length_or_zero
from revlens.operators.transform import with_lengths, with_star
from revlens.sources.jsonl import image_count

GOOD_FROM = 4.0
BAD_BELOW = 3.0


def is_good() -> Column:
    return F.col("rating") >= GOOD_FROM


def is_bad() -> Column:
    return F.col("rating") < BAD_BELOW


def rating_stats(reviews: DataFrame) -> DataFrame:
    """Count, mean, population standard deviation, minimum and maximum of the rating."""
    rating = F.col("rating")
    return reviews.agg(
        F.count(rating).alias("n"),
        exact_avg(rating).alias("avg_rating"),
        population_stddev(F.sum(rating), sum_of_squares(rating), F.count(rating)).alias("stddev_rating"),
        F.min(rating).alias("min_rating"),
        F.max(rating).alias("max_rating"),
    )


def rating_by_votes(reviews: DataFrame) -> DataFrame:
    """Average rating and number of ratings for each number of helpful votes."""
    return reviews.groupBy("helpful_vote").agg(
        exact_avg(F.col("rating")).alias("avg_rating"), F.count("rating").alias("n")
    )


def votes_up_to(by_votes: DataFrame, most: int = 20) -> DataFrame:
    """Only the groups with at most ``most`` votes and at least one rating."""
    return by_votes.filter((F.col("helpful_vote") <= most) & (F.col("n") > 0))


def split_counts(reviews: DataFrame, condition: Column, name: str) -> DataFrame:
    """Number of rated reviews with and without a property, as ``name`` 1 and 0."""
    flagged = reviews.select(condition.cast("int").alias(name)).dropna()
    return flagged.groupBy(name).agg(F.count(F.lit(1)).alias("n"))


def good_share(reviews: DataFrame) -> DataFrame:
    """Good and other ratings in one row, with their percentages; 0 when absent."""
    counts = reviews.agg(
        F.count_if(is_good()).alias("good"), F.count_if(~is_good()).alias("not_good")
    )
    total = F.col("good") + F.col("not_good")
    return counts.select(
        "good",
        "not_good",
        mean(100 * F.col("good"), total).alias("good_percent"),
        mean(100 * F.col("not_good"), total).alias("not_good_percent"),
    )


def average_length(reviews: DataFrame) -> DataFrame:
    """Average text length over all rows."""
    length = length_or_zero(F.col("text"))
    return reviews.agg(exact_avg(length).alias("avg_length"), F.count(length).alias("n"))


def length_by_rating(reviews: DataFrame) -> DataFrame:
    """Average text length for each exact rating."""
    return reviews.groupBy("rating").agg(
        exact_avg(length_or_zero(F.col("text"))).alias("avg_length")
    )


def length_by_star(reviews: DataFrame) -> DataFrame:
    """Average text length for stars 1 to 5, two decimals."""
    length = length_or_zero(F.col("text"))
    return with_star(reviews).groupBy("star").agg(round_half_up(exact_avg(length), 2).alias("avg_length"))


def length_by_votes(reviews: DataFrame) -> DataFrame:
    """Average text length for each number of helpful votes, two decimals."""
    length = length_or_zero(F.col("text"))
    return reviews.groupBy("helpful_vote").agg(
        round_half_up(exact_avg(length), 2).alias("avg_length")
    )


def category_summary(reviews: DataFrame) -> DataFrame:
    """Side-by-side statistics of each category."""
    rating, length = F.col("rating"), F.col("text_length")
    sized = with_lengths(reviews).withColumn("n_images", image_count(F.col("images")))
    return sized.groupBy("category").agg(
        F.count(F.lit(1)).alias("total_reviews"),
        exact_avg(rating).alias("avg_rating"),
        population_stddev(F.sum(rating), sum_of_squares(rating), F.count(rating)).alias("stddev_rating"),
        exact_avg(length).alias("avg_review_length"),
        population_stddev(F.sum(length), sum_of_whole(length, length), F.count(length)).alias(
            "stddev_review_length"
        ),
        exact_avg(F.col("title_length")).alias("avg_title_length"),
        exact_avg(F.col("helpful_vote")).alias("avg_helpful_votes"),
        F.sum("helpful_vote").alias("total_helpful_votes"),
        F.count_if("verified_purchase").alias("verified_purchases"),
        exact_avg(F.col("n_images")).alias("avg_images_per_review"),
    )


def helpful_by_category(reviews: DataFrame) -> DataFrame:
    """Most helpful votes, and number of reviews with any, for each category."""
    return reviews.groupBy("category").agg(
        F.max("helpful_vote").alias("max_votes"),
        F.count_if(F.col("helpful_vote") > 0).alias("reviews_with_votes"),
    )


def verified_by_category(reviews: DataFrame) -> DataFrame:
    """Verified and other reviews for each category, with the verified percentage."""
    counted = reviews.groupBy("category").agg(
        F.count(F.lit(1)).alias("total"), F.count_if("verified_purchase").alias("verified")
    )
    return counted.select("*", *verified_columns())


def verified_columns() -> list[Column]:
    return [
        (F.col("total") - F.col("verified")).alias("unverified"),
        mean(100 * F.col("verified"), F.col("total")).alias("verified_percent"),
    ]


def user_stats(reviews: DataFrame) -> DataFrame:
    """Average rating and helpfulness (two decimals) and number of reviews per user."""
    return reviews.groupBy("user_id").agg(
        round_half_up(exact_avg(F.col("rating")), 2).alias("avg_rating"),
        round_half_up(exact_avg(F.col("helpful_vote")), 2).alias("avg_helpfulness"),
        F.count("rating").alias("review_count"),
    )


def most_helpful_first(stats: DataFrame) -> DataFrame:
    return stats.orderBy(F.col("avg_helpfulness").desc(), "user_id")


def product_average(reviews: DataFrame, rating: str = "rating") -> DataFrame:
    """Average of the named rating column and number of ratings per product."""
    return reviews.groupBy("asin").agg(
        exact_avg(F.col(rating)).alias("avg_rating"), F.count(rating).alias("n")
    )
