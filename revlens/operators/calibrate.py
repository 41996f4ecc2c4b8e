"""Ratings corrected for reviewers who always rate high or low."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.functions.numbers import clamp, exact_avg, mean, round_half_up, scaled
from revlens.operators.skew import join_totals
from revlens.operators.steps import StepCounts
from revlens.session import materialise

CENTRE = 3.0
LOWEST, HIGHEST = 1.0, 5.0
MIN_REVIEWS_PER_USER = 3
MORE_THAN_PER_PRODUCT = 5


def user_averages(reviews: DataFrame) -> DataFrame:
    """Average rating (two decimals), number of ratings and number of rows per user."""
    return reviews.groupBy("user_id").agg(
        round_half_up(exact_avg(F.col("rating")), 2).alias("user_avg"),
        F.count("rating").alias("user_reviews"),
        F.count(F.lit(1)).alias("user_rows"),
    )


def calibrated_hundredths() -> Column:
    """The rating moved so that its user's average becomes 3, held within 1 and 5.

    In whole hundredths, so that sums are exact. The shift uses the rounded average.
    """
    moved = F.col("rating") + (F.lit(CENTRE) - F.col("user_avg"))
    return scaled(clamp(moved, LOWEST, HIGHEST), 2)


def with_user_averages(reviews: DataFrame, averages: DataFrame | None = None) -> DataFrame:
    """Each review with ``user_avg`` and ``user_reviews``; safe for very active users.

    ``averages`` is the stored result of ``user_averages``. It is computed and stored if
    it is not given (starts a job), so that the reviews are read twice and not more.
    """
    if averages is None:
        averages = materialise(user_averages(reviews))
    return join_totals(reviews, averages, "user_id", "user_rows").drop("user_rows")


def calibrate(
    reviews: DataFrame, min_reviews: int = MIN_REVIEWS_PER_USER, averages: DataFrame | None = None
) -> DataFrame:
    """Reviews of users with at least ``min_reviews``, with ``calibrated_rating`` added.

    Starts a job unless ``averages`` are given, see ``with_user_averages``.
    """
    return (
        with_user_averages(reviews, averages)
        .filter(F.col("user_reviews") >= min_reviews)
        .withColumn("calibrated_rating", calibrated_hundredths() / 100.0)
        .select(*reviews.columns, "calibrated_rating")
    )


def product_delta(
    reviews: DataFrame,
    min_reviews: int = MIN_REVIEWS_PER_USER,
    more_than: int = MORE_THAN_PER_PRODUCT,
    averages: DataFrame | None = None,
    steps: StepCounts | None = None,
) -> DataFrame:
    """Original and calibrated average per product, and their difference.

    Only products with more than ``more_than`` ratings and at least one calibrated
    rating. Both averages come from one pass over the joined rows. Without ``averages``
    the three columns needed are stored first and the averages are computed from them, so
    that ``reviews`` are read and parsed once (starts two jobs). ``steps`` takes the numbers of
    rows that are joined, with how many of them are rated and of users with enough ratings, of
    products, and of products that are left.
    """

    def counted(step: str, df: DataFrame, **parts: Column) -> DataFrame:
        return steps.after(step, df, **parts) if steps else df

    needed = reviews.select("user_id", "asin", "rating")
    if averages is None:
        needed = materialise(needed)
    enough = F.col("user_reviews") >= min_reviews
    calibrated = F.when(enough, calibrated_hundredths())
    joined = with_user_averages(needed, averages)
    joined = counted("joined", joined, rated=F.col("rating").isNotNull(), of_known_users=F.coalesce(enough, F.lit(False)))
    per_product = (
        joined.groupBy("asin")
        .agg(
            exact_avg(F.col("rating")).alias("orig_avg"),
            (mean(F.sum(calibrated), F.count(calibrated)) / 100.0).alias("calib_avg"),
            F.count("rating").alias("count"),
        )
    )
    products = counted("products", per_product, calibrated=F.col("calib_avg").isNotNull())
    chosen = products.filter(F.col("calib_avg").isNotNull() & (F.col("count") > more_than))
    return counted("chosen", chosen).select(
        "asin",
        "orig_avg",
        "calib_avg",
        (F.col("calib_avg") - F.col("orig_avg")).alias("delta"),
        "count",
    )


def top_delta(deltas: DataFrame, k: int = 30) -> DataFrame:
    """The ``k`` products whose average changed most, listed by original average."""
    most_changed = deltas.orderBy(F.abs("delta").desc(), "asin").limit(k)
    return most_changed.orderBy("orig_avg", "asin")
