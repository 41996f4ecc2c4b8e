"""User-calibrated product ratings."""

from __future__ import annotations

from pyspark.sql import DataFrame

from revlens.operators import calibrate, summary
from revlens.session import materialise


def describe_calibration(
    reviews: DataFrame,
    min_reviews: int = calibrate.MIN_REVIEWS_PER_USER,
    more_than: int = calibrate.MORE_THAN_PER_PRODUCT,
    k: int = 30,
) -> dict[str, DataFrame]:
    """User averages, calibrated reviews, and products before and after (starts jobs).

    Texts are read only for the calibrated reviews. Everything else starts from the four
    columns it needs, stored once, and from the stored averages and differences.
    """
    needed = materialise(reviews.select("user_id", "asin", "rating", "helpful_vote"))
    averages = materialise(calibrate.user_averages(needed))
    deltas = materialise(calibrate.product_delta(needed, min_reviews, more_than, averages))
    return {
        "user_stats": summary.most_helpful_first(summary.user_stats(needed)),
        "calibrated_reviews": calibrate.calibrate(reviews, min_reviews, averages),
        "product_delta": deltas,
        "top_delta": calibrate.top_delta(deltas, k),
    }
