"""Distributions: pivots, exact quartiles, histograms and vote bands.

Each starts from a grouped count, so that what is windowed or binned afterwards is one
row per distinct value and not one row per review.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlens.functions.numbers import mean, scaled
from revlens.functions.text import length_or_zero
from revlens.operators.summary import length_by_votes

# Vote bands, lower bound included and upper bound excluded; the last is open.
VOTE_BANDS = (
    ("Low", 0, 20),
    ("Medium-low", 20, 40),
    ("Medium", 40, 60),
    ("Medium-high", 60, 80),
    ("High", 80, None),
)


def rating_pivot(reviews: DataFrame, categories: list[str]) -> DataFrame:
    """Ratings by category: one count column per category, 0 where there is none."""
    counts = [F.count_if(F.col("category") == c).alias(c) for c in categories]
    return reviews.groupBy("rating").agg(*counts)


def length_counts(reviews: DataFrame) -> DataFrame:
    """Number of reviews for each category and text length."""
    sized = reviews.select("category", length_or_zero(F.col("text")).alias("text_length"))
    return sized.groupBy("category", "text_length").agg(F.count(F.lit(1)).alias("n"))


def quartiles_of_counts(counts: DataFrame, group: str, value: str, n: str = "n") -> DataFrame:
    """Minimum, quartiles and maximum of counted values, exact.

    A quartile is the element at index ``n/4``, ``n/2`` or ``3n/4`` (rounded down) of the
    sorted values, which is the smallest value with more than that many values up to it.
    """
    running = Window.partitionBy(group).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(group)
    ranked = counts.select(
        group,
        F.col(value).alias("_value"),
        F.sum(n).over(running).alias("_up_to"),
        F.sum(n).over(whole).alias("_total"),
    )

    def at(index: str) -> Column:
        return F.min(F.when(F.col("_up_to") > F.expr(index), F.col("_value")))

    return ranked.groupBy(group).agg(
        F.min("_value").alias("min_length"),
        at("_total div 4").alias("q1_length"),
        at("_total div 2").alias("median_length"),
        at("3 * _total div 4").alias("q3_length"),
        F.max("_value").alias("max_length"),
    )


def length_quartiles(reviews: DataFrame) -> DataFrame:
    """Exact quartiles of the text length for each category."""
    return quartiles_of_counts(length_counts(reviews), "category", "text_length")


def rating_counts(reviews: DataFrame) -> DataFrame:
    """Number of reviews for each rating."""
    return reviews.dropna(subset=["rating"]).groupBy("rating").agg(F.count(F.lit(1)).alias("n"))


def _binned(counts: DataFrame, bin_of: Column, edges: Column, bins: int) -> DataFrame:
    """Counts per bin 1 to ``bins`` with the bin edges, in one row per bin."""
    sums = [
        F.coalesce(F.sum(F.when(bin_of == b, F.col("n"))), F.lit(0)).alias(f"n{b}")
        for b in range(1, bins + 1)
    ]
    one_row = counts.agg(*sums, edges.alias("edges"))
    rows = F.array(
        *(
            F.struct(
                F.lit(b).alias("bin"),
                F.col("edges")[b - 1].alias("low"),
                F.col("edges")[b].alias("high"),
                F.col(f"n{b}").alias("n"),
            )
            for b in range(1, bins + 1)
        )
    )
    return one_row.select(F.inline(rows))


def rating_histogram(reviews: DataFrame, stars: int = 5) -> DataFrame:
    """One bin per star, with edges halfway between stars; other ratings are left out."""
    top = stars + 0.5
    bin_of = F.when(F.col("rating") == top, stars).otherwise(F.floor(F.col("rating") + 0.5))
    edges = F.array(*(F.lit(s + 0.5) for s in range(stars + 1)))
    return _binned(rating_counts(reviews), bin_of, edges, stars)


def equal_width_histogram(reviews: DataFrame, bins: int = 5) -> DataFrame:
    """Bins of equal width between the lowest and the highest rating.

    The highest rating falls in the last bin. If all ratings are equal the range is
    widened by half a star on both sides.
    """
    counts = rating_counts(reviews)
    # Reading n here too keeps both uses of the counts alike, so they are computed once.
    counted = F.when(F.col("n") > 0, F.col("rating"))
    lowest, highest = F.min(counted), F.max(counted)
    pad = F.when(lowest == highest, 0.5).otherwise(0.0)
    span = counts.agg(F.struct((lowest - pad).alias("low"), (highest + pad).alias("high")).alias("span"))
    spanned = counts.withColumn("_span", span.scalar())
    low, width = F.col("_span.low"), F.col("_span.high") - F.col("_span.low")
    edge = [low + width * b / bins for b in range(bins + 1)]
    bin_of = sum((F.col("rating") >= e).cast("int") for e in edge[:bins])
    edges = F.array(*edge)
    return _binned(spanned, bin_of, F.first(edges, ignorenulls=True), bins)


def length_by_vote_band(reviews: DataFrame) -> DataFrame:
    """Unweighted mean, per vote band, of the average text lengths per vote count.

    All bands are listed; an empty one has a NULL mean. The per-vote averages have two
    decimals, so they are added up in whole hundredths.
    """
    per_vote = length_by_votes(reviews)
    hundredths = scaled(F.col("avg_length"), 2)

    def band_mean(low: int, high: int | None) -> Column:
        below = F.lit(True) if high is None else F.col("helpful_vote") < high
        inside = F.when((F.col("helpful_vote") >= low) & below, hundredths)
        return mean(F.sum(inside), F.count(inside)) / 100.0

    one_row = per_vote.agg(*(band_mean(low, high).alias(name) for name, low, high in VOTE_BANDS))
    rows = F.array(
        *(
            F.struct(F.lit(name).alias("band"), F.col(f"`{name}`").alias("mean_of_means"))
            for name, _, _ in VOTE_BANDS
        )
    )
    return one_row.select(F.inline(rows))
