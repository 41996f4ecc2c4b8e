"""Length and vocabulary of the texts of each star rating, and lengths by helpful votes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.functions.text import STOP_WORDS
from revlens.operators.distribution import length_by_vote_band, rating_histogram
from revlens.operators.summary import length_by_star, length_by_votes
from revlens.operators.words import highest_frequency, top_words
from revlens.session import materialise


def describe_texts(
    reviews: DataFrame, k: int = 10, stop_words: Sequence[str] | DataFrame = STOP_WORDS
) -> dict[str, DataFrame]:
    """One pass over the texts for each report but ``highest_frequency`` (starts a job).

    The most frequent words, at most ``5 * k`` rows, are stored for the second report.
    """
    top = materialise(top_words(reviews, k, stop_words))
    return {
        "length_by_star": length_by_star(reviews).orderBy("star"),
        "top_words": top.orderBy("star", "rank"),
        "highest_frequency": highest_frequency(top),
        "length_by_votes": length_by_votes(reviews).orderBy(F.col("helpful_vote").desc()),
        "length_by_vote_band": length_by_vote_band(reviews),
        "rating_histogram": rating_histogram(reviews),
    }
