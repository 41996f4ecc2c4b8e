"""Word frequencies for each star rating."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revlens.functions.numbers import round_half_up
from revlens.functions.text import JUNK_TOKENS, STOP_WORDS, tokens
from revlens.operators.transform import with_star
from revlens.session import materialise

BUCKETS = 1 << 14


def _words(reviews: DataFrame, left_out: Sequence[str]) -> DataFrame:
    """``star, word`` of every token that is neither junk nor left out."""
    words = with_star(reviews).select("star", F.explode(tokens(F.col("text"))).alias("word"))
    return words.filter(~F.col("word").isin(*JUNK_TOKENS, *left_out))


def word_counts(reviews: DataFrame, stop_words: Sequence[str] | DataFrame = STOP_WORDS) -> DataFrame:
    """Occurrences of each word in the texts of each star rating: ``star, word, n``.

    A long list of stop words is given as a DataFrame, its first column holding the words.
    They are taken out of the counts by an anti join; whether they are few enough to be
    broadcast is left to the engine, which knows the size of the list.
    """
    kept = _words(reviews, () if isinstance(stop_words, DataFrame) else stop_words)
    counts = kept.groupBy("star", "word").agg(F.count(F.lit(1)).alias("n"))
    if isinstance(stop_words, DataFrame):
        known = stop_words.select(F.col(stop_words.columns[0]).alias("word"))
        counts = counts.join(known, "word", "left_anti").select("star", "word", "n")
    return counts


def _ranked(counts: DataFrame, k: int) -> DataFrame:
    """The ``k`` largest ``n`` of each star, every task cutting its rows to ``k`` before the shuffle."""
    ranking = Window.partitionBy("star").orderBy(F.col("n").desc(), "word")
    return counts.withColumn("rank", F.row_number().over(ranking)).filter(F.col("rank") <= k)


def frequent_words(words: DataFrame, k: int, buckets: int = BUCKETS) -> tuple[DataFrame, DataFrame]:
    """(counts, totals) of ``star, word`` rows; ``counts`` hold the ``k`` most frequent words of each star.

    Three passes in place of a shuffle of the whole vocabulary (starts two jobs). Words are
    counted by a hash of ``buckets`` values; no word occurs more often than its bucket. The
    words of the ``k`` largest buckets of a star are counted; the ``k``-th largest of these
    counts is a bound. Last, words of buckets that reach the bound are counted: a word of any
    other bucket is rarer than ``k`` known ones. No bucket is left out on a tie, so the
    result is exact for any hash. Both stored tables have at most ``buckets`` rows per star.
    """
    hashed = words.withColumn("bucket", F.pmod(F.xxhash64("word"), F.lit(buckets)).cast("int"))
    sums = materialise(hashed.groupBy("star", "bucket").agg(F.count(F.lit(1)).alias("n")))
    largest = _ranked(sums.withColumnRenamed("bucket", "word"), k).select("star", F.col("word").alias("bucket"))

    def counted(of: DataFrame) -> DataFrame:
        met = hashed.join(F.broadcast(of), ["star", "bucket"], "left_semi")
        return met.groupBy("star", "word").agg(F.count(F.lit(1)).alias("n"))

    known = _ranked(counted(largest), k).groupBy("star")
    bounds = materialise(known.agg(F.min(F.when(F.col("rank") == k, F.col("n"))).alias("bound")))
    reached = sums.join(F.broadcast(bounds), "star").filter(F.col("n") >= F.coalesce("bound", F.lit(0)))
    return counted(reached.select("star", "bucket")), sums.groupBy("star").agg(F.sum("n").alias("total"))


def top_words(
    reviews: DataFrame,
    k: int = 10,
    stop_words: Sequence[str] | DataFrame = STOP_WORDS,
    bounded: bool = False,
) -> DataFrame:
    """The ``k`` most frequent words of each star rating and their share of its words.

    The words come from the counts of all words, or with ``bounded`` from ``frequent_words``
    (starts two jobs; stop words must then be a list). The texts are read once or three times:
    ``bounded`` pays where words hardly repeat within a task, so that counting before the
    shuffle does not shrink them. Ranks come from a window that carries nothing but the
    rank, so every task cuts its words to ``k`` per star before the shuffle. The totals (at
    most five rows, one per star) are broadcast.
    """
    if bounded and isinstance(stop_words, DataFrame):
        raise ValueError("bounded top words take their stop words as a list")
    if bounded:
        counts, totals = frequent_words(_words(reviews, stop_words), k)
    else:
        counts = word_counts(reviews, stop_words)
        totals = counts.groupBy("star").agg(F.sum("n").alias("total"))
    share = round_half_up(F.col("n") / F.col("total"), 5)
    return _ranked(counts, k).join(F.broadcast(totals), "star").select(
        "star", "rank", "word", "n", share.alias("freq")
    )


def highest_frequency(top: DataFrame) -> DataFrame:
    """Largest share among all stars, the common scale of a set of charts."""
    return top.agg(F.max("freq").alias("max_freq"))
