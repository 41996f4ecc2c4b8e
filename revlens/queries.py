"""Every operator as a named query over the given tables: ``(spark, folder) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.functions.dates import millis_of
from revlens.functions.text import count_label, percent_label, title_label
from revlens.operators import (
    calibrate,
    distribution,
    quantiles,
    sampling,
    steps,
    summary,
    transform,
    trend,
    words,
)
from revlens.plans import category_comparison
from revlens.session import materialise
from revlens.sources import rejects
from revlens.sources.jsonl import parse_lenient, parse_strict, typed, with_defaults
from revlens.sources.views import document_reviews, fine_reviews, order_prices, order_reviews, reviews_of, table

Query = Callable[[SparkSession, str], DataFrame]

CATEGORIES = ["book", "video_game"]
HEAD_ROWS = 5000
SAMPLE_ROWS = 150
SAMPLE_FRACTION = 0.01
SEED = 42


def _over(view: Query, operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: operator(view(spark, folder))


def _as_text(df: DataFrame, *columns: str) -> DataFrame:
    """Dates and flags with NULLs as text, which compares the same in every engine."""
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


def _monthly_trend(reviews: DataFrame) -> DataFrame:
    months = trend.monthly(reviews, "review_ts").drop("rating_sum")
    return _as_text(months, "month_start")


def _verified_by_votes(reviews: DataFrame) -> DataFrame:
    return summary.rating_by_votes(transform.verified_only(reviews))


def _good_split(reviews: DataFrame) -> DataFrame:
    return summary.split_counts(transform.verified_only(reviews), summary.is_good(), "is_good")


def _bad_split(reviews: DataFrame) -> DataFrame:
    return summary.split_counts(reviews, summary.is_bad(), "is_bad")


def _row_count(reviews: DataFrame) -> DataFrame:
    return transform.step_counts(
        reviews,
        {
            "all": F.lit(True),
            "dated_and_rated": F.col("timestamp").isNotNull() & F.col("rating").isNotNull(),
            "verified": F.col("verified_purchase"),
            "good": summary.is_good(),
        },
    )


def _price_quartiles(spark: SparkSession, folder: str) -> DataFrame:
    """Quartiles of the prices, of which nearly every one is different."""
    return quantiles.quartiles(order_prices(spark, folder), "category", "price")


def _verified_labels(reviews: DataFrame) -> DataFrame:
    return summary.verified_by_category(reviews).select(
        title_label(F.col("category")).alias("label"),
        count_label(F.col("total")).alias("total_label"),
        percent_label(F.col("verified_percent")).alias("percent_label"),
    )


def _calibrated_average(reviews: DataFrame) -> DataFrame:
    hundredths = (F.col("calibrated_rating") * 100).cast("decimal(12,0)").cast("bigint")
    rated = calibrate.calibrate(reviews.select("user_id", "asin", "rating"))
    return summary.product_average(rated.withColumn("hundredths", hundredths), "hundredths")


def _category_union(spark: SparkSession, folder: str) -> DataFrame:
    """Two datasets with different columns, labelled and put together."""
    documents = document_reviews(spark, folder)
    books = documents.filter(F.col("category") == "book").drop("category", "images")
    games = documents.filter(F.col("category") == "video_game").drop("category", "images", "title")
    together = transform.union_labelled({"book": books, "video_game": games})
    return _as_text(transform.with_lengths(together).drop("text"), "verified_purchase")


def _profiled(report: Callable[[DataFrame], DataFrame]) -> Query:
    """A comparison report computed from the one-pass profile."""
    return lambda spark, folder: report(category_comparison.profile(document_reviews(spark, folder)))


def _event_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Events as JSON lines in which types are mixed; sign-ups are not JSON at all.

    Some lines end in white space and are valid; some are blank, single-quoted, arrays, two
    records, or a record with something behind it, and are not. Some values are absurd.
    """
    events = table(spark, folder, "events")
    kind = F.col("event_id") % 16
    absurd = F.when(kind == 8, F.lit(float("nan"))).when(kind == 9, F.lit(1e300))
    record = F.struct(
        F.coalesce(absurd, F.col("value")).alias("rating"),
        F.col("event_type").alias("title"),
        F.col("event_id").cast("string").alias("asin"),
        F.col("user_id").alias("user_id"),
        F.when(kind == 7, F.lit(999_999_999_999_999_999)).otherwise(millis_of(F.col("ts"))).alias("timestamp"),
        F.get_json_object("props", "$.k").alias("helpful_vote"),
        F.when(F.col("event_type") == "purchase", "Yes").when(F.col("event_type") == "error", "")
        .otherwise("no").alias("verified_purchase"),
    )
    line = F.when(F.col("event_type") == "signup", F.col("event_type")).otherwise(F.to_json(record))
    changed = (
        F.when(kind == 0, F.concat(line, F.lit("\t")))
        .when(kind == 1, F.concat(line, F.lit("\r")))
        .when(kind == 2, F.concat(line, F.lit(" junk}")))
        .when(kind == 3, F.concat(line, line))
        .when(kind == 4, F.replace(line, F.lit('"'), F.lit("'")))
        .when(kind == 5, F.concat(F.lit("["), line, F.lit("]")))
        .when(kind == 6, F.lit("  "))
        .when(kind == 10, F.concat(line, F.lit("]")))
        .otherwise(line)
    )
    return events.select(changed.alias("value"), "event_id")


_INGESTED = {
    "rating": "int",
    "title": "str",
    "text": "str",
    "asin": "str",
    "user_id": "str",
    "timestamp": "date",
    "helpful_vote": "int",
    "verified_purchase": "bool",
}


def _ingest_lenient(spark: SparkSession, folder: str) -> DataFrame:
    records = typed(parse_lenient(_event_lines(spark, folder), _INGESTED), _INGESTED)
    return _as_text(records, "timestamp", "verified_purchase")


def _ingest_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """The lines that ``ingest_lenient`` drops, and why."""
    return rejects.accounted(_event_lines(spark, folder), _INGESTED).rejects.select("event_id", "reason")


def _ingest_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Lines, records, rejected lines by reason, and failed casts by field, of the same pass."""
    return rejects.counts_table(spark, rejects.accounted(_event_lines(spark, folder), _INGESTED).counts)


def _product_delta_steps(spark: SparkSession, folder: str) -> DataFrame:
    """Rows after each step of ``product_delta``, counted while its result is stored."""
    counts = steps.StepCounts()
    materialise(calibrate.product_delta(fine_reviews(spark, folder), steps=counts))
    return counts.table(spark)


def _ingest_strict(spark: SparkSession, folder: str) -> DataFrame:
    """Documents written as JSON and read back whole, with defaults for what is missing.

    Every fifth document has a blank line behind it, which is no record.
    """
    record = F.struct("rating", "title", "text", "images", "helpful_vote", "verified_purchase")
    line = F.to_json(record)
    pair = F.when(F.col("doc_id") % 5 == 0, F.array(line, F.lit(" "))).otherwise(F.array(line))
    lines = document_reviews(spark, folder).select("doc_id", F.explode(pair).alias("value"))
    return with_defaults(parse_strict(lines), keep=["doc_id"])


def _ingest_defaults(spark: SparkSession, folder: str) -> DataFrame:
    """Properties of events, with a default for the field that no record has."""
    fields = {"k": "int", "absent_text": "str", "absent_number": "float", "absent_flag": "bool"}
    lines = table(spark, folder, "events").select("event_id", "props")
    records = typed(parse_lenient(lines, fields, "props"), fields, keep=["event_id"])
    defaults = {"k": 0, "absent_text": "", "absent_number": 0.0, "absent_flag": False}
    return with_defaults(records, defaults, keep=["event_id"])


def _top_words_listed(spark: SparkSession, folder: str) -> DataFrame:
    """The stop words are a table: all words of the benchmark's texts."""
    listed = table(spark, folder, "benchmark").select(F.explode(F.split(F.lower("text"), " ")).alias("word"))
    return words.top_words(document_reviews(spark, folder), stop_words=listed.distinct())


def _head_n(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.head_n(table(spark, folder, "events").drop("ts"), HEAD_ROWS, "event_id")


def _sample_exact(spark: SparkSession, folder: str) -> DataFrame:
    sample = sampling.sample_exact(table(spark, folder, "documents"), SAMPLE_ROWS, ["doc_id"], SEED)
    return sample.orderBy("doc_id")


def _sample_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines drawn by their text, many of them repeated."""
    value = F.concat_ws(" ", "event_type", F.col("user_id").cast("string"))
    lines = table(spark, folder, "events").select(value.alias("value"), "event_id")
    return sampling.sample_repeated(lines, SAMPLE_ROWS, ["event_id"], SEED).select("value").orderBy("value")


def _sample_fraction(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").drop("ts")
    return sampling.sample_fraction(events, SAMPLE_FRACTION, SEED, ["event_id"])


def _sample_rating_stats(spark: SparkSession, folder: str) -> DataFrame:
    documents = sampling.sample_exact(table(spark, folder, "documents"), SAMPLE_ROWS, ["doc_id"], SEED)
    sample = reviews_of(documents, table(spark, folder, "labels"))
    return summary.rating_stats(transform.verified_only(sample))


QUERIES: dict[str, Query] = {
    # Trends
    "yearly_trend": _over(order_reviews, lambda r: trend.yearly(r, "review_ts").orderBy("year")),
    "monthly_trend": _over(order_reviews, _monthly_trend),
    "yearly_of_months": _over(order_reviews, lambda r: trend.yearly_of_months(trend.monthly(r)).orderBy("year")),
    "trend_total": _over(order_reviews, lambda r: trend.total(trend.yearly(r, "review_ts"))),
    # Ratings
    "rating_stats": _over(order_reviews, lambda r: summary.rating_stats(transform.verified_only(r))),
    "rating_by_votes": _over(order_reviews, lambda r: _verified_by_votes(r).orderBy("helpful_vote")),
    "rating_by_votes_head": _over(
        order_reviews, lambda r: _verified_by_votes(r).orderBy("helpful_vote").limit(10)
    ),
    "rating_by_votes_capped": _over(order_reviews, lambda r: summary.votes_up_to(_verified_by_votes(r))),
    "good_split": _over(order_reviews, _good_split),
    "bad_split": _over(order_reviews, _bad_split),
    "bad_split_verified": _over(order_reviews, lambda r: _bad_split(transform.verified_only(r))),
    "good_share": _over(order_reviews, lambda r: summary.good_share(transform.verified_only(r))),
    "rating_pivot": _over(
        order_reviews, lambda r: distribution.rating_pivot(r, CATEGORIES).orderBy("rating")
    ),
    "rating_histogram": _over(order_reviews, distribution.rating_histogram),
    "rating_histogram_eq": _over(order_reviews, distribution.equal_width_histogram),
    "row_count": _over(order_reviews, _row_count),
    # Categories
    "category_summary": _over(document_reviews, lambda r: summary.category_summary(r).orderBy("category")),
    "category_union": _category_union,
    "helpful_by_category": _over(order_reviews, summary.helpful_by_category),
    "verified_by_category": _over(order_reviews, summary.verified_by_category),
    "verified_labels": _over(order_reviews, _verified_labels),
    "profile_summary": _profiled(category_comparison.summary_of),
    "profile_ratings": _profiled(lambda p: category_comparison.pivot_of(p, CATEGORIES)),
    "profile_quartiles": _profiled(category_comparison.quartiles_of),
    "profile_helpful": _profiled(category_comparison.helpful_of),
    "profile_verified": _profiled(category_comparison.verified_of),
    # Lengths
    "avg_length": _over(document_reviews, lambda r: summary.average_length(transform.verified_only(r))),
    "length_by_rating": _over(
        document_reviews, lambda r: summary.length_by_rating(transform.verified_only(r)).orderBy("rating")
    ),
    "length_by_star": _over(document_reviews, lambda r: summary.length_by_star(r).orderBy("star")),
    "length_by_votes": _over(
        document_reviews, lambda r: summary.length_by_votes(r).orderBy(F.col("helpful_vote").desc())
    ),
    "length_by_vote_band": _over(document_reviews, distribution.length_by_vote_band),
    "price_quartiles": _price_quartiles,
    "length_quartiles": _over(document_reviews, distribution.length_quartiles),
    # Words
    "word_counts": _over(document_reviews, words.word_counts),
    "top_words": _over(document_reviews, words.top_words),
    "top_words_listed": _top_words_listed,
    "top_words_bounded": _over(document_reviews, lambda r: words.top_words(r, bounded=True)),
    "top_word_max": _over(document_reviews, lambda r: words.highest_frequency(words.top_words(r))),
    # Users and products
    "user_stats": _over(fine_reviews, lambda r: summary.most_helpful_first(summary.user_stats(r))),
    "product_avg": _over(order_reviews, summary.product_average),
    "product_avg_calibrated": _over(fine_reviews, _calibrated_average),
    "calibrated_reviews": _over(fine_reviews, lambda r: calibrate.calibrate(r.drop("review_ts"))),
    "product_delta": _over(fine_reviews, calibrate.product_delta),
    "product_delta_steps": _product_delta_steps,
    "top_delta": _over(fine_reviews, lambda r: calibrate.top_delta(calibrate.product_delta(r))),
    # Reading and sampling
    "ingest_lenient": _ingest_lenient,
    "ingest_rejects": _ingest_rejects,
    "ingest_counts": _ingest_counts,
    "ingest_strict": _ingest_strict,
    "ingest_defaults": _ingest_defaults,
    "head_n": _head_n,
    "sample_exact": _sample_exact,
    "sample_fraction": _sample_fraction,
    "sample_lines": _sample_lines,
    "sample_rating_stats": _sample_rating_stats,
}
