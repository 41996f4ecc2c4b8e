"""Review-shaped views over order and document tables, for queries and benchmarks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.functions.dates import millis_of

# Part types that count as books in the order view.
BOOK_TYPES = ("ECONOMY", "STANDARD")


# The columns of each table that the queries read.
SCHEMAS = {
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_returnflag string"
    ),
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
    "part": "p_partkey bigint, p_name string, p_type string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int",
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string"
    ),
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def order_reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as reviews: buyers are users, parts are products. No text.

    Ratings go from 0 to 5 in halves; some ratings, times and users are missing, some
    users are empty, and a few line items have very many votes.
    """
    lines = table(spark, folder, "lineitem")
    orders = table(spark, folder, "orders")
    parts = table(spark, folder, "part")
    is_book = F.col("p_type").isin(*BOOK_TYPES)
    quantity = F.floor("l_quantity")
    buyer = F.col("o_custkey").cast("string")
    when = F.when(F.col("o_orderkey") % 101 != 0, F.col("o_orderdate"))
    votes = (F.col("l_linenumber") - 1).cast("bigint") * (F.col("l_suppkey") % 20)
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.when(quantity != 13, quantity % 11 / 2).alias("rating"),
            F.col("p_name").alias("title"),
            F.col("l_partkey").cast("string").alias("asin"),
            F.when(F.col("o_custkey") % 89 == 0, "").when(F.col("o_custkey") % 97 != 0, buyer).alias("user_id"),
            millis_of(when).alias("timestamp"),
            when.alias("review_ts"),
            F.when(F.col("l_orderkey") % 499 == 0, 20_000_000).otherwise(votes).alias("helpful_vote"),
            (F.col("l_returnflag") != "R").alias("verified_purchase"),
            F.when(is_book, "book").otherwise("video_game").alias("category"),
            F.col("l_orderkey").alias("okey"),
            F.col("l_linenumber").alias("lno"),
        )
    )


def order_prices(spark: SparkSession, folder: str) -> DataFrame:
    """The price of each line item with its category; of line items with 13 pieces it is missing."""
    lines, parts = table(spark, folder, "lineitem"), table(spark, folder, "part")
    price = F.when(F.floor("l_quantity") != 13, F.col("l_extendedprice"))
    category = F.when(F.col("p_type").isin(*BOOK_TYPES), "book").otherwise("video_game")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(category.alias("category"), price.alias("price"))


def fine_reviews(spark: SparkSession, folder: str) -> DataFrame:
    """The order view with finer users (buyer and year) and products (part and line).

    Many of them have only a few reviews, so that the minimum-count rules have an effect.
    """
    return order_reviews(spark, folder).withColumns(
        {
            "user_id": F.concat("user_id", F.lit("-"), F.coalesce(F.year("review_ts").cast("string"), F.lit("?"))),
            "asin": F.concat_ws("-", F.col("asin"), F.col("lno").cast("string")),
        }
    )


def document_reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as reviews with text; unlabelled ones have no verified flag.

    Ratings go from 0 to 5.5 in halves and are missing in places; there are no images, or up
    to three, or no list of them.
    """
    return reviews_of(table(spark, folder, "documents"), table(spark, folder, "labels"))


def reviews_of(documents: DataFrame, labels: DataFrame) -> DataFrame:
    return documents.join(labels, "doc_id", "left").select(
        "doc_id",
        F.when(F.col("doc_id") % 37 != 0, F.col("doc_id") % 12 / 2).alias("rating"),
        F.col("source").alias("title"),
        "text",
        F.when(F.col("lang") == "en", "book").otherwise("video_game").alias("category"),
        F.when(F.col("doc_id") % 61 == 0, F.col("doc_id") + 10_000_000)
        .otherwise((F.col("doc_id") % 7) * (F.col("doc_id") % 17))
        .alias("helpful_vote"),
        (F.col("quality") == 1).alias("verified_purchase"),
        F.when(F.col("doc_id") % 9 != 0, F.array_repeat(F.lit("image"), (F.col("doc_id") % 4).cast("int"))).alias("images"),
    )
