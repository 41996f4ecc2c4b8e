"""The review record: fixed schema, typed field list and per-field defaults."""

from __future__ import annotations

from pyspark.sql import types as T

# The fields of a review record, in file order.
REVIEW_SCHEMA = T.StructType(
    [
        T.StructField("rating", T.DoubleType()),
        T.StructField("title", T.StringType()),
        T.StructField("text", T.StringType()),
        # Only the number of images is ever used, so each element stays raw JSON.
        T.StructField("images", T.ArrayType(T.StringType())),
        T.StructField("asin", T.StringType()),
        T.StructField("parent_asin", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("helpful_vote", T.LongType()),
        T.StructField("verified_purchase", T.BooleanType()),
    ]
)

# Target type of each field in a typed projection (see functions.casts).
REVIEW_FIELDS = {
    "rating": "int",
    "title": "str",
    "text": "str",
    "images": "str",
    "asin": "str",
    "parent_asin": "str",
    "user_id": "str",
    "timestamp": "date",
    "helpful_vote": "int",
    "verified_purchase": "bool",
}

# What a missing field counts as in a projection with defaults.
REVIEW_DEFAULTS = {
    "asin": "",
    "parent_asin": "",
    "title": "",
    "text": "",
    "rating": 0.0,
    "timestamp": 0,
    "user_id": "",
    "verified_purchase": False,
    "helpful_vote": 0,
}

# Columns of a yearly trend table, as written to and read back from CSV.
YEARLY_SCHEMA = T.StructType(
    [
        T.StructField("year", T.IntegerType()),
        T.StructField("avg_rating", T.DoubleType()),
        T.StructField("num_ratings", T.LongType()),
    ]
)
