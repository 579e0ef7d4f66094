"""Review table schema and the column groups the operators rely on."""

from __future__ import annotations

from pyspark.sql import types as T

# The ten columns of a review record, in record order.
REVIEW_COLUMNS = [
    "product_id",
    "title",
    "price",
    "user_id",
    "user_name",
    "helpfulness",
    "rating",
    "review_time",
    "review_summary",
    "review_text",
]

REVIEW_SCHEMA = T.StructType(
    [
        T.StructField("product_id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("price", T.FloatType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("user_name", T.StringType()),
        T.StructField("helpfulness", T.StringType()),
        T.StructField("rating", T.FloatType()),
        T.StructField("review_time", T.LongType()),
        T.StructField("review_summary", T.StringType()),
        T.StructField("review_text", T.StringType()),
    ]
)

# Stored table = review columns + partition column (+ a unique key when the
# source has one; the raw dumps do not).
STORED_SCHEMA = T.StructType(
    list(REVIEW_SCHEMA.fields)
    + [T.StructField("review_id", T.StringType()), T.StructField("category", T.StringType())]
)

# Rows missing any of these are dropped by cleaning.
REQUIRED_COLUMNS = ["product_id", "user_id", "rating", "price"]

# Columns completed with a default when a source lacks them.
OPTIONAL_COLUMNS = ["review_time", "title", "user_name", "helpfulness", "review_summary", "review_text"]

# Fixed value: placeholder written into absent optional text columns.
MISSING_TEXT = "N/A"
