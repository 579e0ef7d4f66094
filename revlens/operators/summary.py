"""Table-level statistics.

The reference issues one action per number; here each table is one
aggregate over one scan.  Distinct counts are exact by default
(``approx=True`` switches to HyperLogLog++ for very large tables).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.functions.numbers import price_text, rating_text
from revlens.functions.text import rating_label
from revlens.sources.files import rating_spine

# Metric names of the summary tables.
SUMMARY_METRICS = ["Users", "Products", "Reviews", "Average rating", "Average price"]
SIZE_TYPES = ["Users", "Products", "Reviews"]


def overview(df: DataFrame, keys: Sequence[str] = (), approx: bool = False) -> DataFrame:
    """A9, A10, A11, A14 in one pass (per ``keys``, e.g. per category, or global)."""
    distinct = (lambda c: F.approx_count_distinct(c)) if approx else (lambda c: F.count_distinct(c))
    aggs = [
        distinct("user_id").alias("n_users"),
        distinct("product_id").alias("n_products"),
        F.count(F.lit(1)).alias("n_reviews"),
        F.avg("rating").alias("avg_rating"),
        F.avg("price").alias("avg_price"),
    ]
    return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)


def rating_histogram(df: DataFrame, spark: SparkSession | None = None) -> DataFrame:
    """A15 + J5 + S8: counts of ratings 1..5, zero for absent ones; half stars fall out.

    The five-row spine is the preserved side of a left join against an
    aggregate of at most five rows (filtered to the spine values first), so
    broadcasting it is bounded.
    """
    spark = spark or df.sparkSession
    spine = rating_spine(spark)
    # only spine values can match, so the aggregate has at most five rows
    counts = df.filter(F.col("rating").isin([1.0, 2.0, 3.0, 4.0, 5.0])).groupBy("rating").agg(
        F.count(F.lit(1)).alias("count"))
    return (
        spine
        .join(F.broadcast(counts), "rating", "left")
        .select("rating", F.coalesce("count", F.lit(0)).alias("count"), rating_label("rating").alias("rating_label"))
        .orderBy("rating")
    )


def database_summary(df: DataFrame) -> DataFrame:
    """Five (metric, value) rows with formatted values."""
    o = overview(df)
    return o.select(
        F.inline(
            F.array(
                F.struct(F.lit(SUMMARY_METRICS[0]).alias("metric"), F.col("n_users").cast("string").alias("value")),
                F.struct(F.lit(SUMMARY_METRICS[1]).alias("metric"), F.col("n_products").cast("string").alias("value")),
                F.struct(F.lit(SUMMARY_METRICS[2]).alias("metric"), F.col("n_reviews").cast("string").alias("value")),
                F.struct(F.lit(SUMMARY_METRICS[3]).alias("metric"), rating_text("avg_rating", 2).alias("value")),
                F.struct(F.lit(SUMMARY_METRICS[4]).alias("metric"), price_text("avg_price").alias("value")),
            )
        )
    )


def size_distribution(df: DataFrame) -> DataFrame:
    """(type, count) rows for users, products and reviews."""
    o = overview(df)
    return o.select(
        F.inline(
            F.array(
                F.struct(F.lit(SIZE_TYPES[0]).alias("type"), F.col("n_users").alias("count")),
                F.struct(F.lit(SIZE_TYPES[1]).alias("type"), F.col("n_products").alias("count")),
                F.struct(F.lit(SIZE_TYPES[2]).alias("type"), F.col("n_reviews").alias("count")),
            )
        )
    )


def rating_histogram_by(df: DataFrame, key: str = "category") -> DataFrame:
    """A15 + J5 for every category: five rows per category, zeros included.

    The spine is generated per category (explode of the five ratings over the
    distinct categories), not a cross join; counts are one aggregate.
    """
    spine = df.select(key).distinct().select(
        key, F.explode(F.array(*[F.lit(float(r)).cast("float") for r in range(1, 6)])).alias("rating"))
    counts = df.filter(F.col("rating").isin([1.0, 2.0, 3.0, 4.0, 5.0])).groupBy(key, "rating").agg(
        F.count(F.lit(1)).alias("count"))
    return spine.join(counts, [key, "rating"], "left").select(
        key, "rating", F.coalesce("count", F.lit(0)).alias("count"), rating_label("rating").alias("rating_label"))


def reviews_per(df: DataFrame, key: str) -> DataFrame:
    """Number of reviews per ``key`` (user_id or product_id) - a partial aggregate."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("count"))
