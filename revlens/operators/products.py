"""Product rankings and summaries.

Every ranking is a hash aggregate with partial (map-side) aggregation
followed by ``orderBy(...).limit(k)``, which Spark runs as
TakeOrderedAndProject: a per-partition top-k and a k-row merge, never a full
sort.  Orders always end with a unique tie-breaker so results are repeatable.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlens.functions.dates import display_date
from revlens.functions.text import preview, text_or_default
from revlens.session import sorted_rows

PRODUCT_KEYS = ("product_id", "title")


def product_stats(df: DataFrame, keys: Sequence[str] = PRODUCT_KEYS) -> DataFrame:
    """Per product: number of rated reviews, average rating, average price."""
    return df.groupBy(*keys).agg(
        F.count("rating").alias("n_reviews"),
        F.avg("rating").alias("avg_rating"),
        F.avg("price").alias("avg_price"),
    )


def _top(df: DataFrame, first: Column, k: int) -> DataFrame:
    return df.orderBy(first, F.asc("product_id"), F.asc_nulls_first("title")).limit(k)


def popular_products(df: DataFrame, min_reviews: int = 10, k: int = 10) -> DataFrame:
    """A1 (+P10, O1): best average among products with at least ``min_reviews`` reviews.

    Also the cold-start fallback of the recommender.
    """
    stats = product_stats(df).filter(F.col("n_reviews") >= min_reviews)
    return _top(stats, F.desc("avg_rating"), k)


def top_rated(df: DataFrame, k: int = 10) -> DataFrame:
    """A2 (O1): best average rating, no review floor."""
    return _top(product_stats(df), F.desc("avg_rating"), k)


def most_reviewed(df: DataFrame, k: int = 10) -> DataFrame:
    """A3 core (O2): most reviews; apply to a period filter for "trending"."""
    return _top(product_stats(df), F.desc("n_reviews"), k)


def product_summary(df: DataFrame) -> DataFrame:
    """A5/A6/A7/A19 for all products at once: count, averages (null -> 0), last review.

    One row per product_id.  ``avg_rating_or_zero`` is what the detail
    panels show for a product without rated reviews.
    """
    return df.groupBy("product_id").agg(
        F.count("rating").alias("total_reviews"),
        F.avg("rating").alias("avg_rating"),
        F.avg("price").alias("avg_price"),
        F.max("review_time").alias("last_review"),
    ).select(
        "*",
        F.coalesce(F.col("avg_rating"), F.lit(0.0)).alias("avg_rating_or_zero"),
        F.coalesce(F.col("avg_price"), F.lit(0.0)).alias("avg_price_or_zero"),
        display_date("last_review").alias("last_review_date"),
    )


def one_product(df: DataFrame, product_id: str) -> DataFrame:
    """Rows of one product (pushed down to the scan; row groups skipped on sorted files)."""
    return df.filter(F.col("product_id") == F.lit(product_id))


def product_catalog(df: DataFrame) -> DataFrame:
    """Distinct (product_id, title) pairs."""
    return df.select(*PRODUCT_KEYS).distinct()


def product_dimension(df: DataFrame) -> DataFrame:
    """One row per product: title and price of its latest review (ties: largest review_id).

    Used for look-ups (J3/J7) instead of a fact-to-fact join + distinct.
    """
    latest = F.max_by(F.struct("title", "price"), F.struct("review_time", "review_id"))
    return df.groupBy("product_id").agg(latest.alias("_l")).select("product_id", "_l.title", "_l.price")


def product_reviews(df: DataFrame) -> DataFrame:
    """P16 for all products: the seven display columns, newest first within each product.

    A range-partitioned sort on (product_id, review_time desc, review_id): a
    product with very many reviews spreads over several tasks instead of one.
    The ranges are as many as the input's files need.
    """
    return sorted_rows(df.select(
        "product_id", "user_name", "rating", "price", "helpfulness", "review_summary", "review_text",
        "review_time", display_date("review_time").alias("date"), "review_id",
    ), "product_id", F.desc("review_time"), "review_id")


def latest_reviews(df: DataFrame, k: int = 3, keys: Sequence[str] = ("product_id",)) -> DataFrame:
    """O4 (per product) / O5 (per category) for every key: the ``k`` newest reviews.

    ``row_number() <= k`` is planned with a partial WindowGroupLimit before
    the shuffle, so a hot product sends at most k rows per map task.
    """
    w = Window.partitionBy(*keys).orderBy(F.desc("review_time"), F.asc("review_id"))
    shown = ["user_name", "rating", "review_summary", "review_time", "review_id"]
    if "product_id" not in keys:
        shown = ["product_id", "title", *shown]
    return (
        df.select(*keys, *[c for c in shown if c not in keys], F.row_number().over(w).alias("position"))
        .filter(F.col("position") <= k)
        .withColumn("date", display_date("review_time"))
    )


def representative_review(df: DataFrame) -> DataFrame:
    """O9 + F12 + F13 for every product: one review text (smallest review_id), its preview."""
    return df.groupBy("product_id").agg(F.min_by("review_text", "review_id").alias("review_text")).select(
        "product_id",
        "review_text",
        text_or_default(preview("review_text")).alias("preview"),
    )


def similar_product_stats(df: DataFrame, product_ids: DataFrame, k: int = 10) -> DataFrame:
    """A8 (+J6): statistics of the products in ``product_ids``, best average first.

    The id set is applied with a left-semi join (no collected IN list).
    """
    ids = product_ids.select("product_id").distinct()
    return _top(product_stats(df.join(ids, "product_id", "left_semi")), F.desc("avg_rating"), k)


def top_per_group(stats: DataFrame, group: Sequence[str], first: Column, k: int = 10) -> DataFrame:
    """A ranking for every group at once (e.g. A1/A2/A3 per category).

    ``row_number() <= k`` over each group: Spark limits each map task to k
    rows per group before the shuffle (WindowGroupLimit), so a hot category
    costs no more than a small one.
    """
    w = Window.partitionBy(*group).orderBy(first, F.asc("product_id"), F.asc_nulls_first("title"))
    return stats.withColumn("position", F.row_number().over(w)).filter(F.col("position") <= k)


def popular_products_by(df: DataFrame, group: Sequence[str] = ("category",), min_reviews: int = 10,
                        k: int = 10) -> DataFrame:
    """A1 for every category: the popular list each category page shows."""
    stats = product_stats(df, keys=(*group, *PRODUCT_KEYS)).filter(F.col("n_reviews") >= min_reviews)
    return top_per_group(stats, group, F.desc("avg_rating"), k)


def top_rated_by(df: DataFrame, group: Sequence[str] = ("category",), k: int = 10) -> DataFrame:
    """A2 for every category."""
    return top_per_group(product_stats(df, keys=(*group, *PRODUCT_KEYS)), group, F.desc("avg_rating"), k)


def most_reviewed_by(df: DataFrame, group: Sequence[str] = ("category",), k: int = 10) -> DataFrame:
    """A3 core for every category (apply to a period filter for trending)."""
    return top_per_group(product_stats(df, keys=(*group, *PRODUCT_KEYS)), group, F.desc("n_reviews"), k)
