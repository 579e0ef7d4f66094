"""User summaries, histories and look-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.functions.dates import display_date
from revlens.session import sorted_rows


def user_summary(df: DataFrame, keys=("user_id",)) -> DataFrame:
    """A4 for all users in one aggregate: reviews, average rating (0 when none), last review.

    ``keys=("category", "user_id")`` gives the dashboard's per-category figures.
    """
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_reviews"),
        F.coalesce(F.avg("rating"), F.lit(0.0)).alias("avg_rating"),
        F.max("review_time").alias("last_review"),
    ).withColumn("last_review_date", display_date("last_review"))


def one_user(df: DataFrame, user_id: str) -> DataFrame:
    """Rows of one user."""
    return df.filter(F.col("user_id") == F.lit(user_id))


def user_history(df: DataFrame) -> DataFrame:
    """O3 for all users: seven display columns + date, newest first within each user.

    Range-partitioned sort, so a very active user spreads over several tasks.
    """
    return sorted_rows(df.select(
        "user_id", "product_id", "title", "rating", "price", "helpfulness", "review_summary",
        "review_time", display_date("review_time").alias("date"), "review_id",
    ), "user_id", F.desc("review_time"), "review_id")


def review_detail(df: DataFrame, keys=("user_id", "product_id", "review_time")) -> DataFrame:
    """P11 (keys user, product, time) / P12 (keys user_name, title, time) for every key.

    The reference shows the first matching row; ours takes the one with the
    smallest review_id, computed as a partial aggregate (``min_by``).
    """
    pick = F.min_by(
        F.struct("review_id", "helpfulness", "review_summary", "review_text", "rating"), F.col("review_id")
    )
    return df.groupBy(*keys).agg(pick.alias("_r"), F.count(F.lit(1)).alias("matches")).select(
        *keys, "_r.review_id", "_r.helpfulness", "_r.review_summary", "_r.review_text", "_r.rating", "matches"
    )


def category_users(df: DataFrame) -> DataFrame:
    """Distinct (category, user_id) - the valid logins of every category."""
    return df.select("category", "user_id").distinct()


def user_categories(df: DataFrame) -> DataFrame:
    """For each user, the categories they have reviews in (sorted, comma-joined)."""
    return category_users(df).groupBy("user_id").agg(
        F.array_join(F.sort_array(F.collect_list("category")), ",").alias("categories"),
        F.count(F.lit(1)).alias("n_categories"),
    )


def user_exists(requests: DataFrame, df: DataFrame, keys=("user_id",)) -> DataFrame:
    """P18 in batch: each request row with ``exists`` = the user has reviews (per ``keys``).

    The distinct key set of the reviews is joined once; no list is collected.
    """
    known = df.select(*keys).distinct().withColumn("exists", F.lit(True))
    return requests.join(known, list(keys), "left").withColumn("exists", F.coalesce(F.col("exists"), F.lit(False)))


def user_lookup(dim_user: DataFrame, user_id: str) -> DataFrame:
    """The index row of one user id."""
    return dim_user.filter(F.col("user_id") == F.lit(user_id))
