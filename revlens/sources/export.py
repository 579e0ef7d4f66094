"""Result exports.

Every export is a distributed write (one file per task) of a result
DataFrame - nothing passes through the driver.  The reference offered the
same tables as browser downloads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revlens.sources.files import write_csv


def export_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write any result table as CSV with a header (quotes doubled)."""
    write_csv(df, path, mode)


def sample(df: DataFrame, n: int, key: str = "review_id") -> DataFrame:
    """``n`` rows in hash order of ``key`` - repeatable, unlike a bare limit.

    Rows are counted by the first four digits of the hash (at most 65,536
    counts); only rows up to the digits that complete ``n`` are sorted, so the
    merge holds n rows and one bucket, however many tasks read the table.
    """
    digest = F.md5(F.col(key).cast("string"))
    bucket = F.substring(digest, 1, 4)
    counts = df.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("c"))
    running = F.sum("c").over(Window.orderBy("b").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    last = counts.withColumn("upto", running).filter(F.col("upto") >= n).agg(F.min("b")).scalar()
    return df.filter(bucket <= F.coalesce(last, F.lit("ffff"))).orderBy(digest, F.col(key)).limit(n)


def export_user_history(history: DataFrame, user_id: str, path: str) -> None:
    """Review history of one user."""
    export_csv(history.filter(F.col("user_id") == F.lit(user_id)), path)


def export_recommendations(recs: DataFrame, path: str, with_score: bool = True) -> None:
    """Recommendation list (the variant app leaves the score out, P21)."""
    export_csv(recs if with_score else recs.drop("predicted_rating"), path)


def export_product_reviews(reviews: DataFrame, product_id: str, path: str) -> None:
    """All reviews of one product."""
    export_csv(reviews.filter(F.col("product_id") == F.lit(product_id)), path)


def export_similar(similar: DataFrame, path: str) -> None:
    """Similar-product statistics."""
    export_csv(similar, path)


def export_sample(df: DataFrame, path: str, n: int) -> None:
    """The repeatable sample of a category (``export_period`` writes all of it)."""
    export_csv(sample(df, n), path)


def export_period(df: DataFrame, path: str) -> None:
    """Every row of a (period-filtered) table, written by all tasks in parallel."""
    export_csv(df, path)
