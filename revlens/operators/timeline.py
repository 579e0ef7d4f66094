"""Activity over time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.functions.dates import epoch_to_date, epoch_to_year, in_period
from revlens.operators.products import most_reviewed

# Fixed value: first day of the default analysis period.
DEFAULT_PERIOD_START = "2000-01-01"


def in_range(df: DataFrame, start, end, whole_end_day: bool = False) -> DataFrame:
    """Reviews with start <= review_time <= end (end = midnight starting the end day)."""
    return df.filter(in_period("review_time", start, end, whole_end_day))


def is_empty(df: DataFrame) -> bool:
    """Stops at the first row found."""
    return df.isEmpty()


def daily_activity(df: DataFrame, keys=()) -> DataFrame:
    """A16 (+O6): reviews per day, ascending; only days that have reviews (per ``keys``)."""
    day = epoch_to_date("review_time").alias("date")
    return df.groupBy(*keys, day).agg(F.count(F.lit(1)).alias("count")).orderBy(*keys, "date")


def yearly_activity(df: DataFrame, keys=()) -> DataFrame:
    """A17 (+O6): reviews per year, ascending (per ``keys``)."""
    year = epoch_to_year("review_time").alias("year")
    return df.groupBy(*keys, year).agg(F.count(F.lit(1)).alias("count")).orderBy(*keys, "year")


def trending_products(df: DataFrame, start, end, k: int = 10, whole_end_day: bool = False) -> DataFrame:
    """A3: most-reviewed products of a period."""
    return most_reviewed(in_range(df, start, end, whole_end_day), k)


def period_product_rating(df: DataFrame, start, end, whole_end_day: bool = False) -> DataFrame:
    """P8 + A19 for all products of a period: mean rating (0 when none) and count."""
    return in_range(df, start, end, whole_end_day).groupBy("product_id").agg(
        F.coalesce(F.avg("rating"), F.lit(0.0)).alias("avg_rating"),
        F.count(F.lit(1)).alias("n_reviews"),
    )
