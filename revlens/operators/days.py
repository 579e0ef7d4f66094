"""Period pages from day tables.

A day table holds one row per (category, product, day) with sums that add up,
so a page over any period reads days instead of reviews.  A period ends at the
midnight that starts its last day, so the reviews of that one second are rows of
their own (``midnight``) and every period is exact.

Distinct users and products do not add up; per (category, day) they are kept as
mergeable sketches, which is the approximate form.  The exact one
(:func:`revlens.operators.summary.overview`) stays the default.

A null time is a day of its own that is in no period.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.functions.dates import SECONDS_PER_DAY, epoch_to_date, epoch_to_year, period_bounds
from revlens.operators.products import PRODUCT_KEYS

# 2^12 registers of a sketch: a relative standard error of about 1.6 %
SKETCH_BITS = 12


def _by_day(df: DataFrame, *keys: str):
    into_day = F.pmod("review_time", F.lit(SECONDS_PER_DAY))
    return df.groupBy(*keys, (F.col("review_time") - into_day).alias("day"), (into_day == 0).alias("midnight"))


def _counts() -> list[Column]:
    sums = [F.count(F.lit(1)).alias("n")]
    for c in ("rating", "price"):
        sums += [F.count(c).alias(f"{c}s"), F.sum(F.col(c).cast("double")).alias(f"{c}_sum")]
    return sums


def day_table(df: DataFrame) -> DataFrame:
    """Reviews and sums of ratings and prices per (category, product_id, title, day, midnight)."""
    return _by_day(df, "category", *PRODUCT_KEYS).agg(*_counts())


def day_sketches(df: DataFrame) -> DataFrame:
    """The sums and sketches of users and products per (category, day, midnight)."""
    return _by_day(df, "category").agg(
        *_counts(), F.hll_sketch_agg("user_id", SKETCH_BITS).alias("users"),
        F.hll_sketch_agg("product_id", SKETCH_BITS).alias("products"))


def days_in(days: DataFrame, start, end, whole_end_day: bool = False) -> DataFrame:
    """P13 over a day table: the rows whose reviews are all in the period (the others have none there)."""
    lo, hi = period_bounds(start, end, whole_end_day)
    last = F.col("day") + F.when(F.col("midnight"), 0).otherwise(SECONDS_PER_DAY - 1)
    # the second bound follows from the third; it is the one that reaches the scan
    return days.filter((F.col("day") >= lo) & (F.col("day") <= hi) & (last <= hi))


def _avg(c: str) -> Column:
    return F.try_divide(F.sum(f"{c}_sum"), F.sum(f"{c}s"))


def trending_products(days: DataFrame, start, end, k: int = 10, whole_end_day: bool = False) -> DataFrame:
    """A3: most-reviewed products of a period."""
    stats = days_in(days, start, end, whole_end_day).groupBy(*PRODUCT_KEYS).agg(
        F.sum("ratings").alias("n_reviews"), _avg("rating").alias("avg_rating"), _avg("price").alias("avg_price"))
    return stats.orderBy(F.desc("n_reviews"), "product_id", F.asc_nulls_first("title")).limit(k)


def daily_activity(days: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Reviews per day; apply to :func:`days_in` for a period."""
    return days.groupBy(*keys, epoch_to_date("day").alias("date")).agg(F.sum("n").alias("count")).orderBy(*keys, "date")


def yearly_activity(days: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Reviews per year."""
    return days.groupBy(*keys, epoch_to_year("day").alias("year")).agg(F.sum("n").alias("count")).orderBy(*keys, "year")


def overview(sketches: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """A9, A10, A11, A14 with approximate distinct counts; apply to :func:`days_in` for a period."""
    def distinct(c: str) -> Column:
        # no day at all: an empty sketch
        return F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(c)), F.lit(0).cast("bigint"))

    return sketches.groupBy(*keys).agg(
        distinct("users").alias("n_users"), distinct("products").alias("n_products"),
        F.coalesce(F.sum("n"), F.lit(0).cast("bigint")).alias("n_reviews"),
        _avg("rating").alias("avg_rating"), _avg("price").alias("avg_price"))
