"""Day tables give the pages of the reviews; sketches stay within their error."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from revlens.operators import days, summary, timeline
from revlens.plans import registry
from revlens.plans.tables import clean_table
from tests.conftest import SF001

DAY = 86400


def rows(df):
    rounded = [F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    return list(map(str, df.select(*rounded).collect()))


@pytest.fixture(scope="module")
def reviews(spark):
    """Reviews at, just before and just after midnights, without a time, rating, price or title, and before 1970."""
    times = [0, 1, DAY - 1, DAY, DAY, DAY + 1, 2 * DAY - 1, 2 * DAY, 3 * DAY, -1, -DAY, -DAY - 5, 400 * DAY, None]
    data = [(f"c{i % 2}", f"p{i % 3}", None if i % 5 == 4 else f"t{i % 3}", f"u{i % 4}", None if i % 4 == 3 else i % 5 + 0.5,
             None if i % 6 == 5 else i * 1.25, t) for i, t in enumerate(times * 2)]
    return spark.createDataFrame(
        data, "category string, product_id string, title string, user_id string, rating float, price double, review_time long")


@pytest.mark.parametrize("whole", [False, True])
@pytest.mark.parametrize("start, end", [(0, 1), (0, 2), (1, 1), (-1, 3), (-2, 0), (5, 4), (-10, 500), (600, 700)])
def test_periods_are_exact(reviews, start, end, whole):
    a, b = (dt.date(1970, 1, 1) + dt.timedelta(days=n) for n in (start, end))
    period = timeline.in_range(reviews, a, b, whole)
    table, sketches = days.day_table(reviews), days.day_sketches(reviews)
    inside = days.days_in(table, a, b, whole)
    assert rows(days.trending_products(table, a, b, whole_end_day=whole)) == rows(timeline.trending_products(reviews, a, b, whole_end_day=whole))
    assert rows(days.daily_activity(inside, ("category",))) == rows(timeline.daily_activity(period, ("category",)))
    # so few values that the sketches are exact
    assert rows(days.overview(days.days_in(sketches, a, b, whole))) == rows(summary.overview(period))


def test_all_days_and_empty_tables(reviews):
    assert rows(days.yearly_activity(days.day_table(reviews))) == rows(timeline.yearly_activity(reviews))
    none = reviews.limit(0)
    assert days.day_table(none).count() == 0 and rows(days.overview(days.day_sketches(none))) == rows(summary.overview(none))


def test_sketches_are_within_their_error(spark):
    """Three standard errors of 1.6 %, merged over thousands of days."""
    clean = clean_table(spark, SF001)
    exact = summary.overview(clean, ("category",)).collect()
    close = {r.category: r for r in days.overview(days.day_sketches(clean), ("category",)).collect()}
    assert len(close) == len(exact)
    for r in exact:
        got = close[r.category]
        assert got.n_reviews == r.n_reviews
        assert abs(got.n_users - r.n_users) <= max(1, 0.05 * r.n_users)
        assert abs(got.n_products - r.n_products) <= max(1, 0.05 * r.n_products)
    many = spark.range(60_000).select(
        F.lit("c").alias("category"), F.col("id").cast("string").alias("user_id"), F.lit("p").alias("product_id"), F.lit("t").alias("title"),
        F.lit(1.0).alias("rating"), F.lit(1.0).alias("price"), ((F.col("id") % 50) * DAY + F.col("id") % 7).alias("review_time"))
    assert abs(days.overview(days.day_sketches(many)).first().n_users - 60_000) <= 0.05 * 60_000


@pytest.mark.parametrize("name", ["trending_from_days", "daily_from_days", "yearly_from_days", "period_overview_approx"])
def test_pages_read_no_review(spark, name):
    df = registry.REGISTRY[name][0](spark, SF001)
    plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert "/artefacts/day" in plan and "review_text" not in plan
    if name != "yearly_from_days":
        assert "GreaterThanOrEqual(day," in plan and "LessThanOrEqual(day," in plan
