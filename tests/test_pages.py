"""E2-E4 and the statistics pages, on sf0.001."""

import pytest
from pyspark.sql import functions as F

from revlens.operators import recommend
from revlens.plans import pages
from revlens.plans.tables import clean_table
from tests.conftest import SF001


@pytest.fixture(scope="module")
def clean(spark):
    return clean_table(spark, SF001)


@pytest.fixture(scope="module")
def fitted(clean):
    return recommend.fit_recommender(clean, max_iter=5)


def test_user_dashboard_known_user(clean, fitted):
    uid = fitted.indexed.users.orderBy("user_index").first().user_id
    page = pages.user_dashboard(clean, fitted, uid)
    s = page["summary"].first()
    assert s.user_id == uid and s.total_reviews == clean.filter(F.col("user_id") == uid).count()
    hist = page["history"].collect()
    times = [r.review_time for r in hist]
    assert times == sorted(times, reverse=True)
    recs = page["recommendations"].collect()
    assert 0 < len(recs) <= 10 and all(r.predicted_rating is not None for r in recs)


def test_user_dashboard_price_order(clean, fitted):
    uid = fitted.indexed.users.orderBy("user_index").first().user_id
    recs = pages.user_dashboard(clean, fitted, uid, order="price")["recommendations"].orderBy("position").collect()
    assert [r.position for r in recs] == list(range(1, len(recs) + 1))
    keys = [(r.price, -r.predicted_rating) for r in recs]
    assert keys == sorted(keys)


def test_user_dashboard_unknown_user_gets_popular(clean, fitted):
    page = pages.user_dashboard(clean, fitted, "no-such-user")
    assert page["summary"].count() == 0
    recs = page["recommendations"].orderBy("position").collect()
    popular = [r.product_id for r in recommend.popular_products(clean).collect()]
    assert [r.product_id for r in recs] == popular


def test_product_page(clean):
    p = clean.groupBy("product_id", "title").count().orderBy(F.desc("count"), "product_id").first()
    page = pages.product_page(clean, p.product_id, p.title)
    assert page["summary"].first().total_reviews == p["count"]
    assert page["reviews"].count() == p["count"]
    assert page["latest"].count() == min(3, p["count"])
    similar = page["similar"].collect()
    assert p.product_id in [r.product_id for r in similar] or len(similar) == 10


def test_statistics_pages(clean):
    stats = pages.category_statistics(clean.filter(F.col("category") == "ECONOMY"))
    assert stats["histogram"].count() == 5
    assert stats["latest"].count() == 10
    period = pages.period_analysis(clean, "2000-01-01", "2001-12-31")
    n = period["rows"].count()
    assert period["overview"].first().n_reviews == n
    assert sum(r["count"] for r in period["daily"].collect()) == n
    admin = pages.admin_statistics(clean)
    assert [r.metric for r in admin["database"].collect()] == ["Users", "Products", "Reviews", "Average rating",
                                                              "Average price"]
    assert sum(r["count"] for r in admin["yearly"].collect()) == clean.count()
