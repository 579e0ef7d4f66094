"""The app's pages as lazy result sets (E2-E4 and the statistics pages).

Each function returns a dict of DataFrames for one request (one user, one
category, one period, one product).  Nothing runs until the caller acts on
a DataFrame; the clean table is read once per action with partition and
column pruning, and single-key filters reach the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.operators import products, recommend, search, summary, timeline, users
from revlens.operators.evaluate import quality_metrics, radar_scores
from revlens.operators.timeline import DEFAULT_PERIOD_START


def user_dashboard(clean: DataFrame, fitted: recommend.Fitted, user_id: str, k: int = recommend.TOP_K,
                   order: str = "score") -> dict[str, DataFrame]:
    """Summary, history and recommendations of one user.

    The user summary always answers from the clean table.  Recommendations
    come from the model when it knows the user, else the popular list (M8);
    the choice is a plan (``left_anti`` + union), not a driver branch.
    ``position`` gives the display order.
    """
    mine = users.one_user(clean, user_id)
    ids = clean.sparkSession.createDataFrame([(user_id,)], "user_id string")
    lookup = recommend.product_lookup(fitted.indexed, clean)
    model_recs = recommend.recommendations_for(fitted, lookup, ids, k, order)
    nothing = [F.lit(None).cast(t).alias(c) for c, t in (("avg_rating", "double"), ("avg_price", "double"), ("n_reviews", "long"))]
    fallback = recommend.fallback_for_unknown(ids, model_recs.select("user_id"), clean, k).select(
        "user_id", "position", "product_id", "title", F.lit(None).cast("float").alias("price"),
        F.lit(None).cast("double").alias("predicted_rating"), "avg_rating", "avg_price", "n_reviews",
    )
    model_recs = model_recs.select("*", *nothing)
    return {
        "summary": users.user_summary(mine),
        "history": users.user_history(mine),
        "recommendations": model_recs.unionByName(fallback),
    }


def product_page(clean: DataFrame, product_id: str, title: str, k: int = 10) -> dict[str, DataFrame]:
    """E4 (detail side): statistics, reviews, latest reviews, representative text, similar products."""
    one = products.one_product(clean, product_id)
    return {
        "summary": products.product_summary(one),
        "reviews": products.product_reviews(one),
        "latest": products.latest_reviews(one, k=3),
        "representative": products.representative_review(one),
        "similar": search.similar_products(clean, title, k),
    }


def category_statistics(clean: DataFrame) -> dict[str, DataFrame]:
    """The statistics page of a category: counts, histogram, top rated, latest reviews."""
    latest = clean.select("user_name", "product_id", "title", "rating", "review_summary", "review_time",
                          "review_id").orderBy(F.desc("review_time"), "review_id").limit(10)
    return {
        "overview": summary.overview(clean),
        "histogram": summary.rating_histogram(clean),
        "top_rated": products.top_rated(clean),
        "latest": latest,
    }


def period_analysis(clean: DataFrame, start: str = DEFAULT_PERIOD_START, end: str | None = None,
                    whole_end_day: bool = False) -> dict[str, DataFrame]:
    """Counts, daily series and trending products of a period."""
    import datetime as _dt

    end = end or _dt.date.today().isoformat()
    period = timeline.in_range(clean, start, end, whole_end_day)
    return {
        "rows": period,
        "overview": summary.overview(period),
        "daily": timeline.daily_activity(period),
        "trending": products.most_reviewed(period),
    }


def admin_statistics(clean: DataFrame, predictions: DataFrame | None = None) -> dict[str, DataFrame]:
    """The global page: yearly series, database summary, size table, model radar."""
    out = {
        "yearly": timeline.yearly_activity(clean),
        "database": summary.database_summary(clean),
        "sizes": summary.size_distribution(clean),
    }
    if predictions is not None:
        m = quality_metrics(predictions)
        out["metrics"] = m
        out["radar"] = radar_scores(m)
    return out
