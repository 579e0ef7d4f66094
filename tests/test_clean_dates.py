"""P1-P4 cleaning, F7-F10 and P13 date rules, F12-F15 text helpers."""

import datetime as dt

from pyspark.sql import functions as F

from revlens.functions import dates, numbers, text
from revlens.operators.clean import clean_reviews
from revlens.operators.timeline import in_range


def test_clean_rules(spark):
    df = spark.createDataFrame(
        [
            ("p1", "u1", "4.0", "10.0"),
            ("p1", "u1", "NaN", "10.0"),  # NaN rating dropped
            ("p1", "u1", None, "10.0"),  # null rating dropped
            ("p1", "u1", "x", "10.0"),  # bad rating text -> null -> dropped (no failed job)
            ("p1", "u1", "3.0", None),  # null price dropped
            (None, "u1", "3.0", "1.0"),
            ("p2", None, "3.0", "1.0"),
        ],
        "product_id string, user_id string, rating string, price string",
    )
    out = clean_reviews(df)
    assert out.count() == 1
    # optional columns completed: typed null time, N/A texts
    r = out.first()
    assert r.review_time is None and r.title == "N/A" and r.review_text == "N/A"
    assert dict(out.dtypes)["rating"] == "float" and dict(out.dtypes)["review_time"] == "bigint"
    assert clean_reviews(df, require_price=False).count() == 2


def test_dates(spark):
    day = dt.date(2011, 8, 23)
    secs = dates.day_start_epoch(day)
    df = spark.createDataFrame([(secs + 3600,), (0,), (None,)], "t bigint")
    rows = df.select(dates.display_date("t").alias("d"), dates.epoch_to_date("t").alias("day"),
                     dates.epoch_to_year("t").alias("y")).collect()
    assert rows[0].d == "23/08/2011" and rows[0].day == day and rows[0].y == 2011
    assert rows[1].d == "N/A" and rows[2].d == "N/A"
    assert spark.range(1).select(dates.date_to_epoch(F.lit("2011-08-23")).alias("e")).first().e == secs


def test_period_end_rule(spark):
    lo, hi = dates.period_bounds("2000-01-01", "2000-01-03")
    df = spark.createDataFrame([(lo - 1,), (lo,), (hi,), (hi + 1,)], "review_time bigint")
    assert in_range(df, "2000-01-01", "2000-01-03").count() == 2  # both ends inclusive, end = midnight
    assert in_range(df, "2000-01-01", "2000-01-03", whole_end_day=True).count() == 3


def test_text_helpers(spark):
    df = spark.createDataFrame([("a" * 500,), ("b" * 501,), ("",), (None,)], "t string")
    rows = df.select(text.text_or_default(text.preview("t")).alias("p")).collect()
    assert rows[0].p == "a" * 500
    assert rows[1].p == "b" * 500 + "..."
    assert rows[2].p == text.NO_REVIEW_TEXT and rows[3].p == text.NO_REVIEW_TEXT
    r = spark.range(1).select(
        text.product_label(F.lit("Hinge"), F.lit("P1")).alias("l"),
        text.product_label(F.lit(None).cast("string"), F.lit("P1")).alias("n"),
        numbers.rating_text(F.lit(4.25), 2).alias("r"),
        numbers.price_text(F.lit(12.5)).alias("p"),
        text.rating_label(F.lit(3.0)).alias("s"),
        numbers.safe_ratio(F.lit(1), F.lit(0)).alias("z"),
    ).first()
    assert (r.l, r.n, r.r, r.p, r.s, r.z) == ("Hinge (P1)", None, "4.25/5", "12.50 $", "3 ⭐", 0.0)
