"""Boundary, tie and null cases of the relational operators on hand-made tables."""

from pyspark.sql import functions as F

from revlens.operators import products, search, summary, upsert, users
from revlens.schema import STORED_SCHEMA


def _reviews(spark, rows):
    """rows: (review_id, product_id, title, user_id, rating, price, review_time, text)."""
    full = [
        (pid, title, price, uid, f"name-{uid}", "0/0", rating, t, "s", text, rid, "cat")
        for rid, pid, title, uid, rating, price, t, text in rows
    ]
    return spark.createDataFrame(full, STORED_SCHEMA)


def test_popular_floor_and_ties(spark):
    rows = [(f"a{i}", "pa", "Alpha", f"u{i}", 5.0, 1.0, i, "x") for i in range(10)]  # exactly 10 -> kept
    rows += [(f"b{i}", "pb", "Beta", f"u{i}", 5.0, 1.0, i, "x") for i in range(9)]  # 9 -> dropped
    rows += [(f"c{i}", "pc", "Gamma", f"u{i}", 5.0, 1.0, i, "x") for i in range(12)]  # ties with pa
    df = _reviews(spark, rows)
    got = [r.product_id for r in products.popular_products(df).collect()]
    assert got == ["pa", "pc"]  # equal averages: product_id decides
    assert [r.product_id for r in products.top_rated(df, k=2).collect()] == ["pa", "pb"]


def test_search_regex_literal_and_nulls(spark):
    df = _reviews(spark, [
        ("1", "p1", "Steel Bolt", "u", 4.0, 1.0, 1, "t"),
        ("2", "p2", "brass (big) bolt", "u", 4.0, 1.0, 1, "t"),
        ("3", "p3", None, "u", 4.0, 1.0, 1, "t"),
    ])
    assert sorted(r.product_id for r in search.search_products(df, "BOLT").collect()) == ["p1", "p2"]
    assert [r.product_id for r in search.search_products(df, "(big)", literal=True).collect()] == ["p2"]
    assert sorted(r.product_id for r in search.search_products(df, "").collect()) == ["p1", "p2"]  # null title never
    assert [r.label for r in search.search_products(df, "^steel").collect()] == ["Steel Bolt (p1)"]


def test_histogram_half_stars_and_zeros(spark):
    df = _reviews(spark, [("1", "p", "t", "u", 4.5, 1.0, 1, "x"), ("2", "p", "t", "u", 4.0, 1.0, 1, "x"),
                          ("3", "p", "t", "u", 4.0, 1.0, 1, "x")])
    got = [(r.rating, r["count"], r.rating_label) for r in summary.rating_histogram(df).collect()]
    assert got == [(1.0, 0, "1 ⭐"), (2.0, 0, "2 ⭐"), (3.0, 0, "3 ⭐"), (4.0, 2, "4 ⭐"), (5.0, 0, "5 ⭐")]
    assert sum(c for _, c, _ in got) <= df.count()


def test_representative_review_default(spark):
    df = _reviews(spark, [("2", "p1", "t", "u", 4.0, 1.0, 1, "second"), ("1", "p1", "t", "u", 4.0, 1.0, 1, "first"),
                          ("3", "p2", "t", "u", 4.0, 1.0, 1, None)])
    got = {r.product_id: r.preview for r in products.representative_review(df).collect()}
    assert got == {"p1": "first", "p2": "No review available"}


def test_review_detail_first_match(spark):
    df = _reviews(spark, [("r2", "p", "t", "u", 4.0, 1.0, 7, "b"), ("r1", "p", "t", "u", 2.0, 1.0, 7, "a")])
    r = users.review_detail(df).first()
    assert (r.review_id, r.review_text, r.rating, r.matches) == ("r1", "a", 2.0, 2)


def test_user_exists_and_categories(spark):
    df = _reviews(spark, [("1", "p", "t", "u1", 4.0, 1.0, 1, "x")]).unionByName(
        _reviews(spark, [("2", "p", "t", "u1", 4.0, 1.0, 1, "x")]).withColumn("category", F.lit("a-cat")))
    req = spark.createDataFrame([("u1",), ("u9",)], "user_id string")
    assert {r.user_id: r.exists for r in users.user_exists(req, df).collect()} == {"u1": True, "u9": False}
    r = users.user_categories(df).first()
    assert (r.categories, r.n_categories) == ("a-cat,cat", 2)


def test_upsert_and_delete(spark):
    base = _reviews(spark, [("1", "p", "t", "u", 1.0, 1.0, 1, "old"), ("2", "p", "t", "u", 2.0, 1.0, 1, "keep")])
    changes = _reviews(spark, [("1", "p", "t", "u", 5.0, 1.0, 1, "new"), ("3", "p", "t", "u", 3.0, 1.0, 1, "add")])
    out = {r.review_id: r.review_text for r in upsert.upsert(base, changes).collect()}
    assert out == {"1": "new", "2": "keep", "3": "add"}
    twice = changes.unionByName(_reviews(spark, [("1", "p", "t", "u", 4.0, 1.0, 9, "newer"), ("3", "p", "t", "u", 3.0, 1.0, 0, "older")]))
    rows = [(r.review_id, r.review_text) for r in upsert.upsert(base, twice).collect()]
    assert sorted(rows) == [("1", "newer"), ("2", "keep"), ("3", "add")]
    gone = upsert.delete(base, spark.createDataFrame([("2",)], "review_id string"))
    assert [r.review_id for r in gone.collect()] == ["1"]


def test_similar_product_stats_by_id_set(spark):
    df = _reviews(spark, [("1", "p1", "t1", "u", 2.0, 1.0, 1, "x"), ("2", "p2", "t2", "u", 5.0, 1.0, 1, "x"),
                          ("3", "p3", "t3", "u", 4.0, 1.0, 1, "x")])
    ids = spark.createDataFrame([("p1",), ("p2",), ("p2",)], "product_id string")
    assert [r.product_id for r in products.similar_product_stats(df, ids).collect()] == ["p2", "p1"]


def test_tasks_of_sorts_and_joins_follow_the_input(spark, monkeypatch, tmp_path):
    """More input than the session's shuffle partitions are meant for: more ranges, in the same order."""
    from revlens import session
    from revlens.operators import products, users

    df = spark.range(4000).selectExpr(
        "cast(id % 7 as string) product_id", "cast(id % 5 as string) user_id", "'t' title", "'n' user_name", "1.0f rating",
        "2.0f price", "'1/1' helpfulness", "'s' review_summary", "'x' review_text", "id % 11 review_time", "cast(id as string) review_id")
    df.repartition(4).write.parquet(f"{tmp_path}/r")
    stored = spark.read.parquet(f"{tmp_path}/r")
    size, before = session.scanned_bytes(stored), spark.conf.get("spark.sql.shuffle.partitions")
    wide = [products.product_reviews(stored), users.user_history(stored)]
    monkeypatch.setattr(session.tasks_for, "__defaults__", (-(-size // (3 * int(before))),))
    many = [products.product_reviews(stored), users.user_history(stored)]
    for a, b in zip(wide, many):
        assert b.rdd.getNumPartitions() > int(before)
        assert a.collect() == b.collect()
    with session.partitions_for(spark, size):
        assert int(spark.conf.get("spark.sql.shuffle.partitions")) > int(before)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
