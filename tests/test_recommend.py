"""Indexes, split, ALS output shape, metrics, fallback."""

import os
import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from revlens.operators import evaluate, inner_topk, recommend
from revlens.operators.clean import interactions
from revlens.operators.indexing import dense_index
from revlens.plans.tables import clean_table
from tests.conftest import SF001


@pytest.fixture(scope="module")
def clean(spark):
    return clean_table(spark, SF001)


@pytest.fixture(scope="module")
def fitted(clean):
    return recommend.fit_recommender(clean, max_iter=5)


def test_dense_index_equals_string_indexer(spark, clean):
    rows = interactions(recommend.activity_filter(clean))
    ours = {r.user_id: r.user_index for r in dense_index(rows, "user_id", "user_index").collect()}
    model = StringIndexer(inputCol="user_id", outputCol="i", stringOrderType="frequencyDesc").fit(rows)
    theirs = {label: i for i, label in enumerate(model.labels)}
    assert ours == theirs


def test_dense_index_ties_and_many_partitions(spark):
    data = [("b",), ("a",), ("c",), ("c",), ("d",), ("d",), ("e",)] * 3
    df = spark.createDataFrame(data, "k string").repartition(5)
    got = [(r["k"], r["k_index"], r["count"]) for r in dense_index(df, "k", "k_index").orderBy("k_index").collect()]
    assert got == [("c", 0, 6), ("d", 1, 6), ("a", 2, 3), ("b", 3, 3), ("e", 4, 3)]


def test_activity_filter_counts_on_unfiltered_data(spark):
    # u1 has 5 rows but one is on a product with only 1 row -> u1 keeps 4 rows
    rows = [("u1", f"p{i % 2}", 4.0) for i in range(4)] + [("u1", "px", 3.0)]
    rows += [(f"v{i}", f"p{i % 2}", 2.0) for i in range(6)]
    rows += [("v0", "p0", 5.0)] * 4
    df = spark.createDataFrame(rows, "user_id string, product_id string, rating float")
    out = recommend.activity_filter(df)
    assert out.filter("product_id = 'px'").count() == 0
    assert out.filter("user_id = 'u1'").count() == 4  # one pass, not an iterated core


def test_split_is_stable_and_keeps_pairs_together(spark, clean):
    rows = interactions(clean)
    a = rows.repartition(3).select("user_id", "product_id", recommend.split_flag().alias("f"))
    b = rows.repartition(7).select("user_id", "product_id", recommend.split_flag().alias("f"))
    assert a.exceptAll(b).count() == 0
    mixed = a.groupBy("user_id", "product_id").agg(F.countDistinct("f").alias("n")).filter("n > 1")
    assert mixed.count() == 0
    share = a.filter("f").count() / a.count()
    assert 0.7 < share < 0.9


def test_als_recommendations_shape(fitted, clean):
    recs = recommend.recommendation_table(fitted, clean, k=5)
    rows = recs.collect()
    n_users = fitted.indexed.users.count()
    assert len(rows) <= 5 * n_users and len(rows) > 0
    by_user = {}
    for r in rows:
        assert r.predicted_rating >= 0  # non-negative factors
        by_user.setdefault(r.user_id, []).append((r.position, r.predicted_rating))
    for lst in by_user.values():
        lst.sort()
        assert [p for p, _ in lst] == list(range(1, len(lst) + 1))
        scores = [s for _, s in lst]
        assert scores == sorted(scores, reverse=True)


def test_metrics_equal_evaluator(fitted):
    pred = recommend.predictions(fitted)
    ours = evaluate.quality_metrics(pred).first()
    rmse = RegressionEvaluator(metricName="rmse", labelCol="rating", predictionCol="prediction").evaluate(pred)
    mae = RegressionEvaluator(metricName="mae", labelCol="rating", predictionCol="prediction").evaluate(pred)
    assert ours.rmse == pytest.approx(rmse, rel=1e-9)
    assert ours.mae == pytest.approx(mae, rel=1e-9)
    assert ours.tp + ours.fp + ours.fn <= ours.n
    for c in ("precision", "recall", "f1"):
        assert 0 <= getattr(ours, c) <= 100


def test_quality_metrics_zero_guards(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 1.0)], "rating double, prediction double")
    m = evaluate.quality_metrics(df).first()
    assert (m.tp, m.fp, m.fn, m.precision, m.recall, m.f1) == (0, 0, 0, 0.0, 0.0, 0.0)
    assert m.rmse == pytest.approx(1.0) and m.mae == pytest.approx(1.0)


def test_fallback_for_unknown_users(spark, clean):
    users = spark.createDataFrame([("nobody-1",), ("nobody-2",)], "user_id string")
    known = clean.select("user_id").distinct()
    out = recommend.fallback_for_unknown(users, known, clean, k=10).collect()
    assert len(out) == 20
    first = sorted((r.position, r.product_id) for r in out if r.user_id == "nobody-1")
    assert [p for p, _ in first] == list(range(1, 11))
    # a known user gets no fallback row
    assert recommend.fallback_for_unknown(known.limit(3), known, clean).count() == 0


def test_fit_or_load_per_category(spark, clean, tmp_dir):
    cat = clean.groupBy("category").count().orderBy(F.desc("count"), "category").first().category
    first = recommend.fit_or_load(clean, tmp_dir, cat, max_iter=3)
    again = recommend.fit_or_load(clean, tmp_dir, cat, max_iter=3)
    a = first.model.userFactors.orderBy("id").collect()
    b = again.model.userFactors.orderBy("id").collect()
    assert [r.id for r in a] == [r.id for r in b]
    assert a[0].features == b[0].features

    # later reviews change the frequency order of users; a stored model keeps its own indexes
    def recommended(model):
        lookup = recommend.product_lookup(model.indexed, clean)
        rows = recommend.recommendations_for(model, lookup, model.indexed.users.select("user_id")).collect()
        return sorted((r.user_id, r.position, r.product_id, round(r.predicted_rating, 6)) for r in rows)

    expected = recommended(first)
    some = clean.filter(F.col("category") == cat)
    busy = some.orderBy("user_id").first().user_id
    more = some.limit(1).withColumn("user_id", F.lit(busy)).crossJoin(spark.range(40)).drop("id")
    later = recommend.fit_or_load(clean.unionByName(more), tmp_dir, cat, max_iter=3)
    assert recommended(later) == expected and expected

    # other settings are another model; a half-written model is fitted again
    assert recommend.model_path(tmp_dir, cat, max_iter=3) != recommend.model_path(tmp_dir, cat, max_iter=2)
    path = recommend.model_path(tmp_dir, cat, max_iter=3)
    os.rename(f"{path}/complete", f"{path}/incomplete")
    assert recommend.load_fitted(spark, path) is None
    assert recommended(recommend.fit_or_load(clean, tmp_dir, cat, max_iter=3)) == expected
    with pytest.raises(TypeError):
        recommend.fit_or_load(clean, tmp_dir, cat, rnk=3)


def test_fit_does_not_follow_the_parallelism(spark, clean):
    als = recommend.make_als()
    assert als.getNumUserBlocks() == als.getNumItemBlocks() == recommend.ALS_BLOCKS
    assert recommend.make_als(blocks=3).getNumUserBlocks() == 3


def _factors(spark, x):
    return spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id long, features array<float>")


@pytest.mark.parametrize("group, k", [(7, 6), (16, 1), (None, 100)])
def test_top_products_match_brute_force(spark, monkeypatch, group, k):
    for name, value in (("HEAD", 5), ("USER_BLOCK", 4), ("ITEM_BLOCK", 9)):
        monkeypatch.setattr(inner_topk, name, value)
    rng = np.random.default_rng(1)
    users, items = rng.integers(-3, 4, (50, 4)), rng.integers(-3, 4, (70, 4))
    users[5] = 0  # scores 0 with every product
    items *= rng.integers(1, 5, (70, 1))  # products of different lengths
    got = inner_topk.top_products(_factors(spark, users), _factors(spark, items).repartition(5), k, group)
    rows = sorted((r.user_index, r.position, r.product_index, r.predicted_rating) for r in got.collect())
    want = []
    for u in range(50):
        scores = items @ users[u]
        want += [(u, n + 1, int(i), float(scores[i])) for n, i in enumerate(np.lexsort((np.arange(70), -scores))[:k])]
    assert rows == want


def test_tiles_out_of_reach_are_skipped(spark):
    """Short products cannot reach the tenth score, so their tiles are not there."""
    users = spark.createDataFrame([(i, i // 8, 5.0 + i / 100) for i in range(16)], "id long, gu long, need double")
    items = spark.createDataFrame([(g, n) for g, n in enumerate([9.0, 6.0, 5.05, 1.0])], "gi long, norm double")
    met = sorted(map(tuple, inner_topk.tiles(users, items).collect()))
    assert met == [(0, 0), (0, 1), (0, 2), (1, 0), (1, 1)]


def test_score_requests(spark):
    rng = np.random.default_rng(2)
    users, items = _factors(spark, rng.random((30, 3))), _factors(spark, rng.random((40, 3)))
    asked = spark.createDataFrame([(i,) for i in (3, 3, 7, 29, 1000)], "user_index long")  # a repeat, an unknown one
    got = recommend.score_requests(users, items, asked, 6).collect()
    every = inner_topk.top_products(users, items, 6).filter(F.col("user_index").isin(3, 7, 29)).collect()
    assert sorted(got) == sorted(every) and len(got) == 18
    assert recommend.score_requests(users, items, asked.limit(0)).count() == 0
    assert recommend.score_requests(users, items.limit(0), asked).count() == 0


def test_hot_user_is_split_in_the_activity_filter(spark):
    """Half of all rows on one user: the join against the written key list gets a skew read."""
    keep = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    new = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
           "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
           "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.shuffle.partitions": "20"}
    for k, v in new.items():
        spark.conf.set(k, v)
    try:
        i = F.col("id")
        df = spark.range(400_000).repartition(8).select(
            F.when(i % 2 == 0, "hot").otherwise((i % 5000).cast("string")).alias("user_id"),
            (i % 3000).cast("string").alias("product_id"), F.lit(1.0).alias("rating"))
        out = recommend.activity_filter(df)
        assert out.count() == 400_000
        out.write.format("noop").mode("overwrite").save()
        out.collect()
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in new:
            spark.conf.set(k, keep[k]) if k in keep else spark.conf.unset(k)


def test_content_similarity_hand_case(spark):
    from revlens.operators.content import similar_by_content

    rows = [
        ("a", "red steel bolt", "strong bolt"),
        ("b", "red steel bolt", "strong bolt"),  # same words as a -> cosine 1
        ("c", "blue plastic ring", "soft ring"),  # nothing shared -> absent
        ("d", "red ring", "bolt"),
    ]
    df = spark.createDataFrame(rows, "product_id string, title string, review_text string")
    out = {r.product_id: (r.cosine, r.position) for r in similar_by_content(df, "a").collect()}
    assert set(out) == {"b", "d"}
    assert out["b"][0] == pytest.approx(1.0) and out["b"][1] == 1
    assert 0 < out["d"][0] < 1 and out["d"][1] == 2


def test_variant_trains_on_everything(clean):
    fitted = recommend.fit_recommender(clean, min_interactions=0, train_percent=100, max_iter=3)
    assert fitted.test.count() == 0
    assert fitted.train.count() == clean.count()  # no activity filter, no hold-out
    pred = recommend.predictions(fitted, on=fitted.train)
    assert pred.count() == clean.count()  # in-sample: every pair is known to the model


def test_dense_index_across_many_partitions(spark):
    """Coalescing off, so the counts really span several range partitions and the
    per-partition offsets are exercised; compared with StringIndexer."""
    prev = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(20000).select(
            (F.col("id") % 997).cast("string").alias("k0"), (F.col("id") % 13).alias("m")
        ).select(F.when(F.col("m") < 3, F.lit("hot")).otherwise(F.col("k0")).alias("k"))
        idx = dense_index(df, "k", "k_index")
        parts = idx.select(F.spark_partition_id()).distinct().count()
        ours = {r["k"]: r["k_index"] for r in idx.collect()}
        model = StringIndexer(inputCol="k", outputCol="i", stringOrderType="frequencyDesc").fit(df)
        assert ours == {label: i for i, label in enumerate(model.labels)}
        assert sorted(ours.values()) == list(range(len(ours)))
        assert parts > 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", prev)


def test_a_product_is_sent_once_per_user_group_and_yields_are_k_a_user(spark, monkeypatch):
    """Many tied products over many blocks: ten rows a user leave the tasks, not ten per block."""
    for name, value in (("HEAD", 5), ("USER_BLOCK", 8), ("ITEM_BLOCK", 4), ("PAIRS", 16)):
        monkeypatch.setattr(inner_topk, name, value)
    sent = []
    meet = inner_topk._met
    monkeypatch.setattr(inner_topk, "_met", lambda u, i, n, k: sent.append(meet(u, i, n, k)) or sent[-1])
    users, items = np.ones((40, 3)), np.ones((200, 3))
    items[150:] *= 1 - np.arange(50)[:, None] / 100
    got = inner_topk.top_products(_factors(spark, users), _factors(spark, items), 10, 20).collect()
    assert sorted((r.user_index, r.position, r.product_index) for r in got) == [
        (u, n + 1, n) for u in range(40) for n in range(10)]
    assert sent[-1].count() == 400 and sent[-1].rdd.getNumPartitions() == 2


@pytest.mark.parametrize("size", [1e-30, 1.0, 1e30])
def test_top_products_of_any_size_of_factors(spark, size):
    """Products are found in single precision; factors beyond its range must not be lost."""
    rng = np.random.default_rng(3)
    users, items = rng.normal(size=(20, 6)), rng.normal(size=(90, 6)) * size
    got = inner_topk.top_products(_factors(spark, users), _factors(spark, items), 7).collect()
    want = [(u, n + 1, int(i)) for u in range(20) for n, i in enumerate(np.argsort(-(items @ users[u]))[:7])]
    assert sorted((r.user_index, r.position, r.product_index) for r in got) == want


def _met_pairs(monkeypatch, u, v, ids, k, leaf, block):
    """The ``k`` best products of each user over blocks in falling norm, and how many pairs were scored."""
    scored, meet = [], inner_topk.Asking._meet
    monkeypatch.setattr(inner_topk.Asking, "_meet", lambda self, who, i, *a: scored.append(len(who) * len(i)) or meet(self, who, i, *a))
    asking = inner_topk.Asking(np.arange(len(u)), u, np.full(len(u), np.nan), k)
    by_norm = np.lexsort((ids, -np.sqrt((v * v).sum(axis=1))))
    for at in range(0, len(v), block):
        rows = by_norm[at:at + block]
        rows = rows[inner_topk.like(v[rows], ids[rows], leaf)]
        products = inner_topk.Products(ids[rows].tobytes(), v[rows].tobytes(), True, leaf)
        if asking.open:
            asking.meet(products)
    return asking, sum(scored)


def test_leaves_out_of_reach_are_passed_over(monkeypatch):
    """Products of one length in all directions: norms say nothing, the boxes of the leaves do."""
    rng = np.random.default_rng(5)
    u, v = rng.normal(size=(200, 3)) + [6, 0, 0], rng.normal(size=(8000, 3))
    v /= np.sqrt((v * v).sum(axis=1))[:, None]
    ids = rng.permutation(8000).astype(np.int64)
    asking, pairs = _met_pairs(monkeypatch, u, v, ids, 10, 32, 4000)
    scores = (u[:, None, :] * v[None, :, :]).sum(axis=2)
    for n in range(200):
        best = np.lexsort((ids, -scores[n]))[:10]
        assert asking.found[n].tolist() == ids[best].tolist() and asking.score[n].tolist() == scores[n, best].tolist()
    assert pairs < 0.2 * 200 * 8000  # all of them before


def test_leaves_that_only_tie_with_larger_ids_are_passed_over(monkeypatch):
    u, v = np.tile([[6.0, 0.0, 1.0]], (50, 1)), np.tile([[0.1, 0.2, 0.3]], (5000, 1))
    v[::3, 1] = 0.4  # another vector of the same score
    ids = np.arange(5000)[::-1].copy()
    asking, pairs = _met_pairs(monkeypatch, u, v, ids, 10, 32, 1000)
    assert asking.found.tolist() == [list(range(10))] * 50
    assert pairs < 0.2 * 50 * 5000


@pytest.mark.parametrize("d", [1, 3, 7, 8, 20, 130])
def test_a_leaf_bounds_its_rounded_scores(d):
    rng = np.random.default_rng(d)
    u, v = (rng.normal(size=(300, d)) * 10.0 ** rng.integers(-9, 9, (300, d)) for _ in range(2))
    v[10:20] = v[10]  # a leaf of equal vectors: the bound is the score
    products = inner_topk.Products(np.arange(300).tobytes(), v.tobytes(), True, 10)
    asking = inner_topk.Asking(np.arange(300), u, np.full(300, np.nan), 1)
    for n in range(300):
        scores = (u * v[n]).sum(axis=1)
        asking.score, asking.bar, asking.found = scores[:, None], scores, np.full((300, 1), n + 1)
        assert asking._enters(np.arange(300), np.full(300, n // 10), products).all()
        asking.found = np.full((300, 1), products.least[n // 10])  # its smallest id is there already
        assert n // 10 != 1 or not asking._enters(np.arange(300), np.full(300, 1), products).any()
