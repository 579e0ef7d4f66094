import numpy as np
import pytest
from pyspark.sql import functions as F

from revlens.llm import ann

SCHEMA = "vec_id long, embedding array<float>"


def frame(spark, ids, x):
    return spark.createDataFrame([(None if i is None else int(i), None if v is None else [None if c is None else float(c) for c in v])
                                  for i, v in zip(ids, x)], SCHEMA)


def truth(ids, x, queries, k):
    out = {}
    x = x.astype(np.float32).astype(np.float64)
    for q in queries:
        s = np.einsum("d,nd->n", x[ids == q][0], x)
        order = [i for i in np.lexsort((ids, -s)) if ids[i] != q]
        out[q] = [(int(ids[i]), s[i]) for i in order[:k]]
    return out


def recall(rows, want):
    got = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert got.keys() == want.keys()
    for q, hits in got.items():
        assert len(hits) == len(want[q]) == len({i for i, _ in hits}) and q not in {i for i, _ in hits}
        assert hits == sorted(hits, key=lambda h: (-h[1], h[0]))
    return np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / len(want[q]) for q in want])


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 16))
    x = centres[rng.integers(0, 12, 3000)] + 0.5 * rng.normal(size=(3000, 16))
    x *= rng.uniform(0.3, 2, (3000, 1))  # norms differ, so inner product is not cosine
    return np.arange(3000) * 2, x


def test_recall_against_brute_force(spark, data, monkeypatch):
    ids, x = data
    want = truth(ids, x, [int(i) for i in ids if i % 20 == 0], 20)
    rows = ann.nearest(frame(spark, ids, x), F.col("vec_id") % 20 == 0).collect()
    assert recall(rows, want) >= 0.9
    by = {(r.query_id, r.vec_id): r.score for r in rows}
    x32 = x.astype(np.float32).astype(np.float64)
    for (q, v), s in list(by.items())[:500]:
        assert abs(s - x32[q // 2] @ x32[v // 2]) < 1e-9
    monkeypatch.setattr(ann, "BLOCK", 60)  # blocks of leaves and of queries
    monkeypatch.setattr(ann, "QUERY_BLOCK", 9)
    assert recall(ann.nearest(frame(spark, ids, x), F.col("vec_id") % 20 == 0).collect(), want) >= 0.9


def test_equal_vectors_and_ties(spark):
    rng = np.random.default_rng(2)
    x = np.vstack([np.tile(rng.normal(size=8), (400, 1)), rng.normal(size=(200, 8))])
    ids = rng.permutation(600)
    want = truth(ids, x, [int(i) for i in ids if i % 20 == 0], 20)
    rows = ann.nearest(frame(spark, ids, x), F.col("vec_id") % 20 == 0, target=1.0).collect()
    assert recall(rows, want) >= 0.97
    hot = [int(i) for i in ids[:400] if i % 20 == 0]
    for q in hot:  # ties go to the smaller ids
        assert [r.vec_id for r in sorted(rows, key=lambda r: r["rank"]) if r.query_id == q] == [i for i, _ in want[q]]


def test_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    x = [[1, 0], [2, 0], None, [], [0, 0], [1, None], [nan, 1], [inf, 1], [1, 2, 3], [3, 1], [1, 0]]
    ids = [0, 20, 40, 60, 80, 100, 120, 140, 160, 3, None]
    df = frame(spark, [*ids, 20], [*x, [2, 0]]).withColumn("v", F.lit(1)).withColumn("leaf", F.lit(2))
    got = ann.nearest(df, F.col("vec_id") % 20 == 0).collect()
    assert {r.query_id: [] for r in got}.keys() == {0, 20}
    assert [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == 0] == [(3, 3.0), (20, 2.0)]
    assert ann.nearest(frame(spark, [], []), F.col("vec_id") % 20 == 0).count() == 0


def test_walk_is_best_bin_first_and_complete():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(2000, 6))
    tree = ann.build_tree(x, float(np.sqrt((x * x).sum(1).max())), branch=4, leaf=50)
    leaves = max(tree.leaf) + 1
    assert set(tree.assign(x)) <= set(range(leaves))
    for q in x[:20]:
        walk = list(tree.walk(q))
        assert sorted(walk) == list(range(leaves))
