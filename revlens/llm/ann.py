"""Operator 5, approximate nearest neighbours: hierarchical k-means tree, best bin first.

Index.  Inner product is turned into distance by one more component,
sqrt(M^2 - |v|^2) with M the largest norm.  A tree of k-means splits is fitted
on a bounded sample (``SAMPLE`` vectors, a documented bound) in one task; every
vector of the table is then sent to its leaf.

Search.  A query walks the tree best bin first: a priority queue holds the
branches by the distance of their centre, and leaves come out nearest first.
How many leaves to visit is calibrated: for a bounded set of calibration
queries the true neighbours are found by brute force over all vectors (in
blocks), the rank of each neighbour's leaf in its query's walk is noted, and
the visits widen until ``TARGET_RECALL`` of the neighbours are reached.

Scale.  Equal vectors are one entry with its ``k + 1`` smallest ids: no more
can be among the nearest, as ties go to the smaller id, so this is exact.  A
leaf of many vectors is cut into blocks and a leaf that many queries visit into
query blocks; each pair of blocks is a task's group of bounded size, which
yields at most k rows a query.  Scores are exact inner products of the original
vectors in double precision.

Defined cases: vectors that are null, empty, zero or hold a null or non-finite
component take no part, as queries or candidates; so do those whose length is
not the most common one, and null ids; repeated rows count once; fewer
candidates than k: all of them; no vectors, no rows.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.llm.common import written

K = 20
SAMPLE = 20_000
BRANCH = 8
LEAF = 128
TARGET_RECALL = 0.97
CALIBRATION = 128
BLOCK = 4096
QUERY_BLOCK = 1024
SEED = 11


# ---- the tree ----------------------------------------------------------------


@dataclass
class Tree:
    """Centres of all nodes, children of inner nodes, leaf number of leaves (-1: inner)."""

    centres: np.ndarray
    children: list[list[int]]
    leaf: list[int]
    norm: float

    def lift(self, x: np.ndarray) -> np.ndarray:
        """Vectors with the component that turns inner product into distance."""
        rest = np.sqrt(np.maximum(self.norm ** 2 - (x * x).sum(1), 0))
        return np.hstack([x, rest[:, None]])

    def assign(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector, going down to the nearest centre."""
        out = np.empty(len(x), np.int64)
        todo = [(0, np.arange(len(x)))]
        y = self.lift(x)
        while todo:
            node, rows = todo.pop()
            kids = self.children[node]
            if not kids:
                out[rows] = self.leaf[node]
                continue
            near = _distances(y[rows], self.centres[kids]).argmin(1)
            todo += [(kid, rows[near == i]) for i, kid in enumerate(kids) if (near == i).any()]
        return out

    def walk(self, q: np.ndarray) -> Iterator[int]:
        """Leaves, best bin first, for one query vector."""
        size = np.sqrt((q * q).sum())
        point = np.append(q * (self.norm / size), 0.0)
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            kids = self.children[node]
            if not kids:
                yield self.leaf[node]
                continue
            d = self.centres[kids] - point
            for kid, far in zip(kids, (d * d).sum(1)):
                heapq.heappush(queue, (float(far), kid))


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (centres * centres).sum(1) - 2 * (x @ centres.T)


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    centres = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        near = _distances(x, centres).argmin(1)
        for i in range(k):
            mine = x[near == i]
            centres[i] = mine.mean(0) if len(mine) else x[rng.integers(len(x))]
    return centres


def build_tree(sample: np.ndarray, norm: float, branch: int = BRANCH, leaf: int = LEAF, seed: int = SEED) -> Tree:
    """A tree over the sample: nodes of over ``leaf`` sample vectors are split into ``branch`` by k-means."""
    rng = np.random.default_rng(seed)
    tree = Tree(np.empty((0, 0)), [[]], [-1], norm)
    y = tree.lift(sample)
    centres = [y.mean(0) if len(y) else np.zeros(sample.shape[1] + 1)]
    todo, leaves = [(0, np.arange(len(y)))], 0
    while todo:
        node, rows = todo.pop()
        x = y[rows]
        split = None
        if len(rows) > leaf:
            found = _kmeans(x, branch, rng)
            near = _distances(x, found).argmin(1)
            if len(np.unique(near)) > 1:
                split = [(found[i], rows[near == i]) for i in range(branch) if (near == i).any()]
        if split is None:
            tree.leaf[node] = leaves
            leaves += 1
            continue
        for centre, part in split:
            tree.children[node].append(len(centres))
            todo.append((len(centres), part))
            centres.append(centre)
            tree.children.append([])
            tree.leaf.append(-1)
    tree.centres = np.array(centres)
    return tree


# ---- tables ------------------------------------------------------------------


def usable(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, v array<double>, norm2) of the vectors that take part."""
    v = F.transform(F.col(vector), lambda x: x.cast("double"))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).filter(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull())
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    norm2 = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    rows = rows.filter(finite).withColumn("norm2", norm2).filter("norm2 > 0")
    rows = written(rows, "vectors")
    # one row per vector length
    common = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows if common is None else rows.filter(F.size("v") == common["d"])


def entries(rows: DataFrame, k: int = K) -> DataFrame:
    """(v, ids): distinct vectors with their k + 1 smallest ids."""
    keyed = rows.select("v", "vec_id").distinct()
    first = F.slice(F.array_sort(F.collect_list("vec_id")), 1, k + 1)
    # a first level per (vector, id block), so that a vector held by a third of all rows is never one list
    block = F.pmod(F.xxhash64("vec_id"), F.lit(BLOCK))
    some = keyed.withColumn("b", block).groupBy("v", "b").agg(first.alias("ids"))
    return some.groupBy("v").agg(F.slice(F.array_sort(F.flatten(F.collect_list("ids"))), 1, k + 1).alias("ids"))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), np.float64).reshape(len(column), -1)


def fit(rows: DataFrame, sample: int = SAMPLE, branch: int = BRANCH, leaf: int = LEAF) -> Tree | None:
    """The tree, fitted in one task on about ``sample`` vectors chosen by a hash of the id."""
    total, norm2 = rows.agg(F.count(F.lit(1)), F.max("norm2")).first()
    if not total:
        return None
    share = max(1, int(min(1.0, sample / total) * 1_000_000))
    norm = float(np.sqrt(norm2))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [b for b in batches if len(b)]
        if parts:
            all_ = pd.concat(parts).sort_values("vec_id")
            tree = build_tree(_matrix(all_["v"]), norm, branch, leaf)
            yield pd.DataFrame({"tree": [pickle.dumps(tree)]})

    chosen = rows.filter(F.pmod(F.xxhash64("vec_id"), F.lit(1_000_000)) < share).select("vec_id", "v").distinct()
    got = chosen.repartition(1).mapInPandas(run, "tree binary").first()
    return pickle.loads(got["tree"]) if got else build_tree(np.empty((0, 1)), norm)


def index(found: DataFrame, tree: Tree) -> DataFrame:
    """The entries with their leaf."""
    shared = found.sparkSession.sparkContext.broadcast(tree)  # a bounded number of centres

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                yield b.assign(leaf=shared.value.assign(_matrix(b["v"])))

    return written(found.mapInPandas(run, "v array<double>, ids array<long>, leaf long"), "leaves")


# ---- search ------------------------------------------------------------------

_HITS = "query_id long, hits array<struct<score: double, vec_id: long>>"


def _top(scores: np.ndarray, ids: list, own: int, k: int) -> list[tuple[float, int]]:
    """The k best (score, id) of entries with their id lists, the query's own id left out."""
    if len(scores) > k + 1:
        least = np.partition(scores, len(scores) - k - 1)[len(scores) - k - 1]
        rows = np.flatnonzero(scores >= least)
    else:
        rows = np.arange(len(scores))
    found = [(-scores[i], j) for i in rows for j in ids[i] if j != own]
    return [(-s, j) for s, j in heapq.nsmallest(k, found)]


def _scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products, each summed alone, so that equal vectors have equal scores."""
    return np.einsum("qd,nd->qn", q, x, optimize=False)


def brute_force(found: DataFrame, queries: pd.DataFrame, k: int = K) -> DataFrame:
    """(query_id, hits with leaf): true neighbours of a bounded set of queries, over all entries."""
    shared = found.sparkSession.sparkContext.broadcast(queries)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        asked = shared.value
        q = _matrix(asked["v"])
        best: list[list[tuple]] = [[] for _ in range(len(asked))]
        for b in batches:
            if not len(b):
                continue
            s = _scores(q, _matrix(b["v"]))
            leaf = {j: int(n) for ids, n in zip(b["ids"], b["leaf"]) for j in ids}
            for i, own in enumerate(asked["vec_id"]):
                new = [(-v, j, leaf[j]) for v, j in _top(s[i], b["ids"].tolist(), own, k)]
                best[i] = heapq.nsmallest(k, best[i] + new)
        rows = [(int(o), -s, j, n) for o, hits in zip(asked["vec_id"], best) for s, j, n in hits]
        yield pd.DataFrame(rows, columns=["query_id", "score", "vec_id", "leaf"])

    return found.mapInPandas(run, "query_id long, score double, vec_id long, leaf long")


def calibrate(found: DataFrame, rows: DataFrame, tree: Tree, k: int = K, target: float = TARGET_RECALL) -> int:
    """Leaves to visit so that the calibration queries reach the target recall."""
    asked = rows.orderBy(F.xxhash64(F.lit("calibrate"), "vec_id"), "vec_id").limit(CALIBRATION)
    asked = asked.select("vec_id", "v").toPandas()  # at most CALIBRATION rows
    hits = brute_force(found, asked, k)
    # per query: k rows of every task, merged by partial top-k
    merged = hits.groupBy("query_id").agg(
        F.slice(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id", "leaf"))), 1, k).alias("h"))
    walk = {int(i): {leaf: n for n, leaf in enumerate(tree.walk(np.array(v)))} for i, v in zip(asked["vec_id"], asked["v"])}
    ranks = np.sort([walk[r["query_id"]][h["leaf"]] for r in merged.collect() for h in r["h"]])
    if not len(ranks):
        return 1
    visits = 1
    while (ranks < visits).mean() < target:  # widen until the recall is reached
        visits += 1
    return visits


def search(found: DataFrame, queries: DataFrame, tree: Tree, visits: int, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score) for queries (vec_id, v) against the indexed entries."""
    spark = found.sparkSession
    shared = spark.sparkContext.broadcast(tree)

    def walks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for i, v in zip(b["vec_id"], b["v"]):
                leaves = list(islice(shared.value.walk(np.array(v)), visits))
                yield pd.DataFrame({"query_id": i, "leaf": leaves})

    asked = written(queries.select("vec_id", "v").mapInPandas(walks, "query_id long, leaf long"), "walks")
    sizes = found.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    loads = asked.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / QUERY_BLOCK).cast("int").alias("qblocks"))
    # one row per leaf, bounded by the sample
    grid = written(sizes.join(loads, "leaf").withColumnRenamed("leaf", "l"), "grid")
    own_block = F.pmod(F.xxhash64("v"), F.col("blocks")).cast("int")
    own_qblock = F.pmod(F.xxhash64("query_id"), F.col("qblocks")).cast("int")
    left = found.join(F.broadcast(grid), F.col("leaf") == F.col("l")).select(
        "leaf", own_block.alias("i"), F.explode(F.sequence(F.lit(0), F.col("qblocks") - 1)).alias("j"), "v", "ids")
    right = asked.join(F.broadcast(grid), F.col("leaf") == F.col("l")).select(
        "leaf", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("i"), own_qblock.alias("j"), "query_id")
    right = right.join(queries.select("vec_id", "v"), F.col("query_id") == F.col("vec_id")).drop("vec_id")

    def tile(x: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        if not len(x) or not len(q):
            return pd.DataFrame({"query_id": [], "hits": []})
        s = _scores(_matrix(q["v"]), _matrix(x["v"]))
        ids = x["ids"].tolist()
        rows = [(own, [{"score": a, "vec_id": j} for a, j in _top(s[i], ids, own, k)])
                for i, own in enumerate(q["query_id"])]
        return pd.DataFrame(rows, columns=["query_id", "hits"])

    keys = ["leaf", "i", "j"]
    hits = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(tile, _HITS)
    order = F.transform(F.flatten(F.collect_list("hits")),
                        lambda h: F.struct((-h["score"]).alias("s"), h["vec_id"].alias("vec_id")))
    # at most visits x blocks lists of k
    best = hits.groupBy("query_id").agg(F.slice(F.array_sort(order), 1, k).alias("h"))
    return best.select("query_id", F.posexplode("h").alias("pos", "h")).select(
        "query_id", (F.col("pos") + 1).cast("int").alias("rank"), "h.vec_id", (-F.col("h.s")).alias("score"))


def nearest(vectors: DataFrame, is_query, id_col: str = "vec_id", vector: str = "embedding", k: int = K,
            target: float = TARGET_RECALL) -> DataFrame:
    """The k nearest of every query (rows for which ``is_query`` holds on vec_id) among all other rows."""
    rows = usable(vectors, id_col, vector)
    tree = fit(rows)
    if tree is None:
        return rows.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id",
                           F.lit(0.0).alias("score")).limit(0)
    found = index(entries(rows, k), tree)
    visits = calibrate(found, rows, tree, k, target)
    queries = rows.filter(is_query).select("vec_id", "v").distinct()
    return search(found, queries, tree, visits, k)
