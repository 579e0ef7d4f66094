"""The ``k`` products of largest inner product for every asking user (M7), by tiles.

Users and products are factor vectors.  A score is at most the product of the
two lengths (norms), so:

1. products are ranked by falling norm (a sort by range and counts per
   partition) and cut into groups; every user is scored against the ``HEAD``
   longest ones, which gives a score that their k-th place cannot fall under;
2. a user needs products of norm at least that score / the user's norm; users
   are ranked by it and their blocks dealt to groups;
3. a tile (user group, block of products) is worked on only if the block's
   longest product reaches what the group's least demanding user needs.  One
   task holds a user group with its k best so far and reads the blocks it needs
   one after the other, longest products first;
4. the products of a block are laid in leaves of like vectors (split at the
   median of their widest dimension).  The corner of a leaf's box that lies
   farthest in a user's direction bounds its scores: a leaf whose corner stays
   under the user's k-th score, or reaches just that with larger ids only, is
   passed over.  The sum over the corner is taken as a score's is, and rounding
   keeps the order of sums, so the bound holds for the rounded scores too;
5. of the leaves left, the pairs that can reach the user's k-th score are found
   in single precision, with the rounding error as a margin; only those are
   summed in full.

Nothing passes the driver but two counts, and no join is a product: users and
products meet on the group's number.  A user is sent once and yields k rows.  A
product is sent once per user group that can need it; there are twice as many
groups as cores, and more only if a group would be over ``GROUP`` users, so what
is moved grows with the products and a task's memory is bounded by ``GROUP``.
The work stays the bounds of all leaves and the pairs within them: where neither
norms nor boxes say much (many dimensions, no clusters), all pairs.

Scores are exact: what the matrix product finds near the bar is summed in double,
each pair alone, so equal vectors have equal scores whatever the tile.  Ties go
to the smaller product id.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlens.session import written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

HEAD = 1024
GROUP = 262_144
LEAST_GROUP = 1024
USER_BLOCK, ITEM_BLOCK = 1024, 16_384
ALONE = 60_000  # pairs that can be scored in the time of one more call
LEAF, LEAVES = 128, 8  # scores held at a time: those of a user block and 8 leaves, 4 MB
PAIRS = 1 << 16  # pairs summed in full at a time
SLACK = 1e-9

_SCORES = ("user_index", "product_index", "predicted_rating")
SCORES = "user_index long, product_index long, predicted_rating double"
BLOCK = "ids binary, vectors binary, wide boolean, floors binary"
_BLOCK = ("ids", "vectors", "wide", "floors")
NO_ID = np.iinfo(np.int64).max


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` with its 0-based ``rank`` in ``order``, written."""
    placed = written(df.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")), f"{name}_sorted")
    counts = placed.groupBy("part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition
    shifts = counts.select(F.col("part").alias("p"), (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("s"))
    return written(placed.join(F.broadcast(shifts), F.col("part") == F.col("p")).withColumn(
        "rank", F.col("at") + F.col("s")).drop("part", "at", "p", "s"), name)


def _vectors(df: DataFrame) -> DataFrame:
    v = F.col("features").cast("array<double>")
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))
    return df.select(F.col("id").cast("long").alias("id"), v.alias("features"), norm.alias("norm"))


def _group_size(n: int, spark) -> int:
    """Users of a group: two groups for each core, and no group over ``GROUP``.  Results do not depend on it."""
    return min(GROUP, max(LEAST_GROUP, -(-n // (2 * spark.sparkContext.defaultParallelism))))


def like(v: np.ndarray, ids: np.ndarray, leaf: int) -> np.ndarray:
    """An order of the vectors in which each run of ``leaf`` is close together; the longest first, of equal ones the smallest ids."""
    parts, held = [], [np.argsort(ids, kind="stable")]
    while held:
        rows = held.pop()
        if len(rows) <= leaf:
            parts.append(rows)
            continue
        widest = np.argmax(np.ptp(v[rows], axis=0))
        rows = rows[np.argsort(v[rows, widest], kind="stable")]
        half = leaf * -(-len(rows) // (2 * leaf))  # only the last run is shorter
        held += [rows[half:], rows[:half]]
    norm = _lengths(v)
    parts[:-1] = sorted(parts[:-1], key=lambda rows: (-norm[rows].max(), ids[rows].min()))
    return np.concatenate(parts)


def _blocks(df: DataFrame, *keys: str, leaf: int | None = None) -> DataFrame:
    """One row per block: the ids, vectors and floors of its rows as bytes (vectors in single precision if that is exact).

    With ``leaf`` the rows are in the order of :func:`like`.
    """
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("rank")
        v = np.array(rows["features"].tolist(), np.float64)
        if leaf:
            order = like(v, rows["id"].to_numpy(np.int64), leaf)
            rows, v = rows.iloc[order], v[order]
        with np.errstate(over="ignore"):
            short = v.astype(np.float32)
        wide = not np.array_equal(short, v)
        return pd.DataFrame([(*key, rows["id"].to_numpy(np.int64).tobytes(), (v if wide else short).tobytes(), wide,
                              rows["floor"].to_numpy(np.float64).tobytes())])

    schema = "".join(f"{k} long, " for k in keys) + BLOCK
    return df.groupBy(*keys).applyInPandas(run, schema)


def _unpacked(ids: bytes, vectors: bytes, wide: bool) -> tuple[np.ndarray, np.ndarray]:
    numbers = np.frombuffer(ids, np.int64)
    return numbers, np.frombuffer(vectors, np.float64 if wide else np.float32).reshape(len(numbers), -1).astype(np.float64)


def _lengths(v: np.ndarray) -> np.ndarray:
    largest = np.abs(v).max(axis=1, initial=0.0)  # taken out first: squares may leave the range of a double
    return largest * np.sqrt(((v / np.where(largest > 0, largest, 1)[:, None]) ** 2).sum(axis=1))


class Best:
    """The ``k`` best (larger score, then smaller id) that each of some rows has met; ``bar``: scores below do not count."""

    def __init__(self, ids: np.ndarray, bar: np.ndarray, k: int) -> None:
        self.ids, self.bar, self.k = ids, bar, k
        self.score = np.full((len(ids), k), -np.inf)
        self.found = np.full((len(ids), k), NO_ID)

    def take(self, r: np.ndarray, score: np.ndarray, found: np.ndarray) -> None:
        """Take what the rows ``r`` (by position, repeats included) met."""
        last = self.score[r, -1]
        over = (score >= self.bar[r]) & ((score > last) | ((score == last) & (found < self.found[r, -1])))
        if not over.any():
            return
        r, score, found = r[over], score[over], found[over]
        who = np.unique(r)
        r = np.concatenate([np.repeat(who, self.k), r])
        score = np.concatenate([self.score[who].ravel(), score])
        found = np.concatenate([self.found[who].ravel(), found])
        order = np.lexsort((found, -score, r))
        r, score, found = r[order], score[order], found[order]
        keep = np.arange(len(r)) - np.searchsorted(r, r) < self.k
        self.score[who] = score[keep].reshape(-1, self.k)
        self.found[who] = found[keep].reshape(-1, self.k)
        self.bar[who] = np.maximum(self.bar[who], self.score[who, -1])

    def best(self, names: tuple[str, ...]) -> pa.RecordBatch:
        there = self.found != NO_ID
        return pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(self.ids, self.k)[there.ravel()]), pa.array(self.found[there]), pa.array(self.score[there])],
            names=list(names))


class Products:
    """A block of products: vectors over the norm of the longest (``top``), and the box of each leaf."""

    def __init__(self, ids: bytes, vectors: bytes, wide: bool, leaf: int) -> None:
        self.ids, self.v = _unpacked(ids, vectors, wide)
        self.top = float(_lengths(self.v).max())
        self.unit = (self.v / (self.top or 1)).astype(np.float32)
        self.leaf, starts = leaf, np.arange(0, len(self.ids), leaf)
        self.low, self.high = np.minimum.reduceat(self.v, starts), np.maximum.reduceat(self.v, starts)
        self.corners = np.hstack([self.high, self.low])
        self.far = _lengths(np.maximum(np.abs(self.low), np.abs(self.high)))
        self.least = np.minimum.reduceat(self.ids, starts)

    def rows(self, leaves: np.ndarray) -> np.ndarray:
        rows = (leaves[:, None] * self.leaf + np.arange(self.leaf)).ravel()
        return rows[rows < len(self.ids)]


class Asking(Best):
    """A block of users and the ``k`` best products each has met."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, floor: np.ndarray, k: int) -> None:
        self.u = vectors
        super().__init__(ids, np.where(np.isnan(floor), -np.inf, floor), k)
        self.norm = _lengths(self.u)
        self.unit = (self.u / np.where(self.norm > 0, self.norm, 1)[:, None]).astype(np.float32)
        self.signs = np.vstack([np.maximum(self.u, 0).T, np.minimum(self.u, 0).T])
        self.open = True  # shorter products may still count

    def meet(self, products: Products) -> None:
        """Blocks come in the order of falling ``top``."""
        self.open = bool((self.bar <= self.norm * products.top * (1 + SLACK)).any())
        if not self.open:
            return
        bound = products.corners @ self.signs  # leaf by user
        bound += np.outer(products.far, self.norm * ((len(self.signs) + 8) * 2.0 ** -52))  # its rounding error
        left, step = np.flatnonzero((~(bound < self.bar)).any(axis=1)), 1
        left = left[np.argsort(-bound[left].max(axis=1), kind="stable")]  # the best first, they raise the bars
        while len(left):
            now, left = left[:step], left[step:]
            leaf, rows = np.nonzero(~(bound[now] < self.bar))
            enters = self._enters(rows, now[leaf], products)
            if enters.any():
                rows, leaf = rows[enters], leaf[enters]
                who, some = np.unique(rows), np.unique(leaf)
                # one by one, if few of the users ask for each
                apart = len(some) > 1 and len(rows) * products.leaf + len(some) * ALONE < len(who) * len(some) * products.leaf
                for of in ([n] for n in some) if apart else (some,):
                    at = products.rows(now[of])
                    self._meet(rows[leaf == of[0]] if apart else who, products.ids[at], products.v[at], products.unit[at], products.top)
                left = left[(~(bound[left] < self.bar)).any(axis=1)]
            step = min(2 * step, LEAVES)

    def _enters(self, rows: np.ndarray, leaf: np.ndarray, products: Products) -> np.ndarray:
        """Whether the leaves' corners get into the best of the users ``rows``, by the rule of :meth:`take`."""
        u = self.u[rows]
        most = (u * np.where(u > 0, products.high[leaf], products.low[leaf])).sum(axis=1)
        last = self.score[rows, -1]
        return (most >= self.bar[rows]) & ((most > last) | ((most == last) & (products.least[leaf] < self.found[rows, -1])))

    def _meet(self, who: np.ndarray, ids: np.ndarray, v: np.ndarray, unit: np.ndarray, top: float) -> None:
        """The users ``who`` and the products ``v``; ``unit``: these over ``top``, which no norm exceeds, in single precision."""
        reach = self.norm[who] * top
        zero = who[(reach == 0) & (self.bar[who] <= 0)]  # score 0 with all: the smallest ids
        if len(zero):
            first = np.argsort(ids, kind="stable")[:self.k]
            self._sum(np.repeat(zero, len(first)), np.tile(first, len(zero)), ids, v)
        open_ = (reach > 0) & (self.bar[who] <= reach * (1 + SLACK))
        asking, reach = who[open_], reach[open_]
        if not len(asking):
            return
        margin = (v.shape[1] + 8) * 2.0 ** -23  # twice the rounding error of vectors of length 1
        near = (self.unit if len(asking) == len(self.unit) else self.unit[asking]) @ unit.T
        least = np.maximum(self.bar[asking] / reach, -2.0) - margin
        rows, cols = np.divmod(np.flatnonzero(near >= least.astype(np.float32)[:, None]), near.shape[1])
        many = np.flatnonzero(np.bincount(rows, minlength=len(asking)) > 4 * self.k)
        if len(many):  # the bar is low: the k-th of these products counts
            k_th = np.partition(near[many], near.shape[1] - self.k, axis=1)[:, near.shape[1] - self.k]
            least[many] = np.maximum(least[many], k_th - 2 * margin)
            rows, cols = np.divmod(np.flatnonzero(near >= least.astype(np.float32)[:, None]), near.shape[1])
        self._sum(asking[rows], cols, ids, v)

    def _sum(self, rows: np.ndarray, cols: np.ndarray, ids: np.ndarray, v: np.ndarray) -> None:
        """Take the pairs with their full scores into the best ones; of many, by product, so that the first raise the bar."""
        if len(rows) > PAIRS:
            order = np.argsort(cols, kind="stable")
            rows, cols = rows[order], cols[order]
        for at in range(0, len(rows), PAIRS):
            r, c = rows[at:at + PAIRS], cols[at:at + PAIRS]
            self.take(r, (self.u[r] * v[c]).sum(axis=1), ids[c])


def _asking(held: list[tuple[np.ndarray, np.ndarray, np.ndarray]], k: int) -> list[Asking]:
    """The users of a group in blocks of like directions, which need like products."""
    ids, u, floor = (np.concatenate(c) for c in zip(*held))
    norm = _lengths(u)
    order = like(u / np.where(norm > 0, norm, 1)[:, None], ids, USER_BLOCK)
    return [Asking(ids[rows], u[rows], floor[rows], k) for rows in np.split(order, range(USER_BLOCK, len(order), USER_BLOCK))]


def _streamed(batches: Iterator[pa.RecordBatch], k: int, leaf: int) -> Iterator[pa.RecordBatch]:
    """The best of each group's users; its user blocks come before its product blocks."""
    group, held, asking = None, [], []
    for batch in batches:
        for gu, users, ids, vectors, wide, floors in zip(*(batch[c] for c in ("gu", "users", *_BLOCK))):
            if gu.as_py() != group:
                yield from (block.best(_SCORES) for block in asking)
                group, held, asking = gu.as_py(), [], []
            if users.as_py():
                held.append((*_unpacked(ids.as_py(), vectors.as_py(), wide.as_py()), np.frombuffer(floors.as_py(), np.float64)))
                continue
            if held:
                held, asking = [], _asking(held, k)
            products = Products(ids.as_py(), vectors.as_py(), wide.as_py(), leaf)
            for block in asking:
                if block.open:
                    block.meet(products)
    yield from (block.best(_SCORES) for block in asking)


def _met(users: DataFrame, items: DataFrame, groups: int, k: int) -> DataFrame:
    """The best of the user blocks among the product blocks of their group; a group is a partition of its own."""
    leaf = LEAF

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _streamed(batches, k, leaf)

    rows = users.unionByName(items).repartitionById(groups, F.col("gu").cast("int"))
    return rows.sortWithinPartitions("gu", F.desc("users"), "at").mapInArrow(run, SCORES)


def tiles(users: DataFrame, items: DataFrame) -> DataFrame:
    """(gu, gi): the tiles in which a product may reach what a user needs.

    Product groups are in the order of falling norms, so those of a user group
    are the first ones.  The norms are one number per ``ITEM_BLOCK`` products.
    """
    one = F.lit(1).alias("one")
    longest = items.groupBy("gi").agg(F.max("norm").alias("m")).groupBy(one).agg(F.collect_list("m").alias("longest"))
    needs = users.groupBy("gu").agg(F.min(F.coalesce("need", F.lit(float("-inf")))).alias("need"))
    needs = needs.select("gu", "need", one).join(F.broadcast(longest), "one")  # one row
    n = F.size(F.filter("longest", lambda m: m * (1 + SLACK) >= F.col("need")))
    return needs.select("gu", n.alias("n")).filter("n > 0").select(
        "gu", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n").cast("long") - 1)).alias("gi"))


def top_products(user_factors: DataFrame, item_factors: DataFrame, k: int, group: int | None = None) -> DataFrame:
    """(user_index, product_index, predicted_rating, position) for every row of ``user_factors`` (id, features)."""
    spark = user_factors.sparkSession
    items = numbered(_vectors(item_factors), [F.desc("norm"), F.asc("id")], "topk_items")
    asking = written(_vectors(user_factors), "topk_users")
    n_users = asking.count()
    user_group = group or _group_size(n_users, spark)
    items = items.withColumn("gi", F.floor(F.col("rank") / (group or ITEM_BLOCK)).cast("long"))
    # the first bar, from the longest products
    n = max(1, -(-n_users // user_group))
    head = _blocks(items.filter(F.col("rank") < max(HEAD, k)).withColumn("floor", F.lit(None).cast("double")), "gi", leaf=LEAF)
    head = head.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))).alias("gu"), F.col("gi").alias("at"),
                       F.lit(False).alias("users"), *_BLOCK)
    spread = asking.select(
        F.pmod(F.xxhash64("id"), F.lit(n)).cast("long").alias("gu"), "id", "features", F.col("id").alias("rank"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(-(-user_group // USER_BLOCK))).cast("long").alias("at"),
        F.lit(None).cast("double").alias("floor"))
    first = _met(_blocks(spread, "gu", "at").withColumn("users", F.lit(True)), head, n, k).groupBy("user_index").agg(
        F.min("predicted_rating").alias("floor"), F.count(F.lit(1)).alias("n"))
    first = written(first.filter(F.col("n") == k).select(F.col("user_index").alias("u"), "floor"), "topk_floors")
    need = F.when(F.col("norm") > 0, F.col("floor") / F.col("norm"))
    users = numbered(asking.join(first, F.col("id") == F.col("u"), "left").select("id", "features", "floor", need.alias("need")),
                      [F.asc_nulls_first("need"), F.asc("id")], "topk_needs")
    # dealt in blocks: the users that need many products are in all groups
    users = users.withColumn("gu", F.pmod(F.floor(F.col("rank") / USER_BLOCK), F.lit(n)).cast("long"))
    met = written(tiles(users, items), "topk_tiles")
    user_blocks = _blocks(users.withColumn("at", F.floor(F.col("rank") / USER_BLOCK)), "gu", "at")
    item_blocks = written(_blocks(items.withColumn("floor", F.lit(None).cast("double")), "gi", leaf=LEAF), "topk_blocks")
    scored = _met(user_blocks.withColumn("users", F.lit(True)),
                  item_blocks.join(met, "gi").withColumnRenamed("gi", "at").withColumn("users", F.lit(False)), n, k)
    w = Window.partitionBy("user_index").orderBy(F.desc("predicted_rating"), F.asc("product_index"))
    return scored.withColumn("position", F.row_number().over(w)).filter(F.col("position") <= k)
