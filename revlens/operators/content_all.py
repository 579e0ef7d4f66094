"""The most similar products of every product by content (D1 for all), by tiles.

Cosine of the TF-IDF vectors of :mod:`revlens.operators.content`, with the norms
divided out first, so a cosine is a plain sum over common terms.  Exact, without
comparing all products:

1. Bound of a pair.  The ``AXES`` terms of most weight in all are axes; a product
   is its weights on them and the length of the rest.  The inner product of two
   such vectors is at least the cosine (Cauchy-Schwarz on the rest), and equals
   it if one product has no rest.
2. Products are sorted by their strongest terms and cut into blocks of ``BLOCK``,
   so products that are alike stand together.  The best that a product meets in
   its own block and the two beside it give a floor for its ``k``-th place.
3. Bound of a block.  Weights are not negative, so a product's cosine with any
   product of a block is at most the inner product with the block's largest
   weight on each axis.  A block is sent to a group of blocks only if a product
   there can reach its floor in it.
4. One task holds a group with its ``k`` best so far and reads the blocks it needs
   one after the other.  Pairs whose bound reaches the ``k``-th cosine are summed
   over their common terms.

What is moved are vectors of products, once per group that can need them, and
``k`` rows for each product; pairs are not.  A group is a share of the products
(two groups a core) of at most ``GROUP_ENTRIES`` weights, which bounds a task's
memory.  A product's vector is one row; it is no longer than the vocabulary.
Where neither bound says anything, all pairs are compared.

Defined cases: terms that all products have weigh nothing and are left out;
cosines are ranked to 9 places, equal ones by product id; products without a
positive cosine are not listed, so a product may have fewer than ``k`` rows.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revlens.operators.inner_topk import Best, numbered
from revlens.session import written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TOP = 10
PLACES = 9
SLACK = 1e-9  # half a unit of the last place, and rounding errors
LEAST = 10.0 ** -PLACES / 2  # smaller cosines are zero
AXES = 64
LEAD = 2  # strongest terms sorted by, twice
BLOCK = 1024
BLOCK_ENTRIES = 1 << 18  # weights of a block: 4 MB
GROUP_ENTRIES = 1 << 23
PAIR_ENTRIES = 1 << 20  # weights of pairs summed at a time

_PARTS = ("ids", "ends", "terms", "v", "floors", "top")
PARTS = ", ".join(f"{c} binary" for c in _PARTS)
_NEAR = ("a", "b", "cosine")


class Block(Best):
    """Products with their vectors, sorted by term, and the ``k`` best that each has met."""

    def __init__(self, ids: np.ndarray, ends: np.ndarray, terms: np.ndarray, v: np.ndarray, floors: np.ndarray, k: int) -> None:
        super().__init__(ids, floors, k)
        self.ends, self.terms, self.v = ends, terms, v
        row = np.repeat(np.arange(len(ids)), np.diff(ends, prepend=0))
        on = terms < AXES
        self.u = np.zeros((len(ids), AXES + 1))
        self.u[row[on], terms[on]] = v[on]
        self.u[:, AXES] = np.sqrt(np.bincount(row[~on], v[~on] ** 2, len(ids)))
        self.width = int(terms.max(initial=0)) + 1
        self.key = row * self.width + terms  # ascending

    @classmethod
    def read(cls, ids: bytes, ends: bytes, terms: bytes, v: bytes, floors: bytes, top: bytes, k: int) -> Block:
        return cls(*(np.frombuffer(x, np.int64) for x in (ids, ends, terms)), np.frombuffer(v), np.frombuffer(floors).copy(), k)

    def top(self) -> np.ndarray:
        return self.u.max(axis=0)

    def parts(self) -> list[bytes]:
        return [x.tobytes() for x in (self.ids, self.ends, self.terms, self.v, self.bar, self.top())]

    def reaching(self, tops: np.ndarray) -> np.ndarray:
        """(product, block): can the product reach its bar in the block of largest weights ``tops``?"""
        return self.u @ tops.T >= np.maximum(self.bar - SLACK, LEAST)[:, None]

    def meet(self, other: Block) -> None:
        asking = np.flatnonzero(self.reaching(other.top()[None])[:, 0])
        if not len(asking):
            return
        near = self.u[asking] @ other.u.T
        least = np.maximum(self.bar[asking] - SLACK, LEAST)
        rows, cols = np.nonzero(near >= least[:, None])
        many = np.flatnonzero(np.bincount(rows, minlength=len(asking)) > 4 * self.k)
        if len(many) and near.shape[1] > self.k:  # the k-th that is at least met counts; one may be the product itself
            sure = near[many] - np.outer(self.u[asking[many], AXES], other.u[:, AXES])
            place = near.shape[1] - self.k - 1
            least[many] = np.maximum(least[many], np.partition(sure, place, axis=1)[:, place] - 2 * SLACK)
            rows, cols = np.nonzero(near >= least[:, None])
        bound = near[rows, cols]
        rows = asking[rows]
        others = self.ids[rows] != other.ids[cols]
        rows, cols, bound = rows[others], cols[others], bound[others]
        whole = (self.u[rows, AXES] == 0) | (other.u[cols, AXES] == 0)  # the bound is the cosine
        self._take(rows[whole], bound[whole], other.ids[cols[whole]])
        self._sum(rows[~whole], cols[~whole], other)

    def _take(self, rows: np.ndarray, cosine: np.ndarray, found: np.ndarray) -> None:
        cosine = np.round(cosine, PLACES)
        some = cosine > 0
        self.take(rows[some], cosine[some], found[some])

    def _sum(self, rows: np.ndarray, cols: np.ndarray, other: Block) -> None:
        first = np.concatenate([[0], other.ends[:-1]])
        step = max(1, PAIR_ENTRIES // max(1, int((other.ends - first).max(initial=0))))
        for at in range(0, len(rows), step):
            r, c = rows[at:at + step], cols[at:at + step]
            n = other.ends[c] - first[c]
            pair = np.repeat(np.arange(len(c)), n)
            entry = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + first[c][pair]
            term = other.terms[entry]
            key = r[pair] * self.width + term
            place = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
            common = (self.key[place] == key) & (term < self.width)
            cosine = np.bincount(pair[common], self.v[place[common]] * other.v[entry[common]], len(c))
            self._take(r, cosine, other.ids[c])


def _cut(batches: Iterator[pa.RecordBatch], rows: int, k: int) -> Iterator[Block]:
    """Blocks of the rows in order: of at most ``rows`` products and about ``BLOCK_ENTRIES`` weights, the last two alike."""
    def made(part: list[tuple]) -> Block:
        terms = [np.asarray(t, np.int64) for _, t, _ in part]
        return Block(np.array([i for i, _, _ in part], np.int64), np.cumsum([len(t) for t in terms]).astype(np.int64),
                     np.concatenate(terms), np.concatenate([np.asarray(v, np.float64) for _, _, v in part]),
                     np.zeros(len(part)), k)

    held: list[tuple] = []
    entries = 0
    for batch in batches:
        for i, t, v in zip(batch["id"].to_pylist(), batch["terms"], batch["v"]):
            held.append((i, t.values.to_numpy(zero_copy_only=False), v.values.to_numpy(zero_copy_only=False)))
            entries += len(held[-1][1])
            if len(held) >= 2 * rows or (entries >= 2 * BLOCK_ENTRIES and len(held) > 1):
                n = len(held) // 2
                yield made(held[:n])
                held = held[n:]
                entries = sum(len(t) for _, t, _ in held)
    if len(held) > rows or (entries > BLOCK_ENTRIES and len(held) > 1):
        n = len(held) // 2
        yield made(held[:n])
        held = held[n:]
    if held:
        yield made(held)


def _blocks(products: DataFrame, n: int, rows: int, k: int) -> DataFrame:
    """(block, n, ids, ...): blocks of products in the order of their strongest terms, each product with its floor."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32

        def row(number: int, b: Block) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([first + number]), pa.array([len(b.terms)]),
                                               *(pa.array([x], pa.binary()) for x in b.parts())], names=["block", "n", *_PARTS])

        before = None
        for number, block in enumerate(_cut(batches, rows, k)):
            block.meet(block)
            if before is not None:
                block.meet(before)
                before.meet(block)
                yield row(number - 1, before)
            last, before = number, block
        if before is not None:
            yield row(last, before)

    order = ["lead", "id"]
    dealt = products.repartitionByRange(max(1, -(-n // (4 * rows))), *order).sortWithinPartitions(*order)
    return written(dealt.select("id", "terms", "v").mapInArrow(run, f"block long, n long, {PARTS}"), "content_blocks")


def _dealt(rows: DataFrame, groups: int, *order) -> DataFrame:
    """A group is a partition of its own, in ``order``."""
    return rows.repartitionById(groups, F.col("gu").cast("int")).sortWithinPartitions("gu", *order)


def _tiles(blocks: DataFrame, groups: int, k: int) -> DataFrame:
    """(gu, gi): the blocks in which a product of the group can reach its floor; a group gets each block's largest weights."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def needed() -> pa.RecordBatch:
            gi = np.array(numbers, np.int64)[need]
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(gi), group, np.int32)), pa.array(gi)], names=["gu", "gi"])

        group, numbers, tops, need = None, [], [], None
        for batch in batches:
            for gu, asking, number, *parts in zip(*(batch[c].to_pylist() for c in ("gu", "asking", "block", *_PARTS))):
                if gu != group:
                    if need is not None:
                        yield needed()
                    group, numbers, tops, need = gu, [], [], None
                if not asking:
                    numbers.append(number)
                    tops.append(np.frombuffer(parts[-1]))
                    continue
                if need is None:
                    tops, need = np.array(tops), np.zeros(len(numbers), bool)
                need |= Block.read(*parts, k).reaching(tops).any(axis=0)
        if need is not None:
            yield needed()

    none = [F.lit(None).cast("binary").alias(c) for c in _PARTS[:-1]]
    tops = blocks.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("gu"), F.lit(False).alias("asking"), "block",
                         *none, "top")
    rows = tops.unionByName(blocks.select("gu", F.lit(True).alias("asking"), "block", *_PARTS))
    return _dealt(rows, groups, "asking", "block").mapInArrow(run, "gu int, gi long")


def _nearest(blocks: DataFrame, tiles: DataFrame, groups: int, k: int) -> DataFrame:
    """(a, b, cosine): the best of each group's products in the blocks it needs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, []
        for batch in batches:
            for gu, asking, *parts in zip(*(batch[c] for c in ("gu", "asking", *_PARTS))):
                block = Block.read(*(p.as_py() for p in parts), k)
                if gu.as_py() != group:
                    yield from (own.best(_NEAR) for own in held)
                    group, held = gu.as_py(), []
                if asking.as_py():
                    held.append(block)
                    continue
                for own in held:
                    own.meet(block)
        yield from (own.best(_NEAR) for own in held)

    met = blocks.drop("gu").join(tiles, F.col("block") == F.col("gi")).select("gu", F.lit(False).alias("asking"), "block", *_PARTS)
    rows = met.unionByName(blocks.select("gu", F.lit(True).alias("asking"), "block", *_PARTS))
    return _dealt(rows, groups, F.desc("asking"), "block").mapInArrow(run, "a long, b long, cosine double")


def most_similar_by_content(weights: DataFrame, norm: DataFrame, k: int = TOP, tile: int = BLOCK) -> DataFrame:
    """(product_id, position, similar_id, cosine): the ``k`` products of largest cosine of every product.

    ``weights`` (product_id, term, w) and ``norm`` (product_id, norm) as of :mod:`revlens.operators.content`;
    ``tile``: products of a block.  Results do not depend on it.
    """
    spark = weights.sparkSession
    vectors = written(weights.filter(F.col("w") > 0).join(norm, "product_id").select(
        "product_id", "term", (F.col("w") / F.col("norm")).alias("v")), "content_vectors")
    terms = vectors.groupBy("term").agg(F.sum(F.col("v") * F.col("v")).alias("all"))
    terms = numbered(terms, [F.desc("all"), F.asc("term")], "content_terms").select("term", F.col("rank").alias("t"))
    ids = numbered(vectors.select("product_id").distinct(), [F.asc("product_id")], "content_ids").select(
        "product_id", F.col("rank").alias("id"))
    # one product's terms
    products = vectors.join(terms, "term").groupBy("product_id").agg(
        F.sort_array(F.collect_list(F.struct("t", "v"))).alias("by_term"),
        F.sort_array(F.collect_list(F.struct("v", "t")), asc=False).alias("by_weight")).join(ids, "product_id")
    lead = [F.sort_array(F.slice(F.col("by_weight.t"), 1 + at, LEAD)) for at in (0, LEAD)]
    products = products.select("id", F.col("by_term.t").alias("terms"), F.col("by_term.v").alias("v"), F.concat(*lead).alias("lead"))
    blocks = _blocks(products, ids.count(), tile, k)
    n, entries = blocks.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    groups = max(1, min(n, max(2 * spark.sparkContext.defaultParallelism, -(-entries // GROUP_ENTRIES))))
    # one row per block
    order = blocks.select("block", F.floor((F.row_number().over(Window.orderBy("block")) - 1) * F.lit(groups) / F.lit(max(1, n)))
                          .cast("int").alias("gu"))
    blocks = written(blocks.drop("n").join(F.broadcast(order), "block"), "content_groups")
    tiles = written(_tiles(blocks, groups, k), "content_tiles")
    near = _nearest(blocks, tiles, groups, k)
    own = Window.partitionBy("a").orderBy(F.desc("cosine"), "b")  # k rows
    best = near.withColumn("position", F.row_number().over(own))
    best = best.join(ids.select(F.col("id").alias("a"), "product_id"), "a")
    return best.join(ids.select(F.col("id").alias("b"), F.col("product_id").alias("similar_id")), "b").select(
        "product_id", "position", "similar_id", "cosine")
