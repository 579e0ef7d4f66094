"""Operator 10, SimHash near-dedup: anchor-point covering.

Fingerprints are 64 bits over 3-word shingles; two link at 3 or fewer
differing bits.

Candidate search.  Of two linked fingerprints one 32-bit half differs in at
most one bit.  For each half the anchors are a covering code: the words of the
perfect Golay code on its first 23 bits, with the other 9 bits free, so every
half lies within the covering radius R = 3 of an anchor.  A fingerprint has one
home, its nearest anchor, and is replicated to every anchor within R + 1 (the
radius plus the threshold of the half; 20 of 2^21 anchors on average).  If y is
at home at anchor p and x differs from y in at most one bit of the half, then
d(x, p) <= R + 1, so x is among the replicas at p: comparing homes with
replicas at each anchor finds every link.

Scale.  Exact copies are one fingerprint before the search.  Anchors with many
rows are cut into tiles (home block x replica block) of bounded size, so a hot
anchor spreads over tasks.  A tile keeps only a spanning forest of its links
(one edge per fingerprint at most), never all pairs of a group of copies.
Components come from :mod:`revlens.llm.components`.

Defined cases: null text is an empty text, whose fingerprint is zero and links
like any other; fewer than three words make one shingle of all of them; null
doc_ids take part, and component_id is the smallest doc_id that is not null
(null if there is none); repeated rows stay rows of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.llm.common import columns, free_name, written
from revlens.llm.components import components

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
TILE_ROWS = 8192
BLOCK_WORDS = 200_000

# Fixed value: generator polynomial of the binary Golay code [23, 12, 7].
GOLAY = 0b101011100011
RADIUS = 3


# ---- fingerprints -----------------------------------------------------------


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """The unsigned 64-bit fingerprint of one text; shingles are hashed a block at a time."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    words = min(words, len(tokens))
    n = len(tokens) - words + 1
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, BLOCK_WORDS):
        part = tokens[at:min(at + BLOCK_WORDS, n) + words - 1]
        joined = b" ".join(part)
        lengths = np.fromiter(map(len, part), np.int64, len(part))
        ends = np.cumsum(lengths + 1) - 1
        starts = (ends - lengths)[: len(part) - words + 1].tolist()
        h = np.array([digest(joined[s:e], SEED) for s, e in zip(starts, ends[words - 1:].tolist())], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


@F.pandas_udf(T.LongType())
def fingerprint_udf(texts: pd.Series) -> pd.Series:
    """Fingerprints as signed 64-bit integers."""
    return pd.Series(np.array([fingerprint(t) for t in texts], dtype=np.uint64).view(np.int64))


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


# ---- anchors ----------------------------------------------------------------


def _syndromes(x: np.ndarray) -> np.ndarray:
    """Remainders of 23-bit words modulo the generator polynomial (11 bits)."""
    x = x.astype(np.uint32).copy()
    for bit in range(22, 10, -1):
        x ^= np.where((x >> np.uint32(bit)) & np.uint32(1), np.uint32(GOLAY << (bit - 11)), np.uint32(0))
    return x


def _words_upto(bits: int, weight: int) -> np.ndarray:
    """All words of ``bits`` bits and at most ``weight`` ones, lightest first."""
    level, out = np.zeros(1, np.uint32), [np.zeros(1, np.uint32)]
    for _ in range(weight):
        level = np.unique((level[:, None] | (np.uint32(1) << np.arange(bits, dtype=np.uint32))[None, :]).ravel())
        level = level[np.bitwise_count(level) == np.bitwise_count(out[-1][0]) + 1]
        out.append(level)
    return np.concatenate(out)


class Anchors:
    """Masks from a half to the anchors within the radius plus ``slack``, by syndrome."""

    def __init__(self, slack: int = 1) -> None:
        reach = RADIUS + slack
        low = _words_upto(23, reach)
        syn, weight = _syndromes(low), np.bitwise_count(low)
        high = {w: _words_upto(9, w) << np.uint32(23) for w in range(reach + 1)}
        masks: list[list[np.ndarray]] = [[] for _ in range(2048)]
        for e, s, w in zip(low, syn, weight):
            masks[s].append(e ^ high[reach - int(w)])
        rows = [np.concatenate(m) for m in masks]
        # the leader (lightest error, no error in the free bits) comes first: it gives the home
        self.counts = np.array([len(r) for r in rows], np.int64)
        self.first = np.cumsum(self.counts) - self.counts
        self.flat = np.concatenate(rows)

    def of(self, half: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(index of the half, anchor, is home) of every replica."""
        s = _syndromes(half & np.uint32((1 << 23) - 1))
        n = self.counts[s]
        row = np.repeat(np.arange(len(half)), n)
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return row, half[row] ^ self.flat[self.first[s][row] + within], within == 0


def _replicas(fps: DataFrame) -> DataFrame:
    """(half, anchor, fp, home) for both halves of each distinct fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = Anchors()
        for b in batches:
            fp = b.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(fp), 4096):
                part = fp[at:at + 4096]
                for half in (0, 1):
                    word = (part >> np.uint64(32 * half)).astype(np.uint32)
                    row, anchor, home = anchors.of(word)
                    key = anchor.astype(np.int64) | (half << 32)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key), pa.array(part[row].view(np.int64)), pa.array(home)], ["anchor", "fp", "home"])

    return fps.select("fp").mapInArrow(run, "anchor long, fp long, home boolean")


# ---- links ------------------------------------------------------------------


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, root) that connect the same nodes as the edges (a, b)."""
    nodes, idx = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = idx[: len(a)], idx[len(a):]
    root = np.arange(len(nodes))
    while len(i):
        low = np.minimum(root[i], root[j])
        np.minimum.at(root, root[i], low)
        np.minimum.at(root, root[j], low)
        while not np.array_equal(root, up := root[root]):
            root = up
        open_ = root[i] != root[j]
        i, j = i[open_], j[open_]
    child = root != np.arange(len(nodes))
    return nodes[child], nodes[root[child]]


def tile_links(fp: np.ndarray, home: np.ndarray, max_bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the links between the homes and all rows of one tile."""
    homes = np.unique(fp[home])
    others = np.unique(fp)
    left, right = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
    step = max(1, 1_000_000 // max(1, len(others)))
    for at in range(0, len(homes), step):
        part = homes[at:at + step]
        i, j = np.nonzero(np.bitwise_count(part[:, None] ^ others[None, :]) <= max_bits)
        a, b = part[i], others[j]
        a, b = a[a != b], b[a != b]
        if len(a):
            a, b = forest(a, b)
            left.append(a)
            right.append(b)
    a, b = np.concatenate(left), np.concatenate(right)
    return forest(a, b) if len(a) else (a, b)


def _tiles(rows: DataFrame, tile_rows: int) -> DataFrame:
    """Rows with their tile: an anchor of over ``tile_rows`` rows gets home blocks x replica blocks."""
    counts = rows.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > tile_rows)
    hot = written(counts.select(F.col("anchor").alias("hot"), F.ceil(F.col("n") / tile_rows).cast("int").alias("k")),
                  "hot_anchors")
    mine = F.pmod(F.xxhash64("fp"), F.col("k")).cast("int")
    all_ = F.sequence(F.lit(0), F.col("k") - 1)
    # tile (i, j): homes of block i against rows of block j; a home row is in both roles
    as_home = F.when(F.col("home"), F.transform(all_, lambda j: F.struct(mine.alias("i"), j.alias("j"))))
    as_row = F.transform(all_, lambda i: F.struct(i.alias("i"), mine.alias("j")))
    one = F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))
    joined = rows.join(hot, F.col("anchor") == F.col("hot"), "left")
    cold = joined.filter("hot is null").select("anchor", F.lit(0).alias("i"), F.lit(0).alias("j"), "fp", "home")
    split = joined.filter("hot is not null")
    homes = split.filter("home").select("anchor", F.explode(as_home).alias("t"), "fp", F.lit(True).alias("home"))
    others = split.select("anchor", F.explode(as_row).alias("t"), "fp", F.lit(False).alias("home"))
    return cold.union(homes.union(others).select("anchor", "t.i", "t.j", "fp", "home"))


def _groups(keys: list[np.ndarray]) -> np.ndarray:
    """Start of each run of equal keys."""
    n = len(keys[0])
    change = np.zeros(n, bool)
    change[:1] = True
    for k in keys:
        change[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(change)


def _small_links(fp: np.ndarray, home: np.ndarray, start: np.ndarray, size: np.ndarray, max_bits: int):
    """Links of many small tiles at once: each home against the rows of its tile."""
    tile = np.repeat(np.arange(len(start)), size)
    rows = np.flatnonzero(home)
    n = size[tile[rows]]
    left = np.repeat(rows, n)
    right = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start[tile[rows]], n)
    a, b = fp[left], fp[right]
    near = (a != b) & (np.bitwise_count(a ^ b) <= max_bits)
    return a[near], b[near]


def _tile_edges(tiles: DataFrame, max_bits: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []

        def flush(final: bool):
            """Edges of the whole tiles held; the last tile may go on in the next batch."""
            cols = [np.concatenate(c) for c in zip(*held)]
            held.clear()
            start = _groups(cols[:3])
            end = len(cols[0]) if final else start[-1]
            if not final:
                held.append([c[end:] for c in cols])
                start = start[:-1]
            size = np.diff(np.append(start, end))
            fp, home = cols[3].view(np.uint64), cols[4]
            out_a, out_b = [], []
            # neighbouring small tiles together, of bounded work; a large one by itself
            large = size > 512
            cut = np.append(np.flatnonzero(large), len(size))
            at = 0
            for c in cut:
                while at < c:
                    work = np.cumsum(size[at:c] ** 2)
                    to = at + max(1, int(np.searchsorted(work, 2_000_000, "right")))
                    lo, hi = start[at], start[to - 1] + size[to - 1]
                    a, b = _small_links(fp[lo:hi], home[lo:hi], start[at:to] - lo, size[at:to], max_bits)
                    if len(a):
                        a, b = forest(a, b)
                        out_a.append(a)
                        out_b.append(b)
                    at = to
                if c < len(size):
                    lo = start[c]
                    a, b = tile_links(fp[lo:lo + size[c]], home[lo:lo + size[c]], max_bits)
                    out_a.append(a)
                    out_b.append(b)
                    at = c + 1
            if out_a:
                a, b = np.concatenate(out_a), np.concatenate(out_b)
                if len(a):
                    a, b = forest(a, b)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        n = 0
        for b in batches:
            held.append([b.column(k).to_numpy(zero_copy_only=False) for k in ("anchor", "i", "j", "fp", "home")])
            n += len(held[-1][0])
            if n >= 500_000:
                yield from flush(False)
                n = len(held[0][0])
        if held and n:
            yield from flush(True)

    dealt = tiles.repartition("anchor", "i", "j").sortWithinPartitions("anchor", "i", "j")
    return dealt.mapInArrow(run, "a long, b long")


def link_edges(fps: DataFrame, max_bits: int = MAX_BITS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """(a, b): edges that connect exactly the fingerprints linked at ``max_bits`` or fewer bits.

    ``fps`` holds distinct fingerprints in column ``fp``.
    """
    if max_bits > 3:
        raise ValueError("the halves' threshold of one bit covers up to 3 differing bits")
    rows = written(_replicas(fps), "replicas")
    return _tile_edges(_tiles(rows, tile_rows), max_bits).distinct()


def classes(prints: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(fp, label, component_id): component and smallest id reachable, of each fingerprint of ``prints`` (id, fp)."""
    fps = written(prints.groupBy("fp").agg(F.min(id_col).alias("first_id")), "fingerprints")
    labels = components(link_edges(fps))
    named = fps.join(labels, F.col("fp") == F.col("node"), "left").select(
        "fp", "first_id", F.coalesce("label", "fp").alias("label"))
    named = written(named, "labelled")
    smallest = written(named.groupBy("label").agg(F.min("first_id").alias("component_id")), "component_ids")
    out = named.select("fp", F.col("label").alias("l")).join(smallest, F.col("l") == F.col("label"))
    return written(out.select("fp", "label", "component_id"), "classes")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, fingerprint, component_id), one row per document."""
    prints = written(docs.select(id_col, fingerprint_udf(F.col(text)).alias("fp")), "prints")
    found = classes(prints, id_col).withColumnRenamed("fp", "cfp")
    return prints.join(found, F.col("fp") == F.col("cfp")).select(
        id_col, as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each component: that of smallest id (repeated rows: any one of them)."""
    fp, row = free_name(docs, "_fp"), free_name(docs, "_row")
    marked = docs.withColumn(fp, fingerprint_udf(F.col(text))).withColumn(row, F.monotonically_increasing_id())
    marked = written(marked, "marked")
    prints = marked.select(F.col(id_col).alias("doc_id"), F.col(fp).alias("fp"), F.col(row).alias("row"))
    found = classes(prints).withColumnRenamed("fp", "cfp")
    joined = prints.join(found, F.col("fp") == F.col("cfp"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    kept = written(joined.groupBy("label").agg(first.alias("k")).select(F.col("k.row").alias("kept")), "kept_rows")
    # the kept rows are a share of the corpus, so the join is a shuffle at every size, never a broadcast;
    # hashing their ids leaves the texts unsorted
    return marked.join(kept.hint("shuffle_hash"), F.col(row) == F.col("kept"), "left_semi").select(*columns(docs))
