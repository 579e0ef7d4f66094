"""Operator 11, Merkle dataset manifest in a Van Emde Boas layout.

Every row is a leaf; the leaves of a source, in the order of their ids, are the
bottom of a tree whose nodes hash up to ``ARITY`` children; the roots of the
sources, in the order of the sources, are the leaves of one more such tree.
The manifest holds the nodes in blocks: aligned subtrees of ``HEIGHT`` levels,
each one binary value of 32-byte digests.  Inside a block the nodes lie in Van
Emde Boas order: the tree is split at half height, the top part is stored
first, then the bottom parts from left to right, and each part again in the
same way.  :func:`address` computes a node's place from its depth and index;
building a block and reading the siblings of a leaf both go through it.  The
roots of a tier's blocks are the leaves of the next tier, until one block is
left in each tree.

Scale.  The text is read once, for its digest.  The leaves (a key, an id, one
or two digests) are sorted by range, so a source with a third of all rows is
spread over many tasks; ranks come from counts per (partition, source), not
from a window over a source.  A task holds one block: at most ``ARITY **
HEIGHT`` leaves.  A tier has one row per block, so n leaves need
log(n) / (HEIGHT log ARITY) tiers: three for 10^10 rows.  Siblings are read
once per block, not once per row; what lies above a block is a short list of
digests that its rows share.  The driver sees one number per tier.

Defined cases: a null field is ``-``, an empty text ``0:``; a null source is a
source of its own and the first one; null ids come first in their source; rows
of equal id are ordered by their digest, and equal rows are leaves of their own;
a source of one row has that leaf as its root; a root of all exists once there
is a row, so an empty table gives no rows; columns other than the fields are
not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlens.llm.common import written

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY = 3
HEIGHT = 7  # levels of a block: 2,187 leaves, 3,280 nodes, 105 kB
DIGEST = 32


# ---- one block -----------------------------------------------------------------


def tree_size(levels: int) -> int:
    """Nodes of a full tree of ``levels`` levels."""
    return (ARITY ** levels - 1) // (ARITY - 1)


def address(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Places of the nodes ``index`` at ``depth`` (root 0) of a full tree of ``levels`` levels, in Van Emde Boas order."""
    if levels == 1:
        return np.zeros(len(index), np.int64)
    top = levels - levels // 2
    if depth < top:
        return address(top, depth, index)
    bottom = levels - top
    width = ARITY ** (depth - top)  # nodes of this depth in one bottom part
    return tree_size(top) + index // width * tree_size(bottom) + address(bottom, depth - top, index % width)


def level_counts(n: int, levels: int) -> list[int]:
    """Nodes at depth 0..levels of a block of ``n`` leaves."""
    return [-(-n // ARITY ** (levels - d)) for d in range(levels + 1)]


def _hashed(text: str) -> bytes:
    return hashlib.sha256(text.encode()).digest()


def _hexes(nodes: np.ndarray, levels: int, depth: int, count: int) -> str:
    """The digests of a level from left to right, as hex text."""
    return nodes[address(levels + 1, depth, np.arange(count))].tobytes().hex()


def build_block(digests: bytes, levels: int) -> bytes:
    """The nodes of the tree over the leaf digests, ``levels`` levels above them, in Van Emde Boas order."""
    n = len(digests) // DIGEST
    nodes = np.zeros((tree_size(levels + 1), DIGEST), np.uint8)
    nodes[address(levels + 1, levels, np.arange(n))] = np.frombuffer(digests, np.uint8).reshape(n, DIGEST)
    run = 2 * DIGEST * ARITY
    for depth, count in zip(range(levels, 0, -1), level_counts(n, levels)[:0:-1]):
        hexes = _hexes(nodes, levels, depth, count)
        parents = b"".join(_hashed(hexes[at:at + run]) for at in range(0, len(hexes), run))
        nodes[address(levels + 1, depth - 1, np.arange(len(parents) // DIGEST))] = np.frombuffer(
            parents, np.uint8).reshape(-1, DIGEST)
    return nodes.tobytes()


def block_siblings(stored: bytes, n: int, levels: int) -> tuple[list[list[str]], list[list[str]]]:
    """For each level from the leaves up, what stands left and right of each node in its run, as hex text."""
    nodes = np.frombuffer(stored, np.uint8).reshape(-1, DIGEST)
    one, run = 2 * DIGEST, 2 * DIGEST * ARITY
    lefts, rights = [], []
    for depth, count in zip(range(levels, 0, -1), level_counts(n, levels)[:0:-1]):
        hexes = _hexes(nodes, levels, depth, count)
        at = [one * i for i in range(count)]
        lefts.append([hexes[a - a % run:a] for a in at])
        rights.append([hexes[a + one:a - a % run + run] for a in at])
    return lefts, rights


def fold(digest: str, lefts: list[str], rights: list[str]) -> str:
    """The root that a digest and its siblings, level by level, lead to."""
    for left, right in zip(lefts, rights):
        digest = hashlib.sha256((left + digest + right).encode()).hexdigest()
    return digest


# ---- leaves --------------------------------------------------------------------


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(docs: DataFrame, fields: tuple[str, ...] = FIELDS, **received: Column) -> Column:
    """Digest of a row's fields; ``received`` replaces fields by other expressions."""
    return F.unhex(F.sha2(F.concat(*[_field(received.get(f, docs[f])) for f in fields]), 256))


def _numbered(df: DataFrame, order: list[str]) -> DataFrame:
    """``df`` with its 0-based rank in its ``tree`` by ``order``, and the tree's number of rows.

    Sorted by range over (tree, order); a partition's rows of a tree are ranked
    by place, and the running sum of the counts gives the partition's offset.
    """
    by = [F.col("tree"), *[F.asc_nulls_first(c) for c in order]]
    placed = written(df.repartitionByRange(*by).sortWithinPartitions(*by).select(
        "*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")), "merkle_sorted")
    tree = Window.partitionBy("tree")  # at most one row per (partition, tree)
    before = tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    counts = written(counts.select(
        F.col("tree").alias("t"), F.col("part").alias("p"),
        (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("n").over(tree).alias("n")), "merkle_counts")
    return placed.join(counts, (F.col("tree") == F.col("t")) & (F.col("part") == F.col("p"))).withColumn(
        "rank", F.col("at") + F.col("shift")).drop("t", "p", "part", "at", "shift")


# ---- the forest ----------------------------------------------------------------

BLOCKS = "tree string, block long, blocks long, n int, levels int, nodes binary, top binary"


def _tier(leaves: DataFrame, height: int) -> DataFrame:
    """Blocks of the trees over ``leaves`` (tree, rank, n, digest), one row each, written."""
    width = ARITY ** height

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("rank")
        first, n = rows.iloc[0], len(rows)
        levels = height
        if first["blocks"] == 1:  # the tree ends in this block
            levels = next(k for k in range(height + 1) if ARITY ** k >= n)
        nodes = build_block(b"".join(rows["digest"]), levels)
        return pd.DataFrame({"tree": [first["tree"]], "block": [first["block"]], "blocks": [first["blocks"]], "n": [n],
                             "levels": [levels], "nodes": [nodes], "top": [nodes[:DIGEST]]})  # the root lies first

    keyed = leaves.select("tree", F.floor(F.col("rank") / width).cast("long").alias("block"), "rank",
                          F.ceil(F.col("n") / width).cast("long").alias("blocks"), "digest")
    return written(keyed.groupBy("tree", "block").applyInPandas(run, BLOCKS), "merkle_blocks")


def _forest(leaves: DataFrame, height: int) -> list[DataFrame]:
    """Tiers of blocks from the leaves up; the blocks of a tier are the leaves of the next."""
    tiers = [_tier(leaves, height)]
    while (tiers[-1].agg(F.max("blocks")).first()[0] or 0) > 1:
        up = tiers[-1].filter(F.col("blocks") > 1)
        tiers.append(_tier(up.select("tree", F.col("block").alias("rank"), F.col("blocks").alias("n"),
                                     F.col("top").alias("digest")), height))
    return tiers


def _roots(tiers: list[DataFrame]) -> DataFrame:
    """(tree, digest): the root of each tree, in the tier where one block is left of it."""
    out = None
    for tier in tiers:
        last = tier.filter(F.col("blocks") == 1).select("tree", F.col("top").alias("digest"))
        out = last if out is None else out.unionAll(last)
    return out


PATHS = "tree string, rank long, lefts array<string>, rights array<string>"


def _paths(blocks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per leaf of each block the siblings up to the root, those above the block included."""
    for batch in blocks:
        for b in batch.itertuples(index=False):
            lefts, rights = block_siblings(b.nodes, b.n, b.levels)
            out = []
            for i in range(b.n):
                at = [i // ARITY ** k for k in range(b.levels)]
                out.append((b.tree, b.first + i, [x[j] for x, j in zip(lefts, at)] + list(b.lefts),
                            [x[j] for x, j in zip(rights, at)] + list(b.rights)))
            yield pd.DataFrame(out, columns=["tree", "rank", "lefts", "rights"])


def _with_paths(tiers: list[DataFrame], above: DataFrame, height: int) -> DataFrame:
    """The lowest tier's blocks with the siblings above each block; ``above`` (tree, lefts, rights) has those above the roots."""
    above = above.select(F.col("tree").alias("t"), "lefts", "rights")
    paths = None  # of the blocks of this tier, from the tier above
    for k in range(len(tiers) - 1, -1, -1):
        tier = tiers[k]
        known = tier.filter(F.col("blocks") == 1).join(above, F.col("tree") == F.col("t")).drop("t")
        if paths is not None:
            inner = paths.select(F.col("tree").alias("t"), "rank", "lefts", "rights")
            more = tier.filter(F.col("blocks") > 1).join(
                inner, (F.col("tree") == F.col("t")) & (F.col("block") == F.col("rank"))).drop("t", "rank")
            known = known.unionByName(more)
        if k:
            first = (F.col("block") * ARITY ** height).alias("first")
            paths = written(known.select("*", first).mapInPandas(_paths, PATHS), "merkle_paths")
    return known


# ---- manifest ------------------------------------------------------------------

ALL = "all"


@dataclass
class Manifest:
    """Leaves (tree, rank, n, doc_id, digest, received) and the tiers of blocks of the source trees and of the tree over them."""

    leaves: DataFrame
    sources: list[DataFrame]
    roots: list[DataFrame]
    subroots: DataFrame  # tree (of a source), rank, digest
    height: int


def build_manifest(docs: DataFrame, received: Column | None = None, fields: tuple[str, ...] = FIELDS,
                   id_col: str = "doc_id", source: str = "source", text: str = "text",
                   height: int = HEIGHT) -> Manifest:
    """The trees over ``docs``.

    ``received`` is an expression for the text as it stands now, for rows where
    it may differ (null: as it was); its digest is kept beside the leaf's, so
    that :func:`prove` can say which rows still lead to the root.
    """
    # '' is no encoded name, so a null source stands first, and names keep their bytewise order
    tree = F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit("")).alias("tree")
    other = F.lit(None).cast("binary") if received is None else F.when(
        received.isNotNull(), leaf(docs, fields, **{text: received}))
    leaves = docs.select(tree, F.col(id_col).alias("doc_id"), leaf(docs, fields).alias("digest"),
                         other.alias("received"), F.monotonically_increasing_id().alias("row"))
    # the row number parts equal rows, so that a large group of them is spread too
    leaves = _numbered(leaves, ["doc_id", "digest", "row"]).drop("row")
    sources = _forest(leaves, height)
    subroots = _numbered(_roots(sources).select(F.lit(ALL).alias("tree"), F.col("tree").alias("name"), "digest"), ["name"])
    subroots = written(subroots, "merkle_subroots")
    return Manifest(leaves, sources, _forest(subroots, height), subroots, height)


PROOFS = ("doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
          "verified boolean, proof_nodes int")


def prove(manifest: Manifest) -> DataFrame:
    """One row per leaf: its digests, the digest of its siblings, and the root that it leads to as received."""
    none = F.array().cast("array<string>")
    top = manifest.roots[0].select("tree").distinct().select("tree", none.alias("lefts"), none.alias("rights"))
    root = _roots(manifest.roots).select(F.col("tree").alias("t"), F.lower(F.hex("digest")).alias("root"))
    first = (F.col("block") * ARITY ** manifest.height).alias("first")
    outer = _with_paths(manifest.roots, top, manifest.height).select("*", first).mapInPandas(_paths, PATHS)
    names = manifest.subroots.select(F.col("rank").alias("r"), F.col("name"), F.lower(F.hex("digest")).alias("subroot"))
    # one row: the root of all
    above = written(outer.join(names, F.col("rank") == F.col("r")).join(F.broadcast(root), F.col("tree") == F.col("t"))
                    .select(F.col("name").alias("tree"), "lefts", "rights", "subroot", "root"), "merkle_above")
    blocks = _with_paths(manifest.sources, above.select("tree", "lefts", "rights"), manifest.height)
    ends = above.select(F.col("tree").alias("t"), "subroot", "root")
    blocks = blocks.join(ends, F.col("tree") == F.col("t")).drop("t", "top", "blocks")
    width = ARITY ** manifest.height

    def run(rows: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        b = block.iloc[0]
        lefts, rights = block_siblings(b["nodes"], int(b["n"]), int(b["levels"]))
        up_left, up_right = list(b["lefts"]), list(b["rights"])
        above = "".join(x + y for x, y in zip(up_left, up_right))
        out = []
        for doc_id, rank, digest, received in zip(rows["doc_id"], rows["rank"], rows["digest"], rows["received"]):
            i = rank % width
            left = [x[i // ARITY ** k] for k, x in enumerate(lefts)]
            right = [x[i // ARITY ** k] for k, x in enumerate(rights)]
            proof = "".join(x + y for x, y in zip(left, right)) + above
            folded = fold((received or digest).hex(), left + up_left, right + up_right)
            out.append((None if pd.isna(doc_id) else int(doc_id), digest.hex(), b["subroot"], b["root"],
                        hashlib.sha256(proof.encode()).hexdigest(), folded, folded == b["root"],
                        len(proof) // (2 * DIGEST)))
        frame = pd.DataFrame(out, columns=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
                                           "verified", "proof_nodes"])
        return frame.astype({"doc_id": "Int64"})

    leaves = manifest.leaves.select("tree", F.floor(F.col("rank") / width).cast("long").alias("block"),
                                    F.col("doc_id").cast("long").alias("doc_id"), "rank", "digest", "received")
    return leaves.groupBy("tree", "block").cogroup(blocks.groupBy("tree", "block")).applyInPandas(run, PROOFS)
