"""Merkle manifest: address arithmetic, brute force over whole trees, defined cases."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from revlens.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def climb(level):
    levels = [level]
    while len(level) > 1:
        level = [digest("".join(level[i:i + 3])) for i in range(0, len(level), 3)]
        levels.append(level)
    return levels


def brute_force(rows):
    def leaf(row):
        return digest("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in row))

    trees = {}
    for r in rows:
        trees.setdefault(b"" if r[1] is None else b"=" + r[1].encode(), []).append((r[0], leaf(r), r))
    for t in trees.values():
        t.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    names = sorted(trees)
    levels = {k: climb([x[1] for x in trees[k]]) for k in names}
    top = climb([levels[k][-1][0] for k in names])
    out = []
    for s, name in enumerate(names):
        for i, (doc_id, h, row) in enumerate(trees[name]):
            text = row[4]
            if doc_id is not None and text is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0:
                text = text.replace("\n", "")
            folded, proof = leaf((*row[:4], text)), ""
            for tree, j in ((levels[name], i), (top, s)):
                for level in tree[:-1]:
                    run = level[j - j % 3:j - j % 3 + 3]
                    proof += "".join(x for k, x in enumerate(run) if k != j % 3)
                    run[j % 3] = folded
                    folded, j = digest("".join(run)), j // 3
            out.append((doc_id, h, levels[name][-1][0], top[-1][0], digest(proof), folded, folded == top[-1][0]))
    return out


def received():
    return F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit("")))


def proofs(docs, height=merkle.HEIGHT):
    return [tuple(r)[:7] for r in merkle.prove(merkle.build_manifest(docs, received(), height=height)).collect()]


@pytest.mark.parametrize("levels", [1, 2, 3, 4, 5, 8])
def test_address_is_a_permutation_with_whole_subtrees(levels):
    places = [merkle.address(levels, d, np.arange(3 ** d)) for d in range(levels)]
    assert sorted(np.concatenate(places).tolist()) == list(range(merkle.tree_size(levels)))
    assert places[0][0] == 0
    top = levels - levels // 2
    if top < levels:  # each bottom part is one run of places, in the layout of its own height
        size = merkle.tree_size(levels - top)
        for j in range(3 ** top):
            start = merkle.tree_size(top) + j * size
            own = [merkle.address(levels, top + d, j * 3 ** d + np.arange(3 ** d)) for d in range(levels - top)]
            assert [(p - start).tolist() for p in own] == [
                merkle.address(levels - top, d, np.arange(3 ** d)).tolist() for d in range(levels - top)]


def test_block_reads_its_own_siblings():
    leaves = [digest(str(i)) for i in range(20)]
    nodes = merkle.build_block(bytes.fromhex("".join(leaves)), 3)
    lefts, rights = merkle.block_siblings(nodes, 20, 3)
    assert nodes[:32].hex() == climb(leaves)[-1][0]
    for i in range(20):
        at = [i // 3 ** k for k in range(3)]
        assert merkle.fold(leaves[i], [x[j] for x, j in zip(lefts, at)], [x[j] for x, j in zip(rights, at)]) == \
            climb(leaves)[-1][0]


@pytest.mark.parametrize("height", [2, 7])
def test_equals_brute_force_at_every_block_height(spark, height):
    rnd = random.Random(height)
    sources = [None, "", "b", "é", "a", "a", "a", "a", *[f"c{i}" for i in range(9)]]  # a hot source
    rows = [(None if rnd.random() < 0.05 else i, rnd.choice(sources), rnd.choice([None, "en"]), rnd.choice([None, i]),
             rnd.choice([None, "", "x\ny", "\n", "zü" * i])) for i in range(300)]
    rows += rows[:20]  # repeated rows
    docs = spark.createDataFrame(rows, SCHEMA)
    assert sorted(proofs(docs, height), key=str) == sorted(brute_force(rows), key=str)


def test_single_rows_long_texts_and_clashing_columns(spark):
    rows = [(1, "a", None, None, "line\n" * 200_000), (2, None, None, None, None), (3, "b", "en", 0, "")]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("tree", "rank", "digest", "part")})
    assert sorted(proofs(docs), key=str) == sorted(brute_force(rows), key=str)
    assert {r[0]: r[1] == r[2] for r in proofs(docs)} == {1: True, 2: True, 3: True}  # a lone leaf is its source's root


def test_one_row_and_no_rows(spark):
    one = spark.createDataFrame([(None, None, None, None, None)], SCHEMA)
    leaf = digest("-----")
    assert proofs(one) == [(None, leaf, leaf, leaf, digest(""), leaf, True)]
    assert proofs(one.limit(0)) == []


def test_only_changed_rows_fail(spark):
    rows = [(i, "s", "en", 3, "a\nb" if i % 2 else "ab") for i in range(40)]
    got = {r[0]: r[6] for r in proofs(spark.createDataFrame(rows, SCHEMA))}
    assert got == {i: not (i % 2 and zlib.crc32(str(i).encode()) % 2 == 0) for i in range(40)}
