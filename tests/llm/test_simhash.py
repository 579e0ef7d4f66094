import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from revlens.llm import simhash
from revlens.llm.components import components

SCHEMA = "doc_id long, text string"


def slow_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(fps):
    """node -> smallest index reachable, by comparing all pairs."""
    u = np.array(fps, dtype=np.uint64)
    parent = list(range(len(u)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(u)):
        for j in np.flatnonzero(np.bitwise_count(u[i] ^ u) <= 3):
            a, b = find(i), find(int(j))
            parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(u))]


def test_fingerprints(monkeypatch):
    rng = random.Random(1)
    texts = ["", None, "one", "One two", "A b C", " \t\n", "é É\x1cx \x85y z\xa0 w", "x " * 5000]
    texts += [" ".join(rng.choices(["a", "Bé", "c.", "\n", "dd"], k=rng.randint(0, 40))) for _ in range(100)]
    want = [slow_fingerprint(t) for t in texts]
    assert [simhash.fingerprint(t) for t in texts] == want
    monkeypatch.setattr(simhash, "BLOCK_WORDS", 7)
    assert [simhash.fingerprint(t) for t in texts] == want


def test_the_code_covers_every_half():
    anchors = simhash.Anchors()
    rng = np.random.default_rng(0)
    halves = rng.integers(0, 1 << 32, 3000, dtype=np.uint32)
    row, anchor, home = anchors.of(halves)
    assert (np.bitwise_count(halves[row] ^ anchor) <= simhash.RADIUS + 1).all()
    homes = anchor[home]
    assert len(homes) == len(halves) and (np.bitwise_count(halves ^ homes) <= simhash.RADIUS).all()
    assert (simhash._syndromes(homes & np.uint32((1 << 23) - 1)) == 0).all()
    assert 19 < len(row) / len(halves) < 22
    # a half that differs in one bit is among the replicas of the home
    other = halves ^ (np.uint32(1) << rng.integers(0, 32, 3000, dtype=np.uint32))
    r2, a2, _ = anchors.of(other)
    reached = set(zip(r2.tolist(), a2.tolist()))
    assert all((i, int(h)) in reached for i, h in enumerate(homes))


@pytest.mark.parametrize("tile_rows", [8192, 40])
def test_links_match_all_pairs(spark, tile_rows):
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 1 << 63, 150, dtype=np.uint64)
    for _ in range(4):  # chains of near fingerprints
        x = pool[rng.integers(0, len(pool), 120)].copy()
        for _ in range(4):
            x ^= (np.uint64(1) << rng.integers(0, 64, 120, dtype=np.uint64)) * (rng.random(120) < 0.8).astype(np.uint64)
        pool = np.unique(np.concatenate([pool, x]))
    dense = np.full(600, pool[0])  # a hot group: hundreds of copies around one fingerprint
    for _ in range(4):
        dense ^= (np.uint64(1) << rng.integers(0, 64, 600, dtype=np.uint64)) * (rng.random(600) < 0.6).astype(np.uint64)
    pool = np.unique(np.concatenate([pool, dense, np.array([0, 1, 7, 15, 2**64 - 1], np.uint64)]))
    fps = spark.createDataFrame([(int(x),) for x in pool.view(np.int64)], "fp long")
    edges = simhash.link_edges(fps, tile_rows=tile_rows)
    got = {r.node: r.label for r in components(edges).collect()}
    want, have = {}, {}
    for x, c in zip(pool.view(np.int64).tolist(), slow_components(pool)):
        want.setdefault(c, set()).add(x)
        have.setdefault(got.get(x, x), set()).add(x)
    assert {frozenset(s) for s in want.values()} == {frozenset(s) for s in have.values()}


def near_copies(rng, n):
    vocabulary = [f"w{i}" for i in range(500)]
    rows = []
    for i in range(n):
        words = rng.choices(vocabulary, k=rng.randint(150, 400))
        rows.append(" ".join(words))
        for _ in range(rng.randint(0, 3)):
            words = list(words)
            words[rng.randrange(len(words))] = "changed"
            rows.append(" ".join(words))
    return rows


def documents(rng):
    texts = near_copies(rng, 60) + ["the same text of a hot group"] * 200 + ["", None, " ", "one", "ONE"]
    rng.shuffle(texts)
    rows = [(1000 - i, t) for i, t in enumerate(texts)]
    return rows + [rows[0], rows[0], (None, "null id"), (None, texts[0])]


def expected(rows):
    prints = [slow_fingerprint(t) for _, t in rows]
    label = slow_components(prints)
    least = {}
    for (d, _), c in zip(rows, label):
        least.setdefault(c, [])
        if d is not None:
            least[c].append(d)
    return [(d, f"{p:016x}", min(least[c], default=None)) for (d, _), p, c in zip(rows, prints, label)], label


def test_components_of_documents(spark):
    rows = documents(random.Random(3))
    got = simhash.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted([(r.doc_id, r.fingerprint, r.component_id) for r in got], key=str) == sorted(expected(rows)[0], key=str)


def test_one_document_of_each_group_stays(spark):
    rows = documents(random.Random(4))
    df = spark.createDataFrame(rows, SCHEMA).withColumn("fp", F.lit(1)).withColumn("_row", F.lit("x"))
    kept = simhash.keep_one(df)
    assert kept.columns == ["doc_id", "text", "fp", "_row"]
    found, label = expected(rows)
    assert sorted([r.doc_id for r in kept.collect()], key=str) == sorted([c for c in {lab: f[2] for f, lab in zip(found, label)}.values()], key=str)


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(none).count() == 0 and simhash.keep_one(none).count() == 0


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, i) for i in range(101, 300)] + [(5000, 5000), (7, 7), (9000, 8000), (8000, 9000)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    groups = {}
    for n, lab in got.items():
        groups.setdefault(lab, set()).add(n)
    assert sorted(map(sorted, groups.values())) == [list(range(1, 61)), list(range(100, 300)), [8000, 9000]]
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
