"""Importance resampling against a brute-force version, with cut texts and the defined cases."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from revlens.llm import resampling

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def grams(text):
    w = words(text)
    return [zlib.crc32(" ".join(w[i:i + n]).encode()) % 10_000 for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def brute_force(rows, target, percent=5):
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(grams(text))
    for text in target:
        t.update(grams(text))
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.total() + 10_000) / ((s[b] + 1) * (t.total() + 10_000))))
            for b in range(10_000)]
    out = []
    for doc_id, text in rows:
        g = grams(text)
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in g)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(words(text)), len(g), weight, score, None])
    able = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for rank, r in enumerate(able[:math.floor(percent * len(able) / 100)], 1):
        r[5] = rank
    return [tuple(r) for r in out]


def texts(n, seed):
    rnd = random.Random(seed)
    vocabulary = ["the", "Thing", "ÉTÉ", "été", "x" * 70, "ring", "a1", "日本", "of"] + [f"w{i}" for i in range(60)]
    breaks = [" ", "  ", ", ", "\n", "--", "_", "\x7f"]
    return ["".join(rnd.choice(vocabulary) + rnd.choice(breaks) for _ in range(rnd.randrange(0, 60))) for _ in range(n)]


def test_equals_brute_force(spark):
    rows = [(i, t) for i, t in enumerate(texts(300, 1))]
    rows += [(None, rows[5][1]), (None, None), (7, None), (8, ""), (9, " ,.;"), *rows[:9]]
    target = [*texts(20, 2), None, ""]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {c: F.lit("x") for c in ("score", "rank", "part", "at", "eligible", "bucket")})
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    got = [tuple(r) for r in resampling.resample(docs, goal, percent=20).collect()]
    assert sorted(got, key=str) == sorted(brute_force(rows, target, 20), key=str)


def test_no_rows_and_no_target(spark):
    docs = spark.createDataFrame([(1, "a b c " * 20)], "doc_id long, text string")
    empty = docs.limit(0)
    assert resampling.resample(empty, docs).count() == 0
    got = [tuple(r) for r in resampling.resample(docs, empty, percent=100).collect()]
    assert got == brute_force([(1, "a b c " * 20)], [], 100)


@pytest.mark.parametrize("block", [200, 3000, 1 << 22])
def test_cut_texts_count_every_feature_once(monkeypatch, block):
    monkeypatch.setattr(resampling, "BLOCK_BYTES", block)
    rows = [*texts(60, 3), "Long" * 500 + " a b", "solo", None, " " * 999]
    counter = resampling._counter(resampling.BUCKETS)
    out = next(counter(iter([pa.RecordBatch.from_arrays([pa.array(rows, pa.string())], ["text"])])))
    want = Counter(b for t in rows for b in grams(t))
    assert dict(zip(out.column(0).to_pylist(), out.column(1).to_pylist())) == dict(want)


def test_crc_of_joined_texts():
    parts = [b"", b"a", b"abc", "été".encode(), b"x" * 64, b"y" * 65, b"z" * 300]
    table = resampling.Words(parts)
    for left in (b"q", b"left side", b"x" * 99):
        crc = np.full(len(parts), zlib.crc32(left), np.uint32)
        assert table.appended(crc, np.arange(len(parts))).tolist() == [zlib.crc32(left + b" " + p) for p in parts]
