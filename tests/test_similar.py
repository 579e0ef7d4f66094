"""X3 against all pairs on titles with typing errors, equal sets, hot tokens and many titles per product."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from revlens.functions.fuzzy import score_parts
from revlens.operators import similar


def token_set(title):
    plain = "".join(c if c.isalnum() or c == "_" else " " for c in re.sub("[\x80-\xff]", "", title))
    return frozenset(plain.lower().split())


def plain_score(a, b):
    if not a or not b:
        return 0
    joined = [" ".join(sorted(x)) for x in (a & b, a - b, b - a)]
    return score_parts(joined[0], f"{joined[0]} {joined[1]}".strip(), f"{joined[0]} {joined[2]}".strip(), True)


def all_pairs(rows, k, threshold):
    rows = sorted({r for r in rows if r[1] is not None})
    sets = {t: token_set(t) for _, t in rows}
    out = []
    for product, title in rows:
        best = {}
        for other, t in rows:
            score = plain_score(sets[title], sets[t])
            if other != product and score > threshold:
                best[other] = min(best.get(other, (0, "")), (-score, t))
        ranked = sorted((s, p, t) for p, (s, t) in best.items())[:k]
        out += [(product, title, i + 1, p, t, -s) for i, (s, p, t) in enumerate(ranked)]
    return out


def titles(n, seed):
    rnd = random.Random(seed)
    words = ["red", "blue", "small", "ring", "bolt", "brand", "12", "1", "gear", "gizmo", "éclair", "naïve", "日本"]
    words += [f"w{i}" for i in range(12)]
    rows = []
    for _ in range(n):
        title = " ".join(["brand"] * (rnd.random() < 0.6) + [rnd.choice(words) for _ in range(rnd.choice([0, 1, 2, 3, 4, 6, 14]))])
        if title and rnd.random() < 0.4:  # a typing error
            i = rnd.randrange(len(title))
            title = title[:i] + rnd.choice(["x", "", title[i] * 2]) + title[i + 1:]
        rows.append((str(rnd.randrange(n)), rnd.choice([title, title.upper(), title + "!"])))
    return rows + [("7", None), ("8", "??"), *rows[:5], *[(f"c{i}", "brand ring copy") for i in range(30)]]


@pytest.mark.parametrize("k, tile, seed", [(10, 4096, 1), (2, 16, 2)])
def test_equals_all_pairs(spark, k, tile, seed):
    rows = titles(150, seed)
    catalogue = spark.createDataFrame(rows, "product_id string, title string").withColumn("score", F.lit("x"))
    got = similar.most_similar(catalogue, k, tile=tile)
    assert sorted(map(tuple, got.collect())) == sorted(all_pairs(rows, k, 70))


def test_empty_catalogue(spark):
    assert similar.most_similar(spark.createDataFrame([], "product_id string, title string")).count() == 0


def test_candidates_are_fewer_than_all_pairs(spark):
    """Sets of rare tokens ask for their own neighbours only, though one token is in every title."""
    rows = [(str(i), f"brand item{i % 40:03d}{'abcdefghij'[i % 10] * 3} {i % 40}x{i % 40}") for i in range(400)]
    rows += [(f"n{i}", f"brand {chr(97 + i % 26) * 9}{i}") for i in range(400)]
    catalogue = spark.createDataFrame(rows, "product_id string, title string")
    sets, _ = similar.title_sets(catalogue, 1)
    near = similar.signature_pairs(sets, 1).withColumn("floor", F.lit(71).cast("long"))
    n, scored = sets.count(), near.count()
    assert n == 440 and scored <= n * 4 * 3


def test_keys_of_long_lists_are_cut_into_tiles(spark):
    asked = spark.range(50).select(F.lit(7).alias("key"), F.col("id").alias("a"))
    index = spark.range(100).select(F.lit(7).alias("key"), F.col("id").alias("b"))
    sizes = spark.createDataFrame([(7, 100)], "key int, size int")
    met = similar.tiled(asked, index, sizes, tile=9)
    assert met.select("a", "b").distinct().count() == met.count() == 5000 and met.select("tile").distinct().count() > 6
