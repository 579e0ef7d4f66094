"""D1 for every product against all pairs, with hot terms, tiles, ties and products that share nothing."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import pytest

from revlens.operators import content, content_all

SCHEMA = "product_id string, title string, review_text string"


def all_pairs(rows, k):
    tf = defaultdict(Counter)
    for p, title in {(p, t) for p, t, _ in rows}:
        tf[p].update((title or "").split())
    for p, _, text in rows:
        tf[p].update((text or "").split())
    df = Counter(t for c in tf.values() for t in c)
    n = len({p for p, *_ in rows})
    w = {p: {t: c * math.log((n + 1) / (df[t] + 1)) for t, c in terms.items()} for p, terms in tf.items()}
    norm = {p: math.sqrt(sum(x * x for x in v.values())) for p, v in w.items()}
    out = []
    for a in w:
        cosines = [(round(sum(x * w[b].get(t, 0) for t, x in w[a].items()) / (norm[a] * norm[b]), 9), b)
                   for b in w if b != a and norm[a] and norm[b]]
        best = sorted((-c, b) for c, b in cosines if c > 0)[:k]
        out += [(a, i + 1, b, -c) for i, (c, b) in enumerate(best)]
    return out


@pytest.mark.parametrize("k, tile", [(10, 4096), (3, 8)])
def test_equals_all_pairs(spark, k, tile):
    rnd = random.Random(k)
    words = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(120):
        title = "brand " + " ".join(rnd.choices(words[:12], k=2))
        rows += [(f"p{i}", title, " ".join(rnd.choices(words, k=rnd.randrange(0, 9)))) for _ in range(rnd.randrange(1, 4))]
    rows += [("copy1", "same words", "w1 w2"), ("copy2", "same words", "w1 w2"), ("alone", "nobody", "else"),
             ("empty", None, None), ("hot", "brand w1", " ".join(words * 20))]
    df = spark.createDataFrame(rows, SCHEMA)
    w = content.term_weights(df)
    got = content_all.most_similar_by_content(w, content.norms(w), k, tile).collect()
    want = {(a, i): (b, c) for a, i, b, c in all_pairs(rows, k)}
    assert {(r.product_id, r.position) for r in got} == set(want)
    for r in got:  # sums differ in the last place, so a tie at 9 places may fall either way
        b, c = want[r.product_id, r.position]
        assert abs(r.cosine - c) <= 2e-9 and (r.similar_id == b or any(
            abs(x - c) <= 2e-9 and y == r.similar_id for (p, _), (y, x) in want.items() if p == r.product_id))


def test_no_products(spark):
    w = content.term_weights(spark.createDataFrame([], SCHEMA))
    assert content_all.most_similar_by_content(w, content.norms(w)).count() == 0


def test_terms_beyond_the_axes(spark, monkeypatch):
    monkeypatch.setattr(content_all, "AXES", 4)
    monkeypatch.setattr(content_all, "BLOCK_ENTRIES", 40)
    monkeypatch.setattr(content_all, "GROUP_ENTRIES", 100)
    monkeypatch.setattr(content_all, "PAIR_ENTRIES", 64)
    test_equals_all_pairs(spark, 4, 16)


def test_only_like_blocks_meet(spark, monkeypatch):
    rnd = random.Random(5)
    # 30 kinds of 32 products; the kinds share words that nearly all products have
    rows = [(f"p{i}", f"kind{i % 30} make{i % 30}", " ".join(rnd.choices(["low", "high", "not"], k=4))) for i in range(960)]
    kept, tiles = [], content_all._tiles

    def counted(blocks, groups, k):
        out = tiles(blocks, groups, k)
        kept.append((blocks.count(), groups, out.count()))
        return out

    monkeypatch.setattr(content_all, "_tiles", counted)
    w = content.term_weights(spark.createDataFrame(rows, SCHEMA))
    got = content_all.most_similar_by_content(w, content.norms(w), 10, 16).collect()
    assert len(got) == 9600 and all(int(r.product_id[1:]) % 30 == int(r.similar_id[1:]) % 30 for r in got)
    (blocks, groups, met), = kept
    assert met < blocks * groups / 4
