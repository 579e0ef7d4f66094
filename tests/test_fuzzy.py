"""Token-set score against a plain-Python statement of the definition."""

import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from revlens.functions.fuzzy import half_even_percent, lcs_bits, with_token_set_score


def lcs_dp(a, b):
    prev = [0] * (len(b) + 1)
    for ca in a:
        cur = [0]
        for j, cb in enumerate(b):
            cur.append(prev[j] + 1 if ca == cb else max(prev[j + 1], cur[j]))
        prev = cur
    return prev[-1]


def ratio(x, y):
    if not x or not y:
        return 0
    return round(100 * 2 * lcs_dp(x, y) / (len(x) + len(y)))  # Python round: half to even


def norm(s):
    s = "".join(ch for ch in s if not (0x80 <= ord(ch) <= 0xFF))
    s = re.sub(r"[^\w]", " ", s)  # \w: letters, digits, underscore
    return s.lower().strip()


def score(x, y):
    if x is None or y is None:
        return 0
    a, b = set(norm(x).split()), set(norm(y).split())
    if not a or not b:
        return 0
    t0 = " ".join(sorted(a & b))
    t1 = (t0 + " " + " ".join(sorted(a - b))).strip()
    t2 = (t0 + " " + " ".join(sorted(b - a))).strip()
    return max(ratio(t0, t1), ratio(t0, t2), ratio(t1, t2))


def test_lcs_bits_matches_dp():
    rnd = random.Random(3)
    for _ in range(5000):
        a = "".join(rnd.choice("abc é") for _ in range(rnd.randint(0, 40)))
        b = "".join(rnd.choice("abcd é") for _ in range(rnd.randint(0, 40)))
        assert lcs_bits(a, b) == lcs_dp(a, b)


def test_half_even():
    assert half_even_percent(141, 200) == 70  # 70.5 -> 70
    assert half_even_percent(143, 200) == 72  # 71.5 -> 72
    assert half_even_percent(1, 0) == 0


PAIRS = [
    ("small ring Brand#2 ECONOMY", "small ring Brand#2 ECONOMY"),
    ("small ring Brand#2 ECONOMY", "red ring Brand#2 ECONOMY"),
    ("Copper Tubing, 1/2\" OD", "copper tubing 1 2 od 96 length"),
    ("colour pencil set", "color pencils set"),
    ("Crème brûlée torch", "Creme brulee torch"),
    ("", "anything"),
    (None, "anything"),
    ("!!!", "???"),
    ("snake_case title", "snake case title"),
    ("a b c d", "d c b a"),
]


def test_score_pairs(spark):
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(PAIRS)], "i int, x string, y string")
    got = {r.i: r.score for r in with_token_set_score(df, "x", "y").collect()}
    for i, (x, y) in enumerate(PAIRS):
        assert got[i] == score(x, y), (x, y, got[i], score(x, y))


words = st.sampled_from(["red", "blue", "bolt", "ring", "nut", "Brand#1", "Brand#12", "ECONOMY", "co", "x_y"])


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.lists(words, max_size=6), st.lists(words, max_size=6)), min_size=1, max_size=20))
def test_score_property(spark, pairs):
    data = [(i, " ".join(a), " ".join(b)) for i, (a, b) in enumerate(pairs)]
    df = spark.createDataFrame(data, "i int, x string, y string")
    full = {r.i: r.score for r in with_token_set_score(df, "x", "y").collect()}
    cut = {r.i: r.score for r in with_token_set_score(df, "x", "y", threshold=70).collect()}
    for i, x, y in data:
        assert full[i] == score(x, y)
        # with the pre-filter the score is exact above the threshold
        assert (cut[i] > 70) == (full[i] > 70)
        if full[i] > 70:
            assert cut[i] == full[i]


def test_literal_anchor(spark):
    df = spark.createDataFrame([("large gizmo Brand#4 PROMO",), ("large gizmo Brand#5 PROMO",), ("tiny",)], "t string")
    rows = with_token_set_score(df, "t", F.lit("large gizmo Brand#4 PROMO")).collect()
    assert [r.score for r in rows] == [score(r.t, "large gizmo Brand#4 PROMO") for r in rows]
