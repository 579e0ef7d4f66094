import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from revlens.llm import language

SCHEMA = "doc_id long, text string, lang string"
SYLLABLES = {"en": "th er on an re he in ed nd ha ing", "fr": "é le eau ou que ai ère ment ç", "de": "sch ein ung ß ü ge en keit", "xx": "zz qq ww"}


def corpus(n, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(list(SYLLABLES))
        syl = SYLLABLES[lang].split()
        words = ["".join(rng.choices(syl, k=rng.randint(1, 4))) for _ in range(rng.randint(10, 150))]
        rows.append((i, " ".join(words).capitalize() + ".", lang))
    return rows


def slow_grams(text):
    low, out, word = (text or "").lower(), Counter(), ""
    for c in low + " ":
        if c.isalpha():
            word += c
        elif word:
            padded = f"_{word}_"
            out.update(word)
            out.update(padded[i:i + 2] for i in range(len(padded) - 1))
            out.update(padded[i:i + 3] for i in range(len(padded) - 2))
            word = ""
    return out


def code(gram):
    v = 0
    for c in gram:
        v = v << 21 | (1 if c == "_" else ord(c) + 2)
    return v


def test_grams_match_brute_force(monkeypatch):
    rng = random.Random(2)
    texts = ["", "a", "Ab cd", "É1é", "don't", "中文 字", "  x  ", "İ", "123 ...", "word\nword\tword"]
    texts += ["".join(rng.choices("aB é1.\n", k=60)) for _ in range(50)]
    for size in (language.BLOCK_CHARS, 8):
        monkeypatch.setattr(language, "BLOCK_CHARS", size)
        for t in texts:
            codes, counts = language.count_grams(t)
            assert dict(zip(codes.tolist(), counts.tolist())) == {code(g): n for g, n in slow_grams(t).items()}, t


def test_distance_matches_brute_force():
    known = {"a": [5, 3, 9], "b": [9, 5, 100, 7]}
    p, own = language.Profiles(known), np.array([9, 3, 42])
    want = [sum(abs(known[k].index(c) - i) if c in known[k] else 300 for i, c in enumerate([9, 3, 42])) for k in "ab"]
    assert p.distances(own).tolist() == want


def test_held_out_accuracy(spark):
    df = spark.createDataFrame(corpus(500), SCHEMA)
    keep = F.crc32(F.col("doc_id").cast("string")) % 4 != 2
    known = language.learn(df, keep)
    assert all(len(v) <= language.TOP for v in known.values())
    got = df.filter(~keep).select("lang", language.predict(F.col("text"), known).alias("p")).select("lang", "p.*").collect()
    assert len(got) > 80 and np.mean([r.lang == r.lang_pred for r in got]) > 0.97 and all(0 <= r.score <= 1 for r in got)


def test_profiles_match_brute_force(spark):
    rows = corpus(60, 3)
    known = language.learn(spark.createDataFrame(rows, SCHEMA).repartition(5), F.lit(True))
    for lang in SYLLABLES:
        total = sum((slow_grams(t) for _, t, x in rows if x == lang), Counter())
        want = sorted(total, key=lambda g: (-total[g], code(g)))[: language.TOP]
        assert known[lang] == [code(g) for g in want]


def test_training_is_bounded(spark):
    df = spark.createDataFrame(corpus(400, 4), SCHEMA)
    n = language.training_documents(df, F.lit(True), max_docs=20).groupBy("lang").count().collect()
    assert len(n) == 4 and all(5 <= r["count"] <= 45 for r in n)


@pytest.mark.parametrize("text", [None, "", "  ", "123 !?", "😀"])
def test_texts_without_letters(text):
    assert language.Profiles({"a": [1]}).predict(text) == ("und", 0.0)


def test_defined_cases(spark):
    rows = [(1, "word word", "en"), (1, "word word", "en"), (None, "mot", "fr"), (2, None, "de"), (3, "x", None), (4, "lang " * 100_000, "en")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("code", F.lit(1)).withColumn("h", F.lit(1))
    keep = F.crc32(F.col("doc_id").cast("string")) % 4 != 9
    known = language.learn(df, keep)
    assert "en" in known and "fr" not in known  # a null id is in no fold
    assert df.select(language.predict(F.col("text"), known)).count() == 6
    none = language.learn(df.limit(0), keep)
    assert none == {} and df.select(language.predict(F.col("text"), none)["lang_pred"].alias("p")).first().p == "und"


def test_every_language_is_learned(spark):
    names = [f"l{i:04d}" for i in range(5000)]
    rows = [(i, f"word {n}", n) for i, n in enumerate(names)] + [(9000 + i, "more words", "l0007") for i in range(300)]
    known = language.learn(spark.createDataFrame(rows, SCHEMA), F.lit(True), max_docs=100)
    assert sorted(known) == names
    counts = Counter(r.lang for r in language.training_documents(spark.createDataFrame(rows, SCHEMA), F.lit(True), 100).collect())
    assert set(counts) == set(names) and 60 <= counts["l0007"] <= 140 and sum(counts.values()) - counts["l0007"] == 4999
