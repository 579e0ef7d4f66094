import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from revlens.llm import quality

DOCS, LABELS = "doc_id long, text string", "doc_id long, quality int, toxic int"


def corpus(n, seed=1):
    rng = random.Random(seed)
    words = ["".join(rng.choices("aeiourstlnd", k=rng.randint(1, 9))) for _ in range(800)]
    docs, labels = [], []
    for i in range(n):
        good = rng.random() < 0.7
        text = " ".join(rng.choices(words, k=rng.randint(30, 200))).capitalize() + "."
        if not good:
            text = rng.choice([" ".join([rng.choice(words)] * 60), " ".join(w.upper() + "!!" for w in text.split()),
                               " ".join(w + rng.choice(["###", "%%%"]) for w in text.split())])
        docs.append((i, text))
        labels.append((i, int(good), 0))
    return docs, labels


def test_held_out_accuracy(spark):
    docs, labels = corpus(600)
    d = spark.createDataFrame(docs, DOCS)
    keep = F.crc32(F.col("doc_id").cast("string")) % 3 != 1
    model = quality.fit(d, spark.createDataFrame(labels, LABELS), keep)
    got = d.filter(~keep).select("doc_id", quality.score(F.col("text"), model).alias("s")).collect()
    truth = {i: q for i, q, _ in labels}
    assert len(got) > 100 and all(0 <= r.s <= 1 for r in got)
    assert np.mean([(r.s >= 0.5) == truth[r.doc_id] for r in got]) > 0.95


def test_isotonic_is_the_best_rising_fit():
    rng = np.random.default_rng(2)
    for _ in range(30):
        n = rng.integers(1, 12)
        total = rng.integers(1, 9, n).astype(float)
        hits = np.array([rng.integers(0, t + 1) for t in total], float)
        got = quality.isotonic(hits, total)
        assert (np.diff(got) >= -1e-12).all() and len(got) == n
        mean = lambda a, b: hits[a:b + 1].sum() / total[a:b + 1].sum()
        want = [min(max(mean(a, b) for a in range(i + 1)) for b in range(i, n)) for i in range(n)]
        assert np.allclose(got, want)


def test_random_features_approximate_the_kernel():
    rng = np.random.default_rng(3)
    omega, phase = quality.random_features(5, 8000, gamma=0.1)
    x = rng.normal(size=(20, 5))
    wave = quality.features(x, 0, 1, omega, phase)[:, :8000]
    want = np.exp(-0.1 * ((x[:, None] - x[None]) ** 2).sum(-1))
    assert np.abs(wave @ wave.T - want).max() < 0.06


def test_partition_sums_do_not_depend_on_partitions(spark):
    docs, labels = corpus(120)
    lab = spark.createDataFrame(labels, LABELS)
    models = [quality.fit(spark.createDataFrame(docs, DOCS).repartition(n), lab, F.lit(True)) for n in (1, 7)]
    assert np.allclose(models[0].weights, models[1].weights, atol=1e-6)


@pytest.mark.parametrize("text", [None, "", " ", "\n\n", "a", "😀" * 10, "word " * 300_000])
def test_statistics_of_odd_texts(text):
    s = quality.statistics(text)
    assert len(s) == quality.N_STATS and np.isfinite(s).all()


def test_defined_cases(spark):
    docs = spark.createDataFrame([(1, "x y z"), (1, "x y z"), (2, None), (None, "text"), (3, "")], DOCS)
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (2, None, 0), (3, 7, 0), (None, 0, 0)], LABELS)
    for lab, share in ((labels, 1.0), (labels.limit(0), 0.5)):
        model = quality.fit(docs, lab, F.lit(True))
        assert [r.s for r in docs.select(quality.score(F.col("text"), model).alias("s")).collect()] == [share] * 5
    assert quality.keep_good(docs.limit(0).withColumn("quality", F.lit(1)), labels, F.lit(True)).count() == 0
