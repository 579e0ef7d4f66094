"""Operator 8, quality classifier: random Fourier features, ridge, isotonic calibration.

1. Document statistics: lengths, character classes, repetition of words, lines
   and bytes; shares and logarithms, standardised over the training rows.
2. Random Fourier features approximate a Gaussian kernel over them.
3. Each partition sums its normal equations (features x features); the sums are
   added up and the ridge weights solved, whatever the number of rows.
4. Isotonic calibration: the scores of training rows kept out of the fit are
   counted in ``BINS`` bins, pooled to a rising step curve and read by linear
   interpolation, so scores are probabilities and 0.5 is the cut.

Only text goes into a score.  The fit uses about ``MAX_LABELS`` labelled ids at
most (a documented bound, kept by a hash of the id), so they can be broadcast
to select their texts without a shuffle.

Defined cases: a null text scores as an empty one; repeated label rows count
once, documents of a repeated doc_id each; labels that are null or neither 0
nor 1 are not learned from; with no labelled rows of both kinds every score is the share of label 1
(0.5 without any); no documents, no scores.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice
from operator import eq

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.llm.common import written

FEATURES = 192
GAMMA = 0.05
RIDGE = 1e-3
SEED = 7
BINS = 1000
MAX_LABELS = 60_000
CALIBRATION_FOLD = 5  # every fifth training row calibrates
STEP = 1 << 20
GROUPS = 256

# byte classes of UTF-8 text
_CLASS = np.zeros(256, np.int64)
for _chars, _k in ((b"abcdefghijklmnopqrstuvwxyz", 1), (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", 2), (b"0123456789", 3),
                   (b" \t\r\x0b\x0c", 4), (b"\n", 5), (b".,;:?'\"()-", 6)):
    _CLASS[list(_chars)] = _k
_CLASS[128:] = 7


def statistics(text: str | None) -> list[float]:
    """The document statistics of one text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    n = max(1, len(raw))
    kinds = np.zeros(8, np.int64)
    pairs = 0
    packed = 0
    for at in range(0, len(raw), STEP):
        part = np.frombuffer(raw, np.uint8, min(STEP, len(raw) - at), at)
        kinds += np.bincount(_CLASS[part], minlength=8)
        pairs += int((part[1:] == part[:-1]).sum())
        packed += len(zlib.compress(part, 1))
    words = (text or "").split()
    w = max(1, len(words))
    counts = Counter(words)
    lines = [x for x in (text or "").split("\n") if x.strip()]
    run = sum(map(eq, words, islice(words, 1, None)))
    upper = capital = symbol_end = bare = 0
    for x, c in counts.items():
        if not x[-1].isalnum() and x[-1] not in ".,":
            symbol_end += c
            if not x[0].isalnum():
                bare += c
        if x[0].isupper():
            capital += c
            if x.isupper():
                upper += c
    top = counts.most_common(10)
    return [
        math.log1p(len(raw)), math.log1p(len(words)), len(raw) / w / 10, len(counts) / w,
        len(counts) / w ** 0.8, top[0][1] / w if top else 0.0, sum(c for _, c in top) / w, run / w,
        len(set(lines)) / max(1, len(lines)), math.log1p(len(lines)), len(lines) / w,
        packed / n, pairs / n, symbol_end / w, upper / w, bare / w, capital / w,
        *(kinds / n).tolist(),
    ]


N_STATS = len(statistics("a b"))


@dataclass
class Model:
    """Standardisation, random features, weights and calibration curve; a few thousand numbers."""

    mean: np.ndarray
    scale: np.ndarray
    omega: np.ndarray
    phase: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return features(stats, self.mean, self.scale, self.omega, self.phase) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(stats), self.knots, self.values)


def random_features(n_stats: int = N_STATS, n: int = FEATURES, gamma: float = GAMMA, seed: int = SEED):
    """Frequencies and phases for the kernel exp(-gamma |x - y|^2)."""
    rng = np.random.default_rng(seed)
    return rng.normal(0, math.sqrt(2 * gamma), (n_stats, n)), rng.uniform(0, 2 * math.pi, n)


def features(stats, mean, scale, omega, phase) -> np.ndarray:
    z = np.clip((stats - mean) / scale, -6, 6)
    wave = np.sqrt(2 / omega.shape[1]) * np.cos(z @ omega + phase)
    return np.hstack([wave, z / 10, np.ones((len(stats), 1))])


def isotonic(hits: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Pool adjacent violators: rising means over bins with ``totals`` rows, ``hits`` of them positive."""
    blocks: list[list[float]] = []
    for h, t in zip(hits, totals):
        blocks.append([h, t, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            h2, t2, n2 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + h2, blocks[-1][1] + t2, blocks[-1][2] + n2]
    return np.concatenate([np.full(n, h / t) for h, t, n in blocks]) if blocks else np.empty(0)


def training_rows(docs: DataFrame, labels: DataFrame, keep: Column, max_labels: int = MAX_LABELS) -> DataFrame:
    """(doc_id, quality, text) of about ``max_labels`` labelled ids at most for which ``keep`` (on doc_id) holds."""
    usable = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & keep)
    usable = written(usable.select(F.col("doc_id").alias("labelled"), F.col("quality").cast("int").alias("quality"))
                     .distinct(), "labels")
    share = min(1.0, max_labels / max(1, usable.count()))
    chosen = usable.filter(F.pmod(F.xxhash64("labelled"), F.lit(1_000_000)) < int(share * 1_000_000))
    # about max_labels rows of two numbers, whatever the table's size
    return docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled")).select(
        "doc_id", "quality", "text")


def _sums(rows: DataFrame, mean, scale, omega, phase) -> DataFrame:
    """Partition sums of the normal equations, added up in a few groups."""
    size = omega.shape[1] + len(mean) + 1

    def per_partition(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        gram, right, n = np.zeros((size, size)), np.zeros(size), 0
        for b in batches:
            x = features(np.array(b["stats"].tolist(), float).reshape(len(b), -1), mean, scale, omega, phase)
            gram += x.T @ x
            right += x.T @ b["quality"].to_numpy(float)
            n += len(b)
        if n:
            g = TaskContext.get().partitionId() % GROUPS
            yield pd.DataFrame({"g": [g], "gram": [gram.tobytes()], "rhs": [right.tobytes()], "n": [n]})

    def add(b: pd.DataFrame) -> pd.DataFrame:
        gram = sum(np.frombuffer(x) for x in b["gram"])
        right = sum(np.frombuffer(x) for x in b["rhs"])
        return pd.DataFrame({"g": [0], "gram": [gram.tobytes()], "rhs": [right.tobytes()], "n": [b["n"].sum()]})

    schema = "g long, gram binary, rhs binary, n long"
    # two levels, so that no task adds more than a share of the partitions
    parts = rows.mapInPandas(per_partition, schema).groupBy("g").applyInPandas(add, schema)
    return parts.groupBy("g").applyInPandas(add, schema)


def fit(docs: DataFrame, labels: DataFrame, keep: Column, max_labels: int = MAX_LABELS) -> Model:
    """The model learned from the labelled rows for which ``keep`` holds."""

    def with_stats(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "quality": b["quality"],
                                "stats": [statistics(t) for t in b["text"]]})

    rows = training_rows(docs, labels, keep, max_labels).mapInPandas(
        with_stats, "doc_id long, quality int, stats array<double>")
    rows = written(rows, "statistics").withColumn("fold", F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(CALIBRATION_FOLD)))
    moments = [f(F.col("stats")[i]) for i in range(N_STATS) for f in (F.avg, F.stddev_pop)]
    first = rows.agg(F.count(F.lit(1)), F.avg("quality"), *moments).first()
    share = 0.5 if first[1] is None else float(first[1])
    mean = np.array([x or 0.0 for x in first[2::2]])
    scale = np.maximum(np.array([x or 0.0 for x in first[3::2]]), 1e-6)
    omega, phase = random_features()
    size = FEATURES + N_STATS + 1
    flat = Model(mean, scale, omega, phase, np.zeros(size), np.array([0.0]), np.array([share]))
    if share in (0.0, 1.0) or not first[0]:
        return flat
    part = _sums(rows.filter("fold > 0"), mean, scale, omega, phase)

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for row in b.itertuples():
                gram = np.frombuffer(row.gram).reshape(size, size)
                lift = RIDGE * row.n * np.eye(size) * (np.trace(gram) / row.n / size)
                yield pd.DataFrame({"w": [np.linalg.solve(gram + lift, np.frombuffer(row.rhs)).tobytes()]})

    solved = part.mapInPandas(solve, "w binary").first()
    if solved is None:
        return flat
    weights = np.frombuffer(solved["w"])

    def binned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = Model(mean, scale, omega, phase, weights, flat.knots, flat.values)
        for b in batches:
            s = model.raw(np.array(b["stats"].tolist(), float).reshape(len(b), -1))
            bins = np.clip(np.floor((s + 0.5) / 2 * BINS), 0, BINS - 1).astype("int64")
            yield pd.DataFrame({"bin": bins, "quality": b["quality"]})

    counts = rows.filter("fold = 0").mapInPandas(binned, "bin long, quality int")
    # at most BINS rows
    got = counts.groupBy("bin").agg(F.sum("quality").alias("hits"), F.count(F.lit(1)).alias("n")).orderBy("bin").collect()
    if not got:
        return flat
    knots = np.array([(r["bin"] + 0.5) / BINS * 2 - 0.5 for r in got])
    values = isotonic(np.array([r["hits"] for r in got], float), np.array([r["n"] for r in got], float))
    return Model(mean, scale, omega, phase, weights, knots, values)


def score(text: Column, model: Model) -> Column:
    """Probability of label 1 of a text."""

    def run(texts: pd.Series) -> pd.Series:
        if not len(texts):
            return pd.Series([], dtype=float)
        return pd.Series(np.clip(model.score(np.array([statistics(t) for t in texts])), 0, 1))

    return F.pandas_udf(run, T.DoubleType())(text)


def keep_good(docs: DataFrame, labels: DataFrame, keep: Column) -> DataFrame:
    """``docs`` without those scored under 0.5."""
    return docs.filter(score(F.col("text"), fit(docs, labels, keep)) >= 0.5)
