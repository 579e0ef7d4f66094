"""Operator 9, language ID: rank-order profiles.

A profile is the ``TOP`` most frequent n-grams of 1 to 3 letters, words padded
with a border mark.  A document's profile is compared with each language's by
the out-of-place distance: the sum of rank differences, ``TOP`` for an n-gram
the language does not have.  The smallest distance wins.

Language profiles come from about ``MAX_DOCS`` training documents per language
at most (a documented bound, kept by a hash of the id).  Each partition sums its
n-gram counts per language before the shuffle, so a language that holds a third
of all rows sends one row per n-gram and task.  Texts are counted in blocks,
so a long text needs no more memory than its distinct n-grams.

Defined cases: null text or a text without a letter is ``und`` with score 0;
equal counts rank by n-gram, equal distances by language name; with no training
rows every text is ``und``; rows of null lang are not learned from; the number of
languages has no bound but the driver's memory for their profiles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlens.llm.common import written

TOP = 300
MAX_DOCS = 3000
HASHES = 1_000_000
BLOCK_CHARS = 1 << 18
UNKNOWN = "und"

_LETTER: np.ndarray | None = None


def _letters() -> np.ndarray:
    """For each code point: is it a letter (built once per process)?"""
    global _LETTER
    if _LETTER is None:
        _LETTER = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _LETTER


def _grams(text: str) -> np.ndarray:
    """Codes of all 1- to 3-grams of the words of a text; a word border counts as a letter coded 1."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    code = np.where(_letters()[points], points.astype(np.int64) + 2, 1)
    code = np.concatenate([[1], code, [1]])
    code = code[np.append(True, (code[1:] != 1) | (code[:-1] != 1))]  # one mark between words
    one = code[code != 1]
    two = code[:-1] << 21 | code[1:]
    three = code[:-2] << 42 | code[1:-1] << 21 | code[2:]
    three = three[code[1:-1] != 1]  # no n-gram goes on past a word
    return np.concatenate([one, two, three])


def count_grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram codes of a text, ascending, and their counts."""
    codes, counts = np.empty(0, np.int64), np.empty(0, np.int64)
    text = text or ""
    at = 0
    while at < len(text):
        end = at + BLOCK_CHARS
        while end < len(text) and text[end].isalpha() and end < at + 2 * BLOCK_CHARS:  # to the end of a word
            end += 1
        c, n = np.unique(_grams(text[at:end]), return_counts=True)
        codes, counts = _merge(codes, counts, c, n) if len(codes) else (c, n)
        at = end
    return codes, counts


def _merge(a: np.ndarray, n: np.ndarray, b: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    codes, inverse = np.unique(np.concatenate([a, b]), return_inverse=True)
    return codes, np.bincount(inverse, np.concatenate([n, m])).astype(np.int64)


def profile(codes: np.ndarray, counts: np.ndarray, top: int = TOP) -> np.ndarray:
    """The most frequent codes, by falling count, then code."""
    if len(codes) > top:
        least = np.partition(counts, len(counts) - top)[len(counts) - top]
        codes, counts = codes[counts >= least], counts[counts >= least]
    return codes[np.argsort(-counts, kind="stable")[:top]]


class Profiles:
    """Language profiles prepared for look-ups."""

    def __init__(self, found: dict[str, list[int]]) -> None:
        self.names = sorted(found)
        self.sorted, self.rank = [], []
        for name in self.names:
            codes = np.array(found[name], np.int64)
            order = np.argsort(codes)
            self.sorted.append(codes[order])
            self.rank.append(order)

    def distances(self, own: np.ndarray, top: int = TOP) -> np.ndarray:
        """Out-of-place distance of a document profile to each language."""
        place = np.arange(len(own))
        out = np.zeros(len(self.names))
        for i, (codes, rank) in enumerate(zip(self.sorted, self.rank)):
            at = np.minimum(np.searchsorted(codes, own), len(codes) - 1)
            out[i] = np.where(codes[at] == own, np.abs(rank[at] - place), top).sum()
        return out

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, score): the score is one less the best distance's share of the worst possible."""
        own = profile(*count_grams(text))
        if not len(own) or not self.names:
            return UNKNOWN, 0.0
        d = self.distances(own)
        best = int(d.argmin())
        return self.names[best], float(1 - d[best] / (TOP * len(own)))


def training_documents(docs: DataFrame, keep: Column, max_docs: int = MAX_DOCS) -> DataFrame:
    """(lang, text) of about ``max_docs`` documents per language for which ``keep`` (on doc_id) holds.

    Counts per language give the share of hashes to take (at least one hash), so
    the texts are selected without a sort.  The shares are a written table of one
    row per language, however many there are: Spark broadcasts it while it is
    small, else AQE splits the rows of a large language.
    """
    hashed = F.pmod(F.xxhash64(F.col("doc_id")), F.lit(HASHES))
    usable = docs.filter(F.col("lang").isNotNull() & keep).select("lang", "text", hashed.alias("hash"))
    share = F.greatest(F.lit(1), F.floor(F.least(F.lit(1.0), max_docs / F.count(F.lit(1))) * HASHES)).cast("long")
    shares = written(usable.groupBy("lang").agg(share.alias("share")).withColumnRenamed("lang", "l"), "language_shares")
    return usable.join(shares, (F.col("lang") == F.col("l")) & (F.col("hash") < F.col("share"))).select("lang", "text")


def learn(docs: DataFrame, keep: Column, max_docs: int = MAX_DOCS) -> dict[str, list[int]]:
    """language -> its n-grams by rank."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, list[tuple]] = {}
        totals: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def fold(lang: str) -> None:
            parts = sums.pop(lang)
            codes = np.concatenate([c for c, _ in parts])
            counts = np.concatenate([n for _, n in parts])
            totals[lang] = _merge(*totals.get(lang, (codes[:0], counts[:0])), codes, counts)

        for b in batches:
            for lang, text in zip(b["lang"], b["text"]):
                held = sums.setdefault(lang, [])
                held.append(count_grams(text))
                if len(held) >= 200:
                    fold(lang)
        for lang in list(sums):
            fold(lang)
        for lang, (codes, counts) in totals.items():
            yield pd.DataFrame({"lang": lang, "code": codes, "n": counts})

    counted = training_documents(docs, keep, max_docs).mapInPandas(count, "lang string, code long, n long")
    sums = counted.groupBy("lang", "code").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "code")
    # TOP rows per language; the profiles are the model: TOP numbers per language
    best = sums.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= TOP)
    listed = best.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("r", "code"))).alias("ranked"))
    return {r["lang"]: r["codes"] for r in listed.select("lang", F.col("ranked.code").alias("codes")).collect()}


def predict(text: Column, profiles: dict[str, list[int]]) -> Column:
    """struct(lang_pred, score) of a text."""

    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = Profiles(profiles)
        for part in texts:
            yield pd.DataFrame([known.predict(t) for t in part], columns=["lang_pred", "score"])

    return F.pandas_udf(run, "lang_pred string, score double")(text)
