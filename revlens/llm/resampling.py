"""Operator 12, importance resampling towards a target distribution, on Arrow kernels.

Hashed word n-grams (1 to ``ORDERS`` words) of all documents and of the target
texts are counted in ``BUCKETS`` buckets; a bucket's gain is the log ratio of
its smoothed shares, in thousandths.  A document weighs the sum of its
features' gains; weight plus Gumbel noise, drawn from its id, is its score, and
the highest scores are the sample, a draw without replacement in proportion to
the importance weights.

Arrow kernels do the work on a batch: ``ascii_lower``, ``split_pattern_regex``,
``list_flatten`` and ``dictionary_encode`` give each word an index; shifted
indices form n-grams, each one the pair of an (n-1)-gram and a word, which
``dictionary_encode`` makes distinct again; the CRC of a distinct pair comes
from the CRC of its left part and the word's; ``take`` brings buckets or gains
back to the places, and a segment reduction sums them per document.

Scale.  Texts are read twice, once to count and once to weigh; a task that
counts sends at most ``BUCKETS`` rows, and the gains are ``BUCKETS`` numbers,
whatever the corpus.  A batch is worked through in blocks of about
``BLOCK_BYTES``; a longer text is cut at a separator, and a block begins with
the last words of the one before, so n-grams across the cut are counted once.
Ranks come from a sort by range of (score, id) and the counts per partition.

Defined cases: a null text has no words, no features and weight 0; null ids
take part (their noise is drawn from an empty id) and come last among ties;
repeated rows count, weigh and are ranked as rows of their own, equal ones next
to each other in any order; no documents, no rows; an empty target weighs by
the documents alone; other columns are not read, whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlens.llm.common import written

ORDERS = 3
BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 5
NOISE_SEED = 42
BLOCK_BYTES = 1 << 22
TABLE_BYTES = 64  # words of up to this length take part in the vectorised CRC

# Fixed value: what separates words, after the letters A-Z are lower-cased.
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# the same in a text as it is, and the words
_BREAK = re.compile(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


# ---- crc32 of joined texts -----------------------------------------------------


@lru_cache(1)
def _shift_tables() -> np.ndarray:
    """tables[n, k, b]: what byte ``k`` (value ``b``) of a CRC becomes when ``n`` bytes follow.

    crc32(A + B) is linear in crc32(A) for a given length of B, so four look-ups replace a pass over A.
    """
    single = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        single = np.where(single & 1, (single >> 1) ^ np.uint32(0xEDB88320), single >> 1).astype(np.uint32)
    tables = np.zeros((TABLE_BYTES + 2, 4, 256), np.uint32)
    for k in range(4):
        tables[0, k] = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
    for n in range(1, TABLE_BYTES + 2):
        tables[n] = single[tables[n - 1] & 0xFF] ^ (tables[n - 1] >> np.uint32(8))
    return tables


class Words:
    """CRCs of the distinct words of a block, alone and after a space."""

    def __init__(self, words: list[bytes]) -> None:
        self.words = words
        self.crc = np.fromiter(map(zlib.crc32, words), np.uint32, len(words))
        self.spaced = np.fromiter((zlib.crc32(b" " + w) for w in words), np.uint32, len(words))
        self.size = np.fromiter((1 + len(w) for w in words), np.int64, len(words))

    def appended(self, crc: np.ndarray, word: np.ndarray) -> np.ndarray:
        """crc32 of (text, space, word) from the texts' CRCs and the words' indices."""
        size = self.size.take(word)
        tables = _shift_tables().ravel()
        out = self.spaced.take(word)
        at = np.minimum(size, TABLE_BYTES + 1) * 1024
        for k in range(4):
            out ^= tables.take(at + (256 * k) + ((crc >> np.uint32(8 * k)) & np.uint32(0xFF)))
        for i in np.flatnonzero(size > TABLE_BYTES + 1):
            out[i] = zlib.crc32(b" " + self.words[word[i]], int(crc[i]))
        return out


# ---- features of a block -------------------------------------------------------


def _blocks(texts: pa.Array) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """(texts, row of each, words at its start that were counted already), about ``BLOCK_BYTES`` at a time."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    at = 0
    while at < len(sizes):
        if sizes[at] > BLOCK_BYTES:
            yield from _cut(at, texts[at].as_py())
            at += 1
            continue
        end = at + max(1, int(np.searchsorted(np.cumsum(sizes[at:]), BLOCK_BYTES, "right")))
        yield texts.slice(at, end - at), np.arange(at, end), np.zeros(end - at, np.int64)
        at = end


def _cut(row: int, text: str) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    start, carried = 0, []
    while start < len(text):
        end = start + BLOCK_BYTES // 4
        found = _BREAK.search(text, end) if end < len(text) else None
        end = found.end() if found else len(text)
        part = text[start:end]
        yield pa.array([" ".join([*carried, part])], pa.string()), np.array([row]), np.array([len(carried)])
        carried = (carried + _WORD.findall(part)[1 - ORDERS:])[1 - ORDERS:] if ORDERS > 1 else []
        start = end


def _features(texts: pa.Array, carried: np.ndarray) -> tuple[list[tuple[np.ndarray, np.ndarray, np.ndarray]], np.ndarray]:
    """Per order (bucket of each distinct n-gram, its places' n-gram, their text), and the words of each text."""
    lists = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(texts, "")), pattern=SEPARATOR)
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    flat = pc.list_flatten(lists)
    owner = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    real = pc.not_equal(flat, "")  # what stands before a first or after a last separator
    coded = flat.filter(real).dictionary_encode()
    owner = owner[real.to_numpy(zero_copy_only=False)]
    index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    words = Words(coded.dictionary.cast(pa.binary()).to_pylist())
    n_words = np.bincount(owner, minlength=len(texts))
    place = np.arange(len(index)) - (np.cumsum(n_words) - n_words)[owner]  # of a word in its text
    fresh = place >= carried[owner]  # n-grams that end in a word carried over were counted before
    out = [(words.crc, index[fresh], owner[fresh])]
    grams, crc = index, words.crc
    for order in range(2, ORDERS + 1):
        whole = place[order - 1:] >= order - 1
        left, last = grams[:max(0, len(index) - order + 1)], index[order - 1:]
        pairs = pa.array(np.where(whole, left * len(words.words) + last, -1)).dictionary_encode()
        distinct = pairs.dictionary.to_numpy(zero_copy_only=False)
        grams = pairs.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        if len(words.words):
            crc = words.appended(crc[distinct // len(words.words)], distinct % len(words.words))
        use = whole & fresh[order - 1:]
        out.append((crc, grams[use], owner[order - 1:][use]))
    return out, n_words - carried


def _counter(n_buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(n_buckets, np.int64)
        for batch in batches:
            for texts, _, carried in _blocks(batch.column(0)):
                for crc, grams, _ in _features(texts, carried)[0]:
                    per = np.bincount(grams, minlength=len(crc))
                    counts += np.bincount(crc % n_buckets, weights=per, minlength=n_buckets).astype(np.int64)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], ["bucket", "n"])

    return run


def bucket_counts(df: DataFrame, text: str = "text", n_buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): the features of all texts, counted per bucket; a task sends its sums."""
    slim = df.select(F.col(text).cast("string").alias("text"))
    return slim.mapInArrow(_counter(n_buckets), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, text: str = "text", target_text: str = "text",
          n_buckets: int = BUCKETS) -> list[int]:
    """Gain of each bucket: floor(1000 ln((t + 1)(S + buckets) / ((s + 1)(T + buckets))))."""
    def listed(df: DataFrame, column: str) -> list[int]:
        out = [0] * n_buckets
        for r in bucket_counts(df, column, n_buckets).collect():  # at most n_buckets rows
            out[r["bucket"]] = r["n"]
        return out

    s, t = np.array(listed(docs, text), float), np.array(listed(target, target_text), float)
    ratio = (t + 1) * (s.sum() + n_buckets) / ((s + 1) * (t.sum() + n_buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64).tolist()


# ---- weights and ranks ---------------------------------------------------------

WEIGHED = "doc_id long, n_words long, n_features long, weight long"


def weigh(docs: DataFrame, gain: list[int], id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row; ``gain`` holds one number per bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_bucket = np.array(gain, np.int64)
        for batch in batches:
            totals = np.zeros((3, batch.num_rows), np.int64)  # words, features, weight
            for texts, rows, carried in _blocks(batch.column(1)):
                found, n_words = _features(texts, carried)
                totals[0, rows] += n_words
                for crc, grams, owner in found:
                    each = pc.take(pa.array(by_bucket[crc % len(gain)]), pa.array(grams)).to_numpy(zero_copy_only=False)
                    starts = np.flatnonzero(np.diff(owner, prepend=-1))  # places are in the order of the texts
                    if len(starts):
                        at = rows[owner[starts]]
                        totals[1, at] += np.diff(np.append(starts, len(owner)))
                        totals[2, at] += np.add.reduceat(each, starts)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, totals)],
                                             ["doc_id", "n_words", "n_features", "weight"])

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return slim.mapInArrow(run, WEIGHED)


def noise(doc_id: Column, seed: int = NOISE_SEED) -> Column:
    """Gumbel noise of an id, in thousandths: floor(-1000 ln(-ln((h + 0.5) / 2^32)))."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def ranked(scored: DataFrame, eligible: Column, percent: int = PERCENT) -> DataFrame:
    """``scored`` (doc_id, score, ...) with ``rank`` of the drawn rows: the top ``percent`` of the eligible ones.

    Sorted by range over (eligible, score, id), so the rank is the place in the
    partition plus the rows of the partitions before it.
    """
    order = [F.desc("eligible"), F.desc("score"), F.asc_nulls_last("doc_id")]
    placed = written(
        scored.withColumn("eligible", eligible).repartitionByRange(*order).sortWithinPartitions(*order).select(
            "*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")), "resample_sorted")
    # one row per partition
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy("part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"),
                                       F.count_if("eligible").alias("able"))
    parts = written(parts.select(F.col("part").alias("p"), (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first"))
                                 .alias("shift"), F.floor(F.sum("able").over(Window.partitionBy()) * percent / 100)
                                 .cast("long").alias("drawn")), "resample_parts")
    place = F.col("at") + F.col("shift") + 1
    return placed.join(F.broadcast(parts), F.col("part") == F.col("p")).withColumn(
        "rank", F.when(place <= F.col("drawn"), place)).drop("part", "at", "p", "shift", "drawn", "eligible")


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text: str = "text", target_text: str = "text",
             percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = NOISE_SEED,
             n_buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every row; ``rank`` is null outside the sample."""
    weighed = weigh(docs, gains(docs, target, text, target_text, n_buckets), id_col, text)
    scored = written(weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)), "resample_scores")
    return ranked(scored, F.col("n_words") >= min_words, percent)
