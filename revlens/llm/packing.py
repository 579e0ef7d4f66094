"""Operator 6, packing: cutting-stock column generation.

Documents become token ids (with an end id) and are cut into pieces: whole
sequences of ``SEQUENCE`` ids and one remainder each.  The histogram of piece
lengths, in classes up to ``GRAIN`` ids wide, is the demand of a cutting-stock
problem:

* a linear program over patterns (how many pieces of each class share a
  sequence) is solved by column generation: the simplex duals price the
  classes, a knapsack dynamic program finds the best new pattern;
* the pattern counts are rounded down, and the few pieces left over are packed
  largest first, each sequence filled as well as the rest allows;
* pieces are ranked within their class and dealt to the slots of the patterns;
* patterns that would leave more than 1/``CUT_GAP`` of a sequence empty are not
  used: their pieces are laid end to end, by class and rank, and cut where a
  sequence is full, so all these sequences but the last have no padding.

Scale.  The texts are read once; what is kept per piece is five numbers, and the
ids of remainders, which are read again only to digest the parts of those that
are cut (at most one per sequence).  Only
the histogram (a few hundred classes) goes to the one task that solves the
program, so its size does not depend on the corpus.  Ranks come from counts per
(class, block) with blocks of bounded size, so a class that holds a third of
all pieces is spread over many tasks; places of the pieces laid end to end come
from sums per block in the same way.  The pattern table that is joined to
the pieces has at most about classes x classes rows.

Defined cases: null text is an empty text, which is one piece with the end id
alone; pieces of equal class are ranked by block and then by length and
position; repeated rows are pieces of their own; no documents, no sequences.
"""

from __future__ import annotations

import os
import re
import string
import sys
import zlib
from array import array
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from revlens.llm.common import written

SEQUENCE = 2048
GRAIN = 8
GAP = 0.001
CUT_GAP = 128
END_ID = 1
TOKENIZER = "word_bpe_49k.json"
CACHE_WORDS = 400_000
CACHE_CHARS = 32
BLOCK_CHARS = 1 << 20
RANK_BLOCK = 4096

# Fixed value: the characters the tokenizer takes as white space (str.split also takes \x1c-\x1f).
WORD = re.compile("[^\\t\\n\\x0b\\x0c\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]+")
BREAK = re.compile(r"[\t\n\r ]")
SIMPLE = "\u0130"  # letters below have one lower-case letter and are their own composed form
NOT_SIMPLE = re.compile(f"[^\0-{chr(ord(SIMPLE) - 1)}]")
MARKS = string.punctuation  # neither letters, digits nor white space to the tokenizer
NOT_SPACE = ("\x1c", "\x1d", "\x1e", "\x1f")


def byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 characters stand for themselves, other bytes for 256, 257, ..."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}


class Looked(dict):
    """Values of ``make`` kept by key: up to ``CACHE_WORDS`` new ones, and as many from before they last filled up."""

    def __init__(self, make: Callable[[str], bytes]) -> None:
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, key: str) -> bytes:
        got = self.old.get(key)
        if got is None:
            got = self.make(key)
        if len(key) <= CACHE_CHARS:
            if len(self) >= CACHE_WORDS:
                self.old = dict(self)
                self.clear()
            self[key] = got
        return got


class Encoder:
    """Ids of whole texts, as little-endian 32-bit bytes.

    The tokenizer drops white space and never joins across it, so the ids of a
    text are those of its words in a row; words are encoded once and kept in a
    bounded table.  Latin text is put in lower case first, as the tokenizer does,
    so that a word has one entry.  A word of Latin letters and final ASCII marks
    is two pieces to the tokenizer, the letters in lower case and the marks, so its
    letters are looked up by themselves, as the word they are without the marks.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; threads do not survive a worker's fork
        self.tok = Tokenizer.from_file(path)
        self.model = self.tok.model
        self.letters = byte_letters()
        self.added = [t.content for t in self.tok.get_added_tokens_decoder().values()]  # found before lower-casing
        self.marks = Looked(self._encoded)
        self.known = Looked(self._word)

    @staticmethod
    def _ids(ids: list[int]) -> bytes:
        return array("I", ids).tobytes() if sys.byteorder == "little" else np.asarray(ids, "<u4").tobytes()

    def _encoded(self, word: str) -> bytes:
        return self._ids(self.tok.encode(word, add_special_tokens=False).ids)

    def _word(self, word: str) -> bytes:
        core = word.rstrip(MARKS)
        if not core.isalpha() or not (core.isascii() or max(core) < SIMPLE):
            return self._encoded(word)
        lower = core.lower()
        if lower != word:
            ids = self.known[lower]
            return ids if len(core) == len(word) else ids + self.marks[word[len(core):]]
        shown = word if word.isascii() else "".join(map(self.letters.__getitem__, word.encode()))
        return self._ids([t.id for t in self.model.tokenize(shown)])

    def _lower(self, text: str) -> str:
        """``text`` in lower case where that is all the tokenizer's normalizer does to its words, else ``text``."""
        if not text.isascii() and NOT_SIMPLE.search(text):
            return text
        lower = text.lower()
        return text if any(t in lower for t in self.added) else lower

    def blocks(self, text: str) -> Iterator[bytes]:
        """The ids of ``text``, a block of words at a time."""
        at = 0
        while at < len(text):
            end = at + BLOCK_CHARS
            if end < len(text):  # up to the next white space
                m = BREAK.search(text, end)
                end = m.start() if m else len(text)
            part = self._lower(text[at:end])
            words = WORD.findall(part) if any(c in part for c in NOT_SPACE) else part.split()
            yield b"".join(map(self.known.__getitem__, words))
            at = end


@lru_cache(1)
def encoder(path: str) -> Encoder:
    """One encoder per worker process, kept for its next tasks."""
    return Encoder(path)


PIECES = "row long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, cls long, ids binary"


def pieces(docs: DataFrame, id_col: str = "doc_id", text: str = "text", sequence: int = SEQUENCE,
           grain: int = GRAIN, tokenizer_path: str | None = None) -> DataFrame:
    """One row per piece: start, length, crc32 of its ids, ids of its document, class of its length, ids of a remainder."""
    path = tokenizer_path or public_tokenizers.path(TOKENIZER)
    sizes = class_sizes(sequence, grain)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(path)
        end = np.asarray([END_ID], "<u4").tobytes()
        whole = 4 * sequence
        for b in batches:
            out: list[tuple] = []
            for row, doc_id, body in b.itertuples(index=False):
                doc_id = None if pd.isna(doc_id) else int(doc_id)
                rest, start, found = b"", 0, []
                for ids in enc.blocks(body or ""):
                    rest += ids
                    cut = max(0, (len(rest) - 1) // whole) * whole  # the end id is still to come
                    for at in range(0, cut, whole):
                        found.append((start, sequence, zlib.crc32(rest[at:at + whole]), None))
                        start += sequence
                    rest = rest[cut:]
                rest += end
                for at in range(0, len(rest), whole):
                    part = rest[at:at + whole]
                    found.append((start, len(part) // 4, zlib.crc32(part), part if len(part) < whole else None))
                    start += len(part) // 4
                out += [(row, doc_id, s, n, crc, start, ids) for s, n, crc, ids in found]
            frame = pd.DataFrame(out, columns=["row", "doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"])
            frame.insert(6, "cls", np.searchsorted(sizes, frame["length"].to_numpy(np.int64)))
            yield frame.astype({"doc_id": "Int64"})

    slim = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text).alias("text"))
    return slim.mapInPandas(run, PIECES)


# ---- the linear program ------------------------------------------------------


def class_sizes(sequence: int = SEQUENCE, grain: int = GRAIN) -> np.ndarray:
    """The lengths that close a class: every length while they are small, then steps of 2, 4, ... up to ``grain``.

    A piece counts as its class's size, so a short piece wastes nothing and a
    longer one at most 1/32 of its length.
    """
    sizes = [1]
    while sizes[-1] < sequence:
        step = min(grain, max(1, 1 << max(0, sizes[-1].bit_length() - 6)))
        sizes.append(min(sequence, sizes[-1] + step))
    return np.array(sizes)


def knapsack(value: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Most valuable multiset of classes within the capacity, by dynamic programming: value, counts."""
    best = np.zeros(capacity + 1)
    pick = np.full(capacity + 1, -1)
    fitting = np.searchsorted(sizes, np.arange(capacity + 1), "right")
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        if n := fitting[c]:
            options = best[c - sizes[:n]] + value[:n]  # the last piece is of class 0..n - 1
            k = int(options.argmax())
            if options[k] > best[c] + 1e-15:
                best[c], pick[c] = options[k], k
    counts = np.zeros(len(sizes), np.int64)
    c = capacity
    while c > 0:
        if pick[c] >= 0:
            counts[pick[c]] += 1
            c -= sizes[pick[c]]
        else:
            c -= 1
    return float(best[capacity]), counts


def _greedy_basis(demand: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """A first basis: fill by the largest class left, as often as the scarcest class lasts.

    Each pattern uses up one class for good, so in the order of use the matrix
    is triangular and its solution, the times of use, is not negative.
    """
    m = len(sizes)
    left = demand.astype(float).copy()
    columns, times = [], []
    while len(alive := np.flatnonzero(left > 0)):
        pattern, room = np.zeros(m), capacity
        for c in alive[::-1]:
            k = min(room // sizes[c], max(1, int(left[c])))
            if k:
                pattern[c], room = k, room - k * sizes[c]
        need = pattern > 0
        ratio = np.full(m, np.inf)
        ratio[need] = left[need] / pattern[need]
        gone = int(ratio.argmin())
        time = ratio[gone]
        left -= time * pattern
        left[gone] = 0
        columns.append(pattern)
        times.append(time)
        for c in np.flatnonzero(need & (left < 1e-9) & (np.arange(m) != gone)):
            left[c] = 0  # used up at the same time: a pattern of its own, used zero times
            columns.append(np.where(np.arange(m) == c, capacity // sizes[c], 0).astype(float))
            times.append(0.0)
    return np.array(columns).T, np.array(times)


def _inverse(matrix: np.ndarray) -> np.ndarray:
    """Gauss-Jordan with row pivots; plain array arithmetic, as threaded BLAS may not survive a fork."""
    m = len(matrix)
    work = np.hstack([matrix, np.eye(m)])
    for i in range(m):
        p = i + int(np.abs(work[i:, i]).argmax())
        work[[i, p]] = work[[p, i]]
        work[i] /= work[i, i]
        factor = work[:, i].copy()
        factor[i] = 0
        work -= factor[:, None] * work[i]
    return work[:, m:]


def solve_patterns(demand: np.ndarray, sizes: np.ndarray, capacity: int,
                   gap: float = GAP) -> list[tuple[np.ndarray, float]]:
    """Patterns (pieces per class) and how often the linear program uses each.

    Revised simplex on min sum x, A x = demand; the best-priced new pattern
    comes in until the duals prove the value to be within ``gap`` of the optimum.
    """
    used = np.flatnonzero(demand)
    if not len(used):
        return []
    d, size = demand[used].astype(float), sizes[used]
    m = len(used)
    columns, x = _greedy_basis(demand[used], size, capacity)
    inverse = _inverse(columns)
    for step in range(20 * m + 100):
        if step % 100 == 99:  # keep rounding errors from adding up
            inverse = _inverse(columns)
            x = np.maximum((inverse * d).sum(1), 0)
        value = np.maximum(inverse.sum(0), 0)
        worth, counts = knapsack(value, size, capacity)
        # duals divided by the best price are feasible, so their value bounds the optimum
        bound = max((d * value).sum() / worth, (d * size).sum() / capacity)
        if worth <= 1 + 1e-9 or x.sum() <= bound * (1 + gap):
            break
        column = counts.astype(float)
        direction = (inverse * column).sum(1)
        up = direction > 1e-9
        if not up.any():
            break
        ratio = np.full(m, np.inf)
        ratio[up] = x[up] / direction[up]
        out = int(ratio.argmin())
        theta = ratio[out]
        x = np.maximum(x - theta * direction, 0)
        x[out] = theta
        columns[:, out] = column
        pivot = inverse[out] / direction[out]
        inverse -= direction[:, None] * pivot
        inverse[out] = pivot
    result = []
    for i in range(m):
        pattern = np.zeros(len(sizes), np.int64)
        pattern[used] = np.rint(columns[:, i]).astype(np.int64)
        result.append((pattern, float(x[i])))
    return result


def best_fill(left: np.ndarray, sizes: np.ndarray, room: int) -> dict[int, int]:
    """The pieces that fill ``room`` best, larger ones first (subset sums as bits of an integer)."""
    items = []
    for c in np.flatnonzero((left > 0) & (sizes <= room))[::-1].tolist():
        n, k = min(int(left[c]), room // int(sizes[c])), 1
        while n:  # 1, 2, 4, ... pieces at a time
            items.append((c, min(k, n), min(k, n) * int(sizes[c])))
            n, k = n - min(k, n), 2 * k
    mask = (1 << (room + 1)) - 1
    sums = [1]
    for _, _, size in items:
        sums.append((sums[-1] | sums[-1] << size) & mask)
    at, content = sums[-1].bit_length() - 1, {}
    for (c, n, size), before in zip(reversed(items), reversed(sums[:-1])):
        if not before >> at & 1:
            content[c] = content.get(c, 0) + n
            at -= size
    return content


def plan_sequences(demand: np.ndarray, sizes: np.ndarray, capacity: int) -> list[tuple[dict[int, int], int]]:
    """(pattern {class: pieces}, sequences) that use each piece exactly once.

    Patterns of the linear program are rounded down and never take more pieces
    than there are; then the largest piece left opens a sequence that is filled
    as well as the rest allows.
    """
    left = demand.astype(np.int64).copy()
    plan: list[tuple[dict[int, int], int]] = []
    for pattern, times in sorted(solve_patterns(demand, sizes, capacity), key=lambda p: -p[1]):
        need = pattern > 0
        n = min(int(times + 1e-6), int((left[need] // pattern[need]).min())) if need.any() else 0
        if n:
            left -= n * pattern
            plan.append(({int(c): int(pattern[c]) for c in np.flatnonzero(pattern)}, n))
    while len(rest := np.flatnonzero(left)):
        first = int(rest[-1])
        left[first] -= 1
        content = best_fill(left, sizes, capacity - int(sizes[first]))
        for c, k in content.items():
            left[c] -= k
        content[first] = content.get(first, 0) + 1
        more = min(int(left[c] // k) for c, k in content.items())  # again while the pieces last
        for c, k in content.items():
            left[c] -= more * k
        plan.append((content, 1 + more))
    return plan


SLOTS = "cls long, first long, last long, per long, sequence long"


def slot_table(plan: list[tuple[dict[int, int], int]], sizes: np.ndarray, capacity: int) -> pd.DataFrame:
    """Which ranks of a class go where: (cls, first, last, per, sequence).

    Ranks first..last - 1 of the class fill ``per`` slots of each sequence from
    ``sequence`` on.  Where ``per`` is 0 they are laid end to end from the
    sequence ``sequence`` on, as their pattern leaves too much room.
    """
    used: Counter = Counter()
    loose: Counter = Counter()
    rows, sequence = [], 0
    for pattern, times in plan:
        if (capacity - sum(int(sizes[c]) * k for c, k in pattern.items())) * CUT_GAP > capacity:
            loose.update({c: k * times for c, k in pattern.items()})
            continue
        for c, k in sorted(pattern.items()):
            rows.append((c, used[c], used[c] + k * times, k, sequence))
            used[c] += k * times
        sequence += times
    rows += [(c, used[c], used[c] + k, 0, sequence) for c, k in sorted(loose.items())]
    return pd.DataFrame(rows, columns=["cls", "first", "last", "per", "sequence"]).astype("int64")


# ---- dealing -----------------------------------------------------------------


PLACED = ("row", "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id")


def _ranked(found: DataFrame) -> DataFrame:
    """Pieces with a dense 0-based rank in their class, by blocks of bounded size.

    A class of many pieces is cut by a hash into blocks; a window ranks each
    block, and the running sum of block counts gives its offset.
    """
    n = found.groupBy("cls").agg(F.count(F.lit(1)).alias("n"))
    n = n.select(F.col("cls").alias("c0"), F.ceil(F.col("n") / RANK_BLOCK).cast("int").alias("blocks"))
    # at most one row per class: SEQUENCE / GRAIN rows
    blocked = found.join(F.broadcast(n), F.col("cls") == F.col("c0")).withColumn(
        "block", F.pmod(F.xxhash64("row", "start"), F.col("blocks")).cast("int")).drop("c0", "blocks")
    sizes = blocked.groupBy("cls", "block").agg(F.count(F.lit(1)).alias("size"))
    before = Window.partitionBy("cls").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = written(sizes.select(F.col("cls").alias("c1"), F.col("block").alias("b1"),
                                   F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset")), "rank_offsets")
    inside = Window.partitionBy("cls", "block").orderBy("length", "row", "start")
    ranked = blocked.withColumn("r", F.row_number().over(inside) - 1)
    return ranked.join(offsets, (F.col("cls") == F.col("c1")) & (F.col("block") == F.col("b1"))).withColumn(
        "rank", F.col("offset") + F.col("r")).drop("c1", "b1", "offset", "r")


def _end_to_end(loose: DataFrame, found: DataFrame, sequence: int) -> DataFrame:
    """``loose`` with sequence_id, laid end to end by class, block and length; a piece over a border becomes two.

    Places come from sums per (class, block), which are summed within the class,
    and sums per class, which are at most a few hundred rows.
    """
    sums = written(loose.groupBy("cls", "block").agg(F.sum("length").alias("ids")), "loose_sums")
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    blocks = sums.select("cls", F.col("block").alias("b3"), F.coalesce(
        F.sum("ids").over(before.partitionBy("cls").orderBy("block")), F.lit(0)).alias("block_at"))
    # one row per class
    classes = sums.groupBy("cls").agg(F.sum("ids").alias("ids")).select(F.col("cls").alias("c4"), F.coalesce(
        F.sum("ids").over(before.orderBy("cls")), F.lit(0)).alias("class_at"))
    starts = written(blocks.join(F.broadcast(classes), F.col("cls") == F.col("c4")).select(
        F.col("cls").alias("c3"), "b3", (F.col("block_at") + F.col("class_at")).alias("at")), "loose_starts")
    inside = Window.partitionBy("cls", "block").orderBy("length", "row", "start")
    run = F.sum("length").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("length")
    laid = loose.withColumn("run", run).join(starts, (F.col("cls") == F.col("c3")) & (F.col("block") == F.col("b3")))
    place = F.col("at") + F.col("run")
    laid = written(laid.withColumn("sequence_id", F.col("sequence") + F.floor(place / sequence).cast("long")).withColumn(
        "head", F.least(F.col("length"), sequence - place % sequence)).drop("run", "c3", "b3", "at"), "loose_places")
    cut = written(laid.filter(F.col("head") < F.col("length")), "cut_pieces")
    ids = found.filter(F.col("ids").isNotNull()).select(F.col("row").alias("row_"), F.col("start").alias("start_"), "ids")
    cut = cut.join(ids, (F.col("row") == F.col("row_")) & (F.col("start") == F.col("start_")))

    def part(at, length, sequence_id):
        digest = F.crc32(F.expr("ids").substr((at * 4 + 1).cast("int"), (length * 4).cast("int")))
        return F.struct((F.col("start") + at).alias("start"), length.alias("length"), digest.alias("ids_crc32"),
                        sequence_id.alias("sequence_id"))

    head, zero = F.col("head"), F.lit(0).cast("long")
    both = F.array(part(zero, head, F.col("sequence_id")), part(head, F.col("length") - head, F.col("sequence_id") + 1))
    parts = cut.select("row", "doc_id", "doc_tokens", F.explode(both).alias("p")).select(*[
        f"p.{c}" if c in ("start", "length", "ids_crc32", "sequence_id") else c for c in PLACED])
    return laid.filter(F.col("head") == F.col("length")).select(*PLACED).unionByName(parts)


def pack(docs: DataFrame, id_col: str = "doc_id", text: str = "text", sequence: int = SEQUENCE, grain: int = GRAIN,
         tokenizer_path: str | None = None) -> DataFrame:
    """One row per piece: where it lies in its document and in which sequence at which offset."""
    sizes = class_sizes(sequence, grain)
    found = written(pieces(docs, id_col, text, sequence, grain, tokenizer_path), "pieces")

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        demand = np.zeros(len(sizes), np.int64)
        for b in batches:
            demand[b["cls"].to_numpy()] = b["n"].to_numpy()
        yield slot_table(plan_sequences(demand, sizes, sequence), sizes, sequence)

    # one task, for a row per class
    histogram = found.groupBy("cls").agg(F.count(F.lit(1)).alias("n")).repartition(1)
    table = written(histogram.mapInPandas(solve, SLOTS), "slots").withColumnRenamed("cls", "c2")
    ranked = _ranked(found.drop("ids"))
    # the slot table's size is bounded by the classes, not by the corpus
    dealt = written(ranked.join(F.broadcast(table), (F.col("cls") == F.col("c2")) & (F.col("rank") >= F.col("first")) &
                                (F.col("rank") < F.col("last"))).drop("c2"), "dealt")
    whole = dealt.filter(F.col("per") > 0).withColumn(
        "sequence_id", F.col("sequence") + F.floor((F.col("rank") - F.col("first")) / F.col("per")).cast("long"))
    placed = whole.select(*PLACED).unionByName(_end_to_end(dealt.filter(F.col("per") == 0), found, sequence))
    # a sequence holds at most as many pieces as ids
    inside = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "row", "start")
    total = Window.partitionBy("sequence_id")
    filled = F.sum("length").over(total)
    power = F.expr("sequence_length & (sequence_length - 1)") == 0
    out = placed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
        (F.sum("length").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("length"))
        .alias("offset"),
        filled.alias("sequence_length"),
    )
    return out.withColumn("padding", F.when(power, F.lit(0)).otherwise(sequence - F.col("sequence_length"))
                          .cast("long"))
