"""Operator 7, benchmark decontamination: pigeonhole edit matching.

A test item of n characters may differ from a passage in k = n * ``ERROR_RATE``
edits.  Cut into k + 1 pieces, at least one piece lies in the passage unchanged
(pigeonhole), so exact piece hits (an Aho-Corasick automaton over all pieces)
find every candidate; each is verified with Myers' bit-parallel edit distance
over the window around the hit.

The benchmark is read in blocks of at most ``BLOCK_CHARS`` characters (one
longer item is a block of its own).  One block is a pass over the documents.
Where there are more, the documents are written once with a row number, every
block is a pass of its own that writes its matches alone, and these are merged
by row number, so a task and the driver hold one block at a time.  Documents
are never shuffled by piece: a piece that is frequent in the corpus costs only
where it occurs.

Comparison is on normalised text: lower case, any white space as a blank, one
character for one, so spans are code points of the original text.  Windows of
one item in one document are joined before they are verified.  Every occurrence
in a window is reported: ends within the budget are taken by distance, then by
place, unless their span overlaps one that is taken (:func:`occurrences`).

Defined cases: null and empty texts match nothing; null, empty and
blank items are never found; items shorter than ``MIN_ITEM_CHARS`` must match
exactly and between word borders; repeated items each match; repeated rows keep
a row each; no documents or no items, no matches.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.llm.common import columns, free_name, written
from revlens.session import scratch_path

ERROR_RATE = 0.06
MIN_ITEM_CHARS = 30
BLOCK_CHARS = 1_000_000

MATCH = "array<struct<item_id: long, start: long, end: long, distance: long>>"
_BLANKS = [chr(c) for c in range(0x3001) if chr(c).isspace() and c != 32]


def normalise(text: str) -> str:
    """Lower case and blanks, keeping the number of characters."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c if len(c) == 1 else o for o in text for c in [o.lower()])
    for c in _BLANKS:
        low = low.replace(c, " ")
    return low


def budget(n: int, rate: float = ERROR_RATE) -> int:
    """Edits allowed for an item of ``n`` characters."""
    return int(n * rate) if n >= MIN_ITEM_CHARS else 0


def cut(item: str, k: int) -> list[tuple[int, str]]:
    """(offset, piece) of the k + 1 pieces of an item."""
    n = len(item)
    edges = [j * n // (k + 1) for j in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(edges, edges[1:])]


def myers(item: str, text: str, k: int) -> list[tuple[int, int]]:
    """(distance, end) of every end in ``text`` where ``item`` occurs with at most k edits.

    Myers' algorithm with one bit per character of the item.
    """
    m = len(item)
    masks: dict[str, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    ends = [(m, 0)] if m <= k else []
    get = masks.get
    for j, c in enumerate(text, 1):
        eq = get(c, 0)
        x = eq | minus
        d = (((x & plus) + plus) ^ plus) | x
        up = minus | ~(d | plus)
        down = plus & d
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up = up << 1 & full
        plus = ((down << 1) | ~(x | up)) & full
        minus = up & x
        if score <= k:
            ends.append((score, j))
    return ends


def occurrences(item: str, text: str, k: int) -> list[tuple[int, int, int]]:
    """(start, end, distance) of the occurrences of ``item`` in ``text`` with at most k edits, none overlapping.

    Ends are taken by distance, then by place; an end's span is the shortest at its distance.  A span
    that overlaps one that is taken is left out.
    """
    taken: list[tuple[int, int, int]] = []
    least = max(1, len(item) - k)  # no span is shorter
    for distance, end in sorted(myers(item, text, k)):
        at = bisect_left(taken, (end,))
        # the neighbours by start: the span before must end, and the one after must start, outside
        before = taken[at - 1][1] if at else 0
        if end - least < before:
            continue
        back = text[max(0, end - len(item) - k):end][::-1]
        start = end - (shortest_prefix(item[::-1], back, distance) if distance else len(item))
        if start >= before:
            taken.insert(at, (start, end, distance))
    return taken


class Matcher:
    """The items of one block and the automaton over their pieces."""

    def __init__(self, items: list[tuple[int, str]], rate: float = ERROR_RATE) -> None:
        self.items = [(i, t, budget(len(t), rate)) for i, t in ((i, normalise(t)) for i, t in items) if t.strip()]
        found: dict[str, list[tuple[int, int]]] = {}
        for at, (_, text, k) in enumerate(self.items):
            for offset, piece in cut(text, k):
                found.setdefault(piece, []).append((at, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, uses in found.items():
            self.automaton.add_word(piece, (len(piece), uses))
        if found:
            self.automaton.make_automaton()
        self.empty = not found

    def find(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """(item_id, start, end, distance) of the items found, best occurrence per window."""
        if self.empty or not text:
            return []
        text = normalise(text)
        windows: dict[int, list[tuple[int, int]]] = {}
        for last, (length, uses) in self.automaton.iter(text):
            for at, offset in uses:
                _, item, k = self.items[at]
                lo = last + 1 - length - offset - k
                hi = lo + len(item) + 2 * k
                held = windows.setdefault(at, [])
                if held and held[-1][0] <= lo <= held[-1][1]:
                    held[-1] = (held[-1][0], max(hi, held[-1][1]))
                else:
                    held.append((lo, hi))
        out = []
        for at, held in windows.items():
            item_id, item, k = self.items[at]
            for lo, hi in joined(held):
                lo = max(0, lo)
                if not k:
                    out += [(item_id, at, at + len(item), 0) for at in whole_words(item, text, lo, hi)]
                else:
                    out += [(item_id, lo + a, lo + b, d) for a, b, d in occurrences(item, text[lo:hi], k)]
        return sorted(out, key=lambda x: (x[1], x[0] is None, x[0]))


def joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans by start, those that touch or overlap made one."""
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def whole_words(item: str, text: str, lo: int, hi: int) -> Iterator[int]:
    """Starts of exact occurrences between word borders."""
    at = text.find(item, lo, hi)
    while at >= 0:
        end = at + len(item)
        if not (at and text[at - 1].isalnum()) and not text[end:end + 1].isalnum():
            yield at
        at = text.find(item, at + 1, hi)


def shortest_prefix(item: str, text: str, distance: int) -> int:
    """Length of the shortest prefix of ``text`` at ``distance`` edits from ``item`` (plain rows, short texts)."""
    row = list(range(len(item) + 1))
    for j, c in enumerate(text, 1):
        if row[-1] == distance:
            return j - 1
        last, row[0] = row[0], j
        for i, p in enumerate(item, 1):
            last, row[i] = row[i], min(row[i] + 1, row[i - 1] + 1, last + (p != c))
    return len(text)


def blocks(benchmark: DataFrame, id_col: str = "item_id", text: str = "text",
           block_chars: int = BLOCK_CHARS) -> Iterator[list[tuple[int, str]]]:
    """The items, a bounded block at a time."""
    held, size = [], 0
    rows = benchmark.select(F.col(id_col).cast("long"), text).filter(F.col(text).isNotNull())
    for item_id, body in rows.toLocalIterator():
        if held and size + len(body) > block_chars:
            yield held
            held, size = [], 0
        held.append((item_id, body))
        size += len(body)
    if held:
        yield held


def find_items(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
               item_text: str = "text", rate: float = ERROR_RATE, block_chars: int = BLOCK_CHARS,
               into: str = "matches") -> DataFrame:
    """``docs`` plus ``into``: the items found in each text, by start."""
    found = blocks(benchmark, item_id, item_text, block_chars)
    first, second = next(found, None), next(found, None)
    if second is None:
        matches = _matches(docs, first, rate, text) if first else F.from_json(F.lit("[]"), MATCH)
        return docs.select(*columns(docs), F.array_sort(matches, _by_start).alias(into))
    row = free_name(docs, "_row")
    numbered = written(docs.withColumn(row, F.monotonically_increasing_id()), "decontamination", "documents")
    path = scratch_path(docs.sparkSession, "llm", "decontamination", "matches")
    while first:
        hits = numbered.select(row, _matches(numbered, first, rate, text).alias("m")).filter(F.size("m") > 0)
        hits.write.mode("append").parquet(path)
        first, second = second, next(found, None)
    merged = docs.sparkSession.read.schema(f"{row} long, m {MATCH}").parquet(path).groupBy(row).agg(
        F.flatten(F.collect_list("m")).alias("_merged"))  # the matches of one text
    merged = merged.withColumnsRenamed({row: "_of", "_merged": into + "_"})
    matches = F.coalesce(merged[into + "_"], F.from_json(F.lit("[]"), MATCH))
    out = numbered.join(merged, numbered[row] == merged["_of"], "left")
    return out.select(*[numbered["`" + c.replace("`", "``") + "`"] for c in docs.columns],
                      F.array_sort(matches, _by_start).alias(into))


def _matches(docs: DataFrame, items: list[tuple[int, str]], rate: float, text: str):
    """The items of one block found in each text, as a column."""
    # at most block_chars characters, or one item
    shared = docs.sparkSession.sparkContext.broadcast(items)
    return F.pandas_udf(_finder(shared, rate), MATCH)(F.col(text))


def _finder(shared, rate: float):
    def find(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = Matcher(shared.value, rate)
        for part in texts:
            yield pd.Series([[dict(zip(("item_id", "start", "end", "distance"), m)) for m in matcher.find(t)]
                             for t in part], dtype=object)

    return find


def _by_start(a, b):
    def order(x, y):
        return F.when(x < y, -1).when(x > y, 1).otherwise(0)

    by = order(a["start"], b["start"])
    return F.when(by != 0, by).otherwise(order(a["item_id"], b["item_id"]))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **args) -> DataFrame:
    """``docs`` without those that hold a benchmark item."""
    hits = free_name(docs, "_hits")
    found = find_items(docs, benchmark, into=hits, **args)
    return found.filter(F.size(hits) == 0).select(*columns(docs))
