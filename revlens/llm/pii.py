"""Operator 13, personal data: bootstrapped contextual extraction.

Four patterns find e-mail addresses, IP addresses, card and phone numbers that
say what they are by their form.  These are the seeds.  What stands before them,
the two words to their left, are lexical patterns; other tokens that look like
identifiers but fit no form ("bob77@localhost" after "reach me:") are the
instances that the patterns may reveal:

* the graph has an edge for each distinct (pattern, instance);
* a pattern's confidence in a kind is the share of its instances that are known
  members of the kind (seeds, then also discovered ones), ``DOUBT`` more counted
  against it; patterns of fewer than ``MIN_SUPPORT`` members or a confidence
  under ``PATTERN_CONFIDENCE`` count as 0;
* an instance's score is the mean confidence of all patterns it stands in,
  weighted by how much is known of each, n / (n + ``EVIDENCE``) for n instances,
  so a number that also stands where ordinary numbers do scores low; from
  ``INSTANCE_CONFIDENCE`` on it is a discovered identifier, and in the next round
  a member that supports further patterns;
* after ``ROUNDS`` rounds every place of a discovered identifier is a span of
  kind ``found_email``, ``found_ip``, ``found_card`` or ``found_phone``.

Scale.  The text is read once; what is kept of a document are its seeds and
candidate tokens with their patterns (about one word in a hundred).  Copies add
no edge, as edges are made distinct by a partial aggregate first.  A round
joins the edges with the instances that count and with the patterns that are
confident, both unique per key and written, so a hot pattern or token is a hot
key of one side only, which AQE splits; sums are partial aggregates.  Nothing
passes the driver.

Defined cases: null text has no spans; matches of one kind do not overlap, those
of different kinds may; a match that fails its check is dropped (but may be a
candidate); candidates never overlap a seed; a token between kinds takes the
higher score, on a tie the kind listed first; repeated rows are documents of
their own with equal spans; an empty table gives no rows; a context is at most
``CONTEXT_CHARS`` long and ends at a line's start; other columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlens.llm.common import written

KINDS = ("email", "ip", "card", "phone")
FOUND = tuple(f"found_{k}" for k in KINDS)

ROUNDS = 3
DOUBT = 1.0
MIN_SUPPORT = 3
EVIDENCE = 5.0
PATTERN_CONFIDENCE = 0.6
INSTANCE_CONFIDENCE = 0.5
PLACES = 9  # scores are compared to these places, as their sums have no order
CONTEXT_WORDS = 2
CONTEXT_CHARS = 120
TOKEN_CHARS = (5, 64)
TOKEN_DIGITS = 3

# The forms of the four kinds.  Repeats are possessive where giving back cannot help.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
CARD_DIGITS, PHONE_DIGITS = (12, 19), (9, 15)

# number groups in a row, or a token from its first digit or @ on
_CANDIDATE = re.compile(r"[0-9][0-9().-]*+(?:\x20\(?[0-9][0-9().-]*+(?!\S))++|[0-9@]\S*+")
_LABEL = re.compile(r"[^\W\d]+[:=](?=\S)")
MARKS = "\"'.,;:!?()[]{}<>#*%$&|=`~"
_DIGIT = re.compile("[0-9]")


# ---- seeds -----------------------------------------------------------------------


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of local part, @, dotted domain: found by the @, so a long word costs one pass."""
    done = 0
    for m in _DOMAIN.finditer(text):
        before = text[max(done, text.rfind("@", done, m.start()) + 1):m.start()]
        size = len(before) - len(before.rstrip(LOCAL))
        if size:
            yield m.start() - size, m.end()
            done = m.end()


def ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            yield m.span()


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and luhn(digits):
            yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if PHONE_DIGITS[0] <= len(_DIGIT.findall(m.group())) <= PHONE_DIGITS[1]:
            yield m.span()


def seeds(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base spans, by start and then kind as listed."""
    found = [(s, KINDS.index(k), e, k) for k, find in zip(KINDS, (emails, ips, cards, phones)) for s, e in find(text)]
    return [(s, e, k) for s, _, e, k in sorted(found)]


# ---- candidates and contexts -----------------------------------------------------


def candidates(text: str, taken: list[tuple[int, int, str]]) -> Iterator[tuple[int, int]]:
    """Tokens that look like identifiers and overlap no seed."""
    ends, most = [], 0
    for _, e, _ in taken:
        most = max(most, e)
        ends.append(most)  # the largest end so far, as seeds of different kinds may overlap
    starts = [s for s, _, _ in taken]
    done = 0
    for m in _CANDIDATE.finditer(text):
        head = text[done:m.start()]
        start = m.start() - (0 if not head or head[-1].isspace() else len(head.rsplit(None, 1)[-1]))
        end = done = m.end()
        label = _LABEL.match(text, start, end)
        start = label.end() if label else start
        token = text[start:end]
        start += len(token) - len(token.lstrip(MARKS))
        end -= len(token) - len(token.rstrip(MARKS))
        token = text[start:end]
        if not TOKEN_CHARS[0] <= len(token) <= TOKEN_CHARS[1]:
            continue
        if "@" not in token and len(_DIGIT.findall(token)) < TOKEN_DIGITS:
            continue
        k = bisect_left(starts, end)  # seeds that start before the token ends
        if k == 0 or ends[k - 1] <= start:
            yield start, end


def context(text: str, start: int) -> str:
    """The pattern of a place: the last words before it on its line, without case, digits and marks."""
    line = text[max(0, start - CONTEXT_CHARS):start].rpartition("\n")[2]
    words = line.split()[-CONTEXT_WORDS:]
    plain = [_DIGIT.sub("0", w.strip(MARKS.replace(":", "").replace("=", "")).lower()) or w for w in words]
    return " ".join(["^"] * (CONTEXT_WORDS - len(plain)) + plain)


SCAN = "row long, doc_id long, found array<struct<start:long, end:long, kind:string, instance:string, pattern:string>>"


def scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Seeds and candidates (kind null) of every row, with their normalised token and their pattern."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = []
            for body in b["text"]:
                body = body or ""
                base = seeds(body)
                spans = base + [(s, e, None) for s, e in candidates(body, base)]
                found.append([{"start": s, "end": e, "kind": k, "instance": " ".join(body[s:e].lower().split()),
                               "pattern": context(body, s)} for s, e, k in spans])
            yield pd.DataFrame({"row": b["row"], "doc_id": b["doc_id"].astype("Int64"), "found": found})

    slim = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text).cast("string").alias("text"))
    return slim.mapInPandas(run, SCAN)


# ---- bootstrapping -----------------------------------------------------------------


def bootstrap(edges: DataFrame, rounds: int = ROUNDS, min_support: int = MIN_SUPPORT,
              pattern_confidence: float = PATTERN_CONFIDENCE,
              instance_confidence: float = INSTANCE_CONFIDENCE) -> tuple[DataFrame, DataFrame]:
    """(patterns, instances) of the last round.

    ``edges`` are distinct (pattern, instance, kind); ``kind`` is null where the
    instance is no seed.  Patterns are (pattern, kind, confidence), instances
    (instance, kind, score), both only those over their thresholds.
    """
    edges = written(edges, "pii_edges")
    links = written(edges.select("pattern", "instance").distinct(), "pii_links")
    count = F.count(F.lit(1))
    width = written(links.groupBy("pattern").agg(count.alias("n")).select(
        "pattern", "n", (F.col("n") / (F.col("n") + EVIDENCE)).alias("evidence")), "pii_pattern_sizes")
    weight = written(links.join(width, "pattern").groupBy("instance").agg(F.sum("evidence").alias("weight")),
                     "pii_instance_weights")
    known = written(edges.filter(F.col("kind").isNotNull()).select("instance", "kind").distinct(), "pii_seeds")
    seeded = known.select("instance").distinct()
    members, patterns, discovered = known, None, None
    listed_at = F.expr("array_position(array(" + ", ".join(f"'{k}'" for k in KINDS) + "), kind)")
    best = Window.partitionBy("instance").orderBy(F.desc("score"), listed_at)  # at most one row per kind
    for _ in range(rounds):
        support = links.join(members, "instance").groupBy("pattern", "kind").agg(count.alias("support"))
        patterns = written(
            support.filter(F.col("support") >= min_support).join(width, "pattern").select(
                "pattern", "kind", "evidence", (F.col("support") / (F.col("n") + DOUBT)).alias("confidence"))
            .filter(F.col("confidence") >= pattern_confidence), "pii_patterns")
        reached = links.join(patterns, "pattern").groupBy("instance", "kind").agg(
            F.sum(F.col("confidence") * F.col("evidence")).alias("sum"))
        scored = reached.join(seeded, "instance", "left_anti").join(weight, "instance").select(
            "instance", "kind", F.round(F.col("sum") / F.col("weight"), PLACES).alias("score"))
        discovered = written(scored.filter(F.col("score") >= instance_confidence).withColumn(
            "r", F.row_number().over(best)).filter("r = 1").drop("r"), "pii_instances")
        members = known.unionByName(discovered.select("instance", "kind"))
    return patterns.drop("evidence"), discovered


def discover(found: DataFrame, **settings) -> DataFrame:
    """(row, added array<struct<start, end, kind>>): the places of discovered identifiers in a stored :func:`scan`."""
    places = found.select("row", F.explode("found").alias("f")).select("row", "f.*")
    edges = places.groupBy("pattern", "instance", "kind").agg(F.lit(1).alias("one")).drop("one")
    _, instances = bootstrap(edges, **settings)
    new = written(instances.select(F.col("instance").alias("i"), F.concat(F.lit("found_"), "kind").alias("as_kind")),
                  "pii_discovered")
    hits = places.filter(F.col("kind").isNull()).join(new, F.col("instance") == F.col("i"))
    span = F.struct("start", "end", F.col("as_kind").alias("kind"))
    return hits.groupBy("row").agg(F.collect_list(span).alias("added"))  # at most the tokens of one text


def listed(spans: Column) -> Column:
    """``kind:start:end`` of spans, by start and then kind as listed, comma-joined."""
    order = F.array(*[F.lit(k) for k in (*KINDS, *FOUND)])
    keyed = F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.array_position(order, s["kind"]).alias("k"), s["end"].alias("end"),
        s["kind"].alias("kind")))
    return F.array_join(F.transform(F.array_sort(keyed), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """(doc_id, base, spans) of every row: spans are structs (start, end, kind), ``spans`` with the discovered ones."""
    found = written(scan(docs, id_col, text), "pii_scan")
    added = written(discover(found, **settings), "pii_added").withColumnRenamed("row", "row_")
    base = F.transform(F.filter("found", lambda f: f["kind"].isNotNull()),
                       lambda f: F.struct(f["start"].alias("start"), f["end"].alias("end"), f["kind"].alias("kind")))
    joined = found.select("row", "doc_id", base.alias("base")).join(added, F.col("row") == F.col("row_"), "left")
    more = F.coalesce("added", F.array().cast("array<struct<start:bigint,end:bigint,kind:string>>"))
    return joined.select("doc_id", "base", F.concat("base", more).alias("spans"))
