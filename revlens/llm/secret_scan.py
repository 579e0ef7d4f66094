"""Operator 4, secret scans: base patterns plus a randomness test battery.

Base spans come from three patterns (``BASE``).  The method adds tokens that no
pattern names but that look drawn at random:

1. Candidates are runs of at least ``MIN_TOKEN`` encoding characters; their
   encoding (digits, hex, letters, base32, base36, letters of both cases, base62,
   base64) is the smallest that fits.
2. Three tests per encoding: chi-squared uniformity over the alphabet, runs
   above and below its middle, serial correlation of neighbours.  Their
   p-values are combined by Fisher's method; a token stays if it is consistent
   with random symbols (p >= ``MIN_RANDOM_P``).
3. Length-aware false-discovery control: the discovery p-value of a token is
   the chance that ordinary text of that length, whose symbols coincide with
   its encoding's rate of ordinary tokens, would look as uniform.  Short tokens
   can hardly reach a small one.  Benjamini-Hochberg holds the share of false discoveries
   to ``FALSE_DISCOVERIES`` within each band of encoding and length, counted
   over all candidates of the corpus in bins of the p-value.

Only DataFrame functions are used.  Texts are read once, into a narrow table of
spans; no text is shuffled.  The counts per (band, bin) are at most a few
thousand rows, whatever the corpus.

Spans are code points, end exclusive.  Patterns are matched leftmost and without
overlap per kind; a random span never overlaps a base span.

Defined cases: null text is an empty text; no match: counts 0 and the digest of
the empty string; repeated rows keep a row each; no documents, no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlens.llm.common import written

# The base patterns as (kind, pattern, group whose length counts, least length, words to look for first).
# The least length of access and hex is part of the pattern: a shorter run cannot hold a longer match.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
BASE = (
    ("assign", ASSIGN, 2, 12),
    ("access", r"AKIA[A-Z0-9]{14,}", 0, 18),
    ("hex", r"[0-9a-f]{16,}", 0, 16),
)
MIN_TOKEN = 20
TOKEN = r"[A-Za-z0-9+/_-]{%d,}={0,2}" % MIN_TOKEN

# How often two symbols of an ordinary token agree.
TEXT_COINCIDENCE = 0.065  # two letters of English text agree with about this chance; 1/26 if random
# Text written as hex, the first 2,000 characters of sf0.1's documents: 0.106 (fr) to 0.137 (en), the least taken; 1/16 if random.
HEX_COINCIDENCE = 0.106
DIGIT_COINCIDENCE = 0.148  # times written as YYYYMMDDhhmmss, years 1990 to 2025; 1/10 if random

# Encodings, smallest alphabet first, as (name, pattern of tokens that fit, alphabet, rate of ordinary tokens).
# Every run of 16 digits or lower-case hex is a base span, so as candidates only upper-case hex tokens get this far.
# Letters are compared in lower case if the token has one case or only a capital first letter.
ENCODINGS = (
    ("digits", r"^[0-9]+$", "0123456789", DIGIT_COINCIDENCE),
    ("hex", r"^([0-9a-f]+|[0-9A-F]+)$", "0123456789abcdef", HEX_COINCIDENCE),
    ("letters", r"^([A-Z]?[a-z]+|[A-Z]+)$", "abcdefghijklmnopqrstuvwxyz", TEXT_COINCIDENCE),
    ("base32", r"^([a-z2-7]+|[A-Z2-7]+)$", "abcdefghijklmnopqrstuvwxyz234567", TEXT_COINCIDENCE),
    ("base36", r"^([a-z0-9]+|[A-Z0-9]+)$", "abcdefghijklmnopqrstuvwxyz0123456789", TEXT_COINCIDENCE),
    ("base52", r"^[A-Za-z]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", TEXT_COINCIDENCE),
    ("base62", r"^[A-Za-z0-9]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", TEXT_COINCIDENCE),
    ("base64", r"", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", TEXT_COINCIDENCE),
)
CASED = ("base52", "base62", "base64")  # the others are compared in lower case
MIN_RANDOM_P = 0.01
FALSE_DISCOVERIES = 0.05
BIN_WIDTH = 0.1  # of -ln p
MAX_BIN = 400

_SPANS = "array<struct<start: bigint, end: bigint>>"


def find(text: Column, pattern: str, group: int, least: int) -> Column:
    """Spans of the matches of ``pattern`` whose ``group`` has at least ``least`` characters.

    The text between matches and the matches themselves alternate, so their
    lengths give the positions.
    """
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    part = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    gaps = F.split(text, pattern, -1)
    rows = F.arrays_zip(gaps.alias("gap"), whole.alias("m"), part.alias("g"))

    def add(a: Column, x: Column) -> Column:
        start = a["pos"] + F.length(x["0"])
        end = start + F.coalesce(F.length(x["1"]), F.lit(0))
        keep = F.coalesce(F.length(x["2"]) >= least, F.lit(False))
        new = F.array(F.struct(start.cast("bigint").alias("start"), end.cast("bigint").alias("end")))
        return F.struct(end.cast("bigint").alias("pos"),
                        F.when(keep, F.concat(a["out"], new)).otherwise(a["out"]).alias("out"))

    none = F.struct(F.lit(0).cast("bigint").alias("pos"), F.array().cast(_SPANS).alias("out"))
    plain = F.transform(rows, lambda x: F.struct(x["gap"].alias("0"), x["m"].alias("1"), x["g"].alias("2")))
    return F.aggregate(plain, none, add, lambda a: a["out"])


def _maybe(condition: Column, spans: Column) -> Column:
    return F.when(condition, spans).otherwise(F.array().cast(_SPANS))


def spans(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, id, assign, access, hex, tokens): the spans of each document, texts left behind."""
    body = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    body = body.withColumn("row", F.monotonically_increasing_id())
    t = F.col("text")
    low = F.lower(t)
    worth = {
        "assign": (t.contains(":") | t.contains("=")) & _any(low.contains(w) for w in ASSIGN_WORDS),
        "access": t.contains("AKIA"),
        "hex": t.rlike("[0-9a-f]{16}"),
    }
    found = [_maybe(worth[kind], find(t, pattern, group, least)).alias(kind) for kind, pattern, group, least in BASE]
    tokens = _maybe(t.rlike("[A-Za-z0-9+/_-]{%d}" % MIN_TOKEN), find(t, TOKEN, 0, MIN_TOKEN))
    with_text = F.transform(tokens, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"),
        F.substring(t, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")).alias("token")))
    return body.select("row", "doc_id", *found, with_text.alias("tokens"))


def _any(conditions) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out


# ---- the battery -------------------------------------------------------------


def upper_tail(z: Column) -> Column:
    """P(Z > z) of a standard normal, by a logistic approximation (error under 2e-4), kept over 0."""
    x = F.least(F.greatest(z, F.lit(-12.0)), F.lit(12.0))
    return F.lit(1.0) / (1 + F.exp(1.5976 * x + 0.07056 * x * x * x))


def battery(tokens: DataFrame) -> DataFrame:
    """Rows with ``token`` plus encoding, n, random_p (consistent with random) and text_p (text looks like it)."""
    bare = F.regexp_replace("token", "=+$", "")
    rows = tokens.withColumn("bare", F.translate(bare, "-_", "+/"))
    kind = alphabet = rate = None
    for name, pattern, letters, ordinary in ENCODINGS:
        fits = F.col("bare").rlike(pattern)
        kind = F.when(fits, name) if kind is None else kind.when(fits, name)
        alphabet = F.when(fits, letters) if alphabet is None else alphabet.when(fits, letters)
        rate = F.when(fits, ordinary) if rate is None else rate.when(fits, ordinary)
    rows = rows.withColumn("encoding", kind).withColumn("alphabet", alphabet).withColumn("rate", rate)
    rows = rows.withColumn("word", F.when(F.col("encoding").isin(*CASED), F.col("bare")).otherwise(F.lower("bare")))
    rows = rows.withColumn("n", F.length("word").cast("double")).withColumn("k", F.length("alphabet").cast("double"))
    rows = rows.withColumn("x", F.transform(F.split("word", ""), lambda c: F.instr(F.col("alphabet"), c).cast("double")))
    zero = F.lit(0.0)

    # chi-squared from the counts of each symbol; Wilson-Hilferty makes it normal
    squares = F.aggregate(
        F.transform(F.sequence(F.lit(1), F.length("alphabet")),
                    lambda i: F.size(F.filter("x", lambda v: v == i)).cast("double")),
        zero, lambda a, c: a + c * c)
    rows = rows.withColumn("chi2", F.col("k") / F.col("n") * squares - F.col("n"))
    df = F.col("k") - 1
    cube = F.pow(F.greatest(F.col("chi2"), zero) / df, F.lit(1 / 3))
    p_chi = upper_tail((cube - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df)))

    # runs above and below the middle of the alphabet
    high = F.transform("x", lambda v: (v * 2 > F.col("k")).cast("double"))
    rows = rows.withColumn("high", high)
    pairs = lambda c: F.arrays_zip(F.slice(c, 1, (F.col("n") - 1).cast("int")).alias("a"),
                                   F.slice(c, 2, (F.col("n") - 1).cast("int")).alias("b"))
    rows = rows.withColumn("n1", F.aggregate("high", zero, lambda a, v: a + v))
    rows = rows.withColumn("neighbours", pairs("high")).withColumn("steps", pairs("x"))
    runs = F.aggregate("neighbours", F.lit(1.0), lambda a, p: a + F.when(p["a"] != p["b"], 1.0).otherwise(0.0))
    both = 2 * F.col("n1") * (F.col("n") - F.col("n1"))
    spread = both * (both - F.col("n")) / (F.col("n") * F.col("n") * (F.col("n") - 1))
    z_runs = F.abs(runs - both / F.col("n") - 1) / F.sqrt(spread)
    p_runs = F.when(spread > 0, F.least(2 * upper_tail(z_runs), F.lit(1.0))).otherwise(1e-12)

    # lag-one correlation of the symbols' places
    rows = rows.withColumn("mean", F.aggregate("x", zero, lambda a, v: a + v) / F.col("n"))
    var = F.aggregate("x", zero, lambda a, v: a + (v - F.col("mean")) * (v - F.col("mean")))
    cov = F.aggregate("steps", zero, lambda a, p: a + (p["a"] - F.col("mean")) * (p["b"] - F.col("mean")))
    z_serial = F.abs(cov / var + 1 / F.col("n")) * F.sqrt("n")
    p_serial = F.when(var > 0, F.least(2 * upper_tail(z_serial), F.lit(1.0))).otherwise(1e-12)

    s = -(F.ln(p_chi) + F.ln(p_runs) + F.ln(p_serial))
    rows = rows.withColumn("s", s).withColumn("random_p", F.exp(-F.col("s")) * (1 + F.col("s") + F.col("s") * F.col("s") / 2))

    # the same statistic for ordinary tokens: non-central, as symbols coincide more often than 1 in k
    extra = F.greatest((F.col("n") - 1) * (F.col("k") * F.col("rate") - 1), zero)
    z_text = (F.col("chi2") - (F.col("k") - 1 + extra)) / F.sqrt(2 * (F.col("k") - 1) + 4 * extra)
    rows = rows.withColumn("text_p", upper_tail(-z_text))
    return rows.drop("bare", "alphabet", "rate", "word", "k", "x", "chi2", "high", "n1", "neighbours", "steps", "mean", "s")


def thresholds(scored: DataFrame, level: float = FALSE_DISCOVERIES) -> DataFrame:
    """(encoding, band, least_bin): Benjamini-Hochberg per band of encoding and length, over bins of -ln p."""
    counts = scored.groupBy("encoding", "band", "bin").agg(F.count(F.lit(1)).alias("c"))
    best_first = Window.partitionBy("encoding", "band").orderBy(F.desc("bin"))
    total = F.sum("c").over(Window.partitionBy("encoding", "band"))
    # at most MAX_BIN rows a band
    ranked = counts.withColumn("m", total).withColumn(
        "found", F.sum("c").over(best_first.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    worst_p = F.exp(-F.col("bin") * BIN_WIDTH)
    return ranked.filter(worst_p * F.col("m") <= F.lit(level) * F.col("found")).groupBy("encoding", "band").agg(
        F.min("bin").alias("least_bin"))


def random_spans(found: DataFrame, level: float = FALSE_DISCOVERIES) -> DataFrame:
    """(row, random array<struct<start, end>>): the accepted tokens of the table of :func:`spans`."""
    base = F.concat(*[F.col(kind) for kind, *_ in BASE])
    free = F.filter("tokens", lambda t: ~F.exists(base, lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
    tokens = found.select("row", F.explode(free).alias("t")).select("row", "t.*")
    scored = battery(tokens).withColumn("band", F.floor(F.log2("n")).cast("int")).withColumn(
        "bin", F.least(F.floor(-F.ln("text_p") / BIN_WIDTH), F.lit(MAX_BIN)).cast("int"))
    scored = written(scored.select("row", "start", "end", "encoding", "band", "bin", "random_p"), "random_tokens")
    limits = thresholds(scored, level).select(F.col("encoding").alias("e"), F.col("band").alias("b"), "least_bin")
    # one row per encoding and power of two of the length
    ok = scored.join(F.broadcast(limits), (F.col("encoding") == F.col("e")) & (F.col("band") == F.col("b")))
    ok = ok.filter((F.col("bin") >= F.col("least_bin")) & (F.col("random_p") >= MIN_RANDOM_P))
    return ok.groupBy("row").agg(F.collect_list(F.struct("start", "end")).alias("random"))


def scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, assign, access, hex, random): spans per kind, one row per document."""
    found = written(spans(docs, id_col, text), "spans")
    extra = written(random_spans(found), "random_spans").withColumnRenamed("row", "r")
    joined = found.join(extra, F.col("row") == F.col("r"), "left")
    return joined.select(F.col("doc_id").alias(id_col), *[kind for kind, *_ in BASE],
                         F.coalesce("random", F.array().cast(_SPANS)).alias("random"))


def listed(kinds: list[str]) -> Column:
    """kind:start:end of all spans of the kinds, by start, then kind in the order given."""
    def tag(kind: str, i: int) -> Column:
        return F.transform(kind, lambda s: F.struct(s["start"].alias("start"), F.lit(i).alias("i"), s["end"].alias("end")))

    tagged = [tag(kind, i) for i, kind in enumerate(kinds)]
    names = F.array(*[F.lit(k) for k in kinds])
    return F.array_join(F.transform(F.array_sort(F.concat(*tagged)), lambda s: F.concat_ws(
        ":", F.get(names, s["i"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
