"""Token-set similarity of two titles, 0..100.

Definition (fixed, see README):

1. normalise: drop characters U+0080..U+00FF, turn every character that is
   not a letter, digit or underscore into a space, lower-case, trim;
   either side empty -> 0;
2. token sets A, B; ``t0`` = sorted(A & B) joined by spaces,
   ``t1`` = t0 + " " + sorted(A - B), ``t2`` = t0 + " " + sorted(B - A), trimmed;
3. ``ratio(x, y)`` = 200 * LCS(x, y) / (|x| + |y|) rounded half to even,
   0 when either side is empty;
4. score = max(ratio(t0, t1), ratio(t0, t2), ratio(t1, t2)).

Steps 1-2 are native expressions (regex, array set operations, sort), one
projection each.  Steps 3-4 are a small Arrow-batched helper: ``t0`` is a
prefix of ``t1`` and ``t2``, so the first two ratios need no dynamic
programme (LCS = |t0|); the third uses a bit-parallel LCS (one big-integer
update per character), and only on pairs that can still pass the threshold:
indel distance >= Levenshtein distance, so ``2 * LCS <= |t1| + |t2| -
lev(t1, t2)`` is an exact bound, computed with the built-in ``levenshtein``.

The helper is flagged non-deterministic only to keep the optimizer from
pushing the score filter below the projections (or below an aggregate),
which would evaluate it more than once per row; its result is a pure
function of its inputs.
"""

from __future__ import annotations

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The scoring helper runs in executor Python workers, which need not have this
# package installed: ship this module's functions with the UDF, by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Characters removed before matching, the non-word pattern, and
# the default threshold a similar title must exceed.
DROPPED_CHARS = "[\\x{80}-\\x{FF}]"
NON_WORD = "[^\\p{L}\\p{N}_]"
SIMILARITY_THRESHOLD = 70


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalise(text: Column | str) -> Column:
    t = F.regexp_replace(_col(text), DROPPED_CHARS, "")
    t = F.regexp_replace(t, NON_WORD, " ")
    return F.trim(F.lower(t))


def tokens(text: Column | str) -> Column:
    """Distinct tokens of a normalised string (empty array for an empty string)."""
    n = _col(text)
    return F.when(n == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.split(n, " +")))


def _join_sorted(arr: Column) -> Column:
    return F.array_join(F.array_sort(arr), " ")


def lcs_bits(a: str | None, b: str | None) -> int:
    """LCS length by the bit-parallel method: one big-integer update per
    character of ``a`` (bit j of the state tracks position j of ``b``)."""
    if not a or not b:
        return 0
    masks: dict[str, int] = {}
    for j, ch in enumerate(b):
        masks[ch] = masks.get(ch, 0) | (1 << j)
    full = (1 << len(b)) - 1
    v = full
    for ch in a:
        u = v & masks.get(ch, 0)
        v = ((v + u) | (v - u)) & full
    return len(b) - v.bit_count()


def half_even_percent(twice_lcs: int, total: int) -> int:
    """round_half_even(100 * twice_lcs / total) in integers; 0 when total is 0."""
    if total <= 0:
        return 0
    q, r = divmod(100 * twice_lcs, total)
    return q + (1 if 2 * r > total or (2 * r == total and q % 2 == 1) else 0)


def score_parts(t0: str, t1: str, t2: str, run_lcs: bool) -> int:
    """Steps 3-4 of the definition from the token-set strings."""
    r01 = half_even_percent(2 * len(t0), len(t0) + len(t1)) if t0 and t1 else 0
    r02 = half_even_percent(2 * len(t0), len(t0) + len(t2)) if t0 and t2 else 0
    r12 = half_even_percent(2 * lcs_bits(t1, t2), len(t1) + len(t2)) if run_lcs and t1 and t2 else 0
    return max(r01, r02, r12)


_SCORE_UDF = None


def _score_udf():
    global _SCORE_UDF
    if _SCORE_UDF is None:

        @F.pandas_udf("int")
        def token_set_batch(t0: pd.Series, t1: pd.Series, t2: pd.Series, run: pd.Series,
                            empty: pd.Series) -> pd.Series:
            out = [0 if e else score_parts(a, b, c, bool(r)) for a, b, c, r, e in zip(t0, t1, t2, run, empty)]
            return pd.Series(out, dtype="int32")

        _SCORE_UDF = token_set_batch.asNondeterministic()
    return _SCORE_UDF


def with_token_set_score(df: DataFrame, x: Column | str, y: Column | str, out: str = "score",
                         threshold: int | None = None) -> DataFrame:
    """Add ``out`` = token-set score 0..100 of ``x`` against ``y`` (null title -> 0).

    With ``threshold`` the LCS of (t1, t2) is skipped for pairs whose exact
    upper bound cannot exceed it; the score is then exact whenever it is
    above the threshold, and some value <= threshold otherwise.
    """
    keep = df.columns
    s = df.select("*", _col(x).alias("_fx"), _col(y).alias("_fy"))
    s = s.select("*", normalise("_fx").alias("_nx"), normalise("_fy").alias("_ny"))
    s = s.select("*", tokens("_nx").alias("_ta"), tokens("_ny").alias("_tb"))
    a, b = F.col("_ta"), F.col("_tb")
    s = s.select(
        "*",
        _join_sorted(F.array_intersect(a, b)).alias("_t0"),
        _join_sorted(F.array_except(a, b)).alias("_da"),
        _join_sorted(F.array_except(b, a)).alias("_db"),
    )
    t0 = F.col("_t0")
    s = s.select(
        "*",
        F.trim(F.concat(t0, F.lit(" "), F.col("_da"))).alias("_t1"),
        F.trim(F.concat(t0, F.lit(" "), F.col("_db"))).alias("_t2"),
    )
    t1, t2 = F.col("_t1"), F.col("_t2")
    total = F.length(t1) + F.length(t2)
    if threshold is None:
        run = F.lit(True)
    else:
        # a score above the threshold needs 100 * 2*LCS / total >= threshold + 0.5,
        # and 2*LCS <= total - levenshtein(t1, t2)
        run = (total - F.levenshtein(t1, t2)) * F.lit(200) >= F.lit(2 * threshold + 1) * total
    empty = F.col("_fx").isNull() | F.col("_fy").isNull() | (F.size(a) == 0) | (F.size(b) == 0)
    score = _score_udf()(F.coalesce(t0, F.lit("")), F.coalesce(t1, F.lit("")), F.coalesce(t2, F.lit("")),
                         F.coalesce(run, F.lit(False)), F.coalesce(empty, F.lit(True)))
    return s.select(*keep, score.cast("bigint").alias(out))


def similar_to(df: DataFrame, x: Column | str, y: Column | str, threshold: int = SIMILARITY_THRESHOLD,
               out: str = "score") -> DataFrame:
    """X1 filter: rows whose score is strictly above ``threshold`` (with the score)."""
    return with_token_set_score(df, x, y, out, threshold).filter(F.col(out) > threshold)
