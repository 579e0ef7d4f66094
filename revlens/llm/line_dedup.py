"""Operator 3, line dedup: site-relative frequency.

Per host, the pages that contain a line are counted and divided by the host's
pages; lines above the boilerplate ratio are dropped from every page of the
host.  Only DataFrame functions are used.

One rule holds for hosts of every size: a line goes if it stands on at least two
different pages and the lower bound of its share (Wilson's interval at
``CONFIDENCE_Z``) is over the ratio.  So all lines of a host of three pages that
stand on each go, a line on 3 of 20 pages may be chance at a ratio of 0.08 and
stays, and on large hosts the bound is the share itself.

Pages count by content: pages of a host with equal text are one page, in its
lines and in its total, so a large group of copies is no boilerplate.  With
``near`` this holds for near copies as well: pages whose lines, to ``NEAR_SHARE``
of their characters, stand on other pages of the host too, and that agree in the
first of these lines in hash order, are one page.

Plan: one row per (page, distinct line) with a 128-bit line key instead of the
text, counted by (host, key) with map-side partial sums, so a hot host or line
only sends one row per task.  The lines over the ratio are few per host (at
most lines per page / ratio) and are gathered to one array per host, written,
and joined back on host: Spark broadcasts that table while it is small, else it
is a sort-merge join whose hot host AQE can split.

Defined cases: lines are compared without surrounding blanks; blank lines are
kept and never counted; a line repeated within a page counts once for it; null
text stays null, an empty text stays empty, and each is one page of its host; a
null host is a host of its own; repeated rows and exact copies count once and
are all cleaned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.llm.common import columns, free_name, written

BOILERPLATE_RATIO = 0.08
MIN_PAGES = 2  # a line of one page is no repeat
CONFIDENCE_Z = 1.645  # one-sided 95 %
NEAR_SHARE = 0.8


def _key(line: Column) -> Column:
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit("line"), line).alias("b"))


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def share_bound(n: Column, total: Column) -> Column:
    """Lower end of Wilson's interval of the share n / total."""
    z2 = CONFIDENCE_Z * CONFIDENCE_Z
    p, total = n.cast("double") / total, total.cast("double")
    spread = CONFIDENCE_Z * F.sqrt(p * (1 - p) / total + z2 / (4 * total * total))
    return (p + z2 / (2 * total) - spread) / (1 + z2 / total)


def _near_pages(once: DataFrame) -> DataFrame:
    """(host, page, label): pages of one label are near copies; ``once`` is (host, page, lines)."""
    lines = once.select("host", "page", F.inline("lines"))
    seen = lines.groupBy("host", "k").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    seen = written(seen.select(F.col("host").alias("h"), F.col("k").alias("s")), "repeated_lines")
    flagged = lines.join(seen, F.col("host").eqNullSafe(F.col("h")) & (F.col("k") == F.col("s")), "left")
    repeated = F.col("s").isNotNull()
    parts = flagged.groupBy(F.col("host").alias("h"), F.col("page").alias("p")).agg(
        F.sum("chars").alias("chars"), F.sum(F.when(repeated, F.col("chars"))).alias("repeated"),
        F.min(F.when(repeated, F.col("k.a"))).alias("least"))
    near = F.col("repeated") >= NEAR_SHARE * F.col("chars")
    out = once.select("host", "page").join(parts, F.col("host").eqNullSafe(F.col("h")) & (F.col("page") == F.col("p")), "left")
    label = F.when(near, F.xxhash64(F.lit("near"), "least")).otherwise(F.xxhash64("page"))
    return written(out.select("host", "page", label.alias("label")), "near_pages")


def boilerplate_lines(pages: DataFrame, host: str, text: str = "text", ratio: float = BOILERPLATE_RATIO,
                      near: bool = False) -> DataFrame:
    """(host, keys array<struct<a, b>>): the lines of each host above the ratio."""
    trimmed = F.filter(F.transform(_lines(F.col(text)), lambda x: F.trim(x)), lambda x: x != "")
    keyed = F.array_distinct(F.transform(trimmed, lambda x: F.struct(_key(x).alias("k"), F.length(x).alias("chars"))))
    slim = pages.select(F.col(host).alias("host"), _key(F.col(text)).alias("page"), keyed.alias("lines"))
    # line keys instead of texts are shuffled, a copy group sends one row per task
    once = written(slim.groupBy("host", "page").agg(F.first("lines").alias("lines")), "distinct_pages")
    if near:
        label = _near_pages(once)
        found = once.join(label.withColumnsRenamed({"host": "h", "page": "p"}),
                          F.col("host").eqNullSafe(F.col("h")) & (F.col("page") == F.col("p")))
        lines = found.select("host", "label", F.inline("lines")).select("host", "label", "k").distinct()
        owners = label.select("host", "label").distinct()
    else:
        lines, owners = once.select("host", F.inline("lines")), once.select("host")
    counts = lines.groupBy("host", "k").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= MIN_PAGES)
    totals = owners.groupBy(F.col("host").alias("h")).agg(F.count(F.lit(1)).alias("total"))
    counts, totals = written(counts, "line_counts"), written(totals, "host_totals")
    over = counts.join(totals, F.col("host").eqNullSafe(F.col("h")))
    over = over.filter(share_bound(F.col("n"), F.col("total")) > F.lit(ratio))
    return over.groupBy("host").agg(F.collect_list("k").alias("keys"))


def drop_boilerplate(pages: DataFrame, host: str, text: str = "text", ratio: float = BOILERPLATE_RATIO,
                     counts: bool = True, near: bool = False) -> DataFrame:
    """``pages`` with boilerplate lines removed from ``text``; ``counts`` adds n_lines and n_dropped."""
    found = written(boilerplate_lines(pages, host, text, ratio, near), "boilerplate")
    keys, at, lines, kept = (free_name(pages, x) for x in ("_keys", "_host", "_lines", "_kept"))
    found = found.select(F.col("host").alias(at), F.col("keys").alias(keys))
    joined = pages.join(found, pages[host].eqNullSafe(F.col(at)), "left")
    joined = joined.withColumn(lines, _lines(F.col(text)))
    joined = joined.withColumn(
        kept,
        F.when(F.col(keys).isNull(), F.col(lines)).otherwise(
            F.filter(lines, lambda x: (F.trim(x) == "") | ~F.array_contains(F.col(keys), _key(F.trim(x))))
        ),
    )
    out = [F.array_join(kept, "\n").alias(text) if c == text else col for c, col in zip(pages.columns, columns(pages))]
    if counts:
        blank = F.col(text).isNull() | (F.col(text) == "")
        dropped = F.coalesce(F.size(lines) - F.size(kept), F.lit(0))
        out += [F.when(blank, 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
                F.when(F.col(text).isNull(), 0).otherwise(dropped).cast("long").alias("n_dropped")]
    return joined.select(*out)
