"""Product search and similar products.

The search has an index: a posting table of the three-character pieces of every
label.  A pattern's fixed text gives the pieces that a match must hold; only the
entries that hold them are matched against the pattern.  A pattern without such
text scans the catalogue, so both ways return the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.functions.fuzzy import SIMILARITY_THRESHOLD, similar_to
from revlens.functions.text import product_label
from revlens.operators.products import PRODUCT_KEYS, product_stats


def search_products(df: DataFrame, term: str, literal: bool = False) -> DataFrame:
    """P15 over reviews; :func:`search_catalogue` is the same over a stored catalogue."""
    return search_catalogue(df.select(*PRODUCT_KEYS).distinct(), term, literal)


def search_catalogue(catalogue: DataFrame, term: str, literal: bool = False) -> DataFrame:
    """Catalogue entries whose label ``title (product_id)`` matches ``term``.

    Case-insensitive regular expression (Java dialect, Unicode case); an empty term matches
    every entry with a title; a null title never matches.  ``literal=True``
    searches the plain text instead.
    """
    label = product_label()
    cat = catalogue.select(*PRODUCT_KEYS, label.alias("label"))
    if literal:
        cond = F.contains(F.lower(F.col("label")), F.lower(F.lit(term)))
    else:
        cond = F.col("label").rlike("(?iu)" + term)
    return cat.filter(F.col("label").isNotNull() & cond)


# Length of the pieces, and the characters beyond A-Z that Unicode case folding takes to an ASCII letter.
GRAM = 3
FOLDED, FOLDS_TO = "\u0130\u0131\u017f\u212a", "iisk"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def label_grams(catalogue: DataFrame) -> DataFrame:
    """(gram, product_id, title): every distinct ASCII piece of each entry's folded label."""
    folded = F.translate("label", _UPPER + FOLDED, _LOWER + FOLDS_TO)
    starts = F.sequence(F.lit(1), F.length("folded") - GRAM + 1)
    pieces = F.transform(starts, lambda i: F.substring(F.col("folded"), i, F.lit(GRAM)))
    entries = catalogue.select(*PRODUCT_KEYS, product_label().alias("label")).filter(F.length("label") >= GRAM)
    return (
        entries.select(*PRODUCT_KEYS, folded.alias("folded"))
        .select(F.explode(F.array_distinct(pieces)).alias("gram"), *PRODUCT_KEYS)
        .filter(F.col("gram").rlike(r"\A[\x00-\x7F]+\z"))
    )


def required_grams(term: str, literal: bool = False) -> list[set[str]] | None:
    """For each alternative of ``term`` the pieces that every match holds; None if one has none.

    Groups, classes, escapes and counted repeats are not read: such a pattern has None.
    """
    if literal:
        alternatives = [_ascii_runs(term.lower(), "")]
    elif set(term) & set("\\()[]{}"):
        return None
    else:
        alternatives = [_ascii_runs(part, ".^$?*+") for part in term.split("|")]
    found = [{run[i:i + GRAM] for run in runs for i in range(len(run) - GRAM + 1)} for runs in alternatives]
    return found if all(found) else None


def _ascii_runs(text: str, special: str) -> list[str]:
    """The runs of ASCII characters, lower case, that stand for themselves in ``text``."""
    runs, run = [], ""
    for c in text:
        if c in special or c > "\x7f":
            # an optional character is not part of the run before it
            runs.append(run[:-1] if c in special and c in "?*" else run)
            run = ""
        else:
            run += c.translate(str.maketrans(_UPPER, _LOWER))
    return [*runs, run]


def search_indexed(grams: DataFrame, catalogue: DataFrame, term: str, literal: bool = False) -> DataFrame:
    """:func:`search_catalogue` over the entries that hold the pieces ``term`` needs (see :func:`label_grams`)."""
    needed = required_grams(term, literal)
    if needed is None:
        return search_catalogue(catalogue, term, literal)
    asked = grams.filter(F.col("gram").isin(sorted(set().union(*needed))))
    # at most the pattern's pieces per entry
    held = asked.groupBy(*PRODUCT_KEYS).agg(F.collect_set("gram").alias("held"))
    fits = F.lit(False)
    for pieces in needed:
        fits = fits | (F.size(F.array_intersect("held", F.array(*map(F.lit, sorted(pieces))))) == len(pieces))
    return search_catalogue(held.filter(fits), term, literal)


def similar_products(df: DataFrame, title: str, k: int = 10, threshold: int = SIMILARITY_THRESHOLD) -> DataFrame:
    """X2 + J6 + A8: products whose title scores above ``threshold`` against ``title``.

    Plan: the reviews aggregated per (product_id, title) - the catalogue with
    its statistics - scored once per title after the aggregate (the anchor
    is a literal, folded once); the matching ids select the statistics rows
    by a left-semi join
    (both sides share one exchange), then a top-k.  A matching product id
    brings all its titles, as in the reference; the anchor itself is included.
    """
    return similar_in(product_stats(df), title, k, threshold)


def similar_in(stats: DataFrame, title: str, k: int = 10, threshold: int = SIMILARITY_THRESHOLD) -> DataFrame:
    """:func:`similar_products` over (stored) statistics per (product_id, title)."""
    matched = similar_to(stats, "title", F.lit(title), threshold).select("product_id").distinct()
    return (
        stats.join(matched, "product_id", "left_semi")
        .orderBy(F.desc("avg_rating"), "product_id", F.asc_nulls_first("title"))
        .limit(k)
    )


def similar_titles(df: DataFrame, title: str, threshold: int = SIMILARITY_THRESHOLD) -> DataFrame:
    """X2 catalogue step alone: (product_id, title, score) of every title above the threshold."""
    return similar_titles_in(df.select(*PRODUCT_KEYS).distinct(), title, threshold)


def similar_titles_in(catalogue: DataFrame, title: str, threshold: int = SIMILARITY_THRESHOLD) -> DataFrame:
    """:func:`similar_titles` over a (stored) catalogue of distinct entries."""
    return similar_to(catalogue.select(*PRODUCT_KEYS), "title", F.lit(title), threshold)
