"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Preview length, the mark appended to a cut preview, and the
# text shown when a product has no review text.
PREVIEW_CHARS = 500
PREVIEW_MARK = "..."
NO_REVIEW_TEXT = "No review available"
STAR = "⭐"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_quotes(c: Column | str) -> Column:
    """remove every double quote (profile names)."""
    return F.replace(_col(c), F.lit('"'), F.lit(""))


def product_label(title: Column | str = "title", product_id: Column | str = "product_id") -> Column:
    """``title (product_id)``; a null title gives a null label."""
    return F.concat(_col(title), F.lit(" ("), _col(product_id), F.lit(")"))


def preview(text: Column | str, chars: int = PREVIEW_CHARS) -> Column:
    """first ``chars`` characters plus ``...`` when the text is longer."""
    t = _col(text)
    return F.when(F.length(t) > chars, F.concat(F.substring(t, 1, chars), F.lit(PREVIEW_MARK))).otherwise(t)


def text_or_default(text: Column | str, default: str = NO_REVIEW_TEXT) -> Column:
    """null or empty text -> default message."""
    t = _col(text)
    return F.coalesce(F.nullif(t, F.lit("")), F.lit(default))


def rating_label(rating: Column | str) -> Column:
    """``4 ⭐`` from a rating."""
    return F.concat(_col(rating).cast("int").cast("string"), F.lit(" " + STAR))
