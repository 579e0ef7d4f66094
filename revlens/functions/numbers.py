"""Number parsing and formatting helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the literal a raw dump uses for an unknown price.
UNKNOWN_PRICE = "unknown"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_price(text: Column | str) -> Column:
    """``unknown`` -> null; other text that is not a number -> null (counted as reject)."""
    t = _col(text)
    return F.nullif(t, F.lit(UNKNOWN_PRICE)).try_cast("float")


def parse_float(text: Column | str) -> Column:
    """F5 for scores: text -> 32-bit float, bad text -> null."""
    return _col(text).try_cast("float")


def parse_epoch(text: Column | str) -> Column:
    """integer epoch seconds, bad text -> null."""
    return _col(text).try_cast("bigint")


def rating_text(x: Column | str, decimals: int = 1) -> Column:
    """``4.3/5`` (``decimals`` places)."""
    return F.format_string(f"%.{decimals}f/5", _col(x))


def price_text(x: Column | str) -> Column:
    """``12.50 $``."""
    return F.format_string("%.2f $", _col(x))


def safe_ratio(num: Column | str, den: Column | str) -> Column:
    """num / den, 0 when den is 0 or null."""
    return F.coalesce(F.try_divide(_col(num).cast("double"), _col(den).cast("double")), F.lit(0.0))
