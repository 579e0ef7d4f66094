"""Date helpers over epoch-second columns.

All of them work in UTC without consulting the session time zone: a day is
``floor(seconds / 86400)`` days after 1970-01-01.  That keeps results equal
on every executor and in the SQL oracle, whatever zone the cluster runs in.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86400

# Display format of a review date and the text shown when a
# review has no usable time.
DISPLAY_DATE_FORMAT = "dd/MM/yyyy"
NO_DATE = "N/A"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_to_date(seconds: Column | str) -> Column:
    """F8: epoch seconds -> calendar date (UTC)."""
    s = _col(seconds)
    return F.date_from_unix_date(F.floor(s / F.lit(SECONDS_PER_DAY)).cast("int"))


def epoch_to_year(seconds: Column | str) -> Column:
    """epoch seconds -> year (UTC)."""
    return F.year(epoch_to_date(seconds))


def display_date(seconds: Column | str) -> Column:
    """epoch seconds -> ``dd/MM/yyyy``; null or 0 -> ``N/A``."""
    s = _col(seconds)
    return F.when(s.isNull() | (s == 0), F.lit(NO_DATE)).otherwise(
        F.date_format(epoch_to_date(s), DISPLAY_DATE_FORMAT)
    )


def date_to_epoch(day: Column | str) -> Column:
    """date -> epoch seconds of its midnight (UTC)."""
    return F.unix_date(F.to_date(_col(day))).cast("bigint") * F.lit(SECONDS_PER_DAY)


def day_start_epoch(day: str | _dt.date) -> int:
    """Epoch seconds of the UTC midnight that starts ``day`` (driver-side, one value)."""
    if isinstance(day, str):
        day = _dt.date.fromisoformat(day)
    return (day - _dt.date(1970, 1, 1)).days * SECONDS_PER_DAY


def period_bounds(start: str | _dt.date, end: str | _dt.date, whole_end_day: bool = False) -> tuple[int, int]:
    """Inclusive epoch bounds of a period.

    As in the reference, the end bound is the midnight that *starts* the end
    day, so reviews later on that day fall outside; ``whole_end_day=True``
    includes them.
    """
    lo = day_start_epoch(start)
    hi = day_start_epoch(end) + (SECONDS_PER_DAY - 1 if whole_end_day else 0)
    return lo, hi


def in_period(seconds: Column | str, start, end, whole_end_day: bool = False) -> Column:
    """Both ends inclusive; pushed down to the parquet scan as two bounds."""
    lo, hi = period_bounds(start, end, whole_end_day)
    s = _col(seconds)
    return (s >= F.lit(lo)) & (s <= F.lit(hi))
