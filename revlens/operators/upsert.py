"""Batch changes to the review table by key (D2: add, change, delete).

An upsert is a left-anti join of the current rows against the changed keys
plus a union of the changed rows: one shuffle of each side on the key, no
per-row driver work.  The result is written as a new table version (write to
a new folder, then switch readers to it) - the store is never edited in place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def last_changes(changes: DataFrame, keys: Sequence[str], latest_by: Sequence[str]) -> DataFrame:
    """One row per key: the largest by ``latest_by``, equal ones by a hash of the row (so repeatable)."""
    order = [F.desc_nulls_last(c) for c in latest_by] + [F.desc(F.xxhash64(*changes.columns))]
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return changes.withColumn("_n", first).filter("_n = 1").drop("_n")


def upsert(base: DataFrame, changes: DataFrame, keys: Sequence[str] = ("review_id",),
           latest_by: Sequence[str] = ("review_time",)) -> DataFrame:
    """Rows of ``changes`` replace rows of ``base`` with the same key; new keys are added.

    Of several changes of one key the last by ``latest_by`` counts.
    """
    keys = list(keys)
    last = last_changes(changes, keys, latest_by)
    return base.join(changes.select(*keys).distinct(), keys, "left_anti").unionByName(last.select(*base.columns))


def delete(base: DataFrame, removed: DataFrame, keys: Sequence[str] = ("review_id",)) -> DataFrame:
    """Rows of ``base`` whose key is in ``removed`` are dropped."""
    keys = list(keys)
    return base.join(removed.select(*keys).distinct(), keys, "left_anti")
