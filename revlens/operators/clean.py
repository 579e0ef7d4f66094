"""Cleaning rules of the review table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.schema import MISSING_TEXT, OPTIONAL_COLUMNS, REQUIRED_COLUMNS


def clean_reviews(df: DataFrame, require_price: bool = True) -> DataFrame:
    """Cast, filter and complete the review table.

    * P1: rating and price as 32-bit floats (bad text -> null, never a failed job);
    * P2: rating neither NaN nor null;
    * P3: rows with a null product_id, user_id, rating or price are dropped
      (``require_price=False`` keeps reviews of unknown price);
    * P4: absent optional columns are added: ``review_time`` as a typed null,
      the text columns as ``N/A``.

    All of it is one projection + one filter; Catalyst pushes the null checks
    into the parquet scan.
    """
    out = df
    for c in ("rating", "price"):
        if c in out.columns and dict(out.dtypes)[c] != "float":
            out = out.withColumn(c, F.col(c).try_cast("float"))
    required = [c for c in REQUIRED_COLUMNS if require_price or c != "price"]
    cond = ~F.isnan("rating")
    for c in required:
        cond = cond & F.col(c).isNotNull()
    out = out.filter(cond)
    missing = [c for c in OPTIONAL_COLUMNS if c not in out.columns]
    if missing:
        adds = [
            (F.lit(None).cast("bigint") if c == "review_time" else F.lit(MISSING_TEXT)).alias(c) for c in missing
        ]
        out = out.select("*", *adds)
    return out


def interactions(df: DataFrame) -> DataFrame:
    """P5: (user_id, product_id, rating) - the input of the collaborative filter."""
    return df.select("user_id", "product_id", "rating")
