"""Helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, *parts: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back.

    Cuts the lineage, so a lost executor re-reads files.  A join against the
    table read back has a plain exchange on this side, which is what AQE needs
    to split a hot key on the other side.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "llm", *parts)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def crc32_mod(col: str, n: int) -> Column:
    """crc32 of the column's text modulo ``n`` (null: null)."""
    return F.crc32(F.col(col).cast("string")) % n


def free_name(df: DataFrame, base: str) -> str:
    """A column name not used by ``df`` (case-insensitively)."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name = "_" + name
    return name


def columns(df: DataFrame) -> list[Column]:
    """All columns of ``df``, whatever characters their names hold."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]
