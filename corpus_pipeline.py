"""The training-data pipeline: five operators of ``revlens.llm`` over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
and read again as the next stage's docs.  All but the last keep the columns of
documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm import decontamination, line_dedup, packing, quality, simhash
from revlens.llm.common import columns, crc32_mod, table, written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"), crc32_mod("doc_id", 3) != 1)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their source's boilerplate lines; n_chars follows the text.

    A class of near copies counts as one page, else a large group of them would lose all its lines
    before one of it is kept.
    """
    cleaned = line_dedup.drop_boilerplate(docs, "source", counts=False, near=True)
    chars = F.when(F.col("text").isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return cleaned.select(*[chars.alias(n) if n == "n_chars" else c for n, c in zip(cleaned.columns, columns(cleaned))])


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.keep_one(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents kept, packed into sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("SimHash near-dedup", simhash_stage),
    ("benchmark decontamination", benchmark_stage),
    ("packing", packing_stage),
]

# a fitted classifier and an edit distance cannot be stated in SQL; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "pipeline", name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
