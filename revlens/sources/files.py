"""Review tables on disk: the parquet store, CSV interchange, category look-up.

The canonical store is parquet partitioned by ``category``: a category query
reads one folder (partition pruning), column pruning and row-group skipping
on ``product_id`` / ``review_time`` come from the parquet reader.  CSV is
kept for interchange with the reference's processed files.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.schema import REVIEW_COLUMNS, REVIEW_SCHEMA, STORED_SCHEMA
from revlens.session import shuffles_removed


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` exists on its file system (any Hadoop-supported one)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def conform(df: DataFrame, with_stored: bool = True) -> DataFrame:
    """Select the review columns by name with their types; absent columns become null.

    Casts use ``try_cast`` so one malformed value cannot fail the job.
    """
    schema = STORED_SCHEMA if with_stored else REVIEW_SCHEMA
    present = set(df.columns)
    cols = []
    for f in schema.fields:
        if f.name in present:
            c = F.col(f.name)
            if df.schema[f.name].dataType != f.dataType:
                c = c.try_cast(f.dataType)
            cols.append(c.alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def stream_folder(path: str) -> str:
    """Where the streaming ingest of the table at ``path`` writes."""
    return path.rstrip("/") + ".stream"


def write_review_table(df: DataFrame, path: str, mode: str = "overwrite", observation=None,
                       metrics=(), cluster: bool = False) -> None:
    """Store reviews as parquet partitioned by ``category``.

    Default: no shuffle.  Each task sorts its rows by (category, product_id,
    review_time) and writes one file per category it holds, so the write is
    a single pass over the input, a hot category or product is spread over
    the tasks that read it, and every file has sorted ``product_id`` row
    groups that product look-ups skip by their statistics.

    ``cluster=True`` range-partitions on (category, product_id, review_id)
    first: fewer, product-clustered files, at the price of a full shuffle
    and of the range partitioner's extra sampling pass over the input.

    An ``observation`` (with its ``metrics``) is attached right before the
    write, so no sampling pass counts rows twice.
    """
    laid = df
    if cluster:
        laid = laid.repartitionByRange("category", "product_id", "review_id")
    laid = laid.sortWithinPartitions("category", "product_id", "review_time")
    if observation is not None:
        laid = laid.observe(observation, *metrics)
    with shuffles_removed(df.sparkSession):
        conform(laid).write.mode(mode).partitionBy("category").parquet(path)


def empty_reviews(spark: SparkSession) -> DataFrame:
    """An empty review table with the stored schema."""
    return spark.createDataFrame([], STORED_SCHEMA)


def read_review_table(
    spark: SparkSession,
    path: str,
    category: str | None = None,
    categories: Iterable[str] | None = None,
) -> DataFrame:
    """The review table, or one category of it.

    ``categories`` is the closed list of valid names; a name outside it
    raises ``ValueError``.  A missing table gives an empty DataFrame (S7).
    Rows written by batch jobs and by the streaming ingest are read together.
    """
    if category is not None and categories is not None and category not in set(categories):
        raise ValueError(f"unknown category: {category!r}")
    df = None
    for folder in (path, stream_folder(path)):
        if path_exists(spark, folder):
            # explicit schema: the partition column stays a string whatever its values look like
            part = spark.read.schema(STORED_SCHEMA).parquet(folder)
            df = part if df is None else df.unionByName(part)
    if df is None:
        df = empty_reviews(spark)
    if category is not None:
        df = df.filter(F.col("category") == F.lit(category))
    return df


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """S3: CSV with header; quotes inside values are doubled (as pandas writes them), blanks kept."""
    writer = df.write.mode(mode).option("header", True).option("quote", '"').option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def read_csv(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """CSV file(s) written by :func:`write_csv`, every column as text, blanks kept."""
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("mode", "PERMISSIVE")
    reader = reader.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    return reader.option("multiLine", multiline).csv(path)


def read_csv_reviews(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Processed CSV file(s) -> typed reviews.

    Reads every column as text and picks columns by header name, so files
    whose column order or set differs (the pandas writer emits only the keys
    it saw) still line up; casts never fail the job (``try_cast``).
    """
    return conform(read_csv(spark, path, multiline), with_stored=False)


def rating_spine(spark: SparkSession, low: int = 1, high: int = 5) -> DataFrame:
    """The ratings low..high as a one-column table (``rating`` float)."""
    return spark.range(low, high + 1).select(F.col("id").cast("float").alias("rating"))


__all__ = [
    "REVIEW_COLUMNS",
    "conform",
    "empty_reviews",
    "path_exists",
    "rating_spine",
    "read_csv_reviews",
    "read_review_table",
    "write_csv",
    "write_review_table",
]
