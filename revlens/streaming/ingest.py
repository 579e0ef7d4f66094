"""Incremental form of the raw-dump ingest (E1) with Structured Streaming.

New dump files dropped in a folder are parsed with the same expressions as
the batch reader and appended to the stored review table.  The file source
and the parquet sink together give exactly-once output: the checkpoint
records which files were committed, so a restarted query (lost driver or
executors) neither skips nor repeats a file.  The sink's commit log would hide
files that other writers put into its folder, so streamed rows go to a folder
beside the batch table, and ``read_review_table`` reads both.  ``available_now=True`` processes
what is there and stops, which is how a scheduled job would run it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from revlens.plans.ingest import with_review_id
from revlens.sources import raw
from revlens.sources.files import conform, stream_folder


def stream_raw_reviews(spark: SparkSession, in_dir: str, line_sep: str = "\n\n",
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of typed reviews from dump files arriving in ``in_dir``."""
    reader = spark.readStream.option("lineSep", line_sep)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    chunks = reader.text(in_dir)
    parsed = raw.parse_blocks(raw.split_blocks(chunks))
    return conform(with_review_id(parsed.withColumn("category", raw.category_of("file_name")).drop("file_name")))


def start_ingest(spark: SparkSession, in_dir: str, out_dir: str, checkpoint: str,
                 available_now: bool = True, line_sep: str = "\n\n") -> StreamingQuery:
    """Append parsed reviews to the store at ``out_dir`` (its stream folder, partitioned by category)."""
    writer = (
        stream_raw_reviews(spark, in_dir, line_sep)
        .writeStream.format("parquet")
        .option("path", stream_folder(out_dir))
        .option("checkpointLocation", checkpoint)
        .partitionBy("category")
        .outputMode("append")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
