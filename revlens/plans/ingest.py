"""Raw dumps -> stored review table (and the CSV interchange form).

One narrow stage reads and parses the dumps and writes the parquet store, by
default without a shuffle (see :func:`revlens.sources.files.write_review_table`).
The reject counts ride along as an observation of the same job instead of
a second pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from revlens.functions.numbers import UNKNOWN_PRICE
from revlens.sources import raw
from revlens.sources.files import write_csv, write_review_table


def with_review_id(df: DataFrame) -> DataFrame:
    """Give rows without a key a content hash as ``review_id`` (ties are then broken
    the same way on every run; identical records of a category share an id)."""
    hashed = [*raw.REVIEW_COLUMNS, *(["category"] if "category" in df.columns else [])]
    cols = [F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in hashed]
    key = F.sha2(F.concat_ws("\u001f", *cols), 256)
    if "review_id" in df.columns:
        return df.withColumn("review_id", F.coalesce(F.col("review_id"), key))
    return df.withColumn("review_id", key)


def parse_dumps(spark: SparkSession, path: str, category: str | None = None,
                line_sep: str | None = None) -> DataFrame:
    """Raw dump(s) -> review rows with category and review_id, plus raw text of numbers."""
    blocks = raw.read_raw_blocks(spark, path, line_sep)
    parsed = raw.parse_blocks(blocks, keep_raw=True)
    cat = F.lit(category) if category is not None else raw.category_of("file_name")
    return with_review_id(parsed.withColumn("category", cat).drop("file_name"))


def ingest_dumps(spark: SparkSession, path: str, out: str, category: str | None = None,
                 line_sep: str | None = None, csv_out: str | None = None) -> dict:
    """Parse dumps under ``path`` and store them at ``out``; returns the counts.

    Numbers that are present but unparsable are stored as null and counted
    (the reference aborts the whole file on the first one).
    """
    parsed = parse_dumps(spark, path, category, line_sep)
    obs = Observation("ingest")
    metrics = [
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.col("raw_price").isNotNull() & (F.col("raw_price") != UNKNOWN_PRICE)
                   & F.col("price").isNull()).alias("bad_price"),
        F.count_if(F.col("raw_rating").isNotNull() & F.col("rating").isNull()).alias("bad_rating"),
        F.count_if(F.col("raw_review_time").isNotNull() & F.col("review_time").isNull()).alias("bad_review_time"),
    ]
    write_review_table(parsed, out, observation=obs, metrics=metrics)
    if csv_out is not None:
        write_csv(spark.read.parquet(out).drop("review_id"), csv_out)
    return dict(obs.get)


def main(argv: list[str] | None = None) -> None:
    """``python -m revlens.plans.ingest RAW_DIR OUT_DIR [--csv DIR] [--category NAME]``

    Runs E1 on the session the environment configures (cluster settings come
    from spark-submit / spark-defaults) and prints the record and reject
    counts as one JSON line.
    """
    import argparse
    import json

    ap = argparse.ArgumentParser(prog="python -m revlens.plans.ingest")
    ap.add_argument("raw_dir")
    ap.add_argument("out_dir")
    ap.add_argument("--csv", dest="csv_out")
    ap.add_argument("--category")
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName("revlens-ingest").getOrCreate()
    counts = ingest_dumps(spark, args.raw_dir, args.out_dir, category=args.category, csv_out=args.csv_out)
    print(json.dumps(counts))


if __name__ == "__main__":
    main()
