"""What a step leaves on disk: shuffle files go as it ends, a fit holds those of few iterations."""

from __future__ import annotations

import os
import threading
import time

from pyspark.sql import functions as F

from revlens.operators import recommend
from revlens.session import written


def shuffles(spark) -> set[str]:
    """Numbers of the shuffles that have files."""
    dirs = [d.getPath() for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    return {name.split("_")[1] for d in dirs for _, _, names in os.walk(d) for name in names if name.startswith("shuffle_")}


def left_of(spark, before: set[str], most: int) -> int:
    """New shuffles with files, once they are at most ``most`` (Spark removes them in the background)."""
    for _ in range(50):
        if len(shuffles(spark) - before) <= most:
            break
        time.sleep(0.2)
    return len(shuffles(spark) - before)


def test_written_tables_leave_no_shuffle_files(spark):
    before = shuffles(spark)
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    kept = [written(df.repartition(3, "k"), "tidy") for _ in range(5)]
    assert left_of(spark, before, 0) == 0
    assert [t.count() for t in kept] == [7] * 5 and df.count() == 7


def test_a_fit_holds_the_shuffle_files_of_few_iterations(spark):
    i = F.col("id")
    rows = spark.range(4000).select((i % 60).cast("string").alias("user_id"), (i * 7 % 83).cast("string").alias("product_id"),
                                    (i % 5 + 1).cast("float").alias("rating"))
    before, most, ended = shuffles(spark), [0], threading.Event()

    def watch():
        while not ended.wait(0.05):
            most[0] = max(most[0], len(shuffles(spark) - before))

    watcher = threading.Thread(target=watch)
    watcher.start()
    try:
        fitted = recommend.fit_recommender(rows, rank=4, blocks=2)
    finally:
        ended.set()
        watcher.join()
    # an iteration has two; ten were held before they were cut
    assert most[0] <= 16
    assert left_of(spark, before, 8) <= 8
    assert fitted.model.userFactors.count() == 60 and recommend.predictions(fitted).count() > 0
