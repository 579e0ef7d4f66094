"""Dense integer ids for users and products.

Same order as ``StringIndexer(stringOrderType="frequencyDesc")``: the most
frequent id gets 0, equal counts are ordered by the id text.  Instead of
fitting a ``StringIndexer`` (whose label array lives on the driver), the
index is computed distributed:

1. count per id (partial aggregate);
2. range-partition and sort the counts by (count desc, id);
3. checkpoint, which pins the partition contents for the next two steps and
   cuts the lineage;
4. per partition, the row position from ``monotonically_increasing_id`` and
   the partition's offset from a running sum of partition sizes (a table of
   one row per partition, broadcast back).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revlens.session import shared_dir


def dense_index(df: DataFrame, col: str, out_col: str | None = None) -> DataFrame:
    """(``col``, ``out_col`` int, ``count``): frequency-ordered dense index of ``col``."""
    out_col = out_col or f"{col.removesuffix('_id')}_index"
    shared_dir(df.sparkSession)  # make sure the checkpoint folder is set
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    order = [F.desc("count"), F.asc(col)]
    ordered = counts.repartitionByRange(*order).sortWithinPartitions(*order).checkpoint(eager=True)
    tagged = ordered.select(
        col, "count",
        F.spark_partition_id().alias("_pid"),
        F.monotonically_increasing_id().alias("_mid"),
    )
    sizes = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    running = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = sizes.select("_pid", (F.sum("_n").over(running) - F.col("_n")).alias("_off"))
    # one row per partition: bounded by the partition count, safe to broadcast
    pos = F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), 33)
    return tagged.join(F.broadcast(offsets), "_pid").select(
        col, (F.col("_off") + pos).cast("int").alias(out_col), "count"
    )
