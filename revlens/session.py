"""Session helpers: the shared scratch folder and a local session for tests.

Library code never builds a session; the caller owns it.  Derived tables and
checkpoints go under the folder the cluster names in ``spark.checkpoint.dir``.
Only a local-mode session without that setting (tests, a laptop) gets a
folder of its own.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# bytes of Parquet input for a task of a full sort or join: up to some hundred MB of rows
TASK_BYTES = 8 << 20

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_LOCAL_FALLBACK: dict[str, str] = {}


def _conf(spark: SparkSession, key: str) -> str | None:
    try:
        value = spark.conf.get(key, None)
    except Exception:  # noqa: BLE001 - connect sessions may refuse core keys
        value = None
    if value:
        return value
    try:
        return spark.sparkContext.getConf().get(key)
    except Exception:  # noqa: BLE001
        return None


def shared_dir(spark: SparkSession) -> str:
    """Base folder for checkpoints and derived tables.

    Reads ``spark.checkpoint.dir``.  When it is unset, a local-mode session
    gets a temporary folder (tests); any other master must configure it.
    """
    base = _conf(spark, "spark.checkpoint.dir")
    if not base:
        master = spark.sparkContext.master if hasattr(spark, "sparkContext") else ""
        if not str(master).startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        key = spark.sparkContext.applicationId
        base = _LOCAL_FALLBACK.get(key)
        if base is None:
            base = tempfile.mkdtemp(prefix="revlens-ckpt-")
            _LOCAL_FALLBACK[key] = base
    try:
        sc = spark.sparkContext
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(base)
    except Exception:  # noqa: BLE001 - no SparkContext on connect sessions
        pass
    return base


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique path under the shared folder (never reused)."""
    return os.path.join(shared_dir(spark), "revlens", *parts, uuid.uuid4().hex)


def tasks_for(spark: SparkSession, size: int, task_bytes: int = TASK_BYTES) -> int | None:
    """Tasks for ``size`` input bytes, if that is more than ``spark.sql.shuffle.partitions``.

    Spark's number is fixed and AQE only merges partitions, so the rows of a task would grow with the input.
    """
    n = -(-size // task_bytes)
    return n if n > int(spark.conf.get("spark.sql.shuffle.partitions")) else None


@contextmanager
def partitions_for(spark: SparkSession, size: int) -> Iterator[None]:
    """Jobs run inside have shuffle partitions enough for ``size`` input bytes (AQE merges small ones)."""
    before, n = spark.conf.get("spark.sql.shuffle.partitions"), tasks_for(spark, size)
    if n is not None:
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
    try:
        yield
    finally:
        if n is not None:
            spark.conf.set("spark.sql.shuffle.partitions", before)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Writes run inside remove their shuffle files as they end.

    Otherwise the files stay until the driver's heap happens to be collected, and those of all steps add up.
    """
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def scanned_bytes(df: DataFrame) -> int:
    """Bytes under the folders of the files that ``df`` reads (a folder per category, not a call per file)."""
    sc = df.sparkSession.sparkContext
    total = 0
    for folder in {name.rpartition("/")[0] for name in df.inputFiles()}:
        path = sc._jvm.org.apache.hadoop.fs.Path(sc._jvm.java.net.URI(folder))
        total += path.getFileSystem(sc._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
    return total


def sorted_rows(df: DataFrame, *order, size: int | None = None) -> DataFrame:
    """``df`` in the order ``order``, by ranges; as many of them as ``size`` bytes (its files') need."""
    n = tasks_for(df.sparkSession, scanned_bytes(df) if size is None else size)
    return df.orderBy(*order) if n is None else df.repartitionByRange(n, *order).sortWithinPartitions(*order)


def written(df: DataFrame, *parts: str) -> DataFrame:
    """``df`` written as Parquet under the shared folder and read back (cuts the lineage)."""
    path = scratch_path(df.sparkSession, *parts)
    with shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "revlens") -> SparkSession:
    """Local session used by tests and the bench (UI off, UTC, AQE on)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark
