"""A review table that changes in place, by versions (D2: add, change, delete, read).

A version is a list that says which folder holds each category.  A change
rewrites the categories it touches into a new folder and commits a list that
points there for those and to the old folders for all others, so its cost is
that of the touched partitions.  Nothing is ever overwritten: a reader keeps the
version it began with, a writer that dies leaves folders that no list names, and
of two writers that began with the same version one fails at its commit.

The list is small (a row per category, a closed list) and is the only thing the
driver reads or writes.  Its file is written under another name and renamed,
after the number has been claimed by a file that only one writer can create.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.operators import upsert
from revlens.schema import STORED_SCHEMA
from revlens.session import partitions_for, scanned_bytes, written
from revlens.sources.files import empty_reviews, write_review_table

# bytes of Parquet that one job of a rewrite shuffles; the next one begins when its shuffle files are gone
BATCH_BYTES = 2 << 30
# a category of several times that is read as many times, but not more than this
MOST_SLICES = 8


class Conflict(RuntimeError):
    """Another writer committed first; nothing of this change is visible."""


class ReviewStore:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        jvm, sc = spark.sparkContext._jvm, spark.sparkContext
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(sc._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._path(f"{self.root}/versions"))

    # ---- versions

    def _names(self) -> list[str]:
        return [s.getPath().getName() for s in self._fs.listStatus(self._path(f"{self.root}/versions"))]

    def versions(self) -> list[int]:
        """Committed versions, oldest first."""
        return sorted(int(n.removesuffix(".json")) for n in self._names() if n.endswith(".json"))

    def version(self) -> int:
        """The latest version; 0 before the first commit."""
        return max(self.versions(), default=0)

    def folders(self, version: int) -> dict[str, str]:
        """category -> folder of a version."""
        if version == 0:
            return {}
        stream = self._fs.open(self._path(f"{self.root}/versions/{version}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _commit(self, base: int, folders: dict[str, str]) -> int:
        taken = [int(n.split(".")[0]) for n in self._names() if n.endswith(".claim")]
        number = max([base, *taken]) + 1
        if not self._fs.createNewFile(self._path(f"{self.root}/versions/{number}.claim")) or self.version() != base:
            raise Conflict(f"version {base} is not the latest any more")
        draft = self._path(f"{self.root}/versions/{number}.draft")
        stream = self._fs.create(draft, True)
        try:
            stream.write(bytearray(json.dumps(folders, sort_keys=True).encode()))
        finally:
            stream.close()
        if not self._fs.rename(draft, self._path(f"{self.root}/versions/{number}.json")):
            raise Conflict(f"version {number} could not be committed")
        return number

    # ---- reading

    def read(self, version: int | None = None, categories: list[str] | None = None) -> DataFrame:
        """The reviews of a version (the latest), or of some categories of it."""
        named = self.folders(self.version() if version is None else version)
        held: dict[str, list[str]] = {}
        for category, folder in named.items():
            if categories is None or category in categories:
                held.setdefault(folder, []).append(category)
        # at most a folder per category, each read with its partitions pruned
        parts = [self.spark.read.schema(STORED_SCHEMA).parquet(f"{self.root}/{folder}").filter(F.col("category").isin(names))
                 for folder, names in sorted(held.items())]
        return reduce(DataFrame.unionByName, parts) if parts else empty_reviews(self.spark)

    # ---- writing

    def _replace(self, base: int, touched: list[str], batches: Iterable[tuple[DataFrame, int]]) -> int:
        """``batches``: rows to write and the input bytes that they are made of."""
        folder = f"data/{uuid.uuid4().hex}"
        for rows, size in batches:
            with partitions_for(self.spark, size):
                write_review_table(rows, f"{self.root}/{folder}", mode="append")
        there = {s.getPath().getName().removeprefix("category=") for s in
                 self._fs.listStatus(self._path(f"{self.root}/{folder}")) if s.isDirectory()}
        left = {c: f for c, f in self.folders(base).items() if c not in touched}
        written = [r["category"] for r in self.spark.read.schema(STORED_SCHEMA).parquet(f"{self.root}/{folder}").select(
            "category").distinct().collect()] if there else []  # names as they are, not as folders spell them
        return self._commit(base, left | {c: folder for c in written})

    def add(self, rows: DataFrame) -> int:
        """The first version, or rows of new keys."""
        base = self.version()
        if base == 0:
            return self._replace(0, [], [(rows, 0)])
        return self.change(rows)

    def _touched(self, base: int, keys: DataFrame) -> list[str]:
        """Categories that hold one of the keys (reads the key column only)."""
        found = self.read(base).select("review_id", "category").join(keys, "review_id", "left_semi")
        return [r["category"] for r in found.select("category").distinct().collect()]

    def _sizes(self, base: int, touched: list[str]) -> dict[str, int]:
        """Category -> bytes of its files (0 if it is new)."""
        jvm, sizes = self.spark.sparkContext._jvm, dict.fromkeys(touched, 0)
        for folder in {name.rpartition("/")[0] for name in self.read(base, touched).inputFiles()}:
            path = self._path(jvm.java.net.URI(folder))
            name = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(path.getName())
            if (category := name.removeprefix("category=")) in sizes:
                sizes[category] += self._fs.getContentSummary(path).getLength()
        return sizes

    def _batches(self, base: int, touched: list[str], keys: DataFrame, last: DataFrame | None = None) -> Iterator[tuple[DataFrame, int]]:
        """The touched categories without the rows of ``keys`` (unique, stored) and with those of ``last``, in batches.

        A batch is some categories of ``BATCH_BYTES``, or a slice of one by a hash of review_id.
        """
        more = scanned_bytes(keys)
        groups: list[tuple[list[str], int]] = []
        for category, size in sorted(self._sizes(base, touched).items(), key=lambda c: c[0] or ""):
            if groups and groups[-1][1] + size <= BATCH_BYTES:
                groups[-1] = ([*groups[-1][0], category], groups[-1][1] + size)
            else:
                groups.append(([category], size))
        for names, size in groups:
            slices = min(MOST_SLICES, max(1, -(-size // BATCH_BYTES)))
            for n in range(slices):
                def of(df: DataFrame) -> DataFrame:
                    df = df.filter(F.col("category").isin(names))
                    return df.filter(F.pmod(F.xxhash64("review_id"), F.lit(slices)) == n) if slices > 1 else df

                # a partition's keys are hashed, so the wide rows are not sorted for the join
                rows = of(self.read(base, names)).join(keys.hint("shuffle_hash"), "review_id", "left_anti")
                yield (rows if last is None else rows.unionByName(of(last).select(*rows.columns))), -(-size // slices) + more

    def change(self, changes: DataFrame) -> int:
        """Rows of ``changes`` replace those of the same review_id, in whatever category they were; new ones are added."""
        base = self.version()
        with partitions_for(self.spark, scanned_bytes(changes)):
            last = written(upsert.last_changes(changes, ["review_id"], ["review_time"]), "changes")  # read several times
        touched = self._touched(base, last.select("review_id"))
        touched += [r["category"] for r in last.select("category").distinct().collect()]
        if not touched:
            return base
        return self._replace(base, touched, self._batches(base, touched, last.select("review_id"), last))

    def remove(self, keys: DataFrame) -> int:
        """The rows whose review_id is in ``keys`` go."""
        base = self.version()
        keys = written(keys.select("review_id").distinct(), "removed")  # read several times
        touched = self._touched(base, keys)
        if not touched:
            return base
        return self._replace(base, touched, self._batches(base, touched, keys))
