"""Results kept across requests (S15): catalogue, dimensions, indexes and term weights of a stored review table.

An artefact is a Parquet table under ``root``, in a folder named by the version
of its input and by its settings.  The version is a digest over path, length and
time of the input's files, taken by a Spark job, so a changed or appended table
is another version and its artefacts are built anew on the next request; an
unchanged one is only read.  A build writes a folder of its own and counts once
its ``_SUCCESS`` mark is there, so builders do not disturb each other or a
reader, and a build that dies leaves nothing that is read.  Tables are sorted by
the key they are asked for, so one key reads one row group.  The reviews by user
are also dealt to folders by a hash of the user, one for every ``USER_FOLDER_BYTES``
of input, so a user's page lists and opens one folder whatever the table's size.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.operators import content, days, products, recommend, search, users
from revlens.operators.clean import clean_reviews, interactions
from revlens.operators.indexing import dense_index
from revlens.session import partitions_for
from revlens.sources.files import path_exists, read_review_table, stream_folder


# input bytes per folder of the reviews by user
USER_FOLDER_BYTES = 256 << 20


def input_state(spark: SparkSession, *paths: str) -> tuple[str, int]:
    """Digest of the Parquet files under ``paths`` (which there are, how long, and from when) and their bytes."""
    parts = []
    for path in paths:
        if not path_exists(spark, path):
            continue
        # only the files' names and attributes are read
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option(
            "pathGlobFilter", "*.parquet").load(path).select("path", "length", "modificationTime")
        parts.append(tuple(files.agg(
            F.count(F.lit(1)), F.sum("length"), F.bit_xor(F.xxhash64("path", "length", "modificationTime"))).first()))
    return hashlib.sha256(repr(parts).encode()).hexdigest()[:16], sum(p[1] or 0 for p in parts)


def input_version(spark: SparkSession, *paths: str) -> str:
    """The digest of :func:`input_state`."""
    return input_state(spark, *paths)[0]


def _complete(spark: SparkSession, folder: str) -> str | None:
    """The first finished build in ``folder``."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return None
    names = sorted(s.getPath().getName() for s in fs.listStatus(path))
    return next((f"{folder}/{n}" for n in names if path_exists(spark, f"{folder}/{n}/_SUCCESS")), None)


class Artefacts:
    """Artefacts of the review table at ``table``, kept under ``root``."""

    def __init__(self, spark: SparkSession, table: str, root: str) -> None:
        self.spark, self.table, self.root = spark, table, root.rstrip("/")

    def clean(self) -> DataFrame:
        return clean_reviews(read_review_table(self.spark, self.table))

    def state(self) -> tuple[str, int]:
        return input_state(self.spark, self.table, stream_folder(self.table))

    def kept(self, name: str, build: Callable[[], DataFrame], *by: str, version: str | None = None,
             folders: str | None = None, **settings) -> DataFrame:
        """The stored table ``name``, built if this version of the input has none.

        Rows are sorted by ``by``; with ``folders`` each value of that column has a folder of its own.
        """
        version = version or self.state()[0]
        text = json.dumps(settings, sort_keys=True)
        folder = f"{self.root}/{name}/{version}-{hashlib.sha256(text.encode()).hexdigest()[:8]}"
        found = _complete(self.spark, folder)
        if found is None:
            with partitions_for(self.spark, self.state()[1]):
                writer = build().repartitionByRange(*by).sortWithinPartitions(*by).write
                if folders:
                    writer = writer.partitionBy(folders)
                writer.parquet(f"{folder}/{uuid.uuid4().hex}")
            found = _complete(self.spark, folder)
        return self.spark.read.parquet(found)

    def statistics(self) -> DataFrame:
        """The catalogue: every (product_id, title) with its number of reviews, average rating and price."""
        return self.kept("statistics", lambda: products.product_stats(self.clean()), "product_id")

    def product_dimension(self) -> DataFrame:
        return self.kept("products", lambda: products.product_dimension(self.clean()), "product_id")

    def user_dimension(self) -> DataFrame:
        return self.kept("users", lambda: recommend.user_dimension(self.clean()), "user_id")

    def label_grams(self) -> DataFrame:
        """(gram, product_id, title): the posting table of the product search."""
        return self.kept("grams", lambda: search.label_grams(self.statistics()), "gram", "product_id")

    def user_reviews(self, user_id: str, folder_bytes: int = USER_FOLDER_BYTES) -> DataFrame:
        """The cleaned reviews of one user, from one folder of the copy laid out by user.

        Within a folder rows are in ranges of (user_id, review_id), so a user with a third of all
        reviews is written and read by many tasks.
        """
        version, size = self.state()
        n = max(1, -(-size // folder_bytes))

        def bucket(user):
            return F.pmod(F.xxhash64(user), F.lit(n)).cast("int")

        def build() -> DataFrame:
            return self.clean().withColumn("user_folder", bucket(F.col("user_id")))

        laid = self.kept("reviews_by_user", build, "user_folder", "user_id", "review_id",
                         version=version, folders="user_folder", folder_bytes=folder_bytes)
        mine = laid.filter(F.col("user_folder") == bucket(F.lit(user_id)))
        return users.one_user(mine, user_id).drop("user_folder")

    def days(self) -> DataFrame:
        """Sums per (category, product, day), by day."""
        return self.kept("days", lambda: days.day_table(self.clean()), "day", "product_id")

    def day_sketches(self) -> DataFrame:
        return self.kept("day_sketches", lambda: days.day_sketches(self.clean()), "day", "category")

    def index(self, key: str, min_interactions: int = recommend.MIN_INTERACTIONS) -> DataFrame:
        """(key, index, count) of the filtered interactions, ``key`` user_id or product_id."""
        def build() -> DataFrame:
            return dense_index(interactions(recommend.activity_filter(self.clean(), min_interactions)), key)

        return self.kept(f"{key}_index", build, key, min_interactions=min_interactions)

    def term_weights(self) -> DataFrame:
        """(product_id, term, w): TF-IDF weights, by term."""
        return self.kept("weights", lambda: content.term_weights(self.clean()), "term")

    def norms(self) -> DataFrame:
        """(product_id, norm) of the weights."""
        return self.kept("norms", lambda: content.norms(self.term_weights()), "product_id")

    def product_lookup(self) -> DataFrame:
        """J3 without the reviews: product_index, product_id, title, price."""
        return self.index("product_id").select("product_id", "product_index").join(self.product_dimension(), "product_id")

    def user_lookup(self) -> DataFrame:
        """J4 without the reviews: user_index, user_id, user_name."""
        return self.index("user_id").select("user_id", "user_index").join(self.user_dimension(), "user_id")
