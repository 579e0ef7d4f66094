"""The versioned store rewrites what a change touches, and a dead or late writer changes nothing."""

from __future__ import annotations

import json
import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from revlens.plans.tables import stored_reviews
from revlens.sources import store as module
from revlens.sources.store import Conflict, ReviewStore
from tests.conftest import SF001


@pytest.fixture()
def reviews(spark):
    return stored_reviews(spark, SF001).filter(F.crc32("review_id") % 20 == 0).cache()  # of all categories


@pytest.fixture()
def store(spark, reviews, tmp_dir):
    made = ReviewStore(spark, f"{tmp_dir}/store")
    assert made.version() == 0 and made.read().count() == 0
    assert made.add(reviews) == 1
    return made


def rows(df):
    return sorted(map(tuple, df.select("review_id", "category", "rating").collect()), key=str)


def test_change_rewrites_touched_categories_only(store, reviews):
    one = reviews.agg(F.min("category")).first()[0]
    changes = reviews.filter(F.col("category") == one).withColumn("rating", F.lit(1.5).cast("float"))
    before, old = store.folders(1), rows(store.read())
    assert store.change(changes) == 2
    after = store.folders(2)
    assert after[one] != before[one] and {c: f for c, f in after.items() if c != one} == {
        c: f for c, f in before.items() if c != one}
    assert rows(store.read()) == sorted([(i, c, 1.5 if c == one else r) for i, c, r in old], key=str)
    assert rows(store.read(1)) == old  # a pinned reader
    assert rows(store.read(categories=[one])) == [r for r in rows(store.read()) if r[1] == one]


def test_rows_move_between_categories_and_categories_vanish(spark, store, reviews):
    names = sorted(store.folders(1))
    moved = reviews.filter(F.col("category") == names[0]).withColumn("category", F.lit("a b/c=%d"))
    store.change(moved)
    assert names[0] not in store.folders(2) and "a b/c=%d" in store.folders(2)
    assert store.read().count() == reviews.count() and store.read(categories=["a b/c=%d"]).count() == moved.count()
    store.remove(moved.select("review_id"))
    assert store.read().count() == reviews.count() - moved.count() and "a b/c=%d" not in store.folders(3)
    assert store.remove(moved.select("review_id")) == 3  # nothing to do, no version
    store.remove(reviews)
    assert store.read().count() == 0 and store.version() == 4


def test_a_writer_that_dies_leaves_the_old_version(spark, store, reviews, monkeypatch):
    old = rows(store.read())
    changes = reviews.withColumn("rating", F.lit(1.0).cast("float"))
    with monkeypatch.context() as m:  # after the rows, before the list
        m.setattr(ReviewStore, "_commit", lambda *a: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            store.change(changes)
    assert store.version() == 1 and rows(store.read()) == old
    with monkeypatch.context() as m:  # after the number was claimed
        m.setattr(module, "json", SimpleNamespace(loads=json.loads, dumps=lambda *a, **k: (_ for _ in ()).throw(OSError("gone"))))
        with pytest.raises(OSError):
            store.change(changes)
    assert store.versions() == [1] and rows(store.read()) == old
    assert store.change(changes) == 3 and store.read().filter("rating = 1").count() == len(old)
    assert not [n for n in os.listdir(f"{store.root}/versions") if n == "2.json"]


def test_the_later_of_two_writers_fails(spark, store, reviews):
    other = ReviewStore(spark, store.root)
    base = other.version()
    store.remove(reviews.limit(1))
    with pytest.raises(Conflict):
        other._commit(base, other.folders(base))
    assert store.version() == 2 and store.read().count() == reviews.count() - 1


def test_changes_are_computed_once(spark, tmp_path):
    """A change that is costly to compute (here: counted) is written before it is read several times."""
    from pyspark.sql import functions as F

    from revlens.plans.tables import stored_reviews
    from tests.conftest import SF001

    rows = stored_reviews(spark, SF001).limit(50).cache()
    store = ReviewStore(spark, f"{tmp_path}/store")
    store.add(rows)
    seen = spark.sparkContext.accumulator(0)

    @F.udf("float")
    def price(x):
        seen.add(1)
        return 5.0

    store.change(rows.withColumn("price", price(F.col("review_time"))))
    assert seen.value == 50
    assert {r.price for r in store.read().collect()} == {5.0}


@pytest.mark.parametrize("most", [1, 20_000, 1 << 30])
def test_a_change_is_committed_in_batches(spark, store, reviews, monkeypatch, most):
    """Whatever is shuffled at a time (slices of a category, some categories, all): the same rows, one version."""
    monkeypatch.setattr(module, "BATCH_BYTES", most)
    jobs, write = [], module.write_review_table
    monkeypatch.setattr(module, "write_review_table", lambda rows, *a, **k: jobs.append(write(rows, *a, **k)))
    old = {r.review_id: (r.review_id, r.category, r.rating) for r in reviews.collect()}
    names = sorted({c for _, c, _ in old.values()})
    third = F.crc32(F.concat("review_id", F.lit("x"))) % 3 == 0
    moved = reviews.filter(third).withColumn("rating", F.lit(1.5).cast("float")).withColumn(
        "category", F.when(F.col("category") == names[0], "a b/c=%d").otherwise(F.col("category")))
    twice = moved.withColumn("review_time", F.col("review_time") - 1).withColumn("rating", F.lit(9).cast("float"))
    new = reviews.limit(1).withColumn("review_id", F.lit("new"))
    assert store.change(moved.unionByName(twice).unionByName(new)) == 2
    want = old | {r.review_id: (r.review_id, r.category, r.rating) for r in moved.unionByName(new).collect()}
    assert rows(store.read()) == sorted(want.values(), key=str)
    slices = module.MOST_SLICES
    assert len(jobs) == {1: slices * len(names) + 1}.get(most, len(jobs)) and (len(jobs) == 1) == (most == 1 << 30)
    gone = [i for n, i in enumerate(sorted(want)) if n % 2]
    assert store.remove(spark.createDataFrame([(i,) for i in gone], "review_id string")) == 3
    assert rows(store.read()) == sorted((v for k, v in want.items() if k not in gone), key=str)
