"""Artefacts are kept per input version and settings; requests read them, not the reviews."""

from __future__ import annotations

import os
import re
import shutil

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from revlens.operators import content, products, recommend, search
from revlens.plans import registry
from revlens.plans.artefacts import Artefacts, input_version
from revlens.plans.tables import clean_table, stored_path, stored_reviews
from tests.conftest import SF001

REQUESTS = ["product_lookup", "user_lookup", "user_index_of", "product_search", "similar_titles", "similar_products",
            "content_similar", "user_page"]


@pytest.mark.parametrize("name", REQUESTS)
def test_requests_read_no_review(spark, name):
    df = registry.REGISTRY[name][0](spark, SF001)
    plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    places = re.findall(r"^Location: .*", plan, flags=re.M)
    assert places and all("/artefacts/" in p for p in places), places


@pytest.fixture()
def kept(spark, tmp_dir):
    stored_reviews(spark, SF001).limit(400).write.partitionBy("category").parquet(f"{tmp_dir}/reviews")
    return Artefacts(spark, f"{tmp_dir}/reviews", f"{tmp_dir}/artefacts")


def builds(kept, name):
    root = f"{kept.root}/{name}"
    return sorted(f"{v}/{b}" for v in os.listdir(root) for b in os.listdir(f"{root}/{v}"))


def test_a_changed_source_is_seen(spark, kept):
    first = kept.statistics().agg(F.sum("n_reviews")).first()[0]
    once = builds(kept, "statistics")
    assert kept.statistics().agg(F.sum("n_reviews")).first()[0] == first and builds(kept, "statistics") == once
    more = stored_reviews(spark, SF001).filter(F.col("price").isNotNull()).limit(50)
    more.write.mode("append").partitionBy("category").parquet(kept.table)
    assert kept.statistics().agg(F.sum("n_reviews")).first()[0] == first + 50 and len(builds(kept, "statistics")) == 2


def test_settings_and_broken_builds(spark, kept):
    assert kept.index("user_id", 1).count() > kept.index("user_id", 3).count()
    assert len({b.split("/")[0] for b in builds(kept, "user_id_index")}) == 2
    kept.norms()
    for build in builds(kept, "norms"):
        os.remove(f"{kept.root}/norms/{build}/_SUCCESS")  # as if the writer had died
    assert kept.norms().count() == kept.clean().select("product_id").distinct().count()
    assert len(builds(kept, "norms")) == 2


def test_equal_to_the_direct_forms(spark, kept):
    clean = kept.clean()
    same = lambda a, b: sorted(map(str, a.select(*sorted(a.columns)).collect())) == sorted(map(str, b.select(*sorted(a.columns)).collect()))
    rounded = lambda df: df.select("product_id", F.round("cosine", 9).alias("cosine"), "position")
    product, title = clean.orderBy("product_id").select("product_id", "title").first()
    assert same(search.search_catalogue(kept.statistics(), "ring"), search.search_products(clean, "ring"))
    assert same(search.similar_titles_in(kept.statistics(), title), search.similar_titles(clean, title))
    assert same(rounded(content.similar_by_weights(kept.term_weights(), kept.norms(), product)),
                rounded(content.similar_by_content(clean, product)))
    assert same(kept.product_dimension(), products.product_dimension(clean))
    assert same(kept.user_dimension(), recommend.user_dimension(clean))


def test_version_of_missing_and_changed_tables(spark, kept, tmp_dir):
    a = input_version(spark, kept.table)
    assert a == input_version(spark, kept.table) and a != input_version(spark, f"{tmp_dir}/nowhere")
    stored_reviews(spark, SF001).limit(5).drop("category").write.parquet(f"{kept.table}/category=new")
    assert a != input_version(spark, kept.table)


def test_changed_test_tables_are_ingested_again(spark, tmp_dir):
    for name in ("lineitem", "orders", "part", "customer"):
        shutil.copy(f"{SF001}/{name}.parquet", f"{tmp_dir}/{name}.parquet")
    before = stored_path(spark, tmp_dir)
    assert stored_path(spark, tmp_dir) == before
    n = clean_table(spark, tmp_dir).count()
    pq.write_table(pq.read_table(f"{SF001}/lineitem.parquet").slice(0, 100), f"{tmp_dir}/lineitem.parquet")
    assert stored_path(spark, tmp_dir) != before and clean_table(spark, tmp_dir).count() < n


def test_a_user_reads_one_folder(spark, kept):
    """One folder of the copy is listed and opened: here 1/40 of its bytes or so, and a row group of that folder."""
    clean = kept.clean()
    folder_bytes = kept.state()[1] // 40 + 1
    for user in [r[0] for r in clean.groupBy("user_id").count().orderBy(F.desc("count")).limit(3).collect()] + ["nobody", "it's"]:
        mine = kept.user_reviews(user, folder_bytes)
        assert sorted(map(str, mine.select(*clean.columns).collect())) == sorted(map(str, clean.filter(F.col("user_id") == user).collect()))
        plan = spark._jvm.PythonSQLUtils.explainString(mine._jdf.queryExecution(), "formatted")
        assert re.search(r"PartitionFilters: \[.*user_folder#\d+ = \d+", plan) and f"EqualTo(user_id,{user})" in plan
    laid = builds(kept, "reviews_by_user")
    assert len(laid) == 1
    root = f"{kept.root}/reviews_by_user/{laid[0]}"
    sizes = [sum(os.path.getsize(f"{root}/{d}/{f}") for f in os.listdir(f"{root}/{d}")) for d in os.listdir(root) if "=" in d]
    assert len(sizes) > 20 and max(sizes) < sum(sizes) / 8


@pytest.mark.parametrize("term", ["bolt|ring", "ring", "RING", "bo", "", "b.lt", "rings?", "brand#1.*promo", "a|ring", "(bolt)", "[rs]ing",
                                  "s\u0131lk", "silk", "kelvin", "stra\u00dfe", "istanbul", "mas+ive", r"\d\d", "zzzz", "^small", "long+?er"])
def test_search_is_equal_with_and_without_the_index(spark, term):
    titles = ["small ring Brand#1 PROMO", "Silk Bolt", "S\u0130LK", "\u017filk", "\u212aelvin", "kelvin", "STRASSE", "stra\u00dfe", "\u0130stanbul",
              "ringring", "masssive bolt", "rin", "b", "", None, "longger", "\U0001f600 ring", "bo\u0308lt"]
    catalogue = spark.createDataFrame([(str(i), t) for i, t in enumerate(titles)], "product_id string, title string")
    for literal in (False, True):
        rows = lambda df: sorted(map(str, df.collect()))
        assert rows(search.search_indexed(search.label_grams(catalogue), catalogue, term, literal)) == rows(
            search.search_catalogue(catalogue, term, literal))


def test_pieces_a_match_must_hold():
    assert search.required_grams("bolt|ring") == [{"bol", "olt"}, {"rin", "ing"}]
    assert search.required_grams("Rings?") == [{"rin", "ing"}] and search.required_grams("ring+s") == [{"rin", "ing"}]
    assert search.required_grams("bolt|a") is None and search.required_grams("(bolt)") is None
    assert search.required_grams("a+b", literal=True) == [{"a+b"}] and search.required_grams("ri\u00f1g") is None
