"""Collaborative filtering per category.

Data flow, all DataFrames:

    clean -> activity filter (semi-joins) -> dense indexes -> hash split
          -> ALS fit -> top-k per user (by tiles, inner_topk) -> look-ups

Nothing is collected: look-ups are joins against one-row-per-key
dimensions, the fallback list is a scalar subquery of at most ``k`` rows.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass
from urllib.parse import quote

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revlens.operators.clean import interactions
from revlens.operators.indexing import dense_index
from revlens.operators.inner_topk import top_products
from revlens.operators.products import popular_products, popular_products_by, product_dimension
from revlens.operators.summary import reviews_per
from revlens.session import scratch_path, shared_dir, written
from revlens.sources.files import path_exists

# Model settings of the reference's collaborative filter.
MIN_INTERACTIONS = 5
ALS_RANK = 20
ALS_MAX_ITER = 20
ALS_REG = 0.1
SPLIT_TRAIN_PERCENT = 80
SPLIT_SEED = 42
TOP_K = 10

# Blocks of users and of products in a fit.  A parameter of the model like its
# seed: the factors depend on it, so it must not follow the cluster's size.
ALS_BLOCKS = 10

# Iterations between two cuts of a fit's lineage.  The factors do not depend on it, but Spark keeps
# the shuffle files of all iterations since the last cut.
CUT_EVERY = 2


def activity_filter(df: DataFrame, min_interactions: int = MIN_INTERACTIONS) -> DataFrame:
    """P9 + J1 + J2: keep rows whose user and product each have >= ``min_interactions`` rows.

    Both counts are taken on the unfiltered input in one pass each (not an
    iterated k-core).  The key lists are unique, so the joins are left-semi: no
    duplicate rows, no extra columns.  They are written and read back: then both
    sides of each join are plain exchanges, and AQE can split the rows of a user
    or product that holds a large share of them.
    """
    if min_interactions <= 0:
        return df
    users = reviews_per(df, "user_id").filter(F.col("count") >= min_interactions).select("user_id")
    products = reviews_per(df, "product_id").filter(F.col("count") >= min_interactions).select("product_id")
    users, products = written(users, "active_users"), written(products, "active_products")
    return df.join(users, "user_id", "left_semi").join(products, "product_id", "left_semi")


def split_flag(seed: int = SPLIT_SEED, train_percent: int = SPLIT_TRAIN_PERCENT):
    """M3: True for training rows.  A hash of (user, product, seed), so the
    split does not depend on partitioning and repeats of a pair stay together."""
    key = F.concat_ws("|", F.col("user_id"), F.col("product_id"), F.lit(str(seed)))
    bucket = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint") % 100
    return bucket < train_percent


@dataclass
class Indexed:
    """Indexed interactions and their two index tables."""

    rows: DataFrame  # user_id, product_id, rating, user_index, product_index
    users: DataFrame  # user_id, user_index, count
    products: DataFrame  # product_id, product_index, count


def index_interactions(df: DataFrame, min_interactions: int = MIN_INTERACTIONS) -> Indexed:
    """P5 + P9 + M1 + M2 + F17: filtered interactions with integer user / product ids.

    The filtered interactions and the indexed rows are each checkpointed once
    (three and five narrow columns): both indexes, the split and the model
    fit then read files instead of re-running the activity filter, and the
    lineage the iterative fit depends on is cut.
    """
    shared_dir(df.sparkSession)
    rows = interactions(activity_filter(df, min_interactions)).checkpoint(eager=True)
    users = dense_index(rows, "user_id", "user_index")
    products = dense_index(rows, "product_id", "product_index")
    indexed = rows.join(users.select("user_id", "user_index"), "user_id").join(
        products.select("product_id", "product_index"), "product_id"
    ).checkpoint(eager=True)
    return Indexed(indexed, users, products)


def train_test(rows: DataFrame, seed: int = SPLIT_SEED, train_percent: int = SPLIT_TRAIN_PERCENT):
    """M3: (train, test); ``train_percent=100`` trains on everything (M5)."""
    flag = split_flag(seed, train_percent)
    return rows.filter(flag), rows.filter(~flag)


def make_als(rank: int = ALS_RANK, max_iter: int = ALS_MAX_ITER, reg: float = ALS_REG, seed: int = SPLIT_SEED,
             blocks: int = ALS_BLOCKS) -> ALS:
    """M4: explicit-feedback, non-negative ALS; unseen ids dropped at scoring.

    Lineage is cut every ``CUT_EVERY`` iterations through the shared checkpoint folder.
    ``blocks`` sets the user/item block count.
    """
    return ALS(
        userCol="user_index", itemCol="product_index", ratingCol="rating",
        coldStartStrategy="drop", nonnegative=True, implicitPrefs=False,
        rank=rank, maxIter=max_iter, regParam=reg, seed=seed, checkpointInterval=CUT_EVERY,
        numUserBlocks=blocks, numItemBlocks=blocks,
    )


@dataclass
class Fitted:
    model: ALSModel
    indexed: Indexed
    train: DataFrame
    test: DataFrame


def fit_recommender(df: DataFrame, min_interactions: int = MIN_INTERACTIONS, train_percent: int = SPLIT_TRAIN_PERCENT,
                    **als_args) -> Fitted:
    """M4 (or M5 with ``min_interactions=0, train_percent=100``).

    The factors are written and read back, so that no shuffle file and no cached block of the fit outlives it.
    """
    spark = df.sparkSession
    shared_dir(spark)
    idx = index_interactions(df, min_interactions)
    train, test = train_test(idx.rows, train_percent=train_percent)
    path = scratch_path(spark, "als")
    make_als(**als_args).fit(train).write().save(path)
    spark.sparkContext._jvm.System.gc()  # Spark removes what a fit held once its objects are collected
    return Fitted(ALSModel.load(path), idx, train, test)


def predictions(fitted: Fitted, on: DataFrame | None = None) -> DataFrame:
    """M6: score pairs (default: the test split); pairs of unseen ids are dropped."""
    return fitted.model.transform(fitted.test if on is None else on)


def product_lookup(indexed: Indexed, clean: DataFrame) -> DataFrame:
    """product_index, product_id, title, price - one row per indexed product."""
    return indexed.products.select("product_id", "product_index").join(product_dimension(clean), "product_id")


def user_dimension(clean: DataFrame) -> DataFrame:
    """One row per user: the name on their latest review."""
    latest = F.max_by("user_name", F.struct("review_time", "review_id"))
    return clean.groupBy("user_id").agg(latest.alias("user_name"))


def user_lookup(indexed: Indexed, clean: DataFrame) -> DataFrame:
    """user_index, user_id, user_name - one row per indexed user."""
    return indexed.users.select("user_id", "user_index").join(user_dimension(clean), "user_id")


def recommendation_table(fitted: Fitted, clean: DataFrame, k: int = TOP_K, order: str = "score") -> DataFrame:
    """M7 + J7 + M9 (+O7): top-k products of every known user with their attributes.

    ``order="score"``: predicted rating descending (app); ``order="price"``:
    price ascending then predicted rating descending (variant app).  As in
    the reference, already-reviewed products stay in the list.
    Recommendations without a product row are dropped (inner join).
    """
    scored = top_products(fitted.model.userFactors, fitted.model.itemFactors, k)
    return with_products(scored, product_lookup(fitted.indexed, clean), order).join(
        fitted.indexed.users.select("user_index", "user_id"), "user_index").select(
        "user_id", "product_id", "title", "price", "predicted_rating", "position")


def score_requests(user_factors: DataFrame, item_factors: DataFrame, requests: DataFrame, k: int = TOP_K) -> DataFrame:
    """M7 for requested users: (user_index, product_index, predicted_rating, position), the k best products each.

    ``user_factors`` and ``item_factors`` are (id, features); ``requests`` holds
    ``user_index`` and may be all users.  Unknown users get no rows.  Ties go to
    the smaller product_index.
    """
    asked = requests.select(F.col("user_index").cast("long").alias("id")).distinct()
    return top_products(asked.join(user_factors, "id").select("id", "features"), item_factors, k)


def with_products(scored: DataFrame, products: DataFrame, order: str = "score") -> DataFrame:
    """J7 + M9 (+O7): scored rows with the attributes of ``products`` (product_index, product_id, title, price).

    ``order="score"``: predicted rating descending; ``order="price"``: price
    ascending, then predicted rating.  Products without a row are dropped; the
    scored side is at most k rows per request.
    """
    flat = scored.drop("position").join(products, "product_index")
    first = [F.asc_nulls_last("price")] if order == "price" else []
    w = Window.partitionBy("user_index").orderBy(*first, F.desc("predicted_rating"), F.asc("product_id"))
    return flat.select("user_index", "product_id", "title", "price", "predicted_rating",
                       F.row_number().over(w).alias("position"))


def recommendations_for(fitted: Fitted, products: DataFrame, user_ids: DataFrame, k: int = TOP_K,
                        order: str = "score") -> DataFrame:
    """M7 + J7 for a request table of user ids; ``products`` is a stored :func:`product_lookup`."""
    users = user_ids.select("user_id").distinct().join(fitted.indexed.users.select("user_id", "user_index"), "user_id")
    scored = score_requests(fitted.model.userFactors, fitted.model.itemFactors, users, k)
    return with_products(scored, products, order).join(users, "user_index").select(
        "user_id", "position", "product_id", "title", "price", "predicted_rating")


def fallback_for_unknown(users: DataFrame, known_users: DataFrame, clean: DataFrame, k: int = TOP_K) -> DataFrame:
    """M8: users the model cannot serve get the popular-products list (A1).

    ``users`` minus ``known_users`` (left-anti), each paired with the <= k
    popular products via a scalar subquery - no join against the list.
    """
    # at most k rows; sorted as the ranking (average desc, then id, title)
    entry = F.struct((-F.col("avg_rating")).alias("key"), "product_id", "title", "avg_rating", "avg_price", "n_reviews")
    ordered = popular_products(clean, k=k).agg(F.sort_array(F.collect_list(entry))).scalar()
    unknown = users.select("user_id").distinct().join(known_users.select("user_id").distinct(), "user_id", "left_anti")
    return unknown.select(
        "user_id", F.posexplode(ordered).alias("pos", "p")
    ).select("user_id", (F.col("pos") + 1).alias("position"), "p.product_id", "p.title", "p.avg_rating", "p.avg_price", "p.n_reviews")


def known_by_category(clean: DataFrame, min_interactions: int = MIN_INTERACTIONS) -> DataFrame:
    """(category, user_id) that the model of a category knows: the users of its training rows.

    The activity filter of a category counts its own rows only.
    """
    at_least = lambda key: clean.groupBy("category", key).agg(F.count(F.lit(1)).alias("n")).filter(
        F.col("n") >= min_interactions).select("category", key)
    # written, so that AQE can split the rows of a hot user or product
    users, products = written(at_least("user_id"), "active_users"), written(at_least("product_id"), "active_products")
    rows = clean.select("category", "user_id", "product_id").filter(split_flag())
    rows = rows.join(users, ["category", "user_id"], "left_semi").join(products, ["category", "product_id"], "left_semi")
    return rows.select("category", "user_id").distinct()


def fallback_by_category(users: DataFrame, known: DataFrame, clean: DataFrame, k: int = TOP_K) -> DataFrame:
    """M8 on category pages: (category, user_id) that ``known`` lacks get the category's popular list (A1)."""
    # at most k rows per category
    lists = popular_products_by(clean, k=k)
    unknown = users.select("category", "user_id").distinct().join(
        known.select("category", "user_id"), ["category", "user_id"], "left_anti")
    return unknown.join(written(lists, "popular_lists"), "category").select(
        "category", "user_id", "position", "product_id", "title", "avg_rating", "avg_price", "n_reviews")


def _settings(fit_args: dict) -> dict:
    """The full settings of a fit, defaults filled in."""
    known = {"min_interactions": MIN_INTERACTIONS, "train_percent": SPLIT_TRAIN_PERCENT, "rank": ALS_RANK,
             "max_iter": ALS_MAX_ITER, "reg": ALS_REG, "seed": SPLIT_SEED, "blocks": ALS_BLOCKS}
    unknown = fit_args.keys() - known.keys()
    if unknown:
        raise TypeError(f"unknown settings: {sorted(unknown)}")
    return known | fit_args


def model_path(model_root: str, category: str, **fit_args) -> str:
    """Folder of the model of a category under the given settings."""
    text = json.dumps(_settings(fit_args), sort_keys=True)
    return f"{model_root.rstrip('/')}/category={quote(category, safe='')}/settings={hashlib.sha256(text.encode()).hexdigest()[:16]}"


def save_fitted(fitted: Fitted, path: str, settings: dict) -> None:
    """Factors, index tables and indexed rows; the settings are written last and mark the model complete."""
    fitted.model.write().overwrite().save(f"{path}/model")
    for name in ("rows", "users", "products"):
        getattr(fitted.indexed, name).write.mode("overwrite").parquet(f"{path}/{name}")
    spark = fitted.indexed.rows.sparkSession
    text = json.dumps(settings, sort_keys=True)
    spark.range(1).select(F.lit(text).alias("settings")).write.mode("overwrite").parquet(f"{path}/complete")


def load_fitted(spark: SparkSession, path: str) -> Fitted | None:
    """The model stored at ``path`` with its own index tables; None if it is missing or half-written."""
    if not path_exists(spark, f"{path}/complete/_SUCCESS"):
        return None
    settings = json.loads(spark.read.parquet(f"{path}/complete").first()["settings"])
    indexed = Indexed(*[spark.read.parquet(f"{path}/{name}") for name in ("rows", "users", "products")])
    train, test = train_test(indexed.rows, train_percent=settings["train_percent"])
    return Fitted(ALSModel.load(f"{path}/model"), indexed, train, test)


def fit_or_load(clean: DataFrame, model_root: str, category: str, refit: bool = False, **fit_args) -> Fitted:
    """One model per category and settings, fitted once and reused by later requests.

    A stored model is used with the indexes it was fitted with: they are ordered
    by frequency, so indexes rebuilt from later reviews would not fit its
    factors.  ``refit`` replaces it with one of the present reviews.
    """
    spark = clean.sparkSession
    path = model_path(model_root, category, **fit_args)
    fitted = None if refit else load_fitted(spark, path)
    if fitted is None:
        rows = clean.filter(F.col("category") == F.lit(category))
        save_fitted(fit_recommender(rows, **fit_args), path, _settings(fit_args))
        fitted = load_fitted(spark, path)
    return fitted
