"""Content-based similar products (D1): TF-IDF cosine against one product.

The reference only announces this in its documentation; this is the
one-anchor form, which needs no all-pairs step:

* terms: lower-cased runs of letters / digits of each distinct title of a
  product and of each of its review texts; ``tf`` = occurrences per product;
* ``idf(t) = ln((N + 1) / (df(t) + 1))`` with N products (Spark ML's IDF);
* weight = tf * idf; each product's vector norm is one aggregate;
* cosine with the anchor = a join of every product's weights with the
  anchor's weights on the term, summed per product (partial aggregation),
  divided by both norms; the anchor itself is left out; top-k.

The join on the term is an ordinary equi-join: Spark broadcasts the anchor
side when its measured size allows and AQE splits a hot term otherwise.
The weight table is written once instead of re-tokenising every review for
each use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revlens.session import written

# Fixed value: what separates terms.
TERM_SPLIT = "[^\\p{L}\\p{N}]+"


def _terms(df: DataFrame, text: str) -> DataFrame:
    return df.select("product_id", F.explode(F.split(F.lower(F.col(text)), TERM_SPLIT)).alias("term")).filter(
        F.col("term") != "")


def term_weights(df: DataFrame) -> DataFrame:
    """(product_id, term, w) TF-IDF weights of every product."""
    titles = _terms(df.select("product_id", "title").distinct(), "title")
    texts = _terms(df.select("product_id", "review_text"), "review_text")
    tf = titles.unionByName(texts).groupBy("product_id", "term").agg(F.count(F.lit(1)).alias("tf"))
    n_products = df.select(F.count_distinct("product_id")).scalar()
    # both written: tf is used twice, and a term of all products can then be split by AQE
    tf = written(tf, "term_counts")
    dfreq = written(tf.groupBy("term").agg(F.count(F.lit(1)).alias("df")), "document_counts")
    idf = F.log((n_products + F.lit(1.0)) / (F.col("df") + F.lit(1.0)))
    return tf.join(dfreq, "term").select("product_id", "term", (F.col("tf") * idf).alias("w"))


def similar_by_content(df: DataFrame, product_id: str, k: int = 10) -> DataFrame:
    """Top-k products by TF-IDF cosine with ``product_id`` (itself excluded).

    The weight table is written once (it feeds the anchor, the norms and the
    main pass); pages keep it and the norms across requests
    (:mod:`revlens.plans.artefacts`).
    """
    w = written(term_weights(df), "term_weights")
    return similar_by_weights(w, norms(w), product_id, k)


def norms(weights: DataFrame) -> DataFrame:
    """(product_id, norm) of a weight table."""
    return weights.groupBy("product_id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))


def similar_by_weights(weights: DataFrame, norm: DataFrame, product_id: str, k: int = 10) -> DataFrame:
    """:func:`similar_by_content` over stored weights and norms: only the anchor's terms are summed."""
    anchor = weights.filter(F.col("product_id") == F.lit(product_id)).select("term", F.col("w").alias("wa"))
    anchor_norm = norm.filter(F.col("product_id") == F.lit(product_id)).select("norm").scalar()
    others = weights.filter(F.col("product_id") != F.lit(product_id))
    dot = others.join(anchor, "term").groupBy("product_id").agg(F.sum(F.col("w") * F.col("wa")).alias("dot"))
    cos = dot.join(norm, "product_id").select(
        "product_id", F.try_divide(F.col("dot"), F.col("norm") * anchor_norm).alias("cosine")
    ).filter(F.col("cosine").isNotNull())
    # rank on 9 places so that equal cosines computed in a different order tie
    order = [F.desc(F.round("cosine", 9)), F.asc("product_id")]
    top = cos.orderBy(*order).limit(k)
    return top.withColumn("position", F.row_number().over(Window.orderBy(*order)))  # k rows
