"""The most similar products of every product by title (X3, batch form of X1 / X2).

Titles of equal token sets are one class, so everything below works on distinct
token sets ``A`` (sorted tokens joined by blanks, ``a`` characters).  The score
(:mod:`revlens.functions.fuzzy`) of two sets with ``c`` common characters is the
largest of ``2c / (c + a)``, ``2c / (c + b)`` and ``2 LCS / (a + b)``.  The search
is exact and compares no set with all others:

1. Bound.  Sets that are equal but for one token meet on a signature; of each
   signature the first ``k + 1`` classes are scored.  That is a number of pairs
   in proportion to the sets, and gives each set a score and a product id that
   its last place cannot fall under (the least similar score, if too few).
2. Common tokens.  A share of ``t`` of the characters of one side can only be
   common if one of its rarest tokens is: its prefix, the tokens that cannot be
   missed together.  The prefix of either side is looked up in the inverted index
   of the other, at the bound of the set that asks.
3. Typing errors.  Sets within the bound by LCS differ in at most ``d``
   characters.  With the characters dealt to more than ``d`` groups, one of any
   ``d + 1`` groups holds equal characters on both sides; each set looks up its
   ``d + 1`` rarest groups, at the number of groups that costs least.  Sets whose
   ``d`` is too large look up the lengths that the bound allows.

A pair is passed on if its packed character counts allow the bound, and ties
with the last place only if the product id is smaller.  Keys of long lists are
cut into tiles (:func:`tiled`), so a token of all titles is spread over many
tasks, and no list is collected.  What is left is scored in full.

Defined cases: a null title or one without a token is similar to nothing and
has no rows; a similar product is listed once, by its best title (then the
smallest); the product itself is left out, its other titles included; equal
scores rank by product id.
"""

from __future__ import annotations

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlens.functions.fuzzy import SIMILARITY_THRESHOLD, lcs_bits, normalise, tokens
from revlens.session import written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TOP = 10
TILE = 4096
GROUPS = (4, 8, 16)  # numbers of character groups
BUCKETS = 32  # packed character counts: four bits each, in two numbers
SLACK = 1e-9


# ---- classes ---------------------------------------------------------------------


def _packed(s: str, first: int) -> Column:
    """Counts of the characters of 16 buckets from ``first``, at most 15 each, in one number."""
    per = [F.shiftleft(F.least(F.lit(15), F.regexp_count(s, F.lit(_bucket(first + i)))).cast("long"), 4 * i) for i in range(16)]
    out = per[0]
    for x in per[1:]:
        out = out.bitwiseOR(x)
    return out


def _bucket(i: int) -> str:
    """Character class of the letters, digits and blank whose code is ``i`` modulo ``BUCKETS``."""
    return "[" + "".join(f"\\x{{{c:X}}}" for c in range(i, 0x250, BUCKETS)) + "]"


def title_sets(catalogue: DataFrame, k: int = TOP) -> tuple[DataFrame, DataFrame]:
    """(sets, entries): the distinct token sets with their first ``k + 1`` products, and each title's set."""
    words = F.array_sort(tokens(normalise("title")))
    entries = catalogue.filter(F.col("title").isNotNull()).select("product_id", "title").distinct().select(
        "product_id", "title", words.alias("tokens")).filter(F.size("tokens") > 0)
    entries = written(entries.withColumn("s", F.array_join("tokens", " ")), "title_entries")
    products = entries.groupBy("s", "tokens", "product_id").agg(F.min("title").alias("title"))
    first = Window.partitionBy("s").orderBy("product_id")  # at most k + 1 rows a task and class
    members = products.withColumn("r", F.row_number().over(first)).filter(F.col("r") <= k + 1).groupBy("s", "tokens").agg(
        F.sort_array(F.collect_list(F.struct("product_id", "title"))).alias("members"))
    sets = members.select(
        F.monotonically_increasing_id().alias("set_id"), "s", "tokens", "members", F.length("s").alias("n"),
        F.col("members")[0]["product_id"].alias("first_id"), _packed("s", 0).alias("low"), _packed("s", 16).alias("high"))
    return written(sets, "title_sets"), entries.select("product_id", "title", "s")


# ---- scores ----------------------------------------------------------------------


def _percent(common: str, total: str) -> str:
    """round_half_even(200 common / total), 0 where nothing is common."""
    q, r = f"((200 * {common}) div ({total}))", f"((200 * {common}) % ({total}))"
    return (f"case when {common} <= 0 then 0L else {q} + case when 2 * {r} > ({total}) or (2 * {r} = ({total}) "
            f"and {q} % 2 = 1) then 1L else 0L end end")


def _lcs_udf():
    @F.pandas_udf("long")
    def common_subsequence(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([lcs_bits(a, b) for a, b in zip(x, y)], dtype="int64")

    return common_subsequence


def score_pairs(pairs: DataFrame, sets: DataFrame, least: int = SIMILARITY_THRESHOLD + 1) -> DataFrame:
    """(a, b, score) of ``pairs`` (a, b, floor): the score by tokens and the score by order, each if it reaches its
    floor and ``least``, so a pair may have two rows.

    The characters left of the common tokens are compared (Python) only if their
    number and their Levenshtein distance allow the floor and more than the tokens give.
    """
    left = sets.select(F.col("set_id").alias("a"), F.col("tokens").alias("ta"), F.col("n").cast("long").alias("na"))
    right = sets.select(F.col("set_id").alias("b"), F.col("tokens").alias("tb"), F.col("n").cast("long").alias("nb"))
    # written, as a filter would repeat the set operations
    p = written(_spread(pairs, "a", "b").join(left, "a").join(right, "b").select(
        "a", "b", F.greatest("floor", F.lit(least)).alias("floor"), "na", "nb",
        F.length(F.array_join(F.array_intersect("ta", "tb"), " ")).cast("long").alias("c"),
        F.array_join(F.array_except("ta", "tb"), " ").alias("x"), F.array_join(F.array_except("tb", "ta"), " ").alias("y")),
        "title_pairs")
    p = p.withColumn("score", F.expr(_percent("c", "(c + least(na, nb))")))
    done = p.filter(F.col("score") >= F.col("floor")).select("a", "b", "score")
    shared = F.when((F.col("c") > 0) & (F.col("x") != "") & (F.col("y") != ""), F.col("c") + 1).otherwise(F.col("c"))
    p = p.withColumn("shared", shared)
    # a score s is rounded from at least s - 0.5, that is 400 LCS >= (2 s - 1)(na + nb)
    enough = (2 * F.greatest("floor", F.col("score") + 1) - 1) * (F.col("na") + F.col("nb"))
    more = p.filter((400 * F.col("shared") + 400 * F.least(F.length("x"), F.length("y")) >= enough)
                    & (400 * F.col("shared") + 200 * (F.length("x") + F.length("y") - F.levenshtein("x", "y")) >= enough))
    more = more.withColumn("lcs", _lcs_udf()("x", "y")).select(
        "a", "b", "floor", F.expr(_percent("(shared + lcs)", "(na + nb)")).alias("score"))
    return done.unionByName(more.filter(F.col("score") >= F.col("floor")).drop("floor"))


def _best(scored: DataFrame, sets: DataFrame, k: int) -> DataFrame:
    """(a, product_id, title, score, r): the first ``k + 1`` products of each set."""
    members = sets.select(F.col("set_id").alias("b"), "members")
    each = scored.join(members, "b").select("a", "score", F.inline("members"))
    # a product once, by its best score, then its smallest title
    once = each.groupBy("a", "product_id").agg(F.max("score").alias("score"),
                                               F.min_by("title", F.struct(-F.col("score"), "title")).alias("title"))
    order = Window.partitionBy("a").orderBy(F.desc("score"), "product_id")
    return once.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k + 1)


# ---- candidates ------------------------------------------------------------------


def signature_pairs(sets: DataFrame, k: int = TOP) -> DataFrame:
    """(a, b): the first ``k + 1`` sets that share a signature with a set, and the set itself."""
    less = F.when(F.size("tokens") > 1, F.transform("tokens", lambda t: F.array_join(F.array_remove("tokens", t), " ")))
    made = F.array_union(F.array("s"), F.coalesce(less, F.array().cast("array<string>")))
    rows = written(sets.select("set_id", "first_id", F.explode(made).alias("signature")), "title_signatures")
    first = Window.partitionBy("signature").orderBy("first_id", "set_id")
    kept = rows.withColumn("r", F.row_number().over(first)).filter(F.col("r") <= k + 1)
    kept = written(kept.select("signature", F.col("set_id").alias("b")), "title_signature_heads")
    near = rows.join(kept, "signature").select(F.col("set_id").alias("a"), "b")
    return near.unionByName(sets.select(F.col("set_id").alias("a"), F.col("set_id").alias("b"))).distinct()


def tiled(asked: DataFrame, index: DataFrame, sizes: DataFrame, tile: int = TILE) -> DataFrame:
    """``asked`` joined with ``index`` on ``key``; a key of more than ``tile`` index rows (``sizes``) is several keys.

    The index row goes to one tile of its key by a hash, the asking row to all.
    """
    tiles = written(sizes.filter(F.col("size") > tile).select(
        "key", F.ceil(F.col("size") / tile).cast("int").alias("tiles")), "title_tiles")
    of = F.coalesce("tiles", F.lit(1))
    probe = asked.join(tiles, "key", "left").select(
        *asked.columns, F.explode(F.sequence(F.lit(0), of - 1)).alias("tile")).drop("tiles")
    rows = index.join(tiles, "key", "left").select(*index.columns, F.pmod(F.xxhash64("b"), of).cast("int").alias("tile"))
    return _spread(probe, "key", "tile").join(rows, ["key", "tile"])


def _l1() -> Column:
    """Lower bound of the characters in which two sets differ, from their packed counts."""
    out = F.lit(0)
    for x, y in (("low", "low_b"), ("high", "high_b")):
        for i in range(0, 64, 4):
            nibble = [F.shiftrightunsigned(F.col(c), i).bitwiseAND(F.lit(15)) for c in (x, y)]
            out = out + F.abs(nibble[0] - nibble[1])
    return out


def _passes(limit: Column) -> Column:
    """Does an upper bound (0..1) reach the asking set's floor, ties only for smaller product ids?"""
    tie = F.col("bound_id").isNull() | (F.col("first_b") < F.col("bound_id"))
    return F.floor(100 * limit + F.lit(0.5 + SLACK)) >= F.col("floor") + F.when(tie, 0).otherwise(1)


def _spread(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` over all shuffle partitions: few bytes that make much work are not to be coalesced."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def _need(t: str, n: str) -> str:
    """Weight (characters and a blank per token) that must be common for 2c / (c + n) >= t."""
    return f"({t} * {n} / (2 - {t}) + 1 - {SLACK})"


def token_pairs(asking: DataFrame, least: int, tile: int = TILE) -> DataFrame:
    """(a, b, floor) of sets whose common tokens may reach the floor of ``a``."""
    flat = written(asking.select("set_id", F.explode("tokens").alias("key")), "title_tokens")
    sizes = written(flat.groupBy("key").agg(F.count(F.lit(1)).alias("size")), "title_token_sizes")
    # rarest first; the tokens of one title
    ranked = flat.join(sizes, "key").groupBy("set_id").agg(F.sort_array(F.collect_list(F.struct("size", "key"))).alias("by"))
    ranked = ranked.select("set_id", F.posexplode("by.key").alias("i", "key"), "by")
    rest = F.aggregate(F.slice(F.col("by.key"), F.col("i") + 1, F.size("by")), F.lit(0), lambda s, t: s + F.length(t) + 1)
    entries = written(ranked.select("set_id", "key", rest.alias("rest")).join(
        asking.drop("tokens", "s"), "set_id"), "title_postings")
    probe = entries.withColumnRenamed("set_id", "a")
    index = entries.select("key", F.col("set_id").alias("b"), F.col("n").alias("nb"), F.col("rest").alias("rest_b"),
                           F.col("low").alias("low_b"), F.col("high").alias("high_b"), F.col("first_id").alias("first_b"))
    lowest = (least - 0.5) / 100
    most = (F.col("n") + F.col("nb") - _l1()) / 2
    fewer = F.least("n", "nb")
    allowed = _passes(2 - 2 * fewer / (most + fewer))  # 2c / (c + n) for the shorter side
    asks = tiled(probe.filter(F.expr(f"rest >= {_need('t', 'n')}")), index, sizes, tile)
    heads = index.filter(F.expr(f"rest_b >= {_need(str(lowest), 'nb')}"))
    head_sizes = heads.groupBy("key").agg(F.count(F.lit(1)).alias("size"))
    asked = tiled(probe, heads, head_sizes, tile).filter(F.expr(f"rest_b >= {_need('t', 'nb')}"))
    return asks.unionByName(asked).filter(allowed & (F.col("a") != F.col("b"))).select("a", "b", "floor")


def _group_keys(s: str) -> Column:
    """array<struct<level, key>>: for each number of groups, each group's characters in order, hashed."""
    chars = F.array_sort(F.split(s, ""))

    def key(groups: int, i: int) -> Column:
        own = F.filter(chars, lambda c: F.ascii(c) % groups == i)
        return F.struct(F.lit(groups).alias("level"),
                        F.xxhash64(F.lit(groups), F.lit(i), F.array_join(own, "")).alias("key"))

    keys = [key(g, i) for g in GROUPS for i in range(g)]
    return F.array(*keys)


def typo_pairs(asking: DataFrame, tile: int = TILE) -> DataFrame:
    """(a, b, floor) of sets whose characters may reach the floor of ``a`` in order."""
    flat = written(asking.select("set_id", F.explode(_group_keys("s")).alias("k")).select("set_id", "k.*"), "title_groups")
    length_key = lambda n: F.xxhash64(F.lit("length"), n.cast("long"))
    base = asking.select("set_id", "n", "low", "high", "first_id", "t", "floor", "bound_id")
    keys = flat.select("set_id", "key").unionByName(base.select("set_id", length_key(F.col("n")).alias("key")))
    sizes = written(keys.groupBy("key").agg(F.count(F.lit(1)).alias("size")), "title_group_sizes")
    # differing characters: (1 - t)(a + b), with b at most a (2 - t) / t
    d = F.floor(F.expr(f"2 * n * (1 - t) / t + {SLACK}"))
    limits = asking.select("set_id", d.alias("d"))
    costs = flat.join(sizes, "key").join(limits, "set_id").filter(F.col("d") < F.col("level")).groupBy("set_id", "level", "d").agg(
        F.sort_array(F.collect_list(F.struct("size", "key"))).alias("by"))  # at most 16 keys
    costs = costs.select("set_id", "level", F.expr("slice(by, 1, int(d) + 1)").alias("by"))
    cost = F.aggregate("by", F.lit(0).cast("long"), lambda s, x: s + x["size"])
    chosen = costs.withColumn("cost", cost).groupBy("set_id").agg(F.min_by("by", F.struct("cost", "level")).alias("by"))
    asks = base.join(chosen, "set_id", "left")
    lengths = F.transform(F.expr("sequence(bigint(ceil(n * t / (2 - t) - 0.001)), bigint(floor(n * (2 - t) / t + 0.001)))"),
                          length_key)
    probe = asks.select(F.col("set_id").alias("a"), "n", "low", "high", "t", "floor", "bound_id",
                        F.explode(F.coalesce(F.col("by.key"), lengths)).alias("key"))
    index = keys.join(base, "set_id").select(
        "key", F.col("set_id").alias("b"), F.col("n").alias("nb"), F.col("low").alias("low_b"),
        F.col("high").alias("high_b"), F.col("first_id").alias("first_b"))
    met = tiled(written(probe, "title_group_probe"), written(index, "title_group_index"), sizes, tile)
    allowed = _passes((F.col("n") + F.col("nb") - _l1()) / (F.col("n") + F.col("nb")))
    return met.filter(allowed & (F.col("a") != F.col("b"))).select("a", "b", "floor")


# ---- the join --------------------------------------------------------------------


def candidate_pairs(sets: DataFrame, bounds: DataFrame, least: int, tile: int = TILE) -> DataFrame:
    """(a, b, floor), distinct: all pairs that may come before the place of ``a`` in ``bounds`` (a, floor, bound_id)."""
    asking = sets.drop("members").join(bounds.withColumnRenamed("a", "set_id"), "set_id", "left")
    asking = asking.withColumn("floor", F.coalesce("floor", F.lit(least).cast("long")))
    asking = written(asking.withColumn("t", (F.col("floor") - 0.5) / 100), "title_bounds")
    return _spread(token_pairs(asking, least, tile).unionByName(typo_pairs(asking, tile)), "a", "b").distinct()


def most_similar(catalogue: DataFrame, k: int = TOP, threshold: int = SIMILARITY_THRESHOLD, tile: int = TILE) -> DataFrame:
    """(product_id, title, position, similar_id, similar_title, score): the ``k`` most similar products of every
    catalogue title (distinct product_id, title), of those that score above ``threshold``."""
    least = threshold + 1
    sets, entries = title_sets(catalogue, k)
    near = signature_pairs(sets, k).withColumn("floor", F.lit(least).cast("long"))
    first = written(score_pairs(near, sets, least), "title_first_scores")
    last = _best(first, sets, k).filter(F.col("r") == k + 1)
    bounds = written(last.select("a", F.col("score").alias("floor"), F.col("product_id").alias("bound_id")), "title_floors")
    more = score_pairs(written(candidate_pairs(sets, bounds, least, tile), "title_candidates"), sets, least)
    best = written(_best(first.unionByName(more).distinct(), sets, k), "title_best").withColumnsRenamed(
        {"product_id": "similar_id", "title": "similar_title"})
    asked = entries.join(sets.select("s", F.col("set_id").alias("a")), "s").join(best, "a")
    own = Window.partitionBy("product_id", "title").orderBy("r")  # at most k + 1 rows
    listed = asked.filter(F.col("similar_id") != F.col("product_id")).withColumn("position", F.row_number().over(own))
    return listed.filter(F.col("position") <= k).select(
        "product_id", "title", "position", "similar_id", "similar_title", "score")
