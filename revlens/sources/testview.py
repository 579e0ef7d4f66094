"""Review table over the TPC-H-like test tables.

Nothing in the test data is a review table, so ``lineitem`` becomes the
review fact: part = product, customer = user, ``p_type`` = category,
quantity -> a 1..5 rating, ship date -> review time.  Line number 7 gets an
unknown price so that cleaning has rows to drop.

The same view is given as DuckDB SQL for the oracle queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.functions.dates import SECONDS_PER_DAY


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def review_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One review per lineitem row; columns of ``STORED_SCHEMA``.

    Joins are plain equi-joins; Spark picks broadcast for the small dimension
    tables by their measured size and sort-merge for lineitem x orders.
    """
    li = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_returnflag", "l_linestatus", "l_shipdate",
    )
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    part = _table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_retailprice")
    cust = _table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    j = (
        li.join(orders, li.l_orderkey == orders.o_orderkey)
        .join(part, li.l_partkey == part.p_partkey)
        .join(cust, orders.o_custkey == cust.c_custkey)
    )
    ship = F.col("l_shipdate")
    review_time = (
        F.unix_date(F.to_date(ship)).cast("bigint") * SECONDS_PER_DAY
        + F.hour(ship) * 3600 + F.minute(ship) * 60 + F.second(ship)
    )
    return j.select(
        F.col("l_partkey").cast("string").alias("product_id"),
        F.concat("p_name", F.lit(" "), "p_brand", F.lit(" "), "p_type").alias("title"),
        F.when(F.col("l_linenumber") == 7, F.lit(None)).otherwise(F.col("p_retailprice")).cast("float").alias("price"),
        F.col("o_custkey").cast("string").alias("user_id"),
        F.col("c_name").alias("user_name"),
        F.concat((F.col("l_linenumber") % 4).cast("string"), F.lit("/3")).alias("helpfulness"),
        (F.floor((F.col("l_quantity") - 1) / 10) + 1).cast("float").alias("rating"),
        review_time.cast("bigint").alias("review_time"),
        F.concat("l_returnflag", "l_linestatus").alias("review_summary"),
        F.concat("p_name", F.lit(" "), "o_orderpriority").alias("review_text"),
        F.concat_ws(
            "-",
            F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"),
            F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"),
            F.col("l_quantity").cast("int").cast("string"),
        ).alias("review_id"),
        F.col("p_type").alias("category"),
    )


# DuckDB form of the same view (used inside oracle SQL as a CTE).
REVIEWS_SQL = """
select cast(l_partkey as varchar) as product_id,
       concat(p_name, ' ', p_brand, ' ', p_type) as title,
       case when l_linenumber = 7 then null else cast(p_retailprice as float) end as price,
       cast(o_custkey as varchar) as user_id,
       c_name as user_name,
       concat(cast(l_linenumber % 4 as varchar), '/3') as helpfulness,
       cast(floor((l_quantity - 1) / 10) + 1 as float) as rating,
       cast(epoch(l_shipdate) as bigint) as review_time,
       concat(l_returnflag, l_linestatus) as review_summary,
       concat(p_name, ' ', o_orderpriority) as review_text,
       concat(cast(l_orderkey as varchar), '-', cast(l_linenumber as varchar), '-',
              cast(l_partkey as varchar), '-', cast(l_suppkey as varchar), '-',
              cast(cast(l_quantity as bigint) as varchar)) as review_id,
       p_type as category
from lineitem join orders on l_orderkey = o_orderkey
              join part on l_partkey = p_partkey
              join customer on o_custkey = c_custkey
"""

# Cleaning rules P1-P3 in SQL.
CLEAN_SQL = """
select * from reviews
where rating is not null and not isnan(rating)
  and product_id is not null and user_id is not null and price is not null
"""


def with_reviews(body: str) -> str:
    """Wrap an oracle query body with the ``reviews`` and ``clean`` CTEs."""
    return f"with reviews as ({REVIEWS_SQL}), clean as ({CLEAN_SQL})\n{body}"
