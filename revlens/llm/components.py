"""Connected components of an edge table by random contraction.

Each round points every node to the neighbour (or itself) of smallest random
rank and rewrites the edges to those targets.  Which node a node points to is
an edge of the graph, so connectivity is kept; the random order makes the
number of nodes that are still a target fall by a constant factor a round, so
the rounds grow with the logarithm of the longest path.  Labels are composed
round by round.  Every table is written and read back: lineage stays short,
and both sides of each join are plain exchanges, so AQE splits a hub node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.llm.common import written


def _rank(node):
    return F.struct(F.xxhash64(F.lit("rank"), node).alias("r"), node.alias("v"))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) for every node of an edge; nodes of one component share a label.

    The label is one of the component's nodes, the same for every run.
    """
    both = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v")
    todo = written(both.union(both.select("v", "u")).distinct(), "edges")
    labels: DataFrame | None = None
    while not todo.isEmpty():
        best = todo.groupBy("u").agg(F.min(_rank(F.col("v"))).alias("m"))
        own = _rank(F.col("u"))
        target = written(best.select("u", F.least(own, F.col("m"))["v"].alias("t")), "targets")
        if labels is None:
            labels = target.select(F.col("u").alias("node"), F.col("t").alias("label"))
        else:
            labels = labels.join(target, F.col("label") == F.col("u"), "left").select(
                "node", F.coalesce("t", "label").alias("label"))
        labels = written(labels, "labels")
        at_u = target.select(F.col("u").alias("u1"), F.col("t").alias("t1"))
        at_v = target.select(F.col("u").alias("v1"), F.col("t").alias("t2"))
        half = todo.filter("u < v").join(at_u, F.col("u") == F.col("u1")).select("t1", "v")
        moved = half.join(at_v, F.col("v") == F.col("v1")).filter("t1 <> t2").select("t1", "t2").distinct()
        todo = written(moved.select(F.col("t1").alias("u"), F.col("t2").alias("v"))
                       .union(moved.select("t2", "t1")).distinct(), "edges")
    if labels is None:
        return todo.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return labels
