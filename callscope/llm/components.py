"""Connected components of a link table by alternating large-star and
small-star steps, each a grouping and a join; hubs are pre-aggregated before
the shuffle, and every round starts from a table in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callscope.llm.common import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Edges (u, v) with v < u. Large star: every larger neighbour of a node
    moves to the node's smallest neighbour. Small star: so do the node and
    its smaller neighbours."""
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        out = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        near = edges.join(least, "u")
        out = near.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").unionByName(
            least.select("u", F.col("m").alias("v")))
    return out.distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 40) -> DataFrame:
    """id, component (the smallest id reachable) for every id of a link;
    links to itself or to null are ignored. Each round at least halves the
    longest way to the smallest id, so `rounds` (a guard that raises) covers
    any graph that fits a cluster."""
    low, high = F.least(a, b), F.greatest(a, b)
    now = materialize(edges.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).select(
        high.alias("u"), low.alias("v")).distinct(), "edges")
    for _ in range(rounds):
        # stars only: every node has one edge and no centre is a leaf
        seen = now.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("u").alias("u")).first()
        if seen["n"] == seen["u"] and not now.join(now.select(F.col("u").alias("v")), "v", "left_semi").limit(1).count():
            return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
                now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
        now = materialize(_star(_star(now, True), False), "edges")
    raise RuntimeError("connected components did not settle")
