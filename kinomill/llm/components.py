"""Connected components of a graph given as edges, by alternating large-star and small-star steps.

Each step is a group-by with partial minima and an equi-join, whose hot nodes
Spark splits; edges never gather at a node. Lineage is cut after each round.
At most ``FEW`` edges are put into one partition, where the same steps need no shuffle: a round is then one task, not a dozen
stages of as many tasks as the session has shuffle partitions. Rounds never need more edges than twice the first ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinomill.session import cut_lineage

FEW = 200_000  # edges of two numbers: 3 MB


def _with_least(edges: DataFrame, few: bool) -> DataFrame:
    """Edges (node, other) with the least neighbour of the node; ``few`` are one partition, where a join would shuffle and a window does not."""
    if few:
        return edges.withColumn("least", F.min("other").over(Window.partitionBy("node")))
    return edges.join(edges.groupBy("node").agg(F.min("other").alias("least")), "node")


def _large(edges: DataFrame, few: bool) -> DataFrame:
    both = edges.selectExpr("inline(array(struct(u as node, v as other), struct(v as node, u as other)))")
    linked = _with_least(both, few).where("other > node")
    return linked.select(F.col("other").alias("u"), F.least("node", "least").alias("v")).where("u <> v")


def _small(edges: DataFrame, few: bool) -> DataFrame:
    linked = _with_least(edges.select(F.greatest("u", "v").alias("node"), F.least("u", "v").alias("other")), few)
    return linked.selectExpr("inline(array(struct(other as u, least as v), struct(node as u, least as v)))").where("u <> v")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable from each node of ``edges`` (u, v). Nodes without edges are left out."""
    now = cut_lineage(edges.select("u", "v").where("u <> v").distinct())
    few, state = now.count() <= FEW, None
    while True:
        now = now.coalesce(1) if few else now
        now = cut_lineage(_small(_large(now, few).distinct(), few).distinct())
        row = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(row) == state:
            break
        state = tuple(row)
    # At rest every edge goes from a node to its root.
    now = now.coalesce(1) if few else now
    return now.selectExpr("inline(array(struct(u as node, v as root), struct(v as node, v as root)))").distinct()
