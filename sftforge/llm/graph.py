"""Connected components as DataFrame rounds of large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sftforge.llm.common import materialize


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` of longs -> ``(node, root)``, one row per node that has an edge.

    ``root`` is the smallest node of the component.  Each round joins the edges
    with the smallest neighbour of each node (aggregated before the shuffle, so a
    hub costs one row a task) and is written to the shared checkpoint folder;
    the rounds grow with the logarithm of the longest path.
    """
    edges = materialize(edges.where("a <> b").selectExpr("greatest(a, b) AS a", "least(a, b) AS b").distinct(), "edges")
    before = _state(edges)
    while before[0]:
        # Large star: larger neighbours of a node move to its smallest neighbour.
        both = edges.unionByName(edges.selectExpr("b AS a", "a AS b"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (both.where("b > a").join(least, "a").where("b <> m").selectExpr("b AS a", "m AS b").distinct())
        # Small star: smaller neighbours and the node itself move to the smallest of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(least, "a")
        edges = materialize(moved.where("b <> m").selectExpr("b AS a", "m AS b")
                            .unionByName(least.selectExpr("a", "m AS b")).distinct(), "edges")
        after = _state(edges)
        if after == before:
            break
        before = after
    roots = edges.groupBy("a").agg(F.min("b").alias("root"))
    return roots.selectExpr("a AS node", "root").unionByName(
        roots.selectExpr("root AS node", "root").distinct())
