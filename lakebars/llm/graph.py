"""Connected components of an edge table, by alternating large-star and small-star steps.

Every step is a keyed minimum (combined before the shuffle) and a join on
the same key, so a hub with very many edges is split by the skew join.  The
edges of each round are written to the shared work folder: lineage is cut
and a lost executor costs no earlier round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakebars.llm.common import materialize


def _signature() -> list:
    """Observed while a round is written: the number of edges and a sum over them."""
    return [F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")]


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    joined = both.join(least, "u").select("u", "v", F.least("u", "m").alias("m"))
    return joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for every node that is not the smallest of its component.

    ``edges`` holds pairs of longs in any order, repeats and self-loops
    allowed; NULL ends are ignored.  The loop ends when a round changes
    nothing; then every edge points to the smallest node of its component.
    """
    first = (edges.where(F.col(a) != F.col(b))
             .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    current, seen = materialize(first, "edges", _signature())
    while seen["n"]:
        after, now = materialize(_small_star(_large_star(current)), "edges", _signature())
        if (now["n"], now["h"]) == (seen["n"], seen["h"]):
            break
        current, seen = after, now
    return current.select(F.col("u").alias("node"), F.col("v").alias("root"))
