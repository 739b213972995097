"""Connected components of a graph held in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopweave.session import stored


def _directed(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's least neighbour."""
    both = _directed(edges)
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of these."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    rest = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.union(least.select("u", F.col("m").alias("v")))


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for each node of ``edges(u, v)``; the root is the least node reachable.

    Large and small stars take turns until nothing changes. Each turn is a
    stored table, so a lost executor costs one turn; minima are merged before
    the shuffle, and joins on a node with very many edges can be split. Loops
    and repeated edges do no harm; no edges give no rows.
    """
    current = stored(edges.where("u <> v").select("u", "v").distinct())
    before = None
    while True:
        current = stored(_small_star(_large_star(current)).where("u <> v").distinct())
        state = current.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if state == before or not state[0]:
            break
        before = state
    nodes = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.union(current.select(F.col("v"), F.col("v")).distinct())
