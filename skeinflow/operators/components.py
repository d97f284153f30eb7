"""Connected components by alternating large-star and small-star rounds over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..plans.storage import remove, written

MAX_ROUNDS = 60


def edge_components(edges: DataFrame, rows: int | None = None) -> tuple[DataFrame, str]:
    """(v, u) for all nodes in columns a and b of ``edges``: u is the smallest node reachable from v.

    Each step is a table in the shared folder, so a lost executor costs one step at most; the loop
    ends when every component is a star about its smallest node, and fails loudly at ``MAX_ROUNDS``.  Self
    loops and repeated edges are harmless.  ``rows`` may bound the rows of ``edges``.  The second value is the
    result's folder, for the caller to remove.
    """
    spark = edges.sparkSession
    now, path, n = _edges(edges.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).filter("u < v"), rows)
    for _ in range(MAX_ROUNDS):
        both = now.unionByName(now.select(F.col("u").alias("v"), F.col("v").alias("u")))
        # the least neighbours are written first: a hub has all its edges under one key, and Spark splits such a
        # join only between plain exchanges, not after an aggregate of its key
        least = both.groupBy("v").agg(F.least("v", F.min("u")).alias("m"), F.count(F.lit(1)).alias("n"))
        seen = Observation()
        low, low_at = written(least.observe(seen, F.count_if((F.col("m") < F.col("v")) & (F.col("n") > 1)).alias("tied")), "least", "lz4", 2 * n)
        if not seen.get["tied"]:  # each node that has a smaller neighbour has no other: stars only
            remove(spark, low_at)
            return now, path
        large = both.filter("u > v").join(low.select("v", "m").hint("merge"), "v").select(F.col("u").alias("v"), F.col("m").alias("u"))
        large, large_at, n = _edges(large, 2 * n)
        below, below_at = written(large.groupBy("v").agg(F.min("u").alias("m"), F.count(F.lit(1)).alias("n")), "least", "lz4", n)
        # a node of one smaller neighbour keeps its edge; only the others are joined
        few = below.filter("n = 1").select("v", F.col("m").alias("u"))
        many = large.join(below.filter("n > 1").select("v", "m").hint("merge"), "v")
        small = many.filter("u > m").select(F.col("u").alias("v"), F.col("m").alias("u")).unionByName(many.select("v", F.col("m").alias("u")))
        step, new, n = _edges(few.unionByName(small), 2 * n)
        remove(spark, path, low_at, large_at, below_at)
        now, path = step, new
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")


def _edges(edges: DataFrame, rows: int | None) -> tuple[DataFrame, str, int]:
    """Distinct edges as a table, its folder, and their number."""
    seen = Observation()
    made, path = written(edges.distinct().observe(seen, F.count(F.lit(1)).alias("n")), "edges", "lz4", rows)
    return made, path, seen.get["n"]


def connected_components(nodes: DataFrame, edges: DataFrame, node: str = "node") -> DataFrame:
    """(node, component) for every row of ``nodes``; component is the smallest node reachable over edges (a, b).

    The result is a table, and all others that led to it are removed.
    """
    found, path = edge_components(edges)
    named = nodes.join(found.select(F.col("v").alias(node), F.col("u").alias("component")), node, "left")
    result, _ = written(named.withColumn("component", F.coalesce("component", node)), "components")
    remove(nodes.sparkSession, path)
    return result
