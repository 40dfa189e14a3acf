"""Connected components by rounds of contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.llm.shared import checkpoint


def components(edges: DataFrame) -> DataFrame:
    """``id`` and ``component``, the smallest id, for every end of the edges (a, b).

    In each round every node joins its neighbour of the lowest hash, which another seed draws anew,
    so the number of nodes falls by a fixed share however the ids are ordered. Nothing but the
    number of edges left is sent to the driver.
    """
    edges = checkpoint(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    nodes, turn, rounds = None, 0, []
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        drawn = lambda c: F.struct(F.xxhash64(F.lit(turn), c).alias("h"), c.alias("to"))
        lowest = both.groupBy(F.col("a").alias("id")).agg(F.min(drawn(F.col("b"))).alias("n"))
        lowest = checkpoint(lowest.select("id", F.least(F.col("n"), drawn(F.col("id")))["to"].alias("to")))
        rounds.append(lowest)
        left = edges.join(lowest.select(F.col("id").alias("a"), F.col("to").alias("x")), "a")
        left = left.join(lowest.select(F.col("id").alias("b"), F.col("to").alias("y")), "b").where("x <> y")
        edges = checkpoint(left.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
        turn += 1
    if not rounds:
        return edges.select(F.col("a").alias("id"), F.col("a").alias("component")).limit(0)
    nodes = rounds[0]
    for later in rounds[1:]:
        step = later.select(F.col("id").alias("to"), F.col("to").alias("next"))
        nodes = nodes.join(step, "to", "left").select("id", F.coalesce("next", "to").alias("to"))
    nodes = checkpoint(nodes)
    least = nodes.groupBy("to").agg(F.min("id").alias("component"))
    return nodes.join(least, "to").select("id", "component")
