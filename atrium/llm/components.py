"""Connected components of a graph of ids, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atrium.llm.common import broadcast_if_small, materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for each node of `edges` (a, b): component is the least id reachable.

    Each round is two star operations. Least neighbours are found with a map-side combine and written; they
    are broadcast if they are few by count, and else both sides of the join are shuffled for it alone, so that
    adaptive execution can split a node with very many neighbours. Every step is written to the shared
    folder. Self-loops and repeated edges are harmless; no edges give no rows.
    """
    now = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
        # Large star: every larger neighbour of a node is tied to the node's least neighbour.
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = materialize(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
        tied = both.where("b > a").join(broadcast_if_small(least), "a")
        large = materialize(tied.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct(), "large-star")
        # Small star: a node's smaller neighbours and itself are tied to the least of them.
        least = materialize(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        tied = large.join(broadcast_if_small(least), "a")
        small = tied.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        now = materialize(small.distinct(), "edges")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
