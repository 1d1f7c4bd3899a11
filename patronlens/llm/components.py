"""Connected components of a graph given by its edges, as repeated joins and groupings.

Each round points every node at the smallest neighbour of its neighbours (large star,
then small star), which needs a number of rounds that grows with the logarithm of the
longest chain. A node with very many neighbours is safe: its neighbours are only ever
reduced to a minimum, which combines before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronlens.workspace import stage

MAX_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return (
        both.join(least, "a")
        .where(F.col("b") > F.col("a"))
        .select(F.col("b").alias("a"), F.col("least").alias("b"))
        .where("a <> b")
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    moved = (
        down.join(least, "a")
        .where(F.col("b") != F.col("least"))
        .select(F.col("b").alias("a"), F.col("least").alias("b"))
    )
    return moved.union(least.select("a", F.col("least").alias("b"))).where("a <> b").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges(a, b)``; the component is its smallest node.

    Edges without nulls; self links are ignored. Every round is written to the shared
    scratch folder, so lineage stays short and a lost executor costs one round at most.
    """
    current = stage(edges.where("a <> b").select("a", "b").distinct(), "components")
    before = None
    for _ in range(MAX_ROUNDS):
        current = stage(_small_star(_large_star(current)), "components")
        # The order-free digest of a finished round equals that of the round before.
        state = current.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if state == before:
            return _stars(current)
        before = state
    raise RuntimeError("components did not settle")


def _stars(edges: DataFrame) -> DataFrame:
    """At the end every edge points from a node to the least node of its component."""
    leaves = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return leaves.union(roots)
