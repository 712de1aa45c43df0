"""Connected components by alternating large-star and small-star steps.

Each step replaces the edges by edges to the smallest neighbour, so paths shorten until every node
points at the smallest node of its component. The minimum of a neighbourhood is summed up before
the shuffle, so a node with millions of neighbours is no hot task, and edges stay in Spark: each
round is written to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwright.staging import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node points at the smallest node of its neighbourhood."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    joined = both.join(least, "a").filter("b > a")
    return joined.select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours point at the smallest of them. Edges run from large to small."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    joined = edges.join(least, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return joined.union(least.select("a", F.col("m").alias("b"))).distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (two long columns ``a, b``) that is not itself the root.

    ``root`` is the smallest node that is reachable. Repeated edges and loops are allowed; null ends
    are not links. No edges, no rows. The number of rounds is about the logarithm of the longest path.
    """
    ordered = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"), (F.col("a") == F.col("b")).alias("loop"))
    current = stage(ordered.filter("not loop").select("a", "b").distinct(), "edges")
    before = _state(current)
    while before[0]:
        current = stage(_small_star(stage(_large_star(current), "large-star")), "small-star")
        after = _state(current)
        if after == before:
            break
        before = after
    return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
