"""Connected components of an undirected graph by alternating large and small stars.

Each round hooks every node to the least neighbour it knows and costs two aggregations and
two joins; the number of rounds grows with the logarithm of the longest path.  Neighbour
lists are never gathered and minima are partial aggregates, but the join of edges with a node's
least neighbour takes all edges of that node in one task (a sort-merge join, which spills).
Callers hand on forests and stars by distinct texts, which keeps such hubs rare.  Rounds are cut by
tables in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duskwatch.sources.staging import stage


def _hook(edges: DataFrame, both_ways: bool) -> DataFrame:
    """Large star (``both_ways``) or small star over edges (a, b) with a > b."""
    directed = edges.union(edges.select(F.col("b"), F.col("a"))) if both_ways else edges
    least = directed.groupBy("a").agg(F.min("b").alias("least"))
    least = least.select("a", F.least("a", "least").alias("least"))
    known = directed.join(least, "a")
    if both_ways:
        moved = known.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        moved = known.select(F.col("b").alias("a"), F.col("least").alias("b")).union(
            least.select("a", F.col("least").alias("b"))
        )
    return moved.where("a > b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); the root is the component's least node.

    Loops, repeated edges and either direction are fine; nulls are left out; no edges, no rows.
    """
    tidy = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    current = stage(tidy.where("a > b").distinct(), "edges")
    seen = None
    while True:
        mark = current.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))
        ).first()
        if tuple(mark) == seen or not mark[0]:
            break
        seen = tuple(mark)
        current = stage(_hook(_hook(current, True), False), "edges")
    # every node but a root now has one edge, to its root
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
