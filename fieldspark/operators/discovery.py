"""Breadth-first discovery in a bipartite graph of teams and fixtures, a join for each level."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldspark.sources.sinks import written


def reachable(edges: DataFrame, seeds: DataFrame, levels: int | None = None) -> DataFrame:
    """(node, level) of every node that ``edges`` (a, b; both ways) reach from ``seeds`` (node), with the least level.

    One join and one anti-join a level; the visited nodes are written to the shared folder, so that plans don't grow with
    the levels and lost executors cost one level. Nodes without edges, and null ones, reach nothing.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a is not null and b is not null").distinct()
    cut = lambda df: written(df, "reached")
    both = cut(both)
    seen = cut(seeds.select("node", F.lit(0).alias("level")).where("node is not null").distinct())
    frontier, level = seen, 0
    while levels is None or level < levels:
        level += 1
        found = frontier.join(both, frontier["node"] == both["a"]).select(F.col("b").alias("node")).distinct()
        frontier = cut(found.join(seen.select("node"), "node", "left_anti").withColumn("level", F.lit(level)))
        if frontier.isEmpty():
            break
        seen = cut(seen.unionByName(frontier))
    return seen
