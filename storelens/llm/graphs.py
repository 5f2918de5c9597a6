"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.llm.frames import stored

JUMPS = 2  # pointer jumps in a round


def components(edges: DataFrame) -> DataFrame:
    """Columns `node` and `root`, the smallest node of its component, for every node of an edge.

    `edges` has the columns a and b (bigint). Each round points every node to its smallest
    neighbour, follows the pointers, and replaces the edges by those between the nodes pointed to.
    The rounds grow with the logarithm of the graph; a star takes one. Every round's tables are
    written to the shared folder, so a lost executor costs its tasks only.
    """
    ordered = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    edges = stored(ordered.distinct(), "edges")
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    roots = nodes.withColumn("root", F.col("node"))
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        pointer = stored(least.select(F.col("a").alias("v"), F.least("a", "m").alias("p")), "pointers")
        for _ in range(JUMPS):
            further = pointer.select(F.col("v").alias("p"), F.col("p").alias("q"))
            pointer = pointer.join(further, "p").select("v", F.col("q").alias("p"))
        pointer = stored(pointer, "pointers")
        roots = roots.join(pointer, F.col("root") == F.col("v"), "left")
        roots = stored(roots.select("node", F.coalesce("p", "root").alias("root")), "roots")
        for end in ("a", "b"):
            edges = edges.join(pointer.withColumnRenamed("v", end), end).drop(end).withColumnRenamed("p", end)
        edges = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        edges = stored(edges.distinct(), "edges")
    return roots
