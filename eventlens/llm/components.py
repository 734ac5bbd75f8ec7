"""Connected components of an edge table by alternating stars.

A round joins every node's larger neighbours, then its smaller ones, to the least node
around it, until no edge changes. A node with very many edges is one row per task in the
minimum, and its edges are the split side of a skewed join.
"""

from pyspark.sql import DataFrame, functions as F

from eventlens.session import materialize


def _starred(edges: DataFrame, larger: bool) -> DataFrame:
    """(a, b), a > b: one star round."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if larger else edges
    least = both.groupBy(F.col("a").alias("_a")).agg(F.min("b").alias("_m")).withColumn("_m", F.least("_m", "_a"))
    around = both.join(least, F.col("a") == F.col("_a"))
    if larger:
        made = around.filter("b > a").select(F.col("b").alias("a"), F.col("_m").alias("b"))
    else:
        made = around.select(F.col("b").alias("a"), F.col("_m").alias("b")).unionByName(
            least.select(F.col("_a").alias("a"), F.col("_m").alias("b")))
    return made.filter("a > b").distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether every node has one edge to a node that has none."""
    ends = edges.select(F.col("a").alias("v"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionByName(
        edges.select(F.col("b").alias("v"), F.lit(0).alias("down"), F.lit(1).alias("up")))
    nodes = ends.groupBy("v").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return nodes.filter((F.col("down") > 1) | ((F.col("down") > 0) & (F.col("up") > 0))).isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of the edges (a, b) but the roots themselves; the root is
    the least node of the component."""
    edges = materialize(edges.select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct(), "edges")
    while not _settled(edges):
        edges = materialize(_starred(_starred(edges, True), False), "edges")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
