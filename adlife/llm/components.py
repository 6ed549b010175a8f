"""Connected components of an edge table, by alternating star contraction.

Each round first links every node's larger neighbours to its smallest
neighbour, then every node's smaller neighbours; node degrees shrink and the
table ends as one star per component. Rounds grow with the logarithm of the
longest path. Every round deals its edges out by one end, by the other and for
the repeats, and is written to the shared folder. Rounds end when all nodes are
the least of their neighbours or have one neighbour only; the number of other
nodes is all that reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adlife.llm.common import materialized


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """``edges``: (u, v) with u > v. Rows may repeat in the result."""
    linked = (_both(edges) if large else edges.select("u", "v")).withColumn(
        "m", F.least(F.min("v").over(Window.partitionBy("u")), F.col("u")))
    if large:
        out = linked.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        # the node itself is linked to its smallest neighbour by that neighbour's row
        out = linked.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
    return out.where(F.col("u") != F.col("v"))


def _all_stars(edges: DataFrame) -> bool:
    """Whether every node of the distinct ``edges`` is the least of its neighbours or has one neighbour only."""
    nodes = _both(edges).groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
    return not nodes.where("m < u and n > 1").agg(F.count(F.lit(1))).first()[0]


def stars(edges: DataFrame) -> DataFrame:
    """Written (node, root) of every node in ``edges`` (columns a, b) but the roots: root is the least node of its component.

    Self-loops, repeats and null ends are ignored.
    """
    edges = edges.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = materialized(edges, "edges")
    while not _all_stars(edges):
        edges = materialized(_star(_star(edges, large=True), large=False).distinct(), "edges")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node in ``edges`` (columns a, b), roots too. Nodes without an edge are absent."""
    found = stars(edges)
    return found.unionByName(found.select(F.col("root").alias("node"), "root").distinct())
