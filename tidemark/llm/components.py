"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is linked to the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _is_forest(edges: DataFrame) -> bool:
    """Every node hangs on one root, and no root hangs on another node."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("below"), F.lit(0).alias("above")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("below"), F.lit(1).alias("above")))
    nodes = ends.groupBy("node").agg(F.sum("below").alias("below"), F.max("above").alias("above"))
    return nodes.agg(F.count_if((F.col("below") > 1) | ((F.col("below") > 0) & (F.col("above") > 0)))).first()[0] == 0


def components(links: DataFrame, a: str, b: str, name: str = "components") -> DataFrame:
    """``node, root`` for every node of the links but the roots; a root is the smallest node of its component.

    Links are rows (a, b) in any order and number. Each step is a fixed number of shuffles of rows
    (node, node), and each pair of steps is written without repeated rows, so that lineage stays short. Stars shrink, so the
    number of steps grows with the logarithm of the longest chain.
    """
    edges = links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    while True:
        edges = stage(_small_star(_large_star(edges)), name)
        if _is_forest(edges):
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
