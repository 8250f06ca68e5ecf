"""Connected components of an edge table by alternating star contraction.

Each round hangs neighbours on the smallest node seen, first larger neighbours,
then smaller ones; the number of rounds grows with the logarithm of the longest
path. A hot node is one row in the aggregate of its minimum and a join key that
Spark may split. Every round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pricewright.staging import staged


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _larger(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node goes to the smallest node of the neighbourhood."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").where(F.col("v") > F.col("u")).select(
        F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _smaller(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, go to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where(F.col("v") != F.col("m")).select(
        F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``u, v`` edges to ``node, component``: the smallest node reachable. Self-edges and null ends are ignored.

    Nodes without an edge, and empty tables, give no row.
    """
    edges = staged(edges.where("u != v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state = _state(edges)
    while state[0]:
        edges = staged(_smaller(_larger(edges)), "edges")
        state, last = _state(edges), state
        if state == last:
            break
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
