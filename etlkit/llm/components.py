"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from etlkit.operators.reuse import staged


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``id, root`` for every id of ``links``; the root is the smallest id of the component.

    Each round moves links towards the smallest neighbour: first every node hangs its larger
    neighbours onto it, then its smaller ones. Smallest neighbours are aggregated before the
    shuffle and joined back, so a node with very many links is never gathered. A round ends in
    a table in the shared folder, until all links are stars; the number of rounds grows with
    the logarithm of the longest chain. Runs a few jobs per round.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u != v").distinct()
    edges = staged(edges, "links")
    while not _stars(edges):
        both = edges.union(edges.select("v", "u"))
        smallest = both.groupBy("u").agg(F.min("v").alias("m"))
        hung = both.filter("v > u").join(smallest, "u").select(
            F.col("v").alias("u"), F.least("u", "m").alias("v")).filter("u != v").distinct()
        smallest = hung.groupBy("u").agg(F.min("v").alias("m"))
        small = hung.join(smallest, "u")
        edges = staged(
            small.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(smallest.select("u", "m")).distinct(), "links")
    return edges.select(F.col("u").alias("id"), F.col("v").alias("root")).union(
        edges.select(F.col("v"), F.col("v")).distinct())


def _stars(edges: DataFrame) -> bool:
    """Whether every node has one smaller neighbour, which has none itself.

    Counts, per node, its links downwards and whether one comes from above.
    """
    ends = edges.select("u", F.lit(1).alias("down"), F.lit(0).alias("up")).union(
        edges.select("v", F.lit(0), F.lit(1)))
    counted = ends.groupBy("u").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return counted.filter((F.col("down") > 1) | ((F.col("down") > 0) & (F.col("up") > 0))).isEmpty()
