"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """links(a, b) -> (node, root): each linked node with the smallest node it reaches, roots included.

    Every step is a group minimum and an equi-join, so a node with very many neighbours is pre-aggregated and its rows
    may be split by the skew join; nothing is gathered. Rounds grow with the logarithm of the number of nodes.
    """
    edges = links.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = materialize(edges, "cc-links")
    seen = None
    for _ in range(max_rounds):
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        linked = large.join(lower, "u")
        small = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(linked.select("u", F.col("m").alias("v")))
        edges = materialize(small.filter("u != v").distinct(), "cc-links")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError(f"no convergence in {max_rounds} rounds")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
