"""Connected components of undirected links, as the smallest id that each node reaches.

Large-star and small-star rounds: each replaces links by links to the smallest neighbour, so that the
number of rounds is about the logarithm of the longest path. Links of a node are aggregated, not
gathered. Every round is a written table in the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.session import written


def components(links: DataFrame) -> DataFrame:
    """``id, component`` of every node that has a link to another; ``links`` has ``a`` and ``b``."""
    edges = written(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while True:
        # Large star: every larger neighbour of a node is linked to the node's smallest one.
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        # Small star: smaller neighbours and the node itself are linked to the smallest of them.
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("low").alias("b"))
        after = written(small.where("a <> b").distinct(), "links")
        if _sum(after) == _sum(edges):
            return after.select(F.col("a").alias("id"), F.col("b").alias("component"))
        edges = after


def _sum(edges: DataFrame) -> tuple:
    """Number and combined hash of all links, to see whether a round changed any."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first())
