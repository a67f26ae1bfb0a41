"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.session import Scratch


def _digest(links: DataFrame) -> tuple:
    """Order-free summary of a set of links."""
    h = F.xxhash64("u", "v")
    return tuple(links.agg(F.count("*"), F.sum(h.bitwiseAND(F.lit((1 << 31) - 1))), F.bit_xor(h)).first())


def _large_star(links: DataFrame) -> DataFrame:
    """Tie each larger neighbour of a node to the smallest of the node and its neighbours."""
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    """Tie a node and its smaller neighbours to the smallest of them; every link here has ``u > v``."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """``(node, component)`` for every node in ``links(u, v)``; the component is its smallest node.

    Each step is joins and grouped minima over links, written before the next; nothing of it reaches the driver but a
    count and a checksum. Ends when a round changes no link, after about log(nodes) rounds. Nulls and loops are ignored.
    """
    ordered = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    current = scratch.table(ordered.where("u > v").distinct(), "links")
    before = None
    while (now := _digest(current)) != before and now[0]:
        before = now
        large = scratch.table(_large_star(current).where("u > v").distinct(), "large-star")
        current = scratch.table(_small_star(large).where("u > v").distinct(), "small-star")
    nodes = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
