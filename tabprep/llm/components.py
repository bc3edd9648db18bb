"""Connected components by alternating stars, with DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.session import reliable_checkpoint


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest node next to it."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    joined = both.join(least, "u").where("v > u")
    return joined.select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the smallest one."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _signature(edges: DataFrame) -> tuple:
    h = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count("*"), F.sum(F.shiftright(h, 24)), F.bit_xor(h)).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of ``edges(u, v)``; the label is the smallest node reachable.

    Rows with a null end or two equal ends link nothing and are left out. Each round leaves
    a graph with the same components and at most as many edges, so a hub costs rows of its
    own degree and no more; joins on a hub are ones that adaptive execution can split. Every
    round is cut by a checkpoint in the shared folder. An empty frame gives an empty frame.
    """
    now = edges.where("u is not null and v is not null and u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )
    now = reliable_checkpoint(now.distinct())
    before = _signature(now)
    while before[0]:
        now = reliable_checkpoint(_small_star(_large_star(now)))
        after = _signature(now)
        if after == before:
            break
        before = after
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots)
