"""Connected components of an edge table, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.sources.staging import Stages, stage


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's least neighbour (or itself)."""
    around = _both_ways(edges)
    least = around.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return around.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are tied to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    tied = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """node and root, the least node of its component, for every node of an edge (u, v of type long).

    Each round is written to shared storage, so lineage stays short and a lost
    executor repeats one round at most; the round before is then released. The rounds end when the edges no longer
    change: they are then stars around the roots. Self-loops and NULL ends are
    dropped; an empty table gives an empty result.
    """
    held, seen = Stages(), None
    with held.open():
        current = stage(edges.where("u <> v").select("u", "v").distinct(), name)
    while True:
        mark = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark:
            break
        seen = mark
        fresh = Stages()
        with fresh.open():
            current = stage(_small_star(_large_star(current)), name)
        held.release()
        held = fresh
    held.hand_over()
    nodes = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionByName(current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
