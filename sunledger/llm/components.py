"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunledger.llm.common import Stage


def components(links: DataFrame, stage: Stage, name: str) -> DataFrame:
    """``node, component`` (the smallest node reachable) of every node of ``links`` (``a, b`` long).

    A step links each node's neighbours to the smallest of them, by joins, so that no neighbourhood is gathered anywhere;
    the steps are staged and end when one changes nothing.  Their number grows with the logarithm of the nodes.
    """

    def turned(edges: DataFrame, large: bool) -> DataFrame:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        met = both.join(least, "a")
        out = met.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")) if large else met.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        return out.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    def digest(edges: DataFrame) -> tuple:
        return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_003)).head())

    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges, before, step = stage.save(edges, f"{name}-0"), None, 0
    while (now := digest(edges)) != before:
        before, step = now, step + 1
        edges = stage.save(turned(turned(edges, True), False), f"{name}-{step}")
        stage.drop(f"{name}-{step - 1}")
    pairs = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return pairs.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
