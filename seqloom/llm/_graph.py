"""Connected components by alternating large-star and small-star steps, each written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import Workspace


def _is_done(edges: DataFrame) -> bool:
    """Whether every node points to one other at most, and nodes that are pointed at don't point."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("points"), F.lit(0).alias("pointed")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("points"), F.lit(1).alias("pointed"))
    )
    seen = ends.groupBy("node").agg(F.sum("points").alias("points"), F.max("pointed").alias("pointed"))
    return seen.filter("points > 1 or (points = 1 and pointed = 1)").isEmpty()


def components(links: DataFrame, ws: Workspace, name: str) -> DataFrame:
    """(node, label): each node of ``links`` (a, b) with the smallest node it is connected to. Nodes may be of any ordered type.

    Every step is distributed, and a node's neighbours are never gathered: only their minimum is, which is aggregated before the
    shuffle. Steps end when the links form stars, which links to a few centres do at once.
    """
    edges = ws.save(
        links.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{name}-0"
    )
    step = 0
    while not _is_done(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("m", "a").alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(low, "a")
        small = (
            joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(joined.select("a", F.col("m").alias("b")))
            .filter("a != b")
            .distinct()
        )
        step += 1
        edges = ws.save(small, f"{name}-{step}")
        ws.drop(f"{name}-{step - 1}")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
