"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hot_keys, skewed_join, written


def _mark(edges: DataFrame) -> tuple:
    """A value that changes with the set of edges, without bringing edges to the driver."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _starred(edges: DataFrame, neighbours: DataFrame) -> DataFrame:
    """For each (a, v) of ``neighbours``: v with the least of a and a's neighbours."""
    least = written(
        neighbours.groupBy("a").agg(F.min("b").alias("least"), F.count(F.lit(1)).alias("degree")), "star-least"
    )
    hot = hot_keys(least, ["a"], "degree", max(1, edges.count()))
    return skewed_join(neighbours, least.select("a", F.least("a", "least").alias("least")), ["a"], hot)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of the nodes in edges (a, b) of longs; the component is its least node.

    Each round is written to the shared folder; a node of very many edges is pre-aggregated and
    joined by broadcast, so it is never one task's work. The rounds grow with the logarithm of
    the longest path.
    """
    edges = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while (now := _mark(edges)) != before:
        before = now
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = (
            _starred(edges, both)
            .where("b > a and b <> least")
            .select(F.col("b").alias("a"), F.col("least").alias("b"))
            .distinct()
        )
        large = written(large, "large-star")
        small = _starred(large, large)
        edges = written(
            small.where("b <> least")
            .select("b", "least")
            .unionByName(small.select(F.col("a").alias("b"), "least"))
            .select(F.col("b").alias("a"), F.col("least").alias("b"))
            .distinct(),
            "small-star",
        )
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
