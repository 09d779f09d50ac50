"""Connected components of an edge table, without holding a component anywhere."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from mendstream.llm.common import reuse


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b): the label is the least node of its component.

    Alternates two steps until nothing changes: every node hands its larger neighbours to its least neighbour, then its
    smaller ones. Each step is a grouped minimum, summed before the shuffle, and a join whose hot keys may be split; the number of
    rounds grows with the logarithm of the longest path.
    """
    edges = reuse(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = both.join(_least(both), "a").where("b > a and b <> low").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        large = large.where("a <> b")
        small = large.join(_least(large), "a")
        edges = reuse(
            small.where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
            .unionByName(small.select("a", F.col("low").alias("b")))
            .where("a <> b").distinct()
        )
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.countDistinct("a")).first()
        if tuple(state) == before:
            break
        before = tuple(state)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("label"))).distinct()
