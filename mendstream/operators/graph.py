"""The dependency graph of services: what each depends on, and the connected part it belongs to."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from mendstream.session import reuse


def connected(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, part) for every node of ``edges``: ``part`` is the least node that it is connected with.

    In each round a node takes the least label among itself and its neighbours, then the label of that label, so long chains shrink fast.
    """
    pairs = edges.select(F.col(a).alias("node"), F.col(b).alias("other")).where("node is not null and other is not null")
    pairs = reuse(pairs.unionByName(pairs.select(F.col("other").alias("node"), F.col("node").alias("other"))).distinct())
    label = reuse(pairs.groupBy("node").agg(F.least(F.min("other"), F.first("node")).alias("part")))
    while True:
        near = pairs.join(label.withColumnRenamed("node", "other"), "other").groupBy("node").agg(F.min("part").alias("near"))
        step = label.join(near, "node").select("node", F.least("part", "near").alias("part"))
        jump = label.select(F.col("node").alias("part"), F.col("part").alias("far"))
        new = reuse(step.join(jump, "part").select("node", F.least("part", "far").alias("part")))
        if new.join(label, ["node", "part"], "left_anti").isEmpty():
            return new
        label = new


def service_parts(edges: DataFrame) -> DataFrame:
    """service, part, depends (sorted array) of every service that an edge (``service, depends_on``) names."""
    depends = edges.where("service is not null").groupBy("service").agg(F.array_sort(F.collect_set("depends_on")).alias("depends"))
    parts = connected(edges, "service", "depends_on").withColumnRenamed("node", "service")
    return parts.join(depends, "service", "left").select("service", "part", F.coalesce("depends", F.array().cast("array<string>")).alias("depends"))
