"""Exact percentiles of groups of any size, without a list of a group."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from mendstream.operators.scans import join_same


def exact_percentile(df: DataFrame, keys: list[str], col: str, q: float, out: str, width: float = 1.0) -> DataFrame:
    """``keys`` and the interpolated ``q`` percentile of ``col`` (0 <= q <= 1), as ``percentile`` gives it; null where a group has no value.

    Rows are counted by slots of ``width``, summed before the shuffle; only the distinct values of the one or two slots that hold the deciding ranks
    are then put in order. A null key is a group of its own.
    """
    d = df.select(*keys, F.col(col).cast("double").alias("_x")).withColumn("_slot", F.floor(F.col("_x") / width))
    groups = d.select(*keys).distinct()
    slots = d.where("_x is not null").groupBy(*keys, "_slot").agg(F.count("*").alias("_c"))
    group, up = W.partitionBy(*keys), W.partitionBy(*keys).orderBy("_slot").rowsBetween(W.unboundedPreceding, -1)
    at = q * (F.sum("_c").over(group) - 1)
    slots = slots.withColumn("_first", F.coalesce(F.sum("_c").over(up), F.lit(0))).withColumn("_at", at)
    low, high = F.floor("_at"), F.ceil("_at")
    end = F.col("_first") + F.col("_c")
    hit = slots.where(((F.col("_first") <= low) & (low < end)) | ((F.col("_first") <= high) & (high < end))).select(*keys, "_slot", "_first", "_at")
    values = join_same(d.where("_x is not null"), hit, [*keys, "_slot"]).groupBy(*keys, "_slot", "_first", "_at", "_x").agg(F.count("*").alias("_n"))
    inside = W.partitionBy(*keys, "_slot").orderBy("_x").rowsBetween(W.unboundedPreceding, 0)
    values = values.withColumn("_stop", F.col("_first") + F.sum("_n").over(inside)).withColumn("_start", F.col("_stop") - F.col("_n"))
    pick = lambda rank: F.max(F.when((F.col("_start") <= rank) & (rank < F.col("_stop")), F.col("_x")))
    ends = values.groupBy(*keys, "_at").agg(pick(F.floor("_at")).alias("_l"), pick(F.ceil("_at")).alias("_h"))
    ends = ends.withColumn(out, F.col("_l") + (F.col("_at") - F.floor("_at")) * (F.col("_h") - F.col("_l")))
    return join_same(groups, ends.select(*keys, out), keys, "left")
