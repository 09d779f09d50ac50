"""Shared Spark frames for the registered queries."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from mendstream.operators import timeseries as TS
from mendstream.plans import fixtures as X
from mendstream.plans.detect import aligned_windows
from mendstream.session import reuse


def grid(spark, sf) -> DataFrame:
    return aligned_windows(X.telemetry(spark, sf), X.BIN, X.WINDOW)


def split(spark, sf) -> DataFrame:
    return TS.baseline_split(grid(spark, sf))


def kept(spark, sf) -> DataFrame:
    """The split frame written once, for queries that read it in several branches."""
    return reuse(split(spark, sf))


def plain(df: DataFrame) -> DataFrame:
    """The aligned frame's own columns."""
    return df.select(*TS.WIN, "t", "row", "series", "v")


def anchors(df: DataFrame) -> DataFrame:
    """Row after the baseline with the largest error-rate value, per window."""
    best = F.row_number().over(W.partitionBy(*TS.WIN).orderBy(F.desc("v"), "row", "series"))
    return (
        df.where(~F.col("is_baseline") & F.col("series").contains("error")).withColumn("_r", best).where("_r = 1")
        .select(*TS.WIN, F.col("row").alias("anomaly_row"), F.col("t").alias("anchor_t"))
    )


def rounded(df: DataFrame, *cols: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in cols})
