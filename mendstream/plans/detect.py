"""Detection from points to the first anomaly of each window."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from mendstream import fixed
from mendstream.functions.scalars import series_name
from mendstream.operators import detectors as D, timeseries as TS
from mendstream.plans.fixtures import SERVICES
from mendstream.session import reuse

WIN = TS.WIN


def aligned_windows(points: DataFrame, width: int, window: int, services: list[str] = SERVICES) -> DataFrame:
    named = points.withColumn("series", series_name(F.col("service"), F.col("signal_name"), services))
    # the bins are read three times; written once, the points are read once
    return TS.align_series(reuse(TS.bin_points(named, width, window)))


def trigger_metric(df: DataFrame, anchors: DataFrame, services: DataFrame | None = None) -> DataFrame:
    """Series (of the window's ``target_service`` if given) that deviates most at the anomaly row.

    Series with no spread in the baseline are left out; the first name wins a tie.
    """
    base = F.when(F.col("is_baseline"), F.col("v"))
    now = F.max(F.when(F.col("row") == F.col("anomaly_row"), F.col("v")))
    d = df.join(anchors.select(*WIN, "anomaly_row"), WIN)
    if services is not None:
        d = d.join(services, WIN).where(F.col("series").startswith(F.col("target_service")))
    per = d.groupBy(*TS.SERIES).agg(F.avg(base).alias("mean"), F.stddev_samp(base).alias("std"), now.alias("trigger_value"))
    per = per.where("std > 0").withColumn("dev", F.abs(F.col("trigger_value") - F.col("mean")) / F.col("std")).where("dev > 0")
    best = F.row_number().over(W.partitionBy(*WIN).orderBy(F.desc("dev"), "series"))
    return per.withColumn("_r", best).where("_r = 1").select(*WIN, F.col("series").alias("trigger_metric"), "trigger_value", "dev")


def first_anomalies(points: DataFrame, width: int, window: int, detector: str | None = "bocpd", kpi_limit: float = fixed.EWMA_THRESHOLD) -> DataFrame:
    """One row per window: first flagged row after the live baseline (-1 if none), severity and trigger metric."""
    df = reuse(TS.baseline_split(TS.clean_non_finite(aligned_windows(points, width, window))))
    flags = reuse(D.detect(df, detector, max_rows=window // width, kpi_limit=kpi_limit))
    start = df.groupBy(*WIN).agg(F.min("baseline_len").alias("search_start"))
    found = TS.first_detection(flags, start)
    at = flags.select(*WIN, F.col("row").alias("anomaly_row"), "t", "score")
    hits = found.join(at, [*WIN, "anomaly_row"], "left")
    return hits.join(trigger_metric(df, found), WIN, "left").select(
        *WIN, "anomaly_row", "t", "n_flagged",
        F.when(F.col("anomaly_row") >= 0, D.severity(F.col("score"))).alias("severity"), "trigger_metric", "trigger_value",
    )
