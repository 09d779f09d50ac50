"""Sinks: audit records, escalations and the alert queue."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from mendstream import fixed
from mendstream.functions.scrub import scrub_struct

PARTITIONS = ["tenant_id", "year", "month", "day"]


def write_audit(df: DataFrame, path: str, checkpoint: str | None = None):
    """JSON lines split by tenant and date, as a batch append or a stream.

    Batch rows are rebalanced on the partition columns, so a busy tenant-day is split over several
    files and small ones are merged, by their size.
    """
    if df.isStreaming:
        return df.writeStream.format("json").partitionBy(*PARTITIONS).option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    df.hint("rebalance", *PARTITIONS).write.mode("append").partitionBy(*PARTITIONS).json(path)
    return None


def escalations(openings: DataFrame, window: int = fixed.BREAKER_WINDOW) -> DataFrame:
    """Breaker-open messages as ``key, value``."""
    text = F.format_string(fixed.BREAKER_ESCALATION, "service", "namespace", F.col("failure_count").cast("string"))
    body = F.struct(
        F.lit("CIRCUIT_BREAKER_OPEN").alias("event"), "tenant_id", "namespace", "service", "failure_count",
        F.lit(window).alias("error_window_seconds"), F.lit("OPEN").alias("status"), F.col("t").alias("timestamp"), text.alias("description"))
    return openings.select(F.concat_ws("#", F.lit("cb"), "tenant_id", "namespace", "service").alias("key"), F.to_json(body).alias("value"))


def alert_messages(alerts: DataFrame, key: str) -> DataFrame:
    """Accepted alerts, scrubbed, as queue messages ``key, value``; the key column stays out of the body."""
    body = [c for c in alerts.columns if c != key]
    return scrub_struct(alerts, body).select(F.col(key).alias("key"), F.to_json(F.struct(*body)).alias("value"))


def append_messages(path: str):
    """``foreachBatch`` function that appends key/value messages; a repeated batch overwrites its own folder."""

    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").json(f"{path}/batch={batch_id}")

    return write
