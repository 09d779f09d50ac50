"""Telemetry, log, alert and label views derived from the given tables."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from mendstream import fixed

BIN = 3600
WINDOW = 120 * BIN


def events(spark: SparkSession, sf: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf}/events.parquet").select(
        "event_id", "user_id", "event_type", "value",
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("t"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )


def telemetry(spark: SparkSession, sf: str) -> DataFrame:
    kind, v = F.col("event_type"), F.col("value")
    return events(spark, sf).select(
        F.col("event_id").alias("seq"), "t",
        F.concat(F.lit("tenant-"), F.col("user_id") % 4).alias("tenant_id"),
        F.concat(F.lit("svc"), F.col("user_id") % 6).alias("service"),
        F.when(kind == "error", "service_error_rate").when(kind == "view", "service_latency_p95")
        .when(kind == "click", "cpu").when(kind == "purchase", "mem")
        .otherwise("application_log_event").alias("signal_name"),
        F.when(kind == "error", F.round(v / 500, 6)).when(kind == "signup", F.lit(None)).otherwise(v).alias("value_num"),
        F.col("k"),
    )


def logs(spark: SparkSession, sf: str) -> DataFrame:
    err = F.col("event_type") == "error"
    return events(spark, sf).select(
        F.col("event_id").alias("seq"), "t",
        F.concat(F.lit("tenant-"), F.col("user_id") % 4).alias("tenant_id"),
        F.concat(F.lit("svc"), F.col("user_id") % 6).alias("container_name"),
        F.when(
            err,
            F.concat(F.lit("request "), F.col("event_id"), F.lit(" failed after "), F.floor("value"),
                     F.lit(" ms from 10.0.0."), F.col("user_id")),
        ).otherwise(F.concat(F.col("event_type"), F.lit(" ok user "), F.col("user_id"))).alias("message"),
        F.when(err, "error").otherwise("info").alias("level"),
    )


def fault_logs(spark: SparkSession, sf: str) -> DataFrame:
    """Error lines that name a fault: connections in even services, timeouts in odd ones; and plain lines."""
    error = F.when(F.col("user_id") % 2 == 0, F.concat(F.lit("upstream connection refused by pod "), "event_id")).otherwise(F.concat(F.lit("request timeout after "), F.col("event_id"), F.lit(" ms")))
    return events(spark, sf).where("event_type in ('error', 'signup')").select(
        F.col("event_id").alias("seq"), "t",
        F.concat(F.lit("tenant-"), F.col("user_id") % 4).alias("tenant_id"),
        F.concat(F.lit("svc"), F.col("user_id") % 6).alias("container_name"),
        F.when(F.col("event_type") == "error", error).otherwise(F.concat(F.lit("signup ok user "), F.col("user_id"))).alias("message"),
        F.when(F.col("event_type") == "error", "error").otherwise("info").alias("level"),
    )


def tenant_services(spark: SparkSession, profiles: int = 1) -> DataFrame:
    """Known services of each tenant; with two profiles tenants 2 and 3 know the last one by a longer name."""
    longer = [*SERVICES[:5], "svc5_service"]
    rows = [(f"tenant-{k}", s, i) for k in range(4) for i, s in enumerate(longer if profiles == 2 and k > 1 else SERVICES)]
    return spark.createDataFrame(rows, "tenant_id string, service string, ord int")


def alerts(spark: SparkSession, sf: str) -> DataFrame:
    names = F.array(*[F.lit(n) for n in [*fixed.ADMITTED_ALERTS, "HighLoad"]])
    spaces = F.array(F.lit("tenant-payment"), F.lit("tenant-checkout"), F.lit("other"))
    return events(spark, sf).where("event_type = 'error'").select(
        F.col("event_id").alias("alert_id"), "t",
        F.concat(F.lit("tenant-"), F.col("user_id") % 4).alias("tenant_id"),
        F.element_at(spaces, (F.col("user_id") % 3 + 1).cast("int")).alias("namespace"),
        F.concat(F.lit("svc"), F.col("user_id") % 6).alias("service"),
        F.element_at(names, F.col("k") % 5 + 1).alias("alertname"),
        F.when(F.col("event_id") % 10 == 0, "resolved").otherwise("firing").alias("status"),
        F.col("k"),
    )


EDGES = [("svc0", "svc2"), ("svc0", "svc4"), ("svc2", "svc4"), ("svc1", "svc3"), ("svc1", "svc5"), ("svc3", "svc5")]
SERVICES = [f"svc{i}" for i in range(6)]


def edges(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(EDGES, "service string, depends_on string")
