"""Audit records, counters, timelines, retention and rollout gates."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from mendstream import fixed
from mendstream.functions.scrub import scrub_struct
from mendstream.operators.quantiles import exact_percentile
from mendstream.operators.scans import join_same

AUDIT_COLUMNS = ["event_type", "tenant_id", "correlation_id", "epoch", "action", "target", "status", "error", "details"]
TEXT_COLUMNS = ["action", "target", "status", "error", "details"]


def audit_record(event_type: str, df: DataFrame, status: Column, action: Column | None = None, target: Column | None = None,
                 error: Column | None = None, details: Column | None = None) -> DataFrame:
    """Rows of one event type, not yet scrubbed. Needs ``tenant_id, correlation_id, epoch``."""
    text = {"action": action, "target": target, "status": status, "error": error, "details": details}
    cols = [(F.lit(None).cast("string") if c is None else c).alias(name) for name, c in text.items()]
    return df.select(F.lit(event_type).alias("event_type"), "tenant_id", "correlation_id", "epoch", *cols)


def audit_events(stages: dict[str, DataFrame], source: str = "self-heal-worker") -> DataFrame:
    """All stage tables as one scrubbed audit stream with date columns for the sink.

    Keys: incident, detect, decide, execute_start, execute_done, verify, rollback, escalate, breaker;
    each may be left out.
    """
    c = F.col
    build = {
        "incident": lambda d: audit_record("INCIDENT_START", d, F.lit("TRIGGERED"), details=F.to_json(F.struct(c("alert_payload")))),
        "detect": lambda d: audit_record("DETECT", d, F.when(c("anomaly_detected"), "ANOMALY_DETECTED").otherwise("NO_ANOMALY")),
        "decide": lambda d: audit_record("DECIDE", d, F.lit("PLANNED"), c("action"), c("target"), details=F.to_json(F.struct("matched_runbook", "pattern_type"))),
        "execute_start": lambda d: audit_record("EXECUTE_START", d, F.lit("IN_PROGRESS"), c("action"), c("target"), details=F.to_json(F.struct("pattern_type"))),
        "execute_done": lambda d: audit_record("EXECUTE_DONE", d, c("status"), c("action"), c("target"), c("error"), F.to_json(F.struct("execution_time_seconds"))),
        "verify": lambda d: audit_record("VERIFY", d, F.coalesce(c("status"), F.lit("UNKNOWN")), details=F.to_json(F.struct("next_action"))),
        "rollback": lambda d: audit_record("ROLLBACK", d, F.lit("ROLLBACK_INITIATED"), F.lit("ROLLBACK"), details=F.to_json(F.struct("reason"))),
        "escalate": lambda d: audit_record("ESCALATE", d, F.lit("ESCALATED"), F.lit("ESCALATE"), c("service"), details=F.to_json(F.struct("reason"))),
        "breaker": lambda d: audit_record("CIRCUIT_BREAKER_OPEN", d, F.lit("CIRCUIT_BREAKER_OPEN"), F.lit("CIRCUIT_BREAKER_OPEN"), c("service"),
                                          details=F.to_json(F.struct("failure_count", F.lit("1h").alias("window")))),
    }
    out = None
    for name, df in stages.items():
        part = build[name](df)
        out = part if out is None else out.unionByName(part)
    ts = F.timestamp_seconds("epoch")
    return scrub_struct(out, TEXT_COLUMNS).select(
        *AUDIT_COLUMNS, F.lit(source).alias("source"), F.lit("1.0").alias("version"), F.date_format(ts, "yyyy").alias("year"),
        F.date_format(ts, "MM").alias("month"), F.date_format(ts, "dd").alias("day"))


def ops_counters(audit: DataFrame) -> DataFrame:
    """Counts by event type, action and status, one row per counter and label."""
    counter = (
        F.when(F.col("event_type") == "EXECUTE_DONE", "executions").when(F.col("event_type") == "ESCALATE", "escalations")
        .when(F.col("event_type") == "ROLLBACK", "rollbacks").when(F.col("event_type") == "CIRCUIT_BREAKER_OPEN", "breaker_opens")
        .when(F.col("event_type") == "INCIDENT_START", "incidents").otherwise("stages")
    )
    return audit.groupBy(counter.alias("counter"), "event_type", F.coalesce("action", F.lit("")).alias("action"), "status").agg(F.count("*").alias("n"))


def worker_counters(outcomes: DataFrame, openings: DataFrame) -> DataFrame:
    """All counters of the worker, one row per counter and label: counter, status, action, lane, tenant_id, reason, n.

    ``outcomes``: rows of ``worker_outcome`` with ``tenant_id, action, lane, exec_status, rollback_status``; ``openings``: breaker openings with ``tenant_id``. An alert
    counts once for each counter that it touches: its message, a skip, an execution (once it had a plan), an escalation, a rollback.
    """
    o, none = F.col("outcome"), F.lit("")

    def one(name: str, when: Column, status: Column = none, action: Column = none, lane: Column = none, tenant: Column = none, reason: Column = none) -> Column:
        return F.when(when, F.struct(F.lit(name).alias("counter"), status.alias("status"), action.alias("action"), lane.alias("lane"), tenant.alias("tenant_id"), reason.alias("reason")))

    touched = F.array_compact(F.array(
        one("messages", F.col("message_status").isNotNull(), status=F.col("message_status")),
        one("breaker_skips", o == "SKIPPED_CB", tenant=F.col("tenant_id")),
        one("executions", o.isin("EXEC_FAILED", "VERIFY_FAILED", "DRY_RUN", "COMPLETED"), F.col("exec_status"), F.col("action"), F.col("lane")),
        one("escalations", F.col("escalation").isNotNull(), reason=F.col("escalation")),
        one("rollbacks", F.col("rollback"), status=F.col("rollback_status")),
    ))
    rows = outcomes.select(F.inline(touched))
    opened = openings.select(F.lit("breaker_opens").alias("counter"), none.alias("status"), none.alias("action"), none.alias("lane"), "tenant_id", none.alias("reason"))
    labels = ["counter", "status", "action", "lane", "tenant_id", "reason"]
    return rows.unionByName(opened).groupBy(*labels).agg(F.count("*").alias("n"))


def call_errors(calls: DataFrame) -> DataFrame:
    return calls.where(F.coalesce("status_code", F.lit(500)) != 200).groupBy("endpoint", "status_code").agg(F.count("*").alias("n"))


def duration_histogram(calls: DataFrame, by: str, col: str, bounds: list[float] = fixed.HISTOGRAM_BOUNDS, with_inf: bool = True) -> DataFrame:
    """Cumulative buckets (``le``, ``n``) per group.

    Each row is counted once in its own bucket; the cumulative counts come from those few rows.
    """
    tops = [*bounds, float("inf")] if with_inf else list(bounds)
    counted = calls.where(F.col(col).isNotNull()).groupBy(by).agg(*[F.count_if(F.col(col) <= b).alias(f"_{i}") for i, b in enumerate(tops)])
    pairs = F.array(*[F.struct(F.lit(float(b)).alias("le"), F.col(f"_{i}").alias("n")) for i, b in enumerate(tops)])
    return counted.select(by, F.explode(pairs).alias("b")).select(by, "b.le", "b.n")


def incident_timeline(audit: DataFrame) -> DataFrame:
    """Stage times, total seconds and outcome per correlation id."""
    at = lambda kind: F.min(F.when(F.col("event_type") == kind, F.col("epoch")))
    d = audit.groupBy("tenant_id", "correlation_id").agg(
        at("INCIDENT_START").alias("started"), at("DETECT").alias("detected"), at("DECIDE").alias("decided"), at("EXECUTE_DONE").alias("executed"),
        at("VERIFY").alias("verified"), F.max("epoch").alias("ended"), F.bool_or(F.col("event_type") == "ESCALATE").alias("escalated"))
    return d.withColumn("total_seconds", F.col("ended") - F.col("started")).withColumn("auto_resolved", F.col("verified").isNotNull() & ~F.col("escalated"))


def resolved_share(timeline: DataFrame) -> DataFrame:
    return timeline.groupBy("tenant_id").agg(
        F.count("*").alias("incidents"), F.avg(F.col("auto_resolved").cast("double")).alias("auto_resolved_share"), F.avg("total_seconds").alias("mean_seconds"))


def lane_compliance(timeline: DataFrame, lanes: DataFrame, limits: list[tuple[str, int]] = fixed.LANE_SECONDS, share: float = fixed.AUTO_RESOLVED_SHARE) -> DataFrame:
    """Per tenant and lane: incidents, how many ended within the lane's limit, whether all did, the share resolved without a person and whether it is enough.

    ``lanes``: ``correlation_id, lane``; an incident without one is in the fast lane.
    """
    most = F.create_map(*[F.lit(x) for pair in limits for x in pair])
    d = timeline.join(lanes.select("correlation_id", "lane"), "correlation_id", "left").withColumn("lane", F.coalesce("lane", F.lit("fast")))
    per = d.groupBy("tenant_id", "lane").agg(
        F.count("*").alias("incidents"), F.count_if(F.col("total_seconds") < most[F.col("lane")]).alias("within_limit"), F.avg(F.col("auto_resolved").cast("double")).alias("auto_resolved_share"))
    return per.withColumns({"lane_ok": F.col("within_limit") == F.col("incidents"), "share_ok": F.col("auto_resolved_share") >= share})


def retention_tier(df: DataFrame, limits: DataFrame, now: Column, cold_days: int = fixed.COLD_DAYS) -> DataFrame:
    """``hot`` within the signal's hot days, ``cold`` up to 90 days, then ``drop``; unlisted signals have 7 hot days."""
    dim = F.broadcast(limits.select("signal_name", "hot_days"))
    age = (now - F.col("t")) / 86400
    return df.join(dim, "signal_name", "left").withColumn(
        "tier", F.when(age <= F.coalesce("hot_days", F.lit(7)), "hot").when(age <= cold_days, "cold").otherwise("drop")).drop("hot_days")


def rollout_gate(calls: DataFrame, limits: DataFrame, seconds: int = 300, max_5xx: float = fixed.MAX_5XX_RATE) -> DataFrame:
    """Per window and endpoint: abort when the 5xx share or the exact p99 is over its limit.

    A call without a status counts as 5xx; an endpoint without a limit is judged by its 5xx share alone.
    """
    key = ["window_start", "endpoint"]
    code = F.coalesce("status_code", F.lit(500))
    d = calls.withColumn("window_start", F.expr(f"(t div {seconds}) * {seconds}"))
    per = d.groupBy(*key).agg(F.count("*").alias("n"), F.avg((code >= 500).cast("double")).alias("share_5xx"))
    per = join_same(per, exact_percentile(d, key, "latency_ms", 0.99, "p99_ms"), key)
    d = per.join(limits.select("endpoint", "p99_limit_ms"), "endpoint", "left")
    return d.withColumn("abort", (F.col("share_5xx") > max_5xx) | F.coalesce(F.col("p99_ms") > F.col("p99_limit_ms"), F.lit(False)))


def firing_summary(alerts: DataFrame) -> DataFrame:
    return alerts.where("status = 'firing'").groupBy("alertname", "namespace").agg(F.count("*").alias("firing"))


def provider_breaker(calls: DataFrame, seconds: int = 300, share: float = 0.6, throttles: int = 3) -> DataFrame:
    """Seconds in which a provider's error share over the last ``seconds`` is too high or it throttled repeatedly."""
    from mendstream.operators.timeseries import rolling_range

    code = F.coalesce("status_code", F.lit(500))
    per = calls.groupBy("provider", "t").agg(F.count("*").alias("n"), F.count_if(code != 200).alias("e"), F.count_if(code == 429).alias("h"))
    d = rolling_range(per, ["provider"], seconds, {"calls": F.sum("n"), "errors": F.sum("e"), "throttled": F.sum("h")})
    return d.select("provider", "t", "calls", "errors", "throttled", ((F.col("errors") / F.col("calls") > share) | (F.col("throttled") >= throttles)).alias("stop"))


def model_call_audit(calls: DataFrame) -> DataFrame:
    """Per call: tokens, digests of input and output, confidence, latency and cost."""
    from mendstream.operators.states import call_cost

    return calls.select(
        "call_id", "tenant_id", "t", "provider", "input_tokens", "output_tokens", F.sha2("input_text", 256).alias("input_sha256"),
        F.sha2("output_text", 256).alias("output_sha256"), "confidence", "latency_ms", call_cost(F.col("provider"), F.col("input_tokens"), F.col("output_tokens")).alias("cost"))
