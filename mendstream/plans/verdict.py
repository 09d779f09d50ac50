"""The whole detect flow in one plan: bins and log lines of windows in, one verdict per window out.

points -> aligned series -> flags -> first anomaly -> log templates -> root cause -> trigger metric -> incident role. All tenants and windows
go through one job; ``streaming.stateful.stream_verdicts`` runs the same plan on the windows that a stream closes.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from mendstream import fixed
from mendstream.functions.scalars import clip_reason, mask_log
from mendstream.operators import detectors as D, rca as R, states as S, templates as TP, timeseries as TS
from mendstream.plans.detect import trigger_metric
from mendstream.session import reuse

WIN = TS.WIN
LINE = [*WIN, "container_name", "masked"]
COLUMNS = ["tenant_id", "window_id", "anomaly_detected", "anomaly_row", "t", "severity", "target_service", "fault", "service_top_k", "trigger_metric", "trigger_value", "confidence", "reasoning", "role", "root_service", "incident_id"]


def masked_lines(logs: DataFrame, width: int, window: int) -> DataFrame:
    """Log lines (``tenant_id, t, seq, container_name, message, level``) reduced to one row per (window, bin, masked message): ``n``, ``first_seq`` and the first line's ``level``."""
    masked = mask_log(F.concat_ws(" ", "container_name", "message"))
    rows = logs.select("tenant_id", F.expr(f"t div {window}").alias("window_id"), F.expr(f"(t div {width}) * {width}").alias("t"), "container_name", masked.alias("masked"), "seq", "level")
    return rows.groupBy(*LINE, "t").agg(F.count("*").alias("n"), F.min("seq").alias("first_seq"), F.min_by("level", "seq").alias("level"))


def root_causes(raw: DataFrame, lines: DataFrame, anchors: DataFrame, services: DataFrame) -> DataFrame:
    """Root cause of each anchored window: the rank engine's answer, and the score engine's for windows that it has none for."""
    z = reuse(TS.deviation(raw, TS.baseline_stats(raw), anchors))
    distinct = lines.groupBy(*LINE).agg(F.sum("n").alias("n"), F.min("first_seq").alias("first_seq"), F.min_by("level", "first_seq").alias("level"))
    # templates are mined for each window, as each is judged by its own lines
    messages, templates = TP.cluster_messages(distinct.join(anchors.select(*WIN), WIN, "left_semi"), keys=WIN)
    templates = reuse(templates)
    rank = reuse(R.rca_rank(raw, anchors, z, templates, services))
    rest = reuse(anchors.join(rank, WIN, "left_anti"))
    if rest.isEmpty():
        return rank
    frame = raw.join(rest.select(*WIN), WIN, "left_semi")
    times = frame.groupBy(*WIN, "t", "row").agg(F.lit(1).alias("_n")).drop("_n")
    counts = lines.join(messages, LINE).groupBy(*WIN, "t", "template_id").agg(F.sum("n").alias("n"))
    corr = R.metric_log_correlation(frame, TP.dense_counts(counts, times), rest, templates=templates)
    score = R.rca_score(z.join(rest.select(*WIN), WIN, "left_semi"), reuse(corr), templates, services)
    return rank.unionByName(score.select(rank.columns))


def verdicts(bins: DataFrame, lines: DataFrame, services: DataFrame, edges: DataFrame, detector: str | None = "bocpd", max_rows: int | None = None,
             kpi_limit: float = fixed.EWMA_THRESHOLD, closes: DataFrame | None = None, earlier: DataFrame | None = None) -> DataFrame:
    """One row per window of ``bins`` (``tenant_id, window_id, t, series, v``; a kept frame).

    ``lines`` as ``masked_lines`` gives them, ``services``: ``tenant_id, service, ord``, ``edges``: ``service, depends_on``. Each anomaly is an alert of its target service at the end of its window;
    ``closes`` (``tenant_id, service, t``) resolve incidents, ``earlier`` (``tenant_id, service, t, alert_id``) are alerts judged before, whose incidents are still known. A window
    without an anomaly has severity 0, confidence 1 and no role.
    """
    aligned = reuse(TS.align_series(bins))
    df = reuse(TS.baseline_split(TS.clean_non_finite(aligned)))
    flags = reuse(D.detect(df, detector, max_rows=max_rows, kpi_limit=kpi_limit))
    found = reuse(TS.first_detection(flags, df.groupBy(*WIN).agg(F.min("baseline_len").alias("search_start"))))
    at = flags.select(*WIN, F.col("row").alias("anomaly_row"), "t", "score")
    anchors = reuse(found.where("anomaly_row >= 0").join(at, [*WIN, "anomaly_row"]))
    cause = reuse(root_causes(TS.baseline_split(TS.clean_non_finite(aligned, "rca")), lines, anchors, services))
    trigger = trigger_metric(df, anchors, cause.select(*WIN, "target_service")).select(*WIN, "trigger_metric", "trigger_value")
    ends = aligned.groupBy(*WIN).agg(F.max("t").alias("t"))
    alerts = cause.join(ends, WIN).select("tenant_id", F.col("target_service").alias("service"), "t", F.col("window_id").alias("alert_id"))
    alerts = reuse(alerts if earlier is None else alerts.unionByName(earlier.select(alerts.columns)))
    roles = S.correlate_incidents(alerts, edges, closes).select("tenant_id", F.col("alert_id").alias("window_id"), F.col("service").alias("target_service"), "role", "root_service", "incident_id")
    d = found.select(*WIN, "anomaly_row").join(anchors.select(*WIN, "t", "score"), WIN, "left").join(cause, WIN, "left")
    d = d.join(trigger, WIN, "left").join(roles, [*WIN, "target_service"], "left")
    some = F.col("anomaly_row") >= 0
    said = F.when(F.col("role") == "root", F.col("reasoning")).otherwise(clip_reason(F.concat(F.lit(fixed.CORRELATED_PREFIX), "reasoning")))
    return d.withColumns({
        "anomaly_detected": some, "severity": F.when(some, D.severity(F.col("score"))).otherwise(0.0), "confidence": F.when(some, F.col("confidence")).otherwise(1.0),
        "reasoning": F.when(some, said).otherwise(fixed.NO_ANOMALY_REASON),
    }).select(*COLUMNS)
