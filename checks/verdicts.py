"""The whole detect flow per window, in batch and as a stream, and services as a table."""
import uuid

from pyspark.sql import functions as F

from checks import query
from checks.ctes import EDGES, LIVE, with_, TEL
from checks.detection import _EWMA
from checks.rootcause import FAULT, _FAM, _WEIGHT
from checks.states import FOLD
from checks.streams import source
from mendstream.functions.scalars import mask_log, series_name
from mendstream.operators import services as SV, timeseries as TS
from mendstream.plans import fixtures as X
from mendstream.plans.detect import first_anomalies
from mendstream.plans.verdict import masked_lines, verdicts
from mendstream.session import reuse, scratch_dir
from mendstream.streaming import stateful as ST

KPI = 3.0  # a low bar, so that the fixture has anomalies
_SPLIT = LIVE[: LIVE.index("anchors AS")].rstrip(" ,\n")
# anchors are the first flagged rows after the baseline
_FIRST = _SPLIT + _EWMA.format(k=str(KPI))[len(LIVE):] + """, wins2 AS (SELECT tenant_id, window_id, any_value(baseline_len) AS baseline_len FROM split GROUP BY 1, 2),
  first AS (SELECT tenant_id, window_id, min(row) FILTER (is_anomaly AND row >= baseline_len) AS anomaly_row FROM det JOIN wins2 USING (tenant_id, window_id) GROUP BY 1, 2),
  anchors AS (SELECT tenant_id, window_id, anomaly_row, t AS anchor_t FROM first JOIN times USING (tenant_id, window_id) WHERE times.row = anomaly_row)"""
_TRIGGER = """, tr0 AS (SELECT tenant_id, window_id, series, avg(v) FILTER (is_baseline) AS m, stddev_samp(v) FILTER (is_baseline) AS s, max(v) FILTER (row = anomaly_row) AS now FROM split JOIN anchors USING (tenant_id, window_id) GROUP BY 1, 2, 3),
  tr AS (SELECT tenant_id, window_id, series, now, abs(now - m) / s AS dev FROM tr0 WHERE s > 0 AND abs(now - m) / s > 0)"""


@query("d7_kpi_anomalies", "WITH RECURSIVE " + _FIRST + _TRIGGER + """, b AS (SELECT *, row_number() OVER (PARTITION BY tenant_id, window_id ORDER BY dev DESC, series) AS n FROM tr)
SELECT f.tenant_id, f.window_id, coalesce(f.anomaly_row, -1) AS anomaly_row, a.anchor_t AS t, CASE WHEN f.anomaly_row IS NOT NULL THEN 0.4 END AS severity, b.series AS trigger_metric, b.now AS trigger_value
FROM first f LEFT JOIN anchors a USING (tenant_id, window_id) LEFT JOIN (SELECT * FROM b WHERE n = 1) b USING (tenant_id, window_id)""")
def _(spark, sf):
    return first_anomalies(X.telemetry(spark, sf), X.BIN, X.WINDOW, None, KPI).drop("n_flagged")


# families that the words of the two error templates name
_TOKENS = "[{'p': 'connection', 'f': 'disk'}, {'p': 'connection', 'f': 'socket'}, {'p': 'refused', 'f': 'loss'}, {'p': 'timeout', 'f': 'delay'}]"
_LOGGED = FAULT[len(LIVE):].replace("""USING (tenant_id, window_id) WHERE series[:4] = target_service),
  fs AS""", f"""USING (tenant_id, window_id) WHERE series[:4] = target_service
    UNION ALL SELECT tenant_id, window_id, k.f, 'log:' || pattern, 0, -1 FROM lt JOIN best USING (tenant_id, window_id), (SELECT unnest({_TOKENS}) AS k) WHERE container_name = target_service AND contains(pattern, k.p)),
  fs AS""").replace(f"THEN least(500, z) * {_WEIGHT} ELSE", f"THEN least(500, z) * {_WEIGHT} WHEN rank < 0 THEN 12 * {_WEIGHT} ELSE").replace(
    "arg_min(series, rank) FILTER (rank > 0))", "arg_min(series, rank) FILTER (rank > 0), min(series) FILTER (rank < 0))")
_LINES = """, lt AS (SELECT DISTINCT 'tenant-' || (user_id % 4) AS tenant_id, t // 432000 AS window_id, 'svc' || (user_id % 6) AS container_name,
    'svc<NUM> ' || CASE WHEN user_id % 2 = 0 THEN 'upstream connection refused by pod <NUM>' ELSE 'request timeout after <NUM> ms' END AS pattern FROM ev WHERE event_type = 'error')"""
_SAID = "'Diagnosed ' || target_service || ' (' || fault || ') as root cause from aggregated fault evidence led by ''' || lead || ''' (z=' || printf('%.1f', lead_z) || ', scores=' || sc || '). Top candidates: ' || c || '.'"
_CAUSE = f""", x AS (SELECT tenant_id, window_id, string_agg(fault || ':' || printf('%.1f', score), ',' ORDER BY n) FILTER (n <= 3) AS sc FROM fb GROUP BY 1, 2),
  c AS (SELECT tenant_id, window_id, string_agg(series, ', ' ORDER BY rank) AS c FROM ranks WHERE rank <= 3 GROUP BY 1, 2),
  k AS (SELECT tenant_id, window_id, string_agg(s, ',' ORDER BY r) FILTER (n <= 5) AS k FROM (SELECT tenant_id, window_id, series[:4] AS s, min(rank) AS r, row_number() OVER (PARTITION BY tenant_id, window_id ORDER BY min(rank)) AS n FROM ranks GROUP BY 1, 2, 3) GROUP BY 1, 2),
  ca AS (SELECT tenant_id, window_id, target_service, fault, k, {_SAID} AS reasoning FROM fb JOIN best USING (tenant_id, window_id) JOIN x USING (tenant_id, window_id) JOIN c USING (tenant_id, window_id) JOIN k USING (tenant_id, window_id) WHERE n = 1),
  tb AS (SELECT *, row_number() OVER (PARTITION BY tenant_id, window_id ORDER BY dev DESC, series) AS n FROM tr JOIN ca USING (tenant_id, window_id) WHERE series[:4] = target_service)"""
# every anomaly is an alert of its service at the end of its window
_ROLES = ", " + EDGES + """, e0 AS (SELECT ca.tenant_id, target_service AS service, max(times.t) AS t, 1 AS kind, ca.window_id AS alert_id FROM ca JOIN times USING (tenant_id, window_id) GROUP BY 1, 2, 5),
  """ + FOLD[FOLD.index("e1 AS"):]
_VERDICT = "WITH RECURSIVE " + _FIRST + _LINES + _LOGGED + _TRIGGER + _CAUSE + _ROLES + """
SELECT f.tenant_id, f.window_id{start} AS window_id, f.anomaly_row IS NOT NULL AS anomaly_detected, coalesce(f.anomaly_row, -1) AS anomaly_row, a.anchor_t AS t, CASE WHEN f.anomaly_row IS NULL THEN 0.0 ELSE 0.4 END::DOUBLE AS severity,
  ca.target_service, ca.fault, ca.k AS service_top_k, tb.series AS trigger_metric, tb.now AS trigger_value, CASE WHEN f.anomaly_row IS NULL THEN 1.0 ELSE 0.9 END::DOUBLE AS confidence,
  CASE WHEN f.anomaly_row IS NULL THEN 'No anomalies detected in the active telemetry window.' WHEN fo.role = 'root' THEN CASE WHEN len(reasoning) > 300 THEN reasoning[:297] || '...' ELSE reasoning END
    WHEN len('[CORRELATED ALERT] ' || r0) > 300 THEN ('[CORRELATED ALERT] ' || r0)[:297] || '...' ELSE '[CORRELATED ALERT] ' || r0 END AS reasoning, fo.role, fo.root_service
FROM first f LEFT JOIN anchors a USING (tenant_id, window_id) LEFT JOIN (SELECT *, CASE WHEN len(reasoning) > 300 THEN reasoning[:297] || '...' ELSE reasoning END AS r0 FROM ca) ca USING (tenant_id, window_id)
  LEFT JOIN (SELECT tenant_id, window_id, series, now FROM tb WHERE n = 1) tb USING (tenant_id, window_id) LEFT JOIN fo ON fo.tenant_id = f.tenant_id AND fo.alert_id = f.window_id AND fo.role <> ''"""


def _plain(d):
    return d.drop("incident_id").withColumn("service_top_k", F.array_join("service_top_k", ","))


@query("d7_verdicts", _VERDICT.replace("{start} AS window_id", ""))
def _(spark, sf):
    named = X.telemetry(spark, sf).withColumn("series", series_name(F.col("service"), F.col("signal_name"), X.SERVICES))
    bins = reuse(TS.bin_points(named, X.BIN, X.WINDOW))
    lines = reuse(masked_lines(X.fault_logs(spark, sf), X.BIN, X.WINDOW))
    return _plain(verdicts(bins, lines, X.tenant_services(spark), X.edges(spark), None, 120, KPI))


# the same from a stream of points and lines; windows that the watermark has not passed stay open
@query("g11_stream_verdicts", _VERDICT.replace("f.window_id{start}", "f.window_id * 432000") + " WHERE (f.window_id + 1) * 432000 <= (SELECT epoch(max(ts)) FROM events)")
def _(spark, sf):
    root = f"{scratch_dir(spark)}/stream-{uuid.uuid4()}"
    s, err = source(spark, sf), F.col("event_type") == "error"
    signal = F.when(err, "service_error_rate").when(F.col("event_type") == "view", "service_latency_p95").when(F.col("event_type") == "click", "cpu").when(F.col("event_type") == "purchase", "mem")
    value = F.when(err, F.round(F.col("value") / 500, 6)).when(F.col("event_type") != "signup", F.col("value"))
    message = F.when(F.col("user_id") % 2 == 0, F.concat(F.lit("upstream connection refused by pod "), "event_id")).otherwise(F.concat(F.lit("request timeout after "), F.col("event_id"), F.lit(" ms")))
    message = F.when(err, message).otherwise(F.concat(F.lit("signup ok user "), F.col("user_id")))
    none = F.lit(None).cast("string")
    point = F.struct(series_name(F.col("service"), signal, X.SERVICES).alias("series"), value.alias("value_num"), none.alias("container_name"), none.alias("masked"), none.alias("level"))
    line = F.struct(none.alias("series"), F.lit(None).cast("double").alias("value_num"), F.col("service").alias("container_name"), mask_log(F.concat_ws(" ", "service", message)).alias("masked"), F.when(err, "error").otherwise("info").alias("level"))
    kinds = F.array_compact(F.array(F.when(signal.isNotNull(), point), F.when(err | (F.col("event_type") == "signup"), line)))
    events = s.select("ts", "t", F.col("event_id").alias("seq"), "tenant_id", F.inline(kinds))
    w = ST.stream_verdicts(events, X.tenant_services(spark), X.edges(spark), f"{root}/out", f"{root}/state", window="120 hours", slide="120 hours", late="0 seconds", width=X.BIN, detector=None, max_rows=120, kpi_limit=KPI)
    w.trigger(availableNow=True).start().awaitTermination()
    return _plain(spark.read.schema(ST.VERDICT).option("basePath", f"{root}/out").parquet(f"{root}/out")).drop("end_t", "batch")


@query("b6_profile_services", with_(TEL) + f"""SELECT DISTINCT tenant_id, series, CASE WHEN tenant_id IN ('tenant-0', 'tenant-1') OR service <> 'svc5' OR NOT starts_with(signal_name, 'service_') THEN service ELSE 'svc5_service' END AS service,
  CASE WHEN tenant_id IN ('tenant-0', 'tenant-1') OR service <> 'svc5' THEN service WHEN starts_with(signal_name, 'service_') THEN 'svc5_service' END AS first_prefix, {_FAM.format(x='series')} AS fault
FROM (SELECT tenant_id, service, signal_name, service || '_' || signal_name AS series FROM tel WHERE value_num IS NOT NULL)""")
def _(spark, sf):
    points = X.telemetry(spark, sf).where("value_num is not null")
    names = SV.named_signals(points, X.tenant_services(spark, 2)).select("tenant_id", "series").distinct()
    return SV.series_map(names, X.tenant_services(spark, 2)).select("tenant_id", "series", F.col("_service").alias("service"), F.col("_prefix").alias("first_prefix"), F.col("_fault").alias("fault"))
