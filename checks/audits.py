"""J, K4, K5 and the message sinks: audit records, counters, gates."""
from pyspark.sql import functions as F

from checks import query
from checks.ctes import ALERTS, EV, TEL, with_
from checks.decisions import OUTCOME, worker_events
from checks.states import CALLS, _failures, calls
from checks.views import rounded
from mendstream import fixed
from mendstream.functions.scalars import lock_key
from mendstream.operators import audit as J, decide as H, states as S
from mendstream.plans import fixtures as X
from mendstream.sources import sinks


def _stages(spark, sf):
    """Stage tables of the worker, one second apart per stage."""
    w = H.worker_outcome(worker_events(spark, sf)).where("outcome <> 'UNKNOWN_NAMESPACE'")
    w = w.withColumn("correlation_id", F.concat(F.lit("c-"), "alert_id")).withColumn("action", F.lit("RESTART_DEPLOYMENT")).withColumn("target", F.concat(F.lit("deployment/"), "service"))
    at = lambda d, s: d.withColumn("epoch", F.col("t") + s)
    reached = lambda *stop: w.where(~F.col("outcome").isin("SKIPPED_CB", "EXCEPTION", *stop))
    return {
        "incident": at(w, 0).withColumn("alert_payload", F.concat(F.lit("mail ops@example.com about "), "service")),
        "detect": at(reached(), 1),
        "decide": at(reached("NO_ANOMALY"), 2).withColumn("matched_runbook", F.lit("r")).withColumn("pattern_type", F.lit("urgent")),
        "execute_start": at(reached("NO_ANOMALY", "EMPTY_PLAN"), 3).withColumn("pattern_type", F.lit("urgent")),
        "execute_done": at(reached("NO_ANOMALY", "EMPTY_PLAN"), 4).withColumn("status", F.col("exec_status")).withColumn("error", F.lit(None).cast("string")).withColumn("execution_time_seconds", F.lit(1)),
        "verify": at(reached("NO_ANOMALY", "EMPTY_PLAN", "EXEC_FAILED"), 5).withColumn("status", F.lit(None).cast("string")),
        "rollback": at(w.where("rollback"), 6).withColumn("reason", F.lit("Verification failed, rolling back")),
        "escalate": at(w.where("escalation IS NOT NULL"), 7).withColumn("reason", F.col("escalation")),
    }


# (stage, seconds, stages reached) of each outcome
_AUD = OUTCOME + """, st(event_type, s, status, stops) AS (VALUES ('INCIDENT_START', 0, 'TRIGGERED', ''), ('DETECT', 1, '', 'SKIPPED_CB EXCEPTION'), ('DECIDE', 2, 'PLANNED', 'SKIPPED_CB EXCEPTION NO_ANOMALY'), ('EXECUTE_START', 3, 'IN_PROGRESS', 'SKIPPED_CB EXCEPTION NO_ANOMALY EMPTY_PLAN'),
   ('EXECUTE_DONE', 4, '', 'SKIPPED_CB EXCEPTION NO_ANOMALY EMPTY_PLAN'), ('VERIFY', 5, 'UNKNOWN', 'SKIPPED_CB EXCEPTION NO_ANOMALY EMPTY_PLAN EXEC_FAILED'), ('ROLLBACK', 6, 'ROLLBACK_INITIATED', 'x'), ('ESCALATE', 7, 'ESCALATED', 'NO_ANOMALY DRY_RUN COMPLETED')),
  aud AS (SELECT event_type, tenant_id, 'c-' || alert_id AS correlation_id, t + s AS epoch, CASE WHEN event_type = 'ESCALATE' THEN 'ESCALATE' WHEN event_type = 'ROLLBACK' THEN 'ROLLBACK' WHEN event_type IN ('DECIDE', 'EXECUTE_START', 'EXECUTE_DONE') THEN 'RESTART_DEPLOYMENT' END AS action,
   CASE WHEN event_type = 'ESCALATE' THEN service WHEN event_type IN ('DECIDE', 'EXECUTE_START', 'EXECUTE_DONE') THEN 'deployment/' || service END AS target,
   CASE WHEN event_type = 'DETECT' THEN CASE WHEN outcome = 'NO_ANOMALY' THEN 'NO_ANOMALY' ELSE 'ANOMALY_DETECTED' END WHEN event_type = 'EXECUTE_DONE' THEN CASE WHEN k % 10 = 4 THEN 'FAILED' ELSE 'COMPLETED' END ELSE status END AS status,
   CASE event_type WHEN 'INCIDENT_START' THEN '{"alert_payload":"mail [SCRUBBED] about ' || service || '"}' WHEN 'DECIDE' THEN '{"matched_runbook":"r","pattern_type":"urgent"}' WHEN 'EXECUTE_START' THEN '{"pattern_type":"urgent"}' WHEN 'EXECUTE_DONE' THEN '{"execution_time_seconds":1}'
     WHEN 'VERIFY' THEN '{"next_action":"' || CASE WHEN k % 10 = 5 THEN 'ROLLBACK' WHEN k % 10 = 6 THEN 'ESCALATE' ELSE 'DONE' END || '"}' WHEN 'ROLLBACK' THEN '{"reason":"Verification failed, rolling back"}'
     WHEN 'ESCALATE' THEN '{"reason":"' || CASE WHEN outcome = 'SKIPPED_CB' THEN 'CB_OPEN' ELSE outcome END || '"}' END AS details
   FROM oc, st WHERE outcome <> 'UNKNOWN_NAMESPACE' AND NOT contains(stops, outcome) AND (event_type <> 'ROLLBACK' OR (outcome = 'VERIFY_FAILED' AND k % 10 = 5)))"""


@query("j1_audit_events", with_(_AUD) + """SELECT event_type, tenant_id, correlation_id, epoch, action, target, status, NULL::VARCHAR AS error, details, 'self-heal-worker' AS source, '1.0' AS version,
 strftime(to_timestamp(epoch) AT TIME ZONE 'UTC', '%Y') AS year, strftime(to_timestamp(epoch) AT TIME ZONE 'UTC', '%m') AS month, strftime(to_timestamp(epoch) AT TIME ZONE 'UTC', '%d') AS day FROM aud""")
def _(spark, sf):
    return J.audit_events(_stages(spark, sf))


@query("j2_ops_counters", with_(_AUD) + """SELECT CASE event_type WHEN 'EXECUTE_DONE' THEN 'executions' WHEN 'ESCALATE' THEN 'escalations' WHEN 'ROLLBACK' THEN 'rollbacks' WHEN 'INCIDENT_START' THEN 'incidents' ELSE 'stages' END AS counter,
 event_type, coalesce(action, '') AS action, status, count(*) AS n FROM aud GROUP BY 1, 2, 3, 4""")
def _(spark, sf):
    return J.ops_counters(J.audit_events(_stages(spark, sf)))


def _http(spark, sf):
    return calls(spark, sf).join(X.events(spark, sf).select(F.col("event_id").alias("call_id"), "k", "value"), "call_id").select(
        "call_id", "t", "provider", "status_code", F.element_at(F.array(F.lit("/v1/detect"), F.lit("/v1/decide"), F.lit("/v1/verify")), F.col("k") % 3 + 1).alias("endpoint"), (F.col("value") / 50).alias("seconds"), F.floor(F.col("value") * 10).alias("latency_ms"))


HTTP = CALLS + ", ht AS (SELECT call_id, c.t, provider, status_code, ['/v1/detect', '/v1/decide', '/v1/verify'][k % 3 + 1] AS endpoint, value / 50 AS seconds, CAST(floor(value * 10) AS BIGINT) AS latency_ms FROM calls c JOIN ev ON event_id = call_id)"


@query("j2_worker_counters", with_(OUTCOME) + """SELECT 'messages' AS counter, CASE WHEN outcome IN ('EXCEPTION', 'EMPTY_PLAN', 'EXEC_FAILED', 'VERIFY_FAILED') THEN 'FAILED' WHEN outcome = 'NO_ANOMALY' THEN 'COMPLETED' ELSE outcome END AS status, '' AS action, '' AS lane, '' AS tenant_id, '' AS reason, count(*) AS n FROM oc WHERE outcome NOT IN ('UNKNOWN_NAMESPACE', 'SKIPPED_CB') GROUP BY 2
UNION ALL SELECT 'breaker_skips', '', '', '', tenant_id, '', count(*) FROM oc WHERE outcome = 'SKIPPED_CB' GROUP BY 5
UNION ALL SELECT 'executions', CASE WHEN outcome = 'EXEC_FAILED' THEN 'FAILED' ELSE 'COMPLETED' END, 'RESTART_DEPLOYMENT', CASE WHEN k % 3 = 0 THEN 'slow' ELSE 'fast' END, '', '', count(*) FROM oc WHERE outcome IN ('EXEC_FAILED', 'VERIFY_FAILED', 'DRY_RUN', 'COMPLETED') GROUP BY 2, 4
UNION ALL SELECT 'escalations', '', '', '', '', CASE WHEN outcome = 'SKIPPED_CB' THEN 'CB_OPEN' ELSE outcome END, count(*) FROM oc WHERE outcome IN ('SKIPPED_CB', 'EXCEPTION', 'EMPTY_PLAN', 'EXEC_FAILED', 'VERIFY_FAILED') GROUP BY 6
UNION ALL SELECT 'rollbacks', CASE WHEN alert_id % 4 = 0 THEN 'FAILED' ELSE 'COMPLETED' END, '', '', '', '', count(*) FROM oc WHERE outcome = 'VERIFY_FAILED' AND k % 10 = 5 GROUP BY 2
UNION ALL SELECT 'breaker_opens', '', '', '', tenant_id, '', count(*) FROM oc WHERE outcome = 'EXCEPTION' GROUP BY 5""")
def _(spark, sf):
    lanes = worker_events(spark, sf).join(X.alerts(spark, sf).select("alert_id", "k"), "alert_id")
    o = H.worker_outcome(lanes).withColumns({"action": F.lit("RESTART_DEPLOYMENT"), "lane": H.lane(F.when(F.col("k") % 3 == 0, "deferred").otherwise("urgent")), "rollback_status": F.when(F.col("alert_id") % 4 == 0, "FAILED").otherwise("COMPLETED")})
    return J.worker_counters(o, o.where("outcome = 'EXCEPTION'").select("tenant_id"))


@query("j2_call_errors", with_(HTTP) + "SELECT endpoint, status_code, count(*) AS n FROM ht WHERE coalesce(status_code, 500) <> 200 GROUP BY 1, 2")
def _(spark, sf):
    return J.call_errors(_http(spark, sf))


@query("j3_call_duration_histogram", with_(HTTP) + f"SELECT endpoint, le, count(*) FILTER (seconds <= le) AS n FROM ht, (SELECT unnest({fixed.HISTOGRAM_BOUNDS}::DOUBLE[] || ['inf'::DOUBLE]) AS le) GROUP BY 1, 2")
def _(spark, sf):
    return J.duration_histogram(_http(spark, sf), "endpoint", "seconds")


_TL = _AUD + """, tl AS (SELECT tenant_id, correlation_id, min(epoch) FILTER (event_type = 'INCIDENT_START') AS started, min(epoch) FILTER (event_type = 'DETECT') AS detected, min(epoch) FILTER (event_type = 'DECIDE') AS decided, min(epoch) FILTER (event_type = 'EXECUTE_DONE') AS executed,
  min(epoch) FILTER (event_type = 'VERIFY') AS verified, max(epoch) AS ended, bool_or(event_type = 'ESCALATE') AS escalated FROM aud GROUP BY 1, 2),
  t2 AS (SELECT *, ended - started AS total_seconds, verified IS NOT NULL AND NOT escalated AS auto_resolved FROM tl)"""


@query("j4_incident_timeline", with_(_TL) + "SELECT * FROM t2")
def _(spark, sf):
    return J.incident_timeline(J.audit_events(_stages(spark, sf)))


@query("j4_resolved_share", with_(_TL) + "SELECT tenant_id, count(*) AS incidents, round(avg(auto_resolved::INT), 6) AS auto_resolved_share, round(avg(total_seconds), 6) AS mean_seconds FROM t2 GROUP BY 1")
def _(spark, sf):
    return rounded(J.resolved_share(J.incident_timeline(J.audit_events(_stages(spark, sf)))), "auto_resolved_share", "mean_seconds")


@query("j4_lane_compliance", with_(_TL) + """SELECT tenant_id, lane, count(*) AS incidents, count(*) FILTER (total_seconds < CASE lane WHEN 'fast' THEN 15 ELSE 120 END) AS within_limit, round(avg(auto_resolved::INT), 6) AS auto_resolved_share,
  count(*) FILTER (total_seconds < CASE lane WHEN 'fast' THEN 15 ELSE 120 END) = count(*) AS lane_ok, avg(auto_resolved::INT) >= 0.6 AS share_ok
FROM (SELECT t2.* REPLACE (CASE WHEN correlation_id[-1] IN ('3', '7') THEN total_seconds * 20 ELSE total_seconds END AS total_seconds), CASE WHEN correlation_id[-1] = '3' THEN 'slow' ELSE 'fast' END AS lane FROM t2) GROUP BY 1, 2""")
def _(spark, sf):
    t = J.incident_timeline(J.audit_events(_stages(spark, sf)))
    last = F.substring("correlation_id", -1, 1)
    slow = t.where(last == "3").select("correlation_id", F.lit("slow").alias("lane"))
    t = t.withColumn("total_seconds", F.when(last.isin("3", "7"), F.col("total_seconds") * 20).otherwise(F.col("total_seconds")))
    return rounded(J.lane_compliance(t, slow), "auto_resolved_share")


# as of 100 days after the first event
@query("j5_retention_tier", with_(TEL) + """SELECT seq, CASE WHEN (1704067200 + 8640000 - t) / 86400 <= CASE WHEN signal_name = 'application_log_event' THEN 14 ELSE 7 END THEN 'hot' WHEN (1704067200 + 8640000 - t) / 86400 <= 90 THEN 'cold' ELSE 'drop' END AS tier FROM tel""")
def _(spark, sf):
    lim = spark.createDataFrame(fixed.SIGNAL_LIMITS, "signal_name string, hot_days int, max_delay int, max_per_second int")
    return J.retention_tier(X.telemetry(spark, sf), lim, F.lit(1704067200 + 8640000)).select("seq", "tier")


@query("j6_rollout_gate", with_(HTTP) + """SELECT (t // 86400) * 86400 AS window_start, endpoint, count(*) AS n, round(avg((coalesce(status_code, 500) >= 500)::INT), 6) AS share_5xx, round(quantile_cont(latency_ms, 0.99), 6) AS p99_ms,
 avg((coalesce(status_code, 500) >= 500)::INT) > 0.01 OR quantile_cont(latency_ms, 0.99) > CASE endpoint WHEN '/v1/detect' THEN 800 WHEN '/v1/decide' THEN 3000 ELSE 1000 END AS abort FROM ht GROUP BY 1, 2""")
def _(spark, sf):
    lim = spark.createDataFrame(fixed.ENDPOINT_P99_MS, "endpoint string, p99_limit_ms int")
    d = J.rollout_gate(_http(spark, sf), lim, 86400).drop("p99_limit_ms")
    return rounded(d, "share_5xx", "p99_ms")


@query("j7_firing_summary", with_(ALERTS) + "SELECT alertname, namespace, count(*) AS firing FROM al0 WHERE status = 'firing' GROUP BY 1, 2")
def _(spark, sf):
    return J.firing_summary(X.alerts(spark, sf))


@query("k4_provider_breaker", with_(HTTP, "p AS (SELECT provider, t, count(*) AS n, count(*) FILTER (coalesce(status_code, 500) <> 200) AS e, count(*) FILTER (status_code = 429) AS h FROM ht GROUP BY 1, 2)") + """
SELECT provider, t, CAST(sum(n) OVER w AS BIGINT) AS calls, CAST(sum(e) OVER w AS BIGINT) AS errors, CAST(sum(h) OVER w AS BIGINT) AS throttled, sum(e) OVER w / sum(n) OVER w > 0.6 OR sum(h) OVER w >= 3 AS stop FROM p
WINDOW w AS (PARTITION BY provider ORDER BY t RANGE BETWEEN 7199 PRECEDING AND CURRENT ROW)""")
def _(spark, sf):
    return J.provider_breaker(_http(spark, sf), 7200)


@query("k5_model_call_audit", with_(CALLS) + """SELECT c.call_id, c.tenant_id, c.t, c.provider, c.input_tokens, c.output_tokens, sha256(props) AS input_sha256, sha256(event_type) AS output_sha256, round(value / 500, 9) AS confidence, value AS latency_ms, round(cost, 7) AS cost
FROM cost c JOIN events e ON e.event_id = c.call_id""")
def _(spark, sf):
    text = spark.read.parquet(f"{sf}/events.parquet").select(F.col("event_id").alias("call_id"), F.col("props").alias("input_text"), F.col("event_type").alias("output_text"),
                                                             F.round(F.col("value") / 500, 9).alias("confidence"), F.col("value").alias("latency_ms"))
    return rounded(J.model_call_audit(calls(spark, sf).join(text, "call_id")), "cost", digits=7)


@query("a14_write_escalations", with_(ALERTS, """roll AS (SELECT tenant_id, namespace, service, t, count(*) OVER (PARTITION BY tenant_id, namespace, service ORDER BY t RANGE BETWEEN 86399 PRECEDING AND CURRENT ROW) AS n FROM al0 WHERE k < 50)""") + """
SELECT DISTINCT 'cb#' || tenant_id || '#' || namespace || '#' || service AS key, '{"event":"CIRCUIT_BREAKER_OPEN","tenant_id":"' || tenant_id || '","namespace":"' || namespace || '","service":"' || service || '","failure_count":' || n || ',"error_window_seconds":86400,"status":"OPEN","timestamp":' || t
 || ',"description":"The service ''' || service || ''' in namespace ''' || namespace || ''' has failed automatic self-healing ' || n || ' times within 1 hour. All automated healing actions for this service are suspended."}' AS value FROM roll WHERE n >= 3""")
def _(spark, sf):
    return sinks.escalations(S.breaker_openings(_failures(spark, sf), window=86400), 86400)


@query("a15_write_alert_queue", with_(ALERTS) + """SELECT sha256(tenant_id || '#' || namespace || '#' || service || '#' || alertname) AS key,
 '{"alert_id":' || alert_id || ',"status":"' || status || '","summary":"restart of [SCRUBBED]","labels":{"service":"' || service || '","auth_token":"[SCRUBBED]"}}' AS value FROM al0""")
def _(spark, sf):
    a = X.alerts(spark, sf).withColumn("key", lock_key(F.col("tenant_id"), F.col("namespace"), F.col("service"), F.col("alertname")))
    m = a.select("key", "alert_id", "status", F.concat(F.lit("restart of user"), F.col("k"), F.lit("@example.com")).alias("summary"), F.struct("service", F.col("tenant_id").alias("auth_token")).alias("labels"))
    return sinks.alert_messages(m, "key")
