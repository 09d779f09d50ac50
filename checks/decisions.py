"""H and K1-K3: runbooks, plans, gates, verification, attempts."""
from pyspark.sql import functions as F

from checks import query
from checks.ctes import ALERTS, EV, TEL, with_
from checks.views import rounded
from mendstream import fixed
from mendstream.operators import decide as H
from mendstream.plans import fixtures as X
from mendstream.sources.profile import catalog_runbooks, fault_mapping

_F = "['cpu', 'mem', 'delay', 'loss', 'disk', 'socket', 'f1', 'xyz123'][k % 8 + 1]"
_BOOK = "CASE {f} WHEN 'cpu' THEN 'CPUSaturationRecoveryRunbook' WHEN 'mem' THEN 'MemoryLeakRecoveryRunbook' WHEN 'delay' THEN 'NetworkLatencyRecoveryRunbook' WHEN 'loss' THEN 'PacketLossRecoveryRunbook' WHEN 'disk' THEN 'DiskIORecoveryRunbook' WHEN 'socket' THEN 'SocketExhaustionRecoveryRunbook' ELSE 'DefaultRecoveryRunbook' END"
_ACT = "CASE WHEN {f} IN ('cpu', 'socket') THEN 'SCALE_REPLICAS' WHEN {f} = 'mem' THEN 'PATCH_MEMORY_LIMIT' ELSE 'RESTART_DEPLOYMENT' END"
CTX = ALERTS + f", cx AS (SELECT *, {_F} AS f FROM al0)"


def fault8():
    return F.element_at(F.array(*[F.lit(f) for f in ("cpu", "mem", "delay", "loss", "disk", "socket", "f1", "xyz123")]), F.col("k") % 8 + 1)


def contexts(spark, sf):
    return X.alerts(spark, sf).withColumn("suspected_fault_type", fault8()).withColumnRenamed("service", "target_service")


def plans(spark, sf):
    return H.render_plan(H.match_runbook(contexts(spark, sf), fault_mapping(spark), catalog_runbooks(spark)))


@query("h1_match_runbook", with_(CTX) + f"SELECT alert_id, f AS suspected_fault_type, {_BOOK.format(f='f')} AS matched_runbook FROM cx")
def _(spark, sf):
    return H.match_runbook(contexts(spark, sf), fault_mapping(spark), catalog_runbooks(spark)).select("alert_id", "suspected_fault_type", "matched_runbook")


@query("h1_default_runbook", with_(CTX) + "SELECT alert_id, 'DefaultRecoveryRunbook' AS matched_runbook FROM cx")
def _(spark, sf):
    return H.match_runbook(contexts(spark, sf), fault_mapping(spark), catalog_runbooks(spark), always_default=True).select("alert_id", "matched_runbook")


@query("h2_render_plan", with_(CTX) + f"""SELECT alert_id, {_ACT.format(f='f')} AS action, 'deployment/' || service AS target, namespace AS step_namespace, CASE WHEN f IN ('cpu', 'socket') THEN '3' END AS replicas,
  CASE WHEN f = 'mem' THEN '1024' END AS memory_limit_mb, CASE WHEN namespace = 'other' THEN 'tenant-payment,tenant-checkout,other' ELSE 'tenant-payment,tenant-checkout' END AS allowed, 120 AS window_seconds FROM cx""")
def _(spark, sf):
    p = plans(spark, sf).withColumn("s", F.col("action_plan")[0])
    return p.select("alert_id", "s.action", "s.target", F.col("s.params")["namespace"].alias("step_namespace"), F.col("s.params")["replicas"].alias("replicas"),
                    F.col("s.params")["memory_limit_mb"].alias("memory_limit_mb"), F.array_join("blast_radius_config.allowed_namespaces", ",").alias("allowed"), "verify_policy.window_seconds")


@query("h3_blast_radius_gate", with_(CTX) + "SELECT alert_id, namespace, namespace <> 'other' AS allowed FROM cx")
def _(spark, sf):
    return H.blast_radius_gate(plans(spark, sf), ["tenant-payment", "tenant-checkout"]).select("alert_id", "namespace", "allowed")


# each alert acts on its service; the telemetry of the next hour of its tenant is the evidence
_VER = TEL + ", " + ALERTS[len(EV) + 2:] + """, po AS (SELECT a.alert_id AS action_id, p.seq, p.service, p.signal_name, p.value_num FROM al0 a JOIN tel p ON p.tenant_id = a.tenant_id AND p.t > a.t AND p.t <= a.t + 3600 WHERE p.value_num IS NOT NULL),
  br AS (SELECT action_id, seq, CASE WHEN po.service = a.service THEN 0 ELSE 1 END AS kind, CASE WHEN po.service = a.service AND signal_name LIKE '%error%' AND value_num > 0.05 THEN 'High error rate detected: '
     WHEN po.service = a.service AND signal_name LIKE '%latency%' AND value_num > 60 THEN 'High latency detected: ' WHEN po.service <> a.service AND signal_name LIKE '%error%' AND value_num > 0.1 THEN 'Regression detected in other service ''' || po.service || ''': ' END
     || signal_name || ' = ' || value_num AS s FROM po JOIN al0 a ON a.alert_id = po.action_id WHERE a.k % 10 <> 0),
  ag AS (SELECT action_id, string_agg(s, '; ' ORDER BY kind, seq) AS rs, bool_or(kind = 1) AS reg FROM br WHERE s IS NOT NULL GROUP BY 1)"""


@query("h4_verify_action", with_(_VER) + """SELECT alert_id AS action_id, k % 10 <> 0 AND rs IS NULL AS success, coalesce(k % 10 <> 0 AND reg, FALSE) AS regression_detected,
  CASE WHEN k % 10 = 0 THEN 'RETRY' WHEN rs IS NULL THEN 'DONE' WHEN reg THEN 'ROLLBACK' ELSE 'ESCALATE' END AS next_action,
  CASE WHEN k % 10 = 0 THEN 'Healing action ''RESTART_DEPLOYMENT'' on ''deployment/' || service || ''' failed to execute.' WHEN rs IS NULL THEN 'Target service recovered successfully without any regressions.'
    WHEN reg THEN 'Healing action caused regression: ' || rs ELSE 'Target service failed to recover: ' || rs END AS reason FROM al0 LEFT JOIN ag ON action_id = alert_id""")
def _(spark, sf):
    a = X.alerts(spark, sf)
    acts = a.select(F.col("alert_id").alias("action_id"), F.lit("RESTART_DEPLOYMENT").alias("action"), F.concat(F.lit("deployment/"), F.col("service")).alias("target"),
                    F.when(F.col("k") % 10 == 0, "FAILED").otherwise("COMPLETED").alias("status"), "tenant_id", F.col("t").alias("at"))
    return H.verify_action(acts, _numbers(spark, sf), latency=60.0, seconds=3600).select("action_id", "success", "regression_detected", "next_action", "reason")


def _numbers(spark, sf):
    return X.telemetry(spark, sf).where("value_num IS NOT NULL")


@query("h5_success_conditions", with_(_VER, """l AS (SELECT action_id, service, arg_max(value_num, seq) AS v FROM po WHERE signal_name = 'service_latency_p95' GROUP BY 1, 2)""") + """
SELECT alert_id AS plan_id, 0 AS ord, 'pod_ready' AS signal_name, NULL::DOUBLE AS value, NULL::BOOLEAN AS met FROM al0 UNION ALL
SELECT alert_id, 1, 'service_latency_p95', v, v < 60.0 FROM al0 LEFT JOIN l ON l.action_id = alert_id AND l.service = al0.service""")
def _(spark, sf):
    p = X.alerts(spark, sf).select(F.col("alert_id").alias("plan_id"), F.col("service").alias("target_service"), F.array(F.lit("pod_ready == true"), F.lit("service_latency_p95 < 60.0")).alias("conditions"), "tenant_id", F.col("t").alias("at"))
    return H.success_conditions(p, _numbers(spark, sf), seconds=3600).select("plan_id", "ord", "signal_name", "value", "met")


@query("h6_lane", with_(EV) + "SELECT event_id, CASE WHEN k % 3 = 0 THEN 'slow' ELSE 'fast' END AS lane FROM ev")
def _(spark, sf):
    return X.events(spark, sf).select("event_id", H.lane(F.when(F.col("k") % 3 == 0, "deferred").when(F.col("k") % 3 == 1, "urgent")).alias("lane"))


_ORDER = """list_distinct_keep AS (SELECT alert_id, f, string_agg(x, ',' ORDER BY i) AS fault_order FROM (SELECT alert_id, f, x, min(i) AS i FROM (
  SELECT alert_id, f, 0 AS i, f AS x FROM cx UNION ALL SELECT alert_id, f, 1, 'mem' FROM cx WHERE k % 2 = 0 UNION ALL SELECT alert_id, f, 2, 'disk' FROM cx WHERE k % 2 = 0
  UNION ALL SELECT alert_id, f, 3 + j, y FROM cx, (VALUES (0, 'cpu'), (1, 'mem'), (2, 'delay'), (3, 'loss'), (4, 'disk'), (5, 'socket')) c(j, y)) GROUP BY 1, 2, 3) GROUP BY 1, 2)"""


@query("h7_fault_order", with_(CTX, _ORDER) + "SELECT alert_id, fault_order FROM list_distinct_keep")
def _(spark, sf):
    ranked = F.when(F.col("k") % 2 == 0, F.array(F.lit("mem"), F.lit("disk")))
    return contexts(spark, sf).select("alert_id", F.array_join(H.fault_order(F.col("suspected_fault_type"), ranked), ",").alias("fault_order"))


def _attempts(spark, sf):
    c = contexts(spark, sf).select(
        F.col("alert_id").alias("run_key"), "target_service", "suspected_fault_type", F.array(F.lit("svc1"), F.lit("svc2"), F.lit("svc3")).alias("service_top_k"),
        F.when(F.col("k") % 2 == 0, F.array(F.lit("mem"), F.lit("disk"))).alias("ranked"))
    return H.attempt_plan(c)


_ATT = """sv AS (SELECT alert_id, service AS s, 0 AS so FROM cx UNION ALL SELECT alert_id, s, row_number() OVER (PARTITION BY alert_id ORDER BY s) AS so FROM cx, (VALUES ('svc1'), ('svc2'), ('svc3')) v(s) WHERE s <> service),
  fl AS (SELECT alert_id, unnest(string_split(fault_order, ',')) AS fault, unnest(range(len(string_split(fault_order, ',')))) AS fo, len(string_split(fault_order, ',')) AS n FROM list_distinct_keep),
  att AS (SELECT alert_id AS run_key, CAST(so * n + fo + 1 AS INT) AS attempt, s AS service, fault, CASE WHEN so = 0 AND fo = 0 THEN 'first_choice' WHEN so = 0 THEN 'same_service_other_fault' WHEN fo = 0 THEN 'other_service_same_fault' ELSE 'other_service_other_fault' END AS phase FROM sv JOIN fl USING (alert_id))"""


@query("h8_attempt_plan", with_(CTX, _ORDER, _ATT) + "SELECT * FROM att")
def _(spark, sf):
    return _attempts(spark, sf)


@query("h9_first_success", with_(CTX, _ORDER, _ATT, """oc AS (SELECT att.*, CASE WHEN att.service = 'svc' || (k % 5) AND fault = ['cpu', 'disk', 'f9'][k % 3 + 1] THEN 'DONE' WHEN att.service = 'svc' || (k % 5) THEN 'ESCALATE' ELSE 'ROLLBACK' END AS next_action
    FROM att JOIN cx ON cx.alert_id = run_key)""") + """SELECT run_key, attempt, service, fault, phase, next_action FROM (SELECT *, min(attempt) FILTER (next_action = 'DONE') OVER (PARTITION BY run_key) AS d FROM oc) WHERE d IS NULL OR attempt <= d""")
def _(spark, sf):
    truth = X.alerts(spark, sf).select(F.col("alert_id").alias("run_key"), F.concat(F.lit("svc"), F.col("k") % 5).alias("target_service"),
                                       F.element_at(F.array(F.lit("cpu"), F.lit("disk"), F.lit("f9")), F.col("k") % 3 + 1).alias("true_fault"))
    return H.first_success(_attempts(spark, sf), truth)


@query("h10_rollback_rows", with_(EV) + """SELECT event_id, CASE k % 5 WHEN 0 THEN 'namespace not allowed' WHEN 3 THEN 'nothing to restore' WHEN 4 THEN CASE WHEN k >= 50 THEN 'git_commit_sha is missing' END END AS error,
  CASE k % 5 WHEN 1 THEN '{"spec":{"replicas":' || k || '}}' WHEN 2 THEN '{"spec":{"template":{"spec":{"containers":[{"name":"main","resources":{"limits":{"memory":"' || k || 'Mi"},"requests":{"memory":"64Mi"}}}]}}}}'
   WHEN 4 THEN CASE WHEN k < 50 THEN '{"revert":"sha-' || k || '"}' END END AS document FROM ev""")
def _(spark, sf):
    m, k = F.col("k") % 5, F.col("k")
    s = X.events(spark, sf).select(
        "event_id", F.when(m == 4, "deferred").otherwise("urgent").alias("pattern_type"), F.when(m == 0, "other").otherwise("tenant-payment").alias("namespace"),
        F.when(m == 1, k).alias("replicas"), F.when(m == 2, k).when(m == 3, F.lit(0)).alias("memory_limit_mb"), F.when(m == 2, 64).alias("memory_request_mb"), F.lit(None).cast("string").alias("cpu_limit"),
        F.lit("main").alias("container_name"), F.when((m == 4) & (k < 50), F.concat(F.lit("sha-"), k)).alias("git_commit_sha"))
    return H.rollback_rows(s, ["tenant-payment"]).select("event_id", "error", "document")


def worker_events(spark, sf):
    k = F.col("k")
    return X.alerts(spark, sf).select(
        "alert_id", "tenant_id", "t", "service", (F.col("namespace") != "other").alias("known_tenant"), (k % 10 == 0).alias("breaker_open"), (k % 10 == 1).alias("exception"),
        F.when(k % 10 != 2, F.lit(True)).alias("anomaly_detected"), F.when(k % 10 == 3, 0).otherwise(1).alias("plan_size"), F.when(k % 10 == 4, "FAILED").otherwise("COMPLETED").alias("exec_status"),
        (~(k % 10).isin(5, 6)).alias("success"), F.when(k % 10 == 5, "ROLLBACK").when(k % 10 == 6, "ESCALATE").otherwise("DONE").alias("next_action"), (k % 10 == 7).alias("dry_run"))


OUTCOME = ALERTS + """, oc AS (SELECT alert_id, tenant_id, service, t, k, CASE WHEN namespace = 'other' THEN 'UNKNOWN_NAMESPACE' ELSE ['SKIPPED_CB', 'EXCEPTION', 'NO_ANOMALY', 'EMPTY_PLAN', 'EXEC_FAILED', 'VERIFY_FAILED', 'VERIFY_FAILED', 'DRY_RUN', 'COMPLETED', 'COMPLETED'][k % 10 + 1] END AS outcome FROM al0)"""


@query("h11_worker_outcome", with_(OUTCOME) + """SELECT alert_id, outcome, CASE WHEN outcome IN ('EXCEPTION', 'EMPTY_PLAN', 'EXEC_FAILED', 'VERIFY_FAILED') THEN 'FAILED' WHEN outcome = 'NO_ANOMALY' THEN 'COMPLETED' WHEN outcome IN ('DRY_RUN', 'COMPLETED') THEN outcome END AS message_status,
  outcome IN ('EXCEPTION', 'EXEC_FAILED', 'VERIFY_FAILED') AS breaker_failure, outcome = 'VERIFY_FAILED' AND k % 10 = 5 AS rollback, CASE WHEN outcome = 'SKIPPED_CB' THEN 'CB_OPEN' WHEN outcome IN ('EXCEPTION', 'EMPTY_PLAN', 'EXEC_FAILED', 'VERIFY_FAILED') THEN outcome END AS escalation FROM oc""")
def _(spark, sf):
    return H.worker_outcome(worker_events(spark, sf)).select("alert_id", "outcome", "message_status", "breaker_failure", "rollback", "escalation")


@query("h12_next_retry_context", with_(CTX) + """SELECT alert_id, CASE WHEN k % 2 = 0 THEN 'svc-new' ELSE service END AS target_service, CASE WHEN k % 4 = 0 THEN 'socket' ELSE f END AS suspected_fault_type, namespace FROM cx""")
def _(spark, sf):
    c = contexts(spark, sf)
    det = F.struct("target_service", "suspected_fault_type", "namespace")
    cor = F.struct(F.when(F.col("k") % 2 == 0, "svc-new").alias("target_service"), F.when(F.col("k") % 4 <= 1, "socket").alias("suspected_fault_type"), F.lit(None).cast("string").alias("namespace"))
    return H.next_retry_context(c.select("alert_id", det.alias("detected"), cor.alias("corrected"))).select("alert_id", "context.*")


@query("k1_confidence_gate", with_(EV) + "SELECT event_id, CASE WHEN value / 100 < 0.6 THEN 'ESCALATE' ELSE 'ACT' END AS gate FROM ev")
def _(spark, sf):
    return H.confidence_gate(X.events(spark, sf).withColumn("confidence", F.col("value") / 100)).select("event_id", "gate")


@query("k2_patch_limit_gate", with_(ALERTS, """sn AS (SELECT 'tenant-payment' AS namespace, 'svc' || (user_id % 5) AS deployment, arg_max(k + 100, (t, event_id)) AS mb FROM ev WHERE event_type = 'view' GROUP BY 1, 2)""") + """
SELECT alert_id, CASE WHEN al0.k % 9 = 0 THEN 'system_namespace' WHEN mb IS NULL THEN 'no_snapshot' WHEN al0.k * 3 > mb * 1.5 THEN 'growth_over_limit' ELSE 'allowed' END AS gate
FROM al0 LEFT JOIN sn ON sn.namespace = CASE WHEN al0.k % 9 = 0 THEN 'kube-system' ELSE al0.namespace END AND sn.deployment = al0.service""")
def _(spark, sf):
    s = X.events(spark, sf).where("event_type = 'view'").select(
        F.lit("tenant-payment").alias("namespace"), F.concat(F.lit("svc"), F.col("user_id") % 5).alias("deployment"), (F.col("k") + 100).alias("memory_limit_mb"), F.struct("t", "event_id").alias("t"))
    p = X.alerts(spark, sf).select("alert_id", F.when(F.col("k") % 9 == 0, "kube-system").otherwise(F.col("namespace")).alias("namespace"), F.col("service").alias("deployment"), (F.col("k") * 3).alias("memory_limit_mb"))
    return H.patch_limit_gate(p, s).select("alert_id", "gate")


@query("k3_fallback_reason", with_(EV) + """SELECT event_id, CASE WHEN k % 7 = 0 THEN 'cost_cap_exceeded' WHEN c = 429 AND value * 30 + 500 > 2000 THEN 'throttled' WHEN c IS NULL OR c >= 500 OR value * 30 > 2500 THEN 'unavailable' WHEN k % 7 = 1 THEN 'unparsable' END AS fallback_reason
FROM (SELECT *, CASE k % 10 WHEN 0 THEN 500 WHEN 1 THEN 429 WHEN 2 THEN NULL ELSE 200 END AS c FROM ev)""")
def _(spark, sf):
    k = F.col("k")
    c = X.events(spark, sf).select("event_id", (k % 7 == 0).alias("cost_cap_exceeded"), F.when(k % 10 == 0, 500).when(k % 10 == 1, 429).when(k % 10 > 2, 200).alias("status_code"),
                                   (F.col("value") * 30).alias("elapsed_ms"), F.lit(500).alias("retry_wait_ms"), (k % 7 != 1).alias("parsed"))
    return H.fallback_reason(c).select("event_id", "fallback_reason")
