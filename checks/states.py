"""G: cooldown, incidents, breaker, cost, limits."""
from pyspark.sql import functions as F

from checks import query
from checks.ctes import ALERTS, EDGES, EV, TEL, with_
from checks.views import rounded
from mendstream import fixed
from mendstream.operators import states as S
from mendstream.plans import fixtures as X


def _cooldowns(spark):
    return spark.createDataFrame([(n, c) for n, _, c in fixed.NAMESPACES], "namespace string, cooldown int")


_KEY = ["namespace", "service", "alertname"]
# cooldowns in hours: the fixture is sparse
_GAP = "CASE namespace WHEN 'tenant-payment' THEN 18000 WHEN 'tenant-checkout' THEN 30000 ELSE 25000 END"


@query("g1_cooldown_dedup", "WITH RECURSIVE " + ALERTS + f""", f AS (SELECT namespace, service, alertname, t, {_GAP} AS gap, min(alert_id) AS alert_id FROM al0 GROUP BY ALL),
  acc AS (SELECT namespace, service, alertname, min(t) AS t, gap FROM f GROUP BY 1, 2, 3, 5
    UNION ALL SELECT a.namespace, a.service, a.alertname, min(f.t), a.gap FROM acc a JOIN f USING (namespace, service, alertname) WHERE f.t > a.t + a.gap GROUP BY a.namespace, a.service, a.alertname, a.t, a.gap)
SELECT al0.*, al0.alert_id IN (SELECT f.alert_id FROM f JOIN acc USING (namespace, service, alertname, t)) AS accepted FROM al0""")
def _(spark, sf):
    dims = spark.createDataFrame([("tenant-payment", 18000), ("tenant-checkout", 30000)], "namespace string, cooldown int")
    return S.cooldown_dedup(X.alerts(spark, sf), dims, _KEY, default=25000)


# the real cooldowns, by lock key
@query("g1_cooldown_default", "WITH RECURSIVE " + ALERTS + """, f AS (SELECT namespace, service, alertname, t, CASE namespace WHEN 'tenant-payment' THEN 180 ELSE 300 END AS gap, min(alert_id) AS alert_id FROM al0 GROUP BY ALL),
  acc AS (SELECT namespace, service, alertname, min(t) AS t, gap FROM f GROUP BY 1, 2, 3, 5
    UNION ALL SELECT a.namespace, a.service, a.alertname, min(f.t), a.gap FROM acc a JOIN f USING (namespace, service, alertname) WHERE f.t > a.t + a.gap GROUP BY a.namespace, a.service, a.alertname, a.t, a.gap)
SELECT namespace, count(*) AS accepted FROM acc GROUP BY 1""")
def _(spark, sf):
    return S.cooldown_dedup(X.alerts(spark, sf), _cooldowns(spark), _KEY).where("accepted").groupBy("namespace").agg(F.count("*").alias("accepted"))


def _closes(spark, sf):
    """Verified recoveries: a purchase with a large k closes the incident of its service."""
    e = X.telemetry(spark, sf).where("signal_name = 'mem' AND k >= 80")
    return e.select("tenant_id", "service", "t")


# no closes: the fate of a service is settled by its first alert, in order of first alerts
@query("g2_correlate_incidents", "WITH RECURSIVE " + ALERTS + ", " + EDGES + """,
  f AS (SELECT tenant_id, service, arg_min(alert_id, (t, alert_id)) AS first_id, min(t) AS t, row_number() OVER (PARTITION BY tenant_id ORDER BY min(t), arg_min(alert_id, (t, alert_id))) AS i FROM al0 GROUP BY 1, 2),
  g AS (SELECT f.*, coalesce(needs, []) AS needs FROM f LEFT JOIN (SELECT service, list(depends_on) AS needs FROM edges GROUP BY 1) USING (service)),
  st AS (SELECT tenant_id, i, service, first_id, 'root' AS role, service AS root, t AS start, [{'s': service, 't': t}] AS roots FROM g WHERE i = 1
    UNION ALL SELECT tenant_id, i, service, first_id, CASE WHEN len(up) > 0 THEN 'symptom' ELSE 'root' END, CASE WHEN len(up) > 0 THEN up[1].s ELSE service END,
      CASE WHEN len(up) > 0 THEN up[1].t ELSE t END, CASE WHEN len(up) > 0 THEN roots ELSE list_append(roots, {'s': service, 't': t}) END
    FROM (SELECT g.*, st.roots, list_filter(st.roots, lambda r: list_contains(g.needs, r.s)) AS up FROM st JOIN g ON g.tenant_id = st.tenant_id AND g.i = st.i + 1) x)
SELECT a.alert_id, a.tenant_id, a.service, CASE WHEN st.role = 'root' AND a.alert_id <> st.first_id THEN 'duplicate' ELSE st.role END AS role, root AS root_service, start AS start_time
FROM al0 a JOIN st USING (tenant_id, service)""")
def _(spark, sf):
    d = S.correlate_incidents(X.alerts(spark, sf), X.edges(spark))
    return d.select("alert_id", "tenant_id", "service", "role", "root_service", "start_time")


# the whole rule as a recursion over each tenant's events in order
FOLD = ALERTS + ", " + EDGES + """, cl AS (SELECT DISTINCT 'tenant-' || (user_id % 4) AS tenant_id, 'svc' || (user_id % 6) AS service, t FROM ev WHERE event_type = 'purchase' AND k >= 80),
  e0 AS (SELECT tenant_id, service, t, 1 AS kind, alert_id FROM al0 UNION ALL SELECT tenant_id, service, t, 0, -1 FROM cl),
  e1 AS (SELECT e0.*, coalesce(needs, []) AS needs, row_number() OVER (PARTITION BY tenant_id ORDER BY t, kind, alert_id) AS i FROM e0 LEFT JOIN (SELECT service, list(depends_on) AS needs FROM edges GROUP BY 1) USING (service)),
  fo AS (SELECT tenant_id, CAST(0 AS BIGINT) AS i, CAST(-1 AS BIGINT) AS alert_id, CAST(0 AS BIGINT) AS t, '' AS service, '' AS role, '' AS root_service, CAST(0 AS BIGINT) AS start_time, [{'s': '', 't': CAST(0 AS BIGINT)}][2:] AS roots FROM e1 WHERE i = 1
    UNION ALL SELECT tenant_id, i, alert_id, t, service, CASE WHEN kind = 0 THEN '' WHEN len(own) > 0 THEN 'duplicate' WHEN len(up) > 0 THEN 'symptom' ELSE 'root' END, CASE WHEN len(own) > 0 THEN service WHEN len(up) > 0 THEN up[1].s ELSE service END,
      CASE WHEN len(own) > 0 THEN own[1].t WHEN len(up) > 0 THEN up[1].t ELSE t END,
      CASE WHEN kind = 0 THEN list_filter(roots, lambda r: r.s <> service) WHEN len(own) > 0 OR len(up) > 0 THEN roots ELSE list_append(roots, {'s': service, 't': t}) END
    FROM (SELECT e1.*, fo.roots, list_filter(fo.roots, lambda r: r.s = e1.service) AS own, list_filter(fo.roots, lambda r: list_contains(e1.needs, r.s)) AS up FROM fo JOIN e1 ON e1.tenant_id = fo.tenant_id AND e1.i = fo.i + 1) x)"""


@query("g2_incidents_with_closes", "WITH RECURSIVE " + FOLD + " SELECT tenant_id, alert_id, service, role, root_service, start_time FROM fo WHERE role <> ''")
def _(spark, sf):
    d = S.correlate_incidents(X.alerts(spark, sf), X.edges(spark), _closes(spark, sf))
    return d.select("tenant_id", "alert_id", "service", "role", "root_service", "start_time")


@query("g3_close_incident", "WITH RECURSIVE " + FOLD + """, ic AS (SELECT tenant_id, root_service, start_time, coalesce(array_to_string(list_sort(list(DISTINCT service) FILTER (role = 'symptom')), ','), '') AS symptoms, count(*) FILTER (role = 'duplicate') AS duplicates FROM fo WHERE role <> '' GROUP BY 1, 2, 3)
SELECT ic.*, sha256(ic.tenant_id || '#' || root_service || '#' || start_time)[:32] AS incident_id, c.closed_at, CASE WHEN c.closed_at IS NULL THEN 'active' ELSE 'resolved' END AS status
FROM ic LEFT JOIN (SELECT ic.tenant_id, root_service, start_time, min(cl.t) AS closed_at FROM ic JOIN cl ON cl.tenant_id = ic.tenant_id AND cl.service = ic.root_service AND cl.t > ic.start_time GROUP BY 1, 2, 3) c USING (tenant_id, root_service, start_time)""")
def _(spark, sf):
    c = _closes(spark, sf)
    inc = S.incident_table(S.correlate_incidents(X.alerts(spark, sf), X.edges(spark), c), c)
    return inc.withColumn("symptoms", F.array_join("symptoms", ","))


@query("g4_decide_once", with_(EV, """rq AS (SELECT event_id AS request_id, t, CASE WHEN k < 10 THEN 'none' ELSE 'inc-' || (user_id % 40) END AS incident_id, 'svc' || (user_id % 6) AS service FROM ev WHERE event_type = 'click'),
  inc AS (SELECT DISTINCT 'inc-' || (user_id % 40) AS incident_id, 'svc' || (user_id % 40 % 6) AS root_service FROM ev),
  r AS (SELECT *, row_number() OVER (PARTITION BY incident_id, service = root_service ORDER BY t, request_id) AS n FROM rq LEFT JOIN inc USING (incident_id)),
  d AS (SELECT *, CASE WHEN root_service IS NULL THEN NULL WHEN service <> root_service THEN 'correlated downstream symptom of upstream ' || root_service
     WHEN n > 1 THEN 'duplicate alert for root-cause (already decided)' END AS suppression_reason FROM r)""") + """
SELECT incident_id, request_id, t, service, root_service, suppression_reason, suppression_reason IS NOT NULL AS suppressed,
  CASE WHEN suppression_reason IS NOT NULL THEN 'CorrelatedSymptomSuppression' END AS matched_runbook, CASE WHEN suppression_reason IS NOT NULL THEN 10 END AS verify_window_seconds FROM d""")
def _(spark, sf):
    e = X.events(spark, sf)
    rq = e.where("event_type = 'click'").select(F.col("event_id").alias("request_id"), "t", F.when(F.col("k") < 10, "none").otherwise(F.concat(F.lit("inc-"), F.col("user_id") % 40)).alias("incident_id"), F.concat(F.lit("svc"), F.col("user_id") % 6).alias("service"))
    inc = e.select(F.concat(F.lit("inc-"), F.col("user_id") % 40).alias("incident_id"), F.concat(F.lit("svc"), F.col("user_id") % 40 % 6).alias("root_service")).distinct()
    return S.decide_once(rq, inc)


# failures: errors with a small k; a day-long window because the fixture is sparse
_FAIL = ALERTS + """, fa AS (SELECT * FROM al0 WHERE k < 50), roll AS (SELECT tenant_id, namespace, service, t, count(*) OVER (PARTITION BY tenant_id, namespace, service ORDER BY t RANGE BETWEEN 86399 PRECEDING AND CURRENT ROW) AS n FROM fa),
  opn AS (SELECT DISTINCT tenant_id, namespace, service, t, n FROM roll WHERE n >= 3)"""


def _failures(spark, sf):
    return X.alerts(spark, sf).where("k < 50")


@query("g5_circuit_breaker", with_(_FAIL, "f AS (SELECT tenant_id, namespace, service, min(t) AS opened_at FROM opn GROUP BY 1, 2, 3)")
       + "SELECT al0.*, opened_at, coalesce(opened_at <= al0.t, FALSE) AS breaker_open FROM al0 LEFT JOIN f USING (tenant_id, namespace, service)")
def _(spark, sf):
    return S.circuit_breaker(_failures(spark, sf), X.alerts(spark, sf), window=86400)


@query("g5_breaker_reset", with_(_FAIL) + """SELECT alert_id, max(opn.t) AS opened_at, coalesce(any_value(al0.t) - max(opn.t) < 1800, FALSE) AS breaker_open
FROM al0 LEFT JOIN opn ON opn.tenant_id = al0.tenant_id AND opn.namespace = al0.namespace AND opn.service = al0.service AND opn.t <= al0.t GROUP BY 1""")
def _(spark, sf):
    d = S.circuit_breaker(_failures(spark, sf), X.alerts(spark, sf), reset_after=1800, window=86400)
    return d.select("alert_id", "opened_at", "breaker_open")


CALLS = EV + """, calls AS (SELECT event_id AS call_id, t, 'tenant-' || (user_id % 4) AS tenant_id, ['openai', 'anthropic', 'bedrock'][user_id % 3 + 1] AS provider,
  CAST(floor(value * 8000) AS BIGINT) AS input_tokens, CAST(k * 5000 AS BIGINT) AS output_tokens, CASE k % 10 WHEN 0 THEN 500 WHEN 1 THEN 429 WHEN 2 THEN NULL ELSE 200 END AS status_code FROM ev),
  cost AS (SELECT *, input_tokens * CASE provider WHEN 'openai' THEN 2.5 ELSE 3.0 END::DOUBLE / 1e6 + output_tokens * CASE provider WHEN 'openai' THEN 10.0 ELSE 15.0 END::DOUBLE / 1e6 AS cost FROM calls),
  run AS (SELECT *, t // 86400 AS day, coalesce(sum(cost) OVER (PARTITION BY tenant_id, t // 86400 ORDER BY t, call_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cost_before FROM cost)"""


def calls(spark, sf):
    c = X.events(spark, sf).select(
        F.col("event_id").alias("call_id"), "t", F.concat(F.lit("tenant-"), F.col("user_id") % 4).alias("tenant_id"),
        F.element_at(F.array(F.lit("openai"), F.lit("anthropic"), F.lit("bedrock")), (F.col("user_id") % 3 + 1).cast("int")).alias("provider"),
        F.floor(F.col("value") * 8000).alias("input_tokens"), (F.col("k") * 5000).cast("long").alias("output_tokens"),
        F.when(F.col("k") % 10 == 0, 500).when(F.col("k") % 10 == 1, 429).when(F.col("k") % 10 > 2, 200).alias("status_code"))
    return c.withColumn("cost", S.call_cost(F.col("provider"), F.col("input_tokens"), F.col("output_tokens")))


@query("g6_daily_cost_cap", with_(CALLS) + "SELECT call_id, tenant_id, day, round(cost, 7) AS cost, round(cost_before, 7) AS cost_before, cost_before >= 50 AS cost_cap_exceeded FROM run")
def _(spark, sf):
    d = S.daily_cost_cap(calls(spark, sf))
    return rounded(d.select("call_id", "tenant_id", "day", "cost", "cost_before", "cost_cap_exceeded"), "cost", "cost_before", digits=7)


@query("k7_cost_alerts", with_(CALLS) + """SELECT tenant_id, day, min(t) FILTER (cost_before + cost >= 40) AS warned_at, min(t) FILTER (cost_before + cost >= 50) AS capped_at FROM run
GROUP BY 1, 2 HAVING min(t) FILTER (cost_before + cost >= 40) IS NOT NULL""")
def _(spark, sf):
    return S.cost_alerts(calls(spark, sf))


@query("g7_idempotency_dedup", with_(EV, "rq AS (SELECT event_id AS request_id, t, 'tenant-' || (user_id % 4) AS tenant_id, 'key-' || (event_id % 4000) AS idempotency_key, CASE WHEN k % 3 = 0 THEN 'detect' ELSE 'decide' END AS stage FROM ev)") + """
SELECT *, stage = 'decide' AND row_number() OVER (PARTITION BY tenant_id, idempotency_key, stage ORDER BY t, request_id) > 1 AS conflict FROM rq""")
def _(spark, sf):
    rq = X.events(spark, sf).select(F.col("event_id").alias("request_id"), "t", F.concat(F.lit("tenant-"), F.col("user_id") % 4).alias("tenant_id"),
                                    F.concat(F.lit("key-"), F.col("event_id") % 4000).alias("idempotency_key"), F.when(F.col("k") % 3 == 0, "detect").otherwise("decide").alias("stage"))
    return S.idempotency_dedup(rq)


# one-day slots and small limits because the fixture is sparse; hour-wide "seconds" make border ties
@query("g8_tier_rate_limit", with_(EV, "rq AS (SELECT event_id AS request_id, (t // 3600) * 3600 AS t, 'tenant-' || (user_id % 4) AS tenant_id FROM ev)") + """
SELECT request_id, tenant_id, t, row_number() OVER (PARTITION BY tenant_id, t // 86400 ORDER BY t, request_id) <= CASE WHEN tenant_id IN ('tenant-0', 'tenant-1') THEN 30 ELSE 10 END AS allowed FROM rq""")
def _(spark, sf):
    rq = X.events(spark, sf).select(F.col("event_id").alias("request_id"), F.expr("(t div 3600) * 3600").alias("t"), F.concat(F.lit("tenant-"), F.col("user_id") % 4).alias("tenant_id"))
    limit = dict(fixed.TIER_LIMITS)
    tiers = spark.createDataFrame([("tenant-0", limit["pro"]), ("tenant-1", limit["pro"]), ("tenant-2", limit["basic"]), ("tenant-3", limit["basic"])], "tenant_id string, rate_limit int")
    return S.tier_rate_limit(rq, tiers, 86400).select("request_id", "tenant_id", "t", "allowed")


@query("g9_malformed_rate", with_(EV) + """SELECT (t // 21600) * 21600 AS window_start, count(*) AS n, count(*) FILTER (k = 0) AS rejected,
  round(count(*) FILTER (k = 0) / count(*), 6) AS share, count(*) FILTER (k = 0) / count(*) > 0.005 AS alert FROM ev GROUP BY 1""")
def _(spark, sf):
    d = X.events(spark, sf).withColumn("errors", F.when(F.col("k") == 0, F.array(F.lit("ts"))).otherwise(F.array().cast("array<string>")))
    return rounded(S.malformed_rate(d, 21600), "share")


@query("g10_telemetry_sla", with_(TEL, """p AS (SELECT tenant_id, signal_name, (t // 43200) * 43200 AS t, (t // 43200) * 43200 + k AS received_t FROM tel),
  l(signal_name, d, m) AS (VALUES ('service_error_rate', 10, 5), ('service_latency_p95', 10, 5), ('application_log_event', 5, 6))""") + """
SELECT tenant_id, signal_name, t, count(*) AS n, count(*) FILTER (received_t - t >= d) AS late, count(*) > any_value(m) AS over_volume FROM p JOIN l USING (signal_name)
GROUP BY 1, 2, 3 HAVING count(*) > any_value(m) OR count(*) FILTER (received_t - t >= d) > 0""")
def _(spark, sf):
    p = X.telemetry(spark, sf).withColumn("t", F.expr("(t div 43200) * 43200")).withColumn("received_t", F.col("t") + F.col("k"))
    lim = spark.createDataFrame([("service_error_rate", 10, 5), ("service_latency_p95", 10, 5), ("application_log_event", 5, 6)], "signal_name string, max_delay int, max_per_second int")
    return S.telemetry_sla(p, lim)
