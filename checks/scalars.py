"""B: predicates, validation and scalar functions."""
from pyspark.sql import functions as F

from checks import query
from checks.ctes import ALERTS, EV, LOGS, TEL, with_
from checks.views import rounded
from mendstream import fixed
from mendstream.functions import scalars as SC, scrub as SB, validate as V
from mendstream.plans import fixtures as X

_UUID = "'00000000-0000-4000-8000-' || lpad((user_id)::VARCHAR, 12, '0')"


def _uuid(col="user_id"):
    return F.concat(F.lit("00000000-0000-4000-8000-"), F.lpad(F.col(col).cast("string"), 12, "0"))


def _raw_points(spark, sf):
    """Points as sent, some of them broken."""
    e = X.events(spark, sf)
    log = F.col("event_type") == "signup"
    return e.select(
        F.col("event_id").alias("seq"), "k",
        F.when(F.col("k") == 1, "yesterday").otherwise(F.date_format(F.timestamp_seconds("t"), "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("ts"),
        F.when(F.col("k") == 2, "tenant-x").otherwise(_uuid()).alias("tenant_id"),
        F.when(F.col("k") != 3, F.concat(F.lit("svc"), F.col("user_id") % 6)).alias("service"),
        F.when(F.col("k") == 4, "made_up").when(log, "application_log_event").otherwise("cpu").alias("signal_name"),
        F.when(~log & (F.col("k") != 5), F.col("value")).when(log & (F.col("k") == 6), F.col("value")).alias("value_num"),
        F.when((log & (F.col("k") != 6)) | (~log & (F.col("k") == 5)), "text").alias("value_str"),
        F.when(F.col("k") == 7, F.create_map(F.lit("pod"), F.lit("p"))).when(F.col("k") % 2 == 0, F.create_map(F.lit("system"), F.lit("s"))).alias("labels"),
        F.when(F.col("k") == 8, F.array(F.lit("colour"))).otherwise(F.array().cast("array<string>")).alias("extra_keys"))


_RULES = """SELECT event_id AS seq, concat_ws(',', CASE WHEN k = 3 THEN 'missing_field' END, CASE WHEN k = 8 THEN 'extra_field' END, CASE WHEN k = 1 THEN 'ts' END, CASE WHEN k = 2 THEN 'tenant_id' END,
  CASE WHEN k = 4 THEN 'signal_name' END, CASE WHEN k = 7 THEN 'labels_system' END,
  CASE WHEN (k = 5 AND event_type <> 'signup') OR (k = 6 AND event_type = 'signup') OR (k = 4 AND event_type = 'signup') THEN 'value_type' END) AS errors FROM ev"""


@query("b1_validate_telemetry", with_(EV) + f"SELECT seq, errors FROM ({_RULES}) WHERE errors <> ''")
def _(spark, sf):
    _ok, bad = V.validate_telemetry(_raw_points(spark, sf))
    return bad.select("seq", F.array_join("errors", ",").alias("errors"))


@query("b1_valid_points", with_(EV) + f"SELECT count(*) AS n FROM ({_RULES}) WHERE errors = ''")
def _(spark, sf):
    ok, _bad = V.validate_telemetry(_raw_points(spark, sf))
    return ok.agg(F.count("*").alias("n"))


@query("b2_tenant_isolation", with_(EV) + """SELECT 'req-' || (event_id // 10) AS request_id, event_id % 10 AS point_index, 'tenant-' || CASE WHEN k < 3 THEN 9 ELSE event_id // 10 % 4 END AS tenant_id,
  'tenant-' || (event_id // 10 % 4) AS request_tenant, 403 AS status_code FROM ev WHERE k < 3""")
def _(spark, sf):
    e = X.events(spark, sf)
    rid = F.concat(F.lit("req-"), F.expr("event_id div 10"))
    own = F.concat(F.lit("tenant-"), F.expr("event_id div 10 % 4"))
    pts = e.select(rid.alias("request_id"), (F.col("event_id") % 10).alias("point_index"), F.when(F.col("k") < 3, "tenant-9").otherwise(own).alias("tenant_id"))
    return V.tenant_isolation(pts, e.select(rid.alias("request_id"), own.alias("tenant_id")).distinct())


def _envelopes(spark, sf):
    e = X.events(spark, sf)
    k = F.col("k")
    return e.select(
        F.col("event_id").alias("request_id"), F.when(k == 0, "t").otherwise(_uuid()).alias("x_tenant_id"),
        F.when(k == 1, "c").when(k == 2, F.lit(None)).otherwise(_uuid()).alias("x_correlation_id"), F.when(k == 3, "i").otherwise(_uuid("event_id")).alias("idempotency_header"),
        F.when(k == 4, "i").when(k == 5, _uuid()).otherwise(_uuid("event_id")).alias("idempotency_key"), F.when(k == 6, "maybe").when(k == 7, " TRUE ").otherwise("false").alias("x_dry_run_mode"),
        (k == 8).alias("dry_run_mode"), F.when(k == 9, _uuid("event_id")).otherwise(_uuid()).alias("correlation_id"))


_ENV = """SELECT event_id AS request_id, CASE k WHEN 0 THEN 'tenant_header_not_uuid' WHEN 1 THEN 'correlation_header_not_uuid' {two} WHEN 3 THEN 'idempotency_header_not_uuid' WHEN 4 THEN 'idempotency_body_not_uuid'
  WHEN 5 THEN CASE WHEN user_id <> event_id THEN 'idempotency_mismatch' END WHEN 6 THEN 'dry_run_header_invalid' WHEN 7 THEN 'dry_run_mismatch' WHEN 8 THEN 'dry_run_mismatch'
  WHEN 9 THEN CASE WHEN user_id <> event_id THEN 'correlation_mismatch' END END AS error FROM ev"""


@query("b3_validate_envelope", with_(EV) + "SELECT 'detect' AS stage, * FROM (" + _ENV.format(two="") + ") UNION ALL SELECT 'decide', * FROM (" + _ENV.format(two="WHEN 2 THEN 'correlation_header_not_uuid'") + ")")
def _(spark, sf):
    d = _envelopes(spark, sf)
    parts = [d.select(F.lit(s).alias("stage"), "request_id", V.envelope_error(s).alias("error")) for s in ("detect", "decide")]
    return parts[0].unionByName(parts[1])


_SPACES = "(VALUES ('tenant-payment','d3b07384-d113-495f-9f58-20d18d357d75'),('tenant-checkout','6c8b4b2b-4d45-4209-a1b4-4b532d56a31c')) ns(namespace, expected)"


@query("b4_alert_admission", with_(ALERTS) + f"""SELECT alert_id, CASE WHEN status <> 'firing' THEN 'ignored_not_firing' WHEN alertname = 'HighLoad' THEN 'ignored_alert_name' WHEN k < 5 THEN 'ignored_no_namespace'
  WHEN expected IS NULL THEN 'ignored_unknown_namespace' WHEN alert_id % 7 = 0 THEN 'violation' ELSE 'admitted' END AS outcome FROM al0 LEFT JOIN {_SPACES} USING (namespace)""")
def _(spark, sf):
    dim = spark.createDataFrame(fixed.NAMESPACES, "namespace string, tenant_id string, cooldown int")
    tenant = F.create_map(*[F.lit(x) for n, t, _ in fixed.NAMESPACES for x in (n, t)])
    a = X.alerts(spark, sf).drop("tenant_id")
    a = a.withColumn("request_tenant", F.when(F.col("alert_id") % 7 != 0, tenant[F.col("namespace")])).withColumn("namespace", F.when(F.col("k") >= 5, F.col("namespace")))
    return V.alert_outcome(a, dim).select("alert_id", "outcome")


@query("b5_series_name", with_(TEL) + """SELECT seq, CASE WHEN seq % 3 = 0 THEN service || '_' || signal_name WHEN seq % 3 = 1 THEN service || '_' || signal_name ELSE service || '_redis_mem' END AS series FROM tel""")
def _(spark, sf):
    t = X.telemetry(spark, sf)
    s = F.when(F.col("seq") % 3 == 0, F.concat_ws("_", "service", "signal_name")).when(F.col("seq") % 3 == 1, F.col("signal_name")).otherwise(F.lit("redis_mem"))
    return t.select("seq", SC.series_name(F.col("service"), s, [*X.SERVICES, "redis"]).alias("series"))


_NAMES = """nm AS (SELECT event_id AS seq, ['cart', 'cart-db', 'Checkout', 'ghost'][event_id % 4 + 1] || '_' || ['cpu', 'memory_rss', 'disk_io', 'tcp_connections', 'error_rate', 'latency-90', 'workload'][k % 7 + 1] AS series FROM ev)"""
_GROUPS = """concat_ws(',', CASE WHEN regexp_matches(x, 'cpu|processor|core') THEN 'cpu' END, CASE WHEN regexp_matches(x, 'mem|memory|oom|rss|heap|container_resource_usage') THEN 'mem' END,
 CASE WHEN regexp_matches(x, 'disk|io|fs') THEN 'disk' END, CASE WHEN regexp_matches(x, 'socket|connection|conn|fd|file_descriptor|tcp') THEN 'socket' END,
 CASE WHEN regexp_matches(x, 'loss|packet|error|unavailable|reset|refused|deadline|no healthy|dropped') THEN 'loss' END,
 CASE WHEN regexp_matches(x, 'latency|delay|p95|p90|p99|timeout|duration|slow') THEN 'delay' END)"""


def _names(spark, sf):
    pick = lambda xs, i: F.element_at(F.array(*[F.lit(x) for x in xs]), (i + 1).cast("int"))
    return X.events(spark, sf).select(F.col("event_id").alias("seq"), F.concat_ws(
        "_", pick(["cart", "cart-db", "Checkout", "ghost"], F.col("event_id") % 4), pick(["cpu", "memory_rss", "disk_io", "tcp_connections", "error_rate", "latency-90", "workload"], F.col("k") % 7)).alias("series"))


@query("b6_metric_to_service_fault", with_(EV, _NAMES, "s AS (SELECT *, CASE WHEN series LIKE 'cart-db_%' THEN 'cart-db' WHEN series LIKE 'cart_%' THEN 'cart' WHEN series LIKE 'Checkout%' THEN 'checkout' ELSE 'ghost' END AS service FROM nm)")
       + f"SELECT seq, series, service, coalesce(nullif(split_part({_GROUPS}, ',', 1), ''), 'cpu') AS fault FROM (SELECT *, lower(series[length(service) + 2:]) AS x FROM s)")
def _(spark, sf):
    known = ["cart", "cart-db", "checkout"]
    return _names(spark, sf).select("seq", "series", SC.series_service(F.col("series"), known).alias("service"), SC.series_fault(F.col("series"), known).alias("fault"))


@query("b7_fault_groups", with_(LOGS) + f"SELECT seq, {_GROUPS} AS families FROM (SELECT seq, lower(CASE WHEN seq % 2 = 0 THEN message ELSE message || ' Connection RESET, slow disk' END) AS x FROM lg)")
def _(spark, sf):
    text = F.when(F.col("seq") % 2 == 0, F.col("message")).otherwise(F.concat("message", F.lit(" Connection RESET, slow disk")))
    return X.logs(spark, sf).select("seq", F.array_join(SC.fault_groups(text), ",").alias("families"))


_FAULT = "['cpu', 'mem', 'disk', 'delay', 'loss', 'socket', 'f1'][k % 7 + 1]"


def _fault():
    return F.element_at(F.array(*[F.lit(f) for f in ("cpu", "mem", "disk", "delay", "loss", "socket", "f1")]), F.col("k") % 7 + 1)


@query("b9_contract_signal_value", with_(EV) + f"""SELECT event_id, f AS fault, CASE WHEN f IN ('cpu', 'mem', 'disk') THEN 'container_resource_usage' WHEN f = 'delay' THEN 'service_latency_p95' WHEN f = 'socket' THEN 'db_connection_pool_saturation' ELSE 'service_error_rate' END AS signal_name,
  round(CASE WHEN f IN ('cpu', 'mem', 'disk') THEN greatest(x, 1) * 1048576 WHEN f = 'delay' THEN greatest(x, 1) * 1000 WHEN f IN ('loss', 'socket') THEN greatest(0, least(x, 1)) ELSE x END, 6) AS value FROM (SELECT event_id, {_FAULT} AS f, value / 50 AS x FROM ev)""")
def _(spark, sf):
    d = X.events(spark, sf).select("event_id", _fault().alias("fault"), (F.col("value") / 50).alias("x"))
    return rounded(d.select("event_id", "fault", SC.contract_signal(F.col("fault")).alias("signal_name"), SC.contract_value(F.col("fault"), F.col("x")).alias("value")), "value")


_SIGNAL = "CASE alertname WHEN 'PodOOMKilled' THEN 'pod_oom_event' WHEN 'PodCrashLooping' THEN 'container_restart_count' WHEN 'ServiceStuck' THEN 'service_unhealthy' ELSE 'queue_backlog' END"


@query("b10_alert_signal", with_(ALERTS) + f"SELECT alert_id, {_SIGNAL} AS signal_name FROM al0")
def _(spark, sf):
    return X.alerts(spark, sf).select("alert_id", SC.alert_signal(F.col("alertname")).alias("signal_name"))


@query("b11_alert_labels", with_(ALERTS) + """SELECT alert_id, upper(replace(namespace, 'tenant-', '')) AS system, namespace, service AS deployment, CASE WHEN k % 3 = 0 THEN 'pod-' || k ELSE service || '-pod' END AS pod_name,
  CASE WHEN k % 4 = 0 THEN 'app' ELSE 'main' END AS container FROM al0""")
def _(spark, sf):
    pod, con = F.when(F.col("k") % 3 == 0, F.concat(F.lit("pod-"), F.col("k"))), F.when(F.col("k") % 4 == 0, "app")
    d = X.alerts(spark, sf).withColumn("l", SC.alert_labels(F.col("namespace"), F.col("service"), F.col("alertname"), pod, con))
    return d.select("alert_id", *[F.col("l")[x].alias(x) for x in ("system", "namespace", "deployment", "pod_name", "container")])


@query("b12_lock_key", with_(ALERTS) + "SELECT alert_id, sha256(tenant_id || '#' || namespace || '#' || service || '#' || alertname) AS lock_key FROM al0")
def _(spark, sf):
    return X.alerts(spark, sf).select("alert_id", SC.lock_key(F.col("tenant_id"), F.col("namespace"), F.col("service"), F.col("alertname")).alias("lock_key"))


def _texts(spark, sf):
    """Documents with a secret of each kind in turn at their end."""
    d = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    n = F.lpad(F.col("doc_id").cast("string"), 16, "0")
    tail = (
        F.when(F.col("doc_id") % 4 == 0, F.concat(F.lit(" Authorization: Bearer ab"), n, F.lit(".cd-_.ef")))
        .when(F.col("doc_id") % 4 == 1, F.concat(F.lit(" Authorization: basic "), n)).when(F.col("doc_id") % 4 == 2, F.concat(F.lit(" key AKIA"), n)).otherwise(F.concat(F.lit(" mail ops"), n, F.lit("@example.com")))
    )
    return d.withColumn("text", F.concat("text", tail))


_TEXTS = """tx AS (SELECT doc_id, text || CASE doc_id % 4 WHEN 0 THEN ' Authorization: Bearer ab' || n || '.cd-_.ef' WHEN 1 THEN ' Authorization: basic ' || n WHEN 2 THEN ' key AKIA' || n ELSE ' mail ops' || n || '@example.com' END AS text
  FROM (SELECT doc_id, text, lpad(doc_id::VARCHAR, 16, '0') AS n FROM documents))"""
_R = [r"(?i)\bBearer\s+[A-Za-z0-9\-_]+\.[A-Za-z0-9\-_]+\.[A-Za-z0-9\-_.+/=]*", r"(?i)\bBasic\s+[A-Za-z0-9+/=]{8,}", r"\b(A[SK]IA|AIDA)[A-Z0-9]{16}\b", r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b", r"\b(?:\d[ -]*?){13,19}\b"]


def _replace(x, patterns):
    for p in patterns:
        x = f"regexp_replace({x}, '{p}', '[SCRUBBED]', 'g')"
    return x


# the rules without look-around or back-references, which SQL can state
@query("b13_scrub_plain_rules", with_(_TEXTS) + f"SELECT doc_id, md5({_replace('text', _R)}) AS scrubbed FROM tx")
def _(spark, sf):
    rules = [fixed.SCRUB_RULES[i] for i in (0, 1, 2, 5, 6)]
    return _texts(spark, sf).select("doc_id", F.md5(SB.scrub(F.col("text"), rules)).alias("scrubbed"))


@query("b13_scrub")
def _(spark, sf):
    return _texts(spark, sf).select("doc_id", SB.scrub(F.col("text")).alias("scrubbed"))


@query("b14_scrub_struct", with_(_TEXTS) + f"""SELECT doc_id, md5({_replace('right(text, 60)', _R[:3] + _R[3:])}) AS note, '[SCRUBBED]' AS api_key, CASE WHEN doc_id % 2 = 0 THEN '[SCRUBBED]' ELSE 'v' || doc_id END AS tag FROM tx""")
def _(spark, sf):
    d = _texts(spark, sf).select("doc_id", F.struct(
        F.right("text", F.lit(60)).alias("note"), F.col("text").alias("api_key"),
        F.create_map(F.when(F.col("doc_id") % 2 == 0, "Auth-Token").otherwise("tag"), F.concat(F.lit("v"), F.col("doc_id"))).alias("tags")).alias("payload"))
    s = SB.scrub_struct(d, ["payload"])
    return s.select("doc_id", F.md5("payload.note").alias("note"), "payload.api_key", F.map_values("payload.tags")[0].alias("tag"))


@query("b15_scrub_by_keys", with_(EV) + """SELECT event_id, '[SCRUBBED]' AS secret_count, CASE WHEN event_id % 2 = 0 THEN '[SCRUBBED]' ELSE k::VARCHAR END AS number, user_id FROM ev""")
def _(spark, sf):
    d = X.events(spark, sf).select("event_id", F.struct(F.col("k").alias("secret_count"), "user_id",
                                                       F.create_map(F.when(F.col("event_id") % 2 == 0, "passwd_len").otherwise("len"), F.col("k")).alias("m")).alias("p"))
    return SB.scrub_by_keys(d, ["p"]).select("event_id", "p.secret_count", F.map_values("p.m")[0].alias("number"), "p.user_id")


@query("b16_memory_mb", with_(EV) + """SELECT event_id, CAST(CASE k % 6 WHEN 0 THEN floor(value * 1024) WHEN 1 THEN k WHEN 2 THEN greatest(1, event_id // 1024) WHEN 3 THEN floor(value * 1000) WHEN 4 THEN k END AS BIGINT) AS mb FROM ev""")
def _(spark, sf):
    u = F.element_at(F.array(*[F.lit(x) for x in ("Gi", "Mi", "Ki", "G", "M", "Ti")]), F.col("k") % 6 + 1)
    n = F.when(F.col("k") % 3 == 0, F.col("value").cast("string")).when(F.col("k") % 6 == 2, F.col("event_id").cast("string")).otherwise(F.col("k").cast("string"))
    return X.events(spark, sf).select("event_id", SC.memory_mb(F.concat(n, u)).alias("mb"))


@query("b17_mask_log", with_(LOGS) + r"""SELECT seq, regexp_replace(regexp_replace(regexp_replace(message, '\d+\.\d+\.\d+\.\d+', '<IP>', 'g'), '[a-fA-F0-9]{8}-[a-fA-F0-9]{4}-[a-fA-F0-9]{4}-[a-fA-F0-9]{4}-[a-fA-F0-9]{12}', '<UUID>', 'g'), '\d+', '<NUM>', 'g') AS masked FROM lg""")
def _(spark, sf):
    return X.logs(spark, sf).select("seq", SC.mask_log(F.col("message")).alias("masked"))


@query("b18_is_error_log", with_(LOGS) + """SELECT seq, regexp_matches(message, '(?i)(error|exception|fail|timeout|exhaust|limit|abort|invalid|refused|conn|crash|oom|kill)') OR (seq % 5 = 0) AS is_error FROM lg""")
def _(spark, sf):
    return X.logs(spark, sf).select("seq", SC.is_error_log(F.col("message"), F.when(F.col("seq") % 5 == 0, "WARN").otherwise("info")).alias("is_error"))


@query("b19_render_target", with_(EV) + """SELECT event_id, CASE k % 3 WHEN 0 THEN 'deployment/svc' || (user_id % 6) ELSE 'deployment/own-' || user_id END AS target FROM ev""")
def _(spark, sf):
    tpl = F.when(F.col("k") % 3 == 0, fixed.TARGET_TEMPLATE).when(F.col("k") % 3 == 1, "statefulset/{{target_service}}")
    return X.events(spark, sf).select("event_id", SC.render_target(tpl, F.concat(F.lit("svc"), F.col("user_id") % 6), F.concat(F.lit("deployment/own-"), F.col("user_id"))).alias("target"))


@query("b20_clip_reason", """SELECT doc_id, md5(CASE WHEN doc_id % 2 = 0 THEN CASE WHEN length('[CORRELATED ALERT] ' || r) > 300 THEN ('[CORRELATED ALERT] ' || r)[:297] || '...' ELSE '[CORRELATED ALERT] ' || r END ELSE r END) AS reason
FROM (SELECT doc_id, CASE WHEN length(text) > 300 THEN text[:297] || '...' ELSE text END AS r FROM documents)""")
def _(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet")
    return d.select("doc_id", F.md5(SC.correlated_reason(SC.clip_reason(F.col("text")), F.col("doc_id") % 2 == 0)).alias("reason"))


@query("b21_extract_json", """SELECT conv_id, turn, CASE WHEN (conv_id + turn) % 4 = 3 THEN NULL ELSE '{"turn": ' || turn || '}' END AS json FROM conversations""")
def _(spark, sf):
    c = spark.read.parquet(f"{sf}/conversations.parquet").withColumn("m", (F.col("conv_id") + F.col("turn")) % 4)
    plain = F.regexp_replace("text", r"[{}`]", "")
    body = F.concat(F.lit('{"turn": '), F.col("turn"), F.lit("}"))
    fenced = F.concat(F.lit("```json\n"), body, F.lit("\n```\n"), plain)
    noisy = F.concat(plain, F.lit("\n"), body, F.lit("\n"), plain)
    text = F.when(F.col("m") == 0, F.concat(F.lit("  "), body, F.lit(" "))).when(F.col("m") == 1, fenced).when(F.col("m") == 2, noisy).otherwise(plain)
    return c.select("conv_id", "turn", SC.extract_json(text).alias("json"))


# decisions about each alert, broken in turn
_BREAK = 14


def decision_texts(spark, sf):
    a = X.alerts(spark, sf).withColumn("m", F.col("k") % _BREAK)
    m, q = F.col("m"), lambda x: F.concat(F.lit('"'), x, F.lit('"'))
    svc = F.when(m == 1, "ghost").otherwise(F.col("service"))
    fault = F.element_at(F.array(F.lit("cpu"), F.lit("mem"), F.lit("delay")), (F.col("alert_id") % 3 + 1).cast("int"))
    book = F.when(m == 3, "MadeUpRunbook").when(m == 4, "DiskIORecoveryRunbook").otherwise(SC.lookup(fault, fixed.FAULT_RUNBOOK))
    step = F.when(m == 5, F.lit("[]")).otherwise(F.concat(
        F.lit('[{"step":1,"action":"'), F.when(m == 6, "DELETE_ALL").otherwise("RESTART_DEPLOYMENT"), F.lit('","target":"deployment/'), F.when(m == 7, "other").otherwise(svc),
        F.lit('","params":{"namespace":"'), F.when(m == 8, "other").otherwise("tenant-payment"), F.lit('"}}]')))
    text = F.concat(
        F.lit('{"detect_assessment":{"is_detect_output_plausible":true,"assessment_reason":"'), F.when(m == 9, " ").otherwise("seen"), F.lit('"},"corrected_anomaly_context":{"target_service":'), q(svc),
        F.lit(',"suspected_fault_type":'), q(F.when(m == 2, "f1").otherwise(fault)), F.lit('},"matched_runbook":'), q(book), F.lit(',"pattern_type":'), q(F.when(m == 10, "later").otherwise("urgent")),
        F.lit(',"action_plan":'), step, F.lit(',"blast_radius_config":{"max_pod_impact_pct":25,"circuit_breaker_error_rate":0.2,"allowed_namespaces":["'), F.when(m == 11, "x").otherwise("tenant-payment"),
        F.lit('"]},"verify_policy":{'), F.when(m == 12, "").otherwise('"window_seconds":120'), F.lit("}"), F.when(m == 13, ',"extra":1').otherwise(""), F.lit("}"))
    return a.select("alert_id", F.col("service").alias("target_service"), F.lit("loss").alias("suspected_fault_type"), F.lit("tenant-payment").alias("namespace"),
                    F.when(F.col("alert_id") % 50 == 7, "no decision").otherwise(text).alias("raw"))


_REASON = """CASE WHEN alert_id % 50 = 7 THEN 'not_json' ELSE [NULL, 'service', 'fault_type', 'unknown_runbook', 'runbook_mismatch', 'empty_plan', 'action', 'target', 'step_namespace', 'assessment', 'pattern_type', 'blast_namespace', 'verify_policy', 'extra_keys'][k % 14 + 1] END"""


@query("b22_validate_decision", with_(ALERTS, f"d AS (SELECT *, {_REASON} AS reject_reason, alert_id % 3 AS f FROM al0)") + """SELECT alert_id, reject_reason, service AS exec_service,
  CASE WHEN reject_reason IS NULL THEN ['cpu', 'mem', 'delay'][f + 1] ELSE 'loss' END AS exec_fault,
  CASE WHEN reject_reason IS NULL THEN ['CPUSaturationRecoveryRunbook', 'MemoryLeakRecoveryRunbook', 'NetworkLatencyRecoveryRunbook'][f + 1] ELSE 'PacketLossRecoveryRunbook' END AS exec_runbook FROM d""")
def _(spark, sf):
    d = V.validate_decision(decision_texts(spark, sf), X.SERVICES, ["tenant-payment", "tenant-checkout"])
    return d.select("alert_id", "reject_reason", "exec_service", "exec_fault", "exec_runbook")


@query("b23_validate_fault_ranking", with_(ALERTS) + """SELECT alert_id, CASE k % 5 WHEN 1 THEN 'fault_type' WHEN 2 THEN 'confidence' WHEN 3 THEN 'reason' WHEN 4 THEN 'extra_keys' END AS reject_reason,
  CASE WHEN k % 5 = 0 THEN CASE WHEN k >= 50 THEN 'mem,cpu,disk' ELSE 'cpu,mem,disk' END END AS ranking FROM al0""")
def _(spark, sf):
    m = F.col("k") % 5
    first = F.when(m == 2, "1.5").when(F.col("k") >= 50, "0.3").otherwise("0.9")
    text = F.concat(F.lit('{"fault_type_ranking":[{"suspected_fault_type":"cpu","confidence":'), first, F.lit(',"reason":"a"},{"suspected_fault_type":"'), F.when(m == 1, "f1").otherwise("mem"),
                    F.lit('","confidence":0.5,"reason":"'), F.when(m == 3, "").otherwise("b"), F.lit('"},{"suspected_fault_type":"cpu","confidence":7,"reason":""},{"suspected_fault_type":"disk","confidence":0.1,"reason":"c"}]'),
                    F.when(m == 4, ',"x":1').otherwise(""), F.lit("}"))
    d = V.validate_fault_ranking(X.alerts(spark, sf).withColumn("raw", text))
    return d.select("alert_id", "reject_reason", F.array_join(F.transform("ranking", lambda r: r["suspected_fault_type"]), ",").alias("ranking"))


@query("b23_validate_fault_choice", with_(ALERTS) + """SELECT alert_id, CASE k % 5 WHEN 1 THEN 'fault_type' WHEN 2 THEN 'confidence' WHEN 3 THEN 'reason' WHEN 4 THEN 'missing_keys' END AS reject_reason FROM al0""")
def _(spark, sf):
    m = F.col("k") % 5
    text = F.concat(F.lit('{"suspected_fault_type":"'), F.when(m == 1, "f1").otherwise("cpu"), F.lit('","confidence":'), F.when(m == 2, "-0.1").otherwise("0.4"),
                    F.when(m == 4, "").otherwise(F.concat(F.lit(',"reason":"'), F.when(m == 3, "").otherwise("why"), F.lit('"'))), F.lit("}"))
    return V.validate_fault_choice(X.alerts(spark, sf).withColumn("raw", text)).select("alert_id", "reject_reason")


@query("b24_validate_response", with_(ALERTS) + """SELECT alert_id, CASE k % 5 WHEN 1 THEN 'anomaly_detected' WHEN 2 THEN 'anomaly_context.namespace' WHEN 3 THEN 'severity' WHEN 4 THEN 'body' END AS detect,
  CASE k % 5 WHEN 1 THEN 'pattern_type' WHEN 2 THEN 'action_plan' WHEN 3 THEN 'action_plan.step' WHEN 4 THEN 'body' END AS decide,
  CASE k % 5 WHEN 1 THEN 'next_action' WHEN 2 THEN 'success' WHEN 3 THEN 'regression_detected' WHEN 4 THEN 'body' END AS verify FROM al0""")
def _(spark, sf):
    m = F.col("k") % 5
    det = F.when(m == 1, '{"severity":0.5}').when(m == 2, '{"anomaly_detected":true,"anomaly_context":{"target_service":"a","deployment":"d"}}').when(m == 3, '{"anomaly_detected":false,"severity":"high"}').when(m == 4, "<html>") \
        .otherwise('{"anomaly_detected":true,"severity":0.5,"anomaly_context":{"target_service":"a","namespace":"n","deployment":"d","trigger_value":3}}')
    dec = F.when(m == 1, '{"pattern_type":"later","action_plan":[]}').when(m == 2, '{"pattern_type":"urgent","action_plan":5}').when(m == 3, '{"pattern_type":"urgent","action_plan":[{"action":"A"}]}').when(m == 4, "[1]") \
        .otherwise('{"pattern_type":"urgent","action_plan":[{"action":"A","target":"t"}],"verify_policy":{}}')
    ver = F.when(m == 1, '{"success":true,"next_action":"WAIT"}').when(m == 2, '{"next_action":"DONE"}').when(m == 3, '{"success":true,"next_action":"DONE","regression_detected":1}').when(m == 4, "") \
        .otherwise('{"success":true,"next_action":"DONE","regression_detected":false}')
    d = X.alerts(spark, sf).select("alert_id", det.alias("a"), dec.alias("b"), ver.alias("c"))
    return d.select("alert_id", V.response_error(F.col("a"), "detect").alias("detect"), V.response_error(F.col("b"), "decide").alias("decide"), V.response_error(F.col("c"), "verify").alias("verify"))


@query("b25_to_reported_status", with_(EV) + """SELECT event_id, CASE WHEN k % 3 = 1 THEN 'FAILED' ELSE 'COMPLETED' END AS status, CAST(round_even(k / 2.0, 0) AS BIGINT) AS seconds FROM ev""")
def _(spark, sf):
    st = F.element_at(F.array(F.lit("DRY_RUN"), F.lit("FAILED"), F.lit("COMPLETED")), F.col("k") % 3 + 1)
    return X.events(spark, sf).select("event_id", SC.reported_status(st).alias("status"), SC.reported_seconds(F.col("k") / 2).alias("seconds"))


def _pod():
    return F.concat(F.lit("svc-"), F.col("user_id"), F.lit("-"), F.substring(F.md5(F.col("event_id").cast("string")), 1, 8), F.lit("-"), F.when(F.col("k") % 4 == 0, "short").otherwise("ab1"))


_POD = "'svc-' || user_id || '-' || md5(event_id::VARCHAR)[:8] || '-' || CASE WHEN k % 4 = 0 THEN 'short' ELSE 'ab1' END"


@query("b26_pod_to_workload", with_(EV) + "SELECT event_id, CASE WHEN k % 4 = 0 THEN 'svc-' || user_id ELSE '' END AS workload FROM ev")
def _(spark, sf):
    return X.events(spark, sf).select("event_id", SC.pod_to_workload(_pod()).alias("workload"))


@query("a4_pod_service_name", with_(EV) + f"""SELECT event_id, CASE WHEN k % 5 = 0 THEN 'named' WHEN k % 5 = 1 THEN 'app' ELSE regexp_replace({_POD}, '-[a-f0-9]{{8,10}}-[a-z0-9]{{5}}$', '') END AS service FROM ev""")
def _(spark, sf):
    labels = F.when(F.col("k") % 5 == 0, F.create_map(F.lit("app"), F.lit("other"), F.lit("app.kubernetes.io/name"), F.lit("named"))) \
        .when(F.col("k") % 5 == 1, F.create_map(F.lit("app.kubernetes.io/name"), F.lit(""), F.lit("app"), F.lit("app"))).otherwise(F.create_map(F.lit("x"), F.lit("y")))
    return X.events(spark, sf).select("event_id", SC.pod_service_name(labels, _pod()).alias("service"))


@query("b27_dims_from_config", with_(EV) + """SELECT event_id, 'floats' AS kind, 0 AS ord, 'cpu' AS key, value::VARCHAR AS val FROM ev UNION ALL SELECT event_id, 'floats', 2, 'mem', k::DOUBLE::VARCHAR FROM ev
UNION ALL SELECT event_id, 'patterns', 0, 'loss', 'a|' || event_type FROM ev UNION ALL SELECT event_id, 'list', i, NULL, x FROM ev, (VALUES (0, 'a'), (2, 'b')) l(i, x)""")
def _(spark, sf):
    e = X.events(spark, sf)
    fl = SC.dims_from_config(e.select("event_id", F.concat(F.lit("cpu: "), "value", F.lit(", bad:x ,mem:"), "k", F.lit(",,nokey")).alias("config")), "floats")
    pt = SC.dims_from_config(e.select("event_id", F.concat(F.lit(" loss : A | "), "event_type", F.lit(" |; empty: ;x")).alias("config")), "patterns")
    ls = SC.dims_from_config(e.select("event_id", F.lit(" a, ,b ").alias("config")), "list")
    return (
        fl.select("event_id", F.lit("floats").alias("kind"), "ord", "key", F.col("value").cast("string").alias("val"))
        .unionByName(pt.select("event_id", F.lit("patterns").alias("kind"), "ord", "key", F.array_join("tokens", "|").alias("val")))
        .unionByName(ls.select("event_id", F.lit("list").alias("kind"), "ord", F.lit(None).cast("string").alias("key"), F.col("item").alias("val")))
    )


@query("b28_action_patch", with_(EV) + """SELECT event_id, CASE k % 5 WHEN 0 THEN '{"spec":{"template":{"spec":{"containers":[{"name":"main","resources":{"limits":{"memory":"' || (k + 1) || 'Mi"}}}]}}}}'
  WHEN 1 THEN '{"spec":{"replicas":' || k || '}}' WHEN 2 THEN '{"spec":{"template":{"metadata":{"annotations":{"self-heal/restart-at":"' || t || '"}}}}}' END AS patch,
  CASE k % 5 WHEN 3 THEN 'replicas is missing' WHEN 4 THEN 'unsupported action: ROLLOUT_UNDO' END AS error FROM ev""")
def _(spark, sf):
    m = F.col("k") % 5
    action = F.element_at(F.array(*[F.lit(a) for a in ("PATCH_MEMORY_LIMIT", "SCALE_REPLICAS", "RESTART_DEPLOYMENT", "SCALE_REPLICAS", "ROLLOUT_UNDO")]), m + 1)
    params = F.when(m == 0, F.create_map(F.lit("memory_limit_mb"), (F.col("k") + 1).cast("string"), F.lit("memory_request_mb"), F.lit("64"))).when(m == 1, F.create_map(F.lit("replicas"), F.col("k").cast("string"))) \
        .otherwise(F.create_map(F.lit("namespace"), F.lit("n")))
    d = X.events(spark, sf).withColumn("p", SC.action_patch(action, params, F.lit("main"), F.col("t")))
    return d.select("event_id", "p.patch", "p.error")


@query("b29_call_outcome", with_(EV) + """SELECT event_id, CASE c WHEN 200 THEN 'ok' WHEN 400 THEN 'bad_request' WHEN 403 THEN 'tenant_mismatch' WHEN 409 THEN 'idempotency_conflict' WHEN 429 THEN 'rate_limited' WHEN 503 THEN 'unavailable' WHEN 500 THEN 'server_error' ELSE 'unexpected' END AS outcome,
  c = 500 AND a < 2 AS retry, CASE WHEN c = 429 THEN CASE WHEN user_id % 2 = 0 THEN 5 ELSE k END WHEN c = 500 AND a = 0 THEN 1 WHEN c = 500 AND a = 1 THEN 3 END AS wait_seconds
FROM (SELECT *, coalesce([200, 400, 403, 409, 429, 503, 500, NULL, 418][k % 9 + 1], 500) AS c, CAST(event_id % 3 AS INT) AS a FROM ev)""")
def _(spark, sf):
    code = F.element_at(F.array(*[F.lit(c) for c in (200, 400, 403, 409, 429, 503, 500, None, 418)]), F.col("k") % 9 + 1)
    after = F.when(F.col("user_id") % 2 == 1, F.col("k").cast("string")).otherwise("soon")
    return X.events(spark, sf).select("event_id", SC.call_outcome(code, (F.col("event_id") % 3).cast("int"), after).alias("o")).select("event_id", "o.outcome", "o.retry", "o.wait_seconds")
