"""A: readers and sinks, on texts that Spark derives from the given tables and writes first, as a source would."""
import uuid

from pyspark.sql import functions as F

from checks import query
from checks.ctes import ALERTS, EV, LOGS, TEL, with_
from mendstream.operators import audit as J
from mendstream.plans import fixtures as X
from mendstream.session import reuse, scratch_dir
from mendstream.sources import profile as P, readers as R, sinks

def _svc():
    return F.concat(F.lit("svc"), F.col("user_id") % 6)


def _run_path(name):
    return F.concat(F.lit("/data/"), _svc(), F.lit("_"), F.when(F.col("k") < 50, "cpu").otherwise("mem"), F.lit("/"), F.col("k") % 3 + 1, F.lit(f"/{name}"))


_PATH = "'/data/svc' || (user_id % 6) || '_' || CASE WHEN k < 50 THEN 'cpu' ELSE 'mem' END || '/' || (k % 3 + 1) || '/'"
_RUN = "'svc' || (user_id % 6) || '_' || CASE WHEN k < 50 THEN 'cpu' ELSE 'mem' END || '/' || (k % 3 + 1)"


@query("a1_read_metric_runs", with_(EV) + f"""SELECT {_RUN} AS run_key, t, 'svc' || (user_id % 6) AS service, 'svc' || (user_id % 6) || '_cpu' AS signal_name, value AS value_num FROM ev
UNION ALL SELECT {_RUN}, t, 'db', 'db_' || CASE WHEN k < 50 THEN 'latency' ELSE 'error' END, k::DOUBLE FROM ev WHERE event_type <> 'error'""")
def _(spark, sf):
    e = X.events(spark, sf).withColumn("path", _run_path("simple_metrics.csv"))
    rows = e.select("path", F.concat_ws(",", "t", "value", F.when(F.col("event_type") == "error", F.when(F.col("k") < 50, "NaN").otherwise("")).otherwise(F.col("k").cast("string"))).alias("line"))
    head = e.select("path", F.concat(F.lit("time,"), _svc(), F.lit("_cpu,db_"), F.when(F.col("k") < 50, "latency").otherwise("error")).alias("line")).distinct()
    return R.parse_metric_csv(rows.unionByName(head)).select("run_key", "t", "service", "signal_name", "value_num")


@query("a2_read_log_runs", with_(LOGS) + f"""SELECT {_RUN} AS run_key, lg.t, CASE WHEN k = 3 THEN 'unknown' ELSE container_name END AS service, message AS value_str, level FROM lg JOIN ev ON event_id = seq WHERE k <> 4""")
def _(spark, sf):
    e = X.events(spark, sf).select(F.col("event_id").alias("seq"), "k", _run_path("logs.csv").alias("path"))
    rows = X.logs(spark, sf).join(e, "seq").select(
        "path", F.when(F.col("k") == 4, "soon").when(F.col("k") % 2 == 0, (F.col("t") * 1000000000 + F.col("k")).cast("string")).otherwise(F.col("t").cast("string")).alias("timestamp"),
        F.when(F.col("k") != 3, F.col("container_name")).alias("container_name"), "message", "level")
    return R.parse_run_logs(rows).select("run_key", "t", "service", "value_str", F.col("labels")["level"].alias("level"))


def _written(df, root, name):
    """``df`` (path, n, text) as one file per path under ``root``, a line or record at a time in the order of ``n``; ``path`` is relative."""
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    df.repartition("path").sortWithinPartitions("path", "n").drop("n").write.mode("append").partitionBy("path").text(root)
    glob = jvm.org.apache.hadoop.fs.Path(f"{root}/path=*/part-*")
    fs = glob.getFileSystem(conf)
    for f in fs.globStatus(glob):
        run = f.getPath().getParent().getName().split("=", 1)[1].replace("%2F", "/")
        to = jvm.org.apache.hadoop.fs.Path(f"{root}/{run}/{name}")
        fs.mkdirs(to.getParent())
        fs.rename(f.getPath(), to)
    return root


def _run_folders(spark, sf):
    """The events as run folders: metric files whose time stands in another column by service, log files with messages over line breaks."""
    root = f"{scratch_dir(spark)}/runs-{uuid.uuid4()}"
    e = X.events(spark, sf).withColumn("run", F.regexp_extract(_run_path("x"), "^/data/(.*)/x$", 1))
    late = F.col("user_id") % 2 == 1
    cells = [F.col("t").cast("string"), F.col("value").cast("string")]
    line = F.when(late, F.concat_ws(",", cells[1], cells[0])).otherwise(F.concat_ws(",", *cells))
    head = F.when(late, F.concat(_svc(), F.lit("_cpu,time"))).otherwise(F.concat(F.lit("time,"), _svc(), F.lit("_cpu")))
    quoted = F.concat(F.col("t").cast("string"), F.lit(',"said ""'), "event_type", F.lit('""\nagain, '), F.col("event_id").cast("string"), F.lit('",error'))
    plain = F.concat_ws(",", F.col("t").cast("string"), F.concat(F.lit("plain "), "event_id"), F.lit("info"))
    for name, first, body in (("simple_metrics.csv", head, line), ("logs.csv", F.lit("timestamp,message,level"), F.when(F.col("k") % 2 == 0, quoted).otherwise(plain))):
        heads = e.groupBy(F.col("run").alias("path")).agg(F.lit(0).alias("n"), F.max(first).alias("value"))
        rows = e.select(F.col("run").alias("path"), F.lit(1).alias("n"), body.alias("value")).where("value is not null")
        _written(heads.unionByName(rows), root, name)
    return root


_IN_RUN = f"SELECT {_RUN} AS run_key, t, event_id, event_type, k, value, user_id FROM ev"


# files on disk, the time in any column
@query("a1_run_files", with_(EV) + f"SELECT run_key, t, 'svc' || (user_id % 6) AS service, 'svc' || (user_id % 6) || '_cpu' AS signal_name, value AS value_num FROM ({_IN_RUN})")
def _(spark, sf):
    return R.read_metric_runs(spark, _run_folders(spark, sf)).select("run_key", "t", "service", "signal_name", "value_num")


# quoted messages over line breaks
@query("a2_run_files", with_(EV) + f"SELECT run_key, t, CASE WHEN k % 2 = 0 THEN 'said \"' || event_type || '\"' || chr(10) || 'again, ' || event_id ELSE 'plain ' || event_id END AS value_str, CASE WHEN k % 2 = 0 THEN 'error' ELSE 'info' END AS level FROM ({_IN_RUN})")
def _(spark, sf):
    return R.read_log_runs(spark, _run_folders(spark, sf)).select("run_key", "t", "value_str", F.col("labels")["level"].alias("level"))


# one service and fault, cut around an inject time of each run
@query("a8_sliced_runs", with_(EV) + f", r AS ({_IN_RUN}), i AS (SELECT run_key, min(t) + 86400 AS at0 FROM r GROUP BY 1) SELECT run_key, signal_name, count(*) AS n, round(sum(v), 4) AS total FROM (SELECT run_key, t, 'svc2_cpu' AS signal_name, value AS v FROM r UNION ALL SELECT run_key, t, 'application_log_event', NULL FROM r) JOIN i USING (run_key) WHERE run_key LIKE 'svc2_mem/%' AND t BETWEEN at0 - 43200 AND at0 + 86400 GROUP BY 1, 2")
def _(spark, sf):
    root = _run_folders(spark, sf)
    e = X.events(spark, sf).withColumn("run_key", F.regexp_extract(_run_path("x"), "^/data/(.*)/x$", 1))
    at = e.groupBy("run_key").agg((F.min("t") + 86400).alias("inject_time"))
    p = R.load_telemetry(spark, "benchmark_fixture", root=root, service_fault="svc2_mem", inject_time=at, window_before=43200, window_after=86400)
    return p.groupBy("run_key", "signal_name").agg(F.count("*").alias("n"), F.round(F.sum("value_num"), 4).alias("total"))


def _pod_lines(spark, sf):
    e = X.events(spark, sf)
    iso = F.date_format(F.timestamp_seconds("t"), "yyyy-MM-dd'T'HH:mm:ss")
    msg = F.concat(F.lit("said "), F.col("event_type"))
    line = (
        F.when(F.col("k") == 0, F.concat(iso, F.lit("Z  "))).when(F.col("k") == 1, F.concat(F.lit("no time "), msg)).when(F.col("k") == 2, F.lit("alone"))
        .when(F.col("k") % 2 == 0, F.concat(iso, F.lit("."), F.lpad(F.col("k").cast("string"), 2, "0"), F.lit("3456789Z "), msg)).otherwise(F.concat(iso, F.lit("+02:00 "), msg))
    )
    return reuse(e.select("event_id", "user_id", "k", line.alias("line")))


@query("a3_parse_k8s_log_lines", with_(EV) + """SELECT event_id, CAST(CASE WHEN k IN (1, 2) THEN 0 WHEN k % 2 = 0 THEN t * 1000000 + k * 10000 + 3456 ELSE (t - 7200) * 1000000 END AS BIGINT) AS micros,
  CASE WHEN k = 1 THEN 'no time said ' || event_type WHEN k = 2 THEN 'alone' ELSE 'said ' || event_type END AS message FROM ev WHERE k <> 0""")
def _(spark, sf):
    d = R.parse_k8s_log_lines(_pod_lines(spark, sf), read_at=F.timestamp_seconds(F.lit(0)))
    return d.select("event_id", F.unix_micros("ts").alias("micros"), "message")


def _matrix(spark, sf):
    """One response per event: two series, a bad value in the first, some failed."""
    e = X.events(spark, sf)
    s = lambda pod, v1, v2: F.concat(F.lit('{"metric":{"pod":"'), pod, F.lit('"},"values":[['), F.col("t"), F.lit(',"'), v1, F.lit('"],['), F.col("t") + 15, F.lit(',"'), v2, F.lit('"]]}'))
    body = F.concat(F.lit('{"status":"'), F.when(F.col("k") == 0, "error").otherwise("success"), F.lit('","data":{"resultType":"matrix","result":['),
                    s(F.concat(F.lit("pod-"), F.col("user_id") % 9), F.col("value").cast("string"), F.lit("bad")), F.lit(","), s(F.lit("pod-x"), F.col("k").cast("string"), F.lit("1")), F.lit("]}}"))
    return reuse(e.select(F.lit("t").alias("tenant_id"), F.lit("n").alias("namespace"), F.lit("cpu").alias("signal_name"), body.alias("json")))


_POD_ROWS = """SELECT t, CASE WHEN user_id % 9 < 5 THEN 'svc' || (user_id % 9) ELSE 'pod-' || (user_id % 9) END AS service, value AS value_num FROM ev WHERE k <> 0"""


def _pods(spark):
    return spark.createDataFrame([(f"pod-{i}", f"svc{i}") for i in range(5)], "pod string, service string")


@query("a5_read_range_matrix", with_(EV) + _POD_ROWS + " UNION ALL SELECT t, 'pod-x', k::DOUBLE FROM ev WHERE k <> 0 UNION ALL SELECT t + 15, 'pod-x', 1.0 FROM ev WHERE k <> 0")
def _(spark, sf):
    return R.read_range_matrix(_matrix(spark, sf), pods=_pods(spark)).select("t", "service", "value_num")


@query("a5_first_series_only", with_(EV) + _POD_ROWS)
def _(spark, sf):
    return R.read_range_matrix(_matrix(spark, sf), pods=_pods(spark), first_series_only=True).select("t", "service", "value_num")


@query("a6_read_alerts", with_(ALERTS) + """SELECT alert_id, i AS alert_index, CASE WHEN i = 0 THEN status ELSE 'firing' END AS status, CASE WHEN i = 0 THEN alertname ELSE 'HighLoad' END AS alertname, namespace, CASE WHEN i = 0 THEN service END AS service FROM al0, (VALUES (0), (1)) v(i)""")
def _(spark, sf):
    c = F.col
    one = F.concat(F.lit('{"status":"'), c("status"), F.lit('","labels":{"alertname":"'), c("alertname"), F.lit('","namespace":"'), c("namespace"), F.lit('","service":"'), c("service"), F.lit('"},"annotations":{"summary":"s"}}'))
    two = F.concat(F.lit('{"status":"firing","labels":{"alertname":"HighLoad","namespace":"'), c("namespace"), F.lit('"}}'))
    d = X.alerts(spark, sf).select("alert_id", F.concat(F.lit('{"receiver":"r","alerts":['), one, F.lit(","), two, F.lit("]}")).alias("json"))
    return R.read_alerts(d).select("alert_id", "alert_index", "status", "alertname", "namespace", "service")


def _bodies(spark, sf):
    iso = F.date_format(F.timestamp_seconds("t"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    p = lambda sig, v: F.concat(F.lit('{"ts":"'), iso, F.lit('","tenant_id":"t'), F.col("user_id") % 4, F.lit('","service":"s","signal_name":"'), F.lit(sig), F.lit('","value":'), v, F.lit(',"labels":{"system":"x"}}'))
    body = F.concat(F.lit('{"correlation_id":"c'), F.col("event_id"), F.lit('","idempotency_key":"i'), F.col("event_id"), F.lit('","dry_run_mode":'), (F.col("k") < 50).cast("string"), F.lit(',"telemetry_window":['),
                    p("cpu", F.col("value").cast("string")), F.lit(","), p("application_log_event", F.concat(F.lit('"'), F.col("event_type"), F.lit('"'))), F.lit("]}"))
    return reuse(X.events(spark, sf).select(body.alias("json")))


@query("a7_read_push_windows", with_(EV) + """SELECT 'i' || event_id AS idempotency_key, k < 50 AS dry_run_mode, i AS point_index, t, 't' || (user_id % 4) AS tenant_id, CASE WHEN i = 0 THEN 'cpu' ELSE 'application_log_event' END AS signal_name,
 CASE WHEN i = 0 THEN value END AS value_num, CASE WHEN i = 1 THEN event_type END AS value_str FROM ev, (VALUES (0), (1)) v(i)""")
def _(spark, sf):
    return R.read_push_windows(_bodies(spark, sf)).select("idempotency_key", "dry_run_mode", "point_index", "t", "tenant_id", "signal_name", "value_num", "value_str")


@query("a8_load_telemetry", with_(EV) + """SELECT 'push' AS kind, signal_name, count(*) AS n, round(sum(v), 4) AS total FROM (SELECT 'cpu' AS signal_name, value AS v FROM ev UNION ALL SELECT 'application_log_event', NULL FROM ev) GROUP BY 1, 2
UNION ALL SELECT 'k8s', 'application_log_event', count(*) FILTER (k <> 0), NULL FROM ev UNION ALL SELECT 'k8s', 'cpu', 3 * count(*) FILTER (k <> 0), round(sum(value + k + 1) FILTER (k <> 0), 4) FROM ev""")
def _(spark, sf):
    push = R.load_telemetry(spark, "push", requests=_bodies(spark, sf))
    lines = _pod_lines(spark, sf).select(F.lit("n").alias("namespace"), F.lit("p").alias("pod"), F.lit("main").alias("container"), F.create_map(F.lit("app"), F.lit("a")).alias("pod_labels"), "line")
    k8s = R.load_telemetry(spark, "k8s", lines=lines, matrix=_matrix(spark, sf), tenant_id="t")
    both = push.select(F.lit("push").alias("kind"), "signal_name", "value_num").unionByName(k8s.select(F.lit("k8s").alias("kind"), "signal_name", "value_num"))
    return both.groupBy("kind", "signal_name").agg(F.count("*").alias("n"), F.round(F.sum("value_num"), 4).alias("total"))


def _profiles(spark, sf):
    """A profile per tenant: its services and signals as found in the telemetry."""
    t = X.telemetry(spark, sf).groupBy("tenant_id").agg(F.array_sort(F.collect_set("service")).alias("s"), F.array_sort(F.collect_set("signal_name")).alias("m"))
    names = lambda c: F.concat(F.lit('["'), F.array_join(c, '","'), F.lit('"]'))
    book = '{"name":"Restart","pattern_type":"deferred","action_plan":[{"step":1,"action":"RESTART_DEPLOYMENT","target":"deployment/{{target_service}}","params":{"namespace":"n"}}],' \
           '"blast_radius_config":{"max_pod_impact_pct":10,"circuit_breaker_error_rate":0.1,"allowed_namespaces":["n"]},"verify_policy":{"window_seconds":60,"success_conditions":["pod_ready == true"]}}'
    body = F.concat(
        F.lit('{"profile_name":"'), "tenant_id", F.lit('","system":"S","default_namespace":"n","allowed_namespaces":["n"],"services":'), names("s"), F.lit(',"metric_types":'), names("m"),
        F.lit(',"fault_runbook_mapping":{"cpu":"Restart","mem":"Restart"},"dependency_graph":{"'), F.col("s")[0], F.lit('":["'), F.col("s")[1], F.lit('","'), F.col("s")[2], F.lit('"]},"runbooks":{"Restart":' + book + "}}"))
    return t.select(body.alias("json"))


@query("a9_load_platform_profile", with_(TEL, "s AS (SELECT tenant_id AS p, service, row_number() OVER (PARTITION BY tenant_id ORDER BY service) - 1 AS i FROM (SELECT DISTINCT tenant_id, service FROM tel))") + """
SELECT p AS profile_name, 'service' AS dim, service AS a, i::VARCHAR AS b FROM s UNION ALL SELECT p, 'edge', (SELECT service FROM s x WHERE x.p = s.p AND x.i = 0), service FROM s WHERE i > 0 UNION ALL SELECT p, 'default', service, NULL FROM s WHERE i = 0
UNION ALL SELECT DISTINCT tenant_id, 'fault', signal_name, 'Restart' FROM tel WHERE signal_name IN ('cpu', 'mem')""")
def _(spark, sf):
    d = P.parse_profiles(_profiles(spark, sf))
    k = "profile_name"
    out = d["services"].select(k, F.lit("service").alias("dim"), F.col("service").alias("a"), F.col("ord").cast("string").alias("b"))
    out = out.unionByName(d["edges"].select(k, F.lit("edge").alias("dim"), F.col("service").alias("a"), F.col("depends_on").alias("b")))
    out = out.unionByName(d["settings"].select(k, F.lit("default").alias("dim"), F.col("default_service").alias("a"), F.lit(None).cast("string").alias("b")))
    return out.unionByName(d["faults"].join(d["mapping"], [k, "fault"]).select(k, F.lit("fault").alias("dim"), F.col("fault").alias("a"), F.col("runbook").alias("b")))


@query("a10_load_runbooks", with_(TEL) + "SELECT 'Restart' AS name, 'deferred' AS pattern_type, 60 AS window_seconds, count(DISTINCT tenant_id) AS n FROM tel")
def _(spark, sf):
    b = P.load_runbooks(spark, P.parse_profiles(_profiles(spark, sf))["runbooks"])
    return b.groupBy("name", "pattern_type", "window_seconds").agg(F.count("*").alias("n"))


def _files(spark, sf):
    """File paths of run folders; which files exist follows from the events of the folder."""
    name = F.when(F.col("event_type") == "click", "inject_time.txt").when(F.col("event_type") == "view", "metrics.csv").when(F.col("value") < 150, "simple_metrics.csv").when(F.col("value") > 250, "logs.csv").otherwise("notes.md")
    run = F.when(F.col("k") == 99, F.lit("latest")).otherwise((F.col("user_id") * 3 + F.col("k") % 3).cast("string"))
    return X.events(spark, sf).select(F.concat(F.lit("/data/"), _svc(), F.lit("_cpu/"), run, F.lit("/"), name).alias("path"), "t", "k")


_FILES = EV + """, fs AS (SELECT 'svc' || (user_id % 6) || '_cpu/' || (user_id * 3 + k % 3) AS run_key, CASE WHEN event_type = 'click' THEN 'inject_time.txt' WHEN event_type = 'view' THEN 'metrics.csv' WHEN value < 150 THEN 'simple_metrics.csv' WHEN value > 250 THEN 'logs.csv' END AS f, t, k FROM ev WHERE k <> 99),
 ms AS (SELECT run_key, concat_ws(',', CASE WHEN count(*) FILTER (f = 'inject_time.txt') = 0 THEN 'inject_time.txt' END, CASE WHEN count(*) FILTER (f = 'metrics.csv') = 0 THEN 'metrics.csv' END, CASE WHEN count(*) FILTER (f = 'simple_metrics.csv') = 0 THEN 'simple_metrics.csv' END,
   CASE WHEN count(*) FILTER (f = 'logs.csv') = 0 THEN 'logs.csv' END) AS missing, coalesce(max(t) FILTER (f = 'inject_time.txt' AND k >= 10), 0) AS inject_time FROM fs GROUP BY 1)"""


@query("a11_scan_ground_truth", with_(_FILES) + """SELECT run_key, split_part(run_key, '/', 2) AS run_id, run_key[:4] AS target_service, 'cpu' AS suspected_fault_type, inject_time, 'CPUSaturationRecoveryRunbook' AS matched_runbook FROM ms""")
def _(spark, sf):
    f = _files(spark, sf)
    inject = f.where("path LIKE '%/inject_time.txt'").select("path", F.when(F.col("k") < 10, "soon").otherwise(F.concat(F.lit(" "), F.col("t"), F.lit("\n"))).alias("content"))
    inject = inject.withColumn("content", F.regexp_replace("content", "\n", ""))
    return R.ground_truth(f.select("path"), inject).select("run_key", "run_id", "target_service", "suspected_fault_type", "inject_time", "matched_runbook")


@query("a12_dataset_completeness", with_(_FILES) + "SELECT run_key, missing, CAST(len(missing) - len(replace(missing, ',', '')) + CASE WHEN missing = '' THEN 0 ELSE 1 END AS INT) AS n_missing FROM ms")
def _(spark, sf):
    return R.dataset_completeness(_files(spark, sf)).withColumn("missing", F.array_join("missing", ","))


@query("a13_write_audit", with_(ALERTS) + """SELECT tenant_id, strftime(to_timestamp(t) AT TIME ZONE 'UTC', '%Y-%m-%d') AS day, count(*) AS n FROM al0 GROUP BY 1, 2""")
def _(spark, sf):
    a = X.alerts(spark, sf).select("tenant_id", F.concat(F.lit("c-"), "alert_id").alias("correlation_id"), F.col("t").alias("epoch"), F.col("alertname").alias("alert_payload"))
    path = f"{scratch_dir(spark)}/audit-{uuid.uuid4()}"
    sinks.write_audit(J.audit_events({"incident": a}), path)
    back = spark.read.schema("tenant_id string, event_type string, epoch long, year string, month string, day string").json(path)
    return back.groupBy("tenant_id", F.concat_ws("-", "year", "month", "day").alias("day")).agg(F.count("*").alias("n"))


@query("a17_fill_missing_series", with_(ALERTS) + """SELECT alert_id, t, service, 'cpu' AS signal_name, CASE WHEN k < 30 THEN 1.0 ELSE k END AS value_num FROM al0""")
def _(spark, sf):
    a = X.alerts(spark, sf)
    want = a.select("alert_id", "t", "service", F.lit("cpu").alias("signal_name"))
    return R.fill_missing_series(want, a.where("k >= 30").select("alert_id", "t", F.col("k").cast("double").alias("value_num")))
