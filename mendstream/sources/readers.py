"""Readers: run folders, pod logs, range-query results, alert payloads and pushed windows.

Each reader is a parser over a DataFrame of text plus a thin ``spark.read``. All telemetry readers
return the point layout ``t, tenant_id, service, signal_name, value_num, value_str, labels``.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from mendstream import fixed
from mendstream.functions.scalars import pod_service_name
from mendstream.functions.validate import RFC3339
from mendstream.session import bounded, reuse
from mendstream.sources.quoted import quoted_lines, read_quoted_csv

POINT = ["t", "tenant_id", "service", "signal_name", "value_num", "value_str", "labels"]
FILES = 100  # metric files up to which their headers are named in the plan
RUN_PATH = r"([^/]+)/(\d+)/[^/]+$"


def _labels(*pairs: Column) -> Column:
    return F.create_map(*pairs) if pairs else F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))


def _points(df: DataFrame, *extra: str) -> DataFrame:
    have = set(df.columns)
    types = {"value_num": "double", "value_str": "string"}
    cols = [F.col(c) if c in have else (_labels() if c == "labels" else F.lit(None).cast(types[c])).alias(c) for c in POINT]
    return df.select(*cols, *extra)


# -- run folders ------------------------------------------------------------------------------------


def metric_points(rows: DataFrame, tenant_id: str = "benchmark", signals: list[str] | None = None) -> DataFrame:
    """Points of ``path, names, c`` rows: the cells of a line under the names of its file's header, with ``time`` in any column.

    The service is the text before the first underscore; empty and NaN cells are left out, and cells of other ``signals`` before they become rows.
    """
    at = F.array_position("names", "time").cast("int")
    cells = F.filter(F.arrays_zip("names", "c"), lambda x: (x["names"] != "time") & (x["names"].isin(signals) if signals else F.lit(True)))
    rows = rows.where(at > 0).select("path", F.get("c", at - 1).try_cast("double").cast("long").alias("t"), F.explode(cells).alias("x"))
    v = F.col("x.c").try_cast("double")
    rows = rows.where(F.col("t").isNotNull() & v.isNotNull() & ~F.isnan(v))
    named = rows.select("path", "t", F.lit(tenant_id).alias("tenant_id"), F.substring_index("x.names", "_", 1).alias("service"),
                        F.col("x.names").alias("signal_name"), v.alias("value_num"))
    return _points(named, "path").withColumn("run_key", run_key(F.col("path")))


def _cells(line: Column) -> Column:
    return F.transform(F.split(line, ","), lambda x: F.trim(x))


def parse_metric_csv(lines: DataFrame, tenant_id: str = "benchmark") -> DataFrame:
    """Wide CSV lines (``path, line``) of files of any size to points; files may have different headers, a header is the line with a cell ``time``."""
    d = lines.withColumn("c", _cells(F.col("line")))
    is_head = F.array_contains("c", "time")
    head = d.where(is_head).select("path", F.col("c").alias("names")).distinct()
    return metric_points(d.where(~is_head).join(bounded(head), "path"), tenant_id)


def run_key(path: Column) -> Column:
    return F.concat(F.regexp_extract(path, RUN_PATH, 1), F.lit("/"), F.regexp_extract(path, RUN_PATH, 2))


def read_metric_runs(spark: SparkSession, root: str, name: str = "simple_metrics.csv", tenant_id: str = "benchmark",
                     runs: str = "*/[0-9]*", signals: list[str] | None = None) -> DataFrame:
    """Points of the metric files of run folders; a file has its header in the first line and may be of any size, as many tasks read it line by line.

    ``runs`` selects folders, ``signals`` columns. A first pass takes the headers, one row per file; lines then meet the header of their file.
    """
    lines = quoted_lines(spark, f"{root}/{runs}/{name}").withColumn("line", F.regexp_replace("line", "\r$", ""))
    heads = reuse(lines.where("range = 0").groupBy("path").agg(_cells(F.min_by("line", "n")).alias("names")))
    few = heads.limit(FILES + 1).collect()
    if 0 < len(few) <= FILES:  # one scan without a join
        rows = lines.withColumn("names", F.create_map(*[x for r in few for x in (F.lit(r.path), F.lit(r.names))])[F.col("path")])
    else:
        rows = lines.join(bounded(heads), "path")
    return metric_points(rows.select("path", "names", _cells(F.col("line")).alias("c")), tenant_id, signals)


def epoch_seconds(name: str) -> Column:
    """Nanoseconds above 10 000 000 000, else already seconds; null when not a number."""
    x = f"try_cast({name} AS BIGINT)"
    return F.expr(f"CASE WHEN {x} > 10000000000 THEN {x} div 1000000000 ELSE {x} END")


def parse_run_logs(rows: DataFrame, tenant_id: str = "benchmark") -> DataFrame:
    """``path, timestamp, container_name, message, level`` to log points."""
    d = rows.select(
        "path", epoch_seconds("timestamp").alias("t"),
        F.lit(tenant_id).alias("tenant_id"), F.coalesce("container_name", F.lit("unknown")).alias("service"), F.lit("application_log_event").alias("signal_name"),
        F.coalesce("message", F.lit("")).alias("value_str"), _labels(F.lit("level"), F.coalesce("level", F.lit("info"))).alias("labels"))
    return _points(d.where(F.col("t").isNotNull()), "path").withColumn("run_key", run_key(F.col("path")))


LOG_COLUMNS = ["timestamp", "container_name", "message", "level"]


def read_log_runs(spark: SparkSession, root: str, tenant_id: str = "benchmark", runs: str = "*/[0-9]*") -> DataFrame:
    """Log points of run folders; quoted messages may go over line breaks, and a large file is read by many tasks."""
    return parse_run_logs(read_quoted_csv(spark, f"{root}/{runs}/logs.csv", LOG_COLUMNS), tenant_id)


def slice_runs(points: DataFrame, inject: int | DataFrame, before: int = fixed.SLICE_BEFORE, after: int = fixed.SLICE_AFTER) -> DataFrame:
    """Points from ``before`` seconds before to ``after`` seconds after the inject time: one for all runs, or a table ``run_key, inject_time``; a run that it
    does not name stays whole."""
    if not isinstance(inject, DataFrame):
        return points.where(F.col("t").between(inject - before, inject + after))
    d = points.join(inject.select("run_key", F.col("inject_time").alias("_at")), "run_key", "left")
    return d.where(F.col("_at").isNull() | F.col("t").between(F.col("_at") - before, F.col("_at") + after)).drop("_at")


def dataset_completeness(files: DataFrame, required: list[str] = fixed.RUN_FILES) -> DataFrame:
    """Missing required files of every run, from the file paths."""
    name = F.substring_index("path", "/", -1)
    per = files.where(F.col("path").rlike(RUN_PATH)).groupBy(run_key(F.col("path")).alias("run_key")).agg(
        F.collect_set(F.when(name.isin(required), name)).alias("have"))
    missing = F.array_except(F.array(*[F.lit(r) for r in required]), F.col("have"))
    return per.select("run_key", missing.alias("missing"), F.size(missing).alias("n_missing"))


def ground_truth(files: DataFrame, inject: DataFrame, strict: bool = False) -> DataFrame:
    """One row per run folder: service, fault, inject time (0 if missing or unreadable) and runbook.

    ``files``: all file paths; ``inject``: ``path, content`` of the inject-time files. ``strict``
    leaves out runs with a missing file.
    """
    from mendstream.functions.scalars import lookup

    runs = dataset_completeness(files)
    if strict:
        runs = runs.where("n_missing = 0")
    times = inject.groupBy(run_key(F.col("path")).alias("run_key")).agg(F.max(F.trim("content").try_cast("long")).alias("inject_time"))
    service_fault = F.substring_index("run_key", "/", 1)
    fault = F.substring_index(service_fault, "_", -1)
    return runs.join(times, "run_key", "left").select(
        "run_key", service_fault.alias("service_fault"), F.substring_index("run_key", "/", -1).alias("run_id"),
        F.regexp_extract(service_fault, "^(.*)_[^_]*$", 1).alias("target_service"), fault.alias("suspected_fault_type"),
        F.coalesce("inject_time", F.lit(0)).alias("inject_time"), lookup(fault, fixed.FAULT_RUNBOOK, F.lit(fixed.DEFAULT_RUNBOOK)).alias("matched_runbook"), "n_missing")


def scan_ground_truth(spark: SparkSession, root: str, strict: bool = False) -> DataFrame:
    # only names are needed, the content column is pruned away
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path")
    inject = spark.read.text(f"{root}/*/[0-9]*/inject_time.txt", wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("content"))
    return ground_truth(files, inject, strict)


# -- pod logs and range queries ------------------------------------------------------------------------


def parse_k8s_log_lines(df: DataFrame, line: str = "line", read_at: Column | None = None) -> DataFrame:
    """Adds ``ts`` and ``message``; nanoseconds are cut to microseconds, blank messages dropped.

    A line without a readable time keeps its whole text and takes the time it was read.
    """
    read_at = F.current_timestamp() if read_at is None else read_at
    first = F.substring_index(line, " ", 1)
    out = df.withColumn("ts", F.when(F.col(line).contains(" ") & first.rlike(RFC3339), F.try_to_timestamp(first)))
    rest = F.substring(F.col(line), F.length(first) + 2, F.length(line))
    out = out.withColumns({"message": F.when(F.col("ts").isNotNull(), rest).otherwise(F.col(line)), "ts": F.coalesce("ts", read_at)})
    return out.where(F.trim("message") != "")


def pod_log_points(lines: DataFrame, tenant_id: str, read_at: Column | None = None) -> DataFrame:
    """Log points of ``namespace, pod, container, pod_labels, line`` rows."""
    d = parse_k8s_log_lines(lines, read_at=read_at)
    d = d.select(
        F.unix_seconds("ts").alias("t"), F.lit(tenant_id).alias("tenant_id"), pod_service_name(F.col("pod_labels"), F.col("pod")).alias("service"),
        F.lit("application_log_event").alias("signal_name"), F.col("message").alias("value_str"),
        _labels(F.lit("namespace"), F.col("namespace"), F.lit("pod"), F.col("pod"), F.lit("container"), F.col("container"), F.lit("level"), F.lit("info")).alias("labels"))
    return _points(d)


MATRIX = "status string, data struct<result:array<struct<metric:map<string,string>,values:array<array<string>>>>>"


def read_range_matrix(df: DataFrame, json: str = "json", pods: DataFrame | None = None, first_series_only: bool = False) -> DataFrame:
    """Points of range-query results; ``df`` also has ``tenant_id, namespace, signal_name``.

    Results that are not a success and unreadable values are skipped. ``pods`` (``pod, service``) names the
    service, else the pod does.
    """
    # the status is looked at inside the explode: a filter would be pushed below and parse the text twice
    d = df.withColumn("_j", F.from_json(json, MATRIX))
    result = F.col("_j.data.result")
    found = F.when(F.col("_j.status") == "success", F.slice(result, 1, 1) if first_series_only else result)
    d = d.select("tenant_id", "namespace", "signal_name", F.explode(found).alias("s"))
    d = d.select("*", F.col("s.metric")["pod"].alias("pod"), F.explode("s.values").alias("x"))
    t, v = F.try_element_at("x", F.lit(1)).try_cast("double"), F.try_element_at("x", F.lit(2)).try_cast("double")
    d = d.select("tenant_id", "namespace", "signal_name", "pod", F.floor(t).alias("t"), v.alias("value_num")).where("t IS NOT NULL AND value_num IS NOT NULL")
    if pods is not None:
        d = d.join(bounded(pods.select("pod", "service")), "pod", "left")
    else:
        d = d.withColumn("service", F.lit(None).cast("string"))
    d = d.withColumn("service", F.coalesce("service", "pod", F.lit("unknown")))
    d = d.withColumn("labels", _labels(F.lit("namespace"), F.col("namespace"), F.lit("pod"), F.coalesce("pod", F.lit("")), F.lit("source"), F.lit("prometheus")))
    return _points(d)


# -- alerts and pushed windows ---------------------------------------------------------------------------

ALERT_PAYLOAD = """receiver string, status string, alerts array<struct<status:string,
 labels:struct<alertname:string,namespace:string,service:string,severity:string,pod:string,container:string>,
 annotations:struct<summary:string,description:string>,startsAt:string>>"""


def read_alerts(df: DataFrame, json: str = "json") -> DataFrame:
    """One row per alert of the payload, with its position; other columns are kept."""
    keep = [c for c in df.columns if c != json]
    d = df.select(*keep, F.posexplode(F.from_json(json, ALERT_PAYLOAD)["alerts"]).alias("alert_index", "a"))
    return d.select(*keep, "alert_index", "a.status", "a.labels.*", "a.annotations.summary", F.col("a.startsAt").alias("starts_at"))


WINDOW_BODY = """correlation_id string, idempotency_key string, dry_run_mode boolean,
 telemetry_window array<struct<ts:string,tenant_id:string,service:string,signal_name:string,value:variant,labels:map<string,string>>>"""


def read_push_windows(df: DataFrame, json: str = "json") -> DataFrame:
    """Points of detect requests with their request keys and position; numbers and text kept apart."""
    keep = [c for c in df.columns if c != json]
    d = df.withColumn("_b", F.from_json(json, WINDOW_BODY))
    d = d.select(*keep, "_b.correlation_id", "_b.idempotency_key", "_b.dry_run_mode", F.posexplode("_b.telemetry_window").alias("point_index", "p"))
    kind = F.schema_of_variant("p.value")
    return d.select(
        *keep, "correlation_id", "idempotency_key", "dry_run_mode", "point_index", "p.ts", "p.tenant_id", "p.service", "p.signal_name",
        F.unix_seconds(F.try_to_timestamp("p.ts")).alias("t"),
        F.when(kind != "STRING", F.try_variant_get("p.value", "$", "double")).alias("value_num"),
        F.when(kind == "STRING", F.try_variant_get("p.value", "$", "string")).alias("value_str"), "p.labels")


# -- dispatch -----------------------------------------------------------------------------------------------


def _fixture(spark, root, tenant_id="benchmark", service_fault="*", run_id="[0-9]*", inject_time=None, window_before=fixed.SLICE_BEFORE, window_after=fixed.SLICE_AFTER):
    """Run folders, all or of one ``service_fault`` and ``run_id``, whole or cut around ``inject_time`` (see ``slice_runs``)."""
    runs = f"{service_fault}/{run_id}"
    metrics = read_metric_runs(spark, root, tenant_id=tenant_id, runs=runs)
    points = metrics.select(*POINT, "run_key").unionByName(read_log_runs(spark, root, tenant_id, runs).select(*POINT, "run_key"), allowMissingColumns=True)
    return points if inject_time is None else slice_runs(points, inject_time, window_before, window_after)


def _cluster(spark, lines, matrix, tenant_id, pods=None, read_at=None):
    return pod_log_points(lines, tenant_id, read_at).unionByName(read_range_matrix(matrix, pods=pods))


def _push(spark, requests, source=None):
    if source is not None:
        raise ValueError("a pushed window takes no telemetry source")
    return _points(read_push_windows(requests), "idempotency_key", "point_index")


SOURCES = {"benchmark_fixture": _fixture, "k8s": _cluster, "push": _push}


def load_telemetry(spark: SparkSession, kind: str, **options) -> DataFrame:
    """Points from a named source kind, all in one layout."""
    if kind not in SOURCES:
        raise ValueError(f"unknown telemetry source kind: {kind}")
    return SOURCES[kind](spark, **options)


def fill_missing_series(wanted: DataFrame, points: DataFrame) -> DataFrame:
    """Points of every alert's query; an alert whose query returned nothing gets one point of value 1.0.

    ``wanted``: ``alert_id, t, service, signal_name``; ``points``: ``alert_id, t, value_num``.
    """
    have = points.join(wanted.select("alert_id", "service", "signal_name"), "alert_id")
    none = wanted.join(points.select("alert_id").distinct(), "alert_id", "left_anti").withColumn("value_num", F.lit(1.0))
    return have.unionByName(none)
