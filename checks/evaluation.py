"""I and K6: accuracy, latency and acceptance over labelled runs (one run per order)."""
from pyspark.sql import functions as F

from checks import query
from checks.views import rounded
from mendstream import fixed
from mendstream.operators import evaluate as I
from mendstream.sources.profile import fault_mapping

_FAULTS = ["cpu", "mem", "delay", "loss", "disk", "socket"]
_PICK = "['cpu', 'mem', 'delay', 'loss', 'disk', 'socket']"
# labels and predictions derived from each order
RUNS = f"""runs AS (SELECT 'run-' || lpad(o_orderkey::VARCHAR, 9, '0') AS run_key, {_PICK}[o_custkey % 6 + 1] AS fault, {_PICK}[o_custkey % 6 + 1] AS true_fault,
  CASE WHEN o_orderstatus <> 'P' THEN {_PICK}[(o_custkey + CASE WHEN o_totalprice > 200000 THEN 1 ELSE 0 END) % 6 + 1] END AS pred_fault, 'svc' || (o_custkey % 5) AS y_true,
  CASE WHEN o_orderstatus <> 'P' THEN 'svc' || ((o_custkey + CASE WHEN o_totalprice > 300000 THEN 1 ELSE 0 END) % 5) END AS y_pred, o_orderstatus <> 'P' AS detected,
  o_orderstatus <> 'P' AND o_totalprice <= 300000 AS service_ok, o_orderstatus <> 'P' AND o_totalprice <= 400000 AS in_top_k, o_totalprice / 10000 AS delay_s, o_totalprice / 600000 AS confidence, o_custkey % 9 AS n_flagged,
  o_orderpriority AS endpoint, o_totalprice / 1000 AS latency_ms, o_orderstatus = 'F' AS verified FROM orders)"""


def runs(spark, sf):
    o = spark.read.parquet(f"{sf}/orders.parquet")
    seen, price, cust = F.col("o_orderstatus") != "P", F.col("o_totalprice"), F.col("o_custkey")
    pick = lambda i: F.element_at(F.array(*[F.lit(f) for f in _FAULTS]), (i % 6 + 1).cast("int"))
    over = lambda x: F.when(price > x, 1).otherwise(0)
    return o.select(
        F.concat(F.lit("run-"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0")).alias("run_key"), pick(cust).alias("fault"), pick(cust).alias("true_fault"),
        F.when(seen, pick(cust + over(200000))).alias("pred_fault"), F.concat(F.lit("svc"), cust % 5).alias("y_true"), F.when(seen, F.concat(F.lit("svc"), (cust + over(300000)) % 5)).alias("y_pred"),
        seen.alias("detected"), (seen & (price <= 300000)).alias("service_ok"), (seen & (price <= 400000)).alias("in_top_k"), (price / 10000).alias("delay_s"), (price / 600000).alias("confidence"),
        (cust % 9).alias("n_flagged"), F.col("o_orderpriority").alias("endpoint"), (price / 1000).alias("latency_ms"), (F.col("o_orderstatus") == "F").alias("verified"))


_W = "WITH " + RUNS + " "


@query("i1_stratified_sample", "WITH " + RUNS + """, p AS (SELECT *, row_number() OVER (PARTITION BY fault ORDER BY md5('42#' || run_key), run_key) AS r FROM runs)
SELECT run_key, fault FROM (SELECT run_key, fault FROM p WHERE r <= 15 ORDER BY run_key LIMIT 90)""")
def _(spark, sf):
    return I.stratified_sample(runs(spark, sf), 90).select("run_key", "fault")


_SUMMARY = """SELECT count(*) AS runs, count(*) FILTER (detected) AS detected, round(count(*) FILTER (detected) / count(*), 6) AS detection_rate, round(count(*) FILTER (service_ok) / count(*), 6) AS top1_all,
 round(count(*) FILTER (service_ok) / count(*) FILTER (detected), 6) AS top1_detected, round(count(*) FILTER (in_top_k) / count(*), 6) AS topk_all, round(avg(delay_s) FILTER (detected), 6) AS mean_delay_s,
 round(avg(confidence) FILTER (detected), 6) AS mean_confidence, CAST(sum(n_flagged) AS BIGINT) AS flagged_points FROM runs"""
_RATES = ["detection_rate", "top1_all", "top1_detected", "topk_all", "mean_delay_s", "mean_confidence"]


@query("i2_detection_summary", _W + _SUMMARY)
def _(spark, sf):
    return rounded(I.detection_summary(runs(spark, sf)), *_RATES)


_PRF = """x AS (SELECT y_true AS label, count(*) AS support, count(*) FILTER (y_pred = y_true) AS tp FROM runs GROUP BY 1), y AS (SELECT y_pred AS label, count(*) AS predicted FROM runs GROUP BY 1),
  pr AS (SELECT coalesce(tp / nullif(coalesce(predicted, 0), 0), 0) AS p, tp / support AS r FROM x LEFT JOIN y USING (label))"""
_PRF_OUT = "SELECT round(avg(p), 6) AS precision, round(avg(r), 6) AS recall, round(avg(CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END), 6) AS f1 FROM pr"


@query("i3_macro_prf", "WITH " + RUNS + ", " + _PRF + " " + _PRF_OUT)
def _(spark, sf):
    return rounded(I.macro_prf(runs(spark, sf)), "precision", "recall", "f1")


@query("i4_confusion", _W + "SELECT true_fault AS true_label, coalesce(pred_fault, 'none') AS pred_label, count(*) AS n FROM runs GROUP BY 1, 2")
def _(spark, sf):
    return I.confusion(runs(spark, sf))


@query("i4_confusion_wide", _W + "SELECT true_fault AS true_label, " + ", ".join(f"count(*) FILTER (pred_fault = '{f}') AS {f}" for f in _FAULTS) + " FROM runs GROUP BY 1")
def _(spark, sf):
    return I.confusion_wide(runs(spark, sf), _FAULTS)


@query("i4_fault_accuracy", _W + "SELECT true_fault, count(*) AS runs, round(count(*) FILTER (service_ok AND pred_fault = true_fault) / count(*), 6) AS accuracy FROM runs GROUP BY 1")
def _(spark, sf):
    return rounded(I.fault_accuracy(runs(spark, sf)), "accuracy")


@query("i5_latency_summary", _W + """SELECT endpoint, count(*) AS n, round(avg(latency_ms), 2) AS mean_ms, list_sort(list(latency_ms))[greatest(1, CAST(floor(count(*) * 0.99) AS BIGINT))] AS p99_ms,
 list_sort(list(latency_ms))[greatest(1, CAST(floor(count(*) * 0.99) AS BIGINT))] < 500 AS passed FROM runs GROUP BY 1""")
def _(spark, sf):
    return I.latency_summary(runs(spark, sf), ["endpoint"])


_BOOK = "CASE {c} " + " ".join(f"WHEN '{f}' THEN '{b}'" for f, b in fixed.FAULT_RUNBOOK.items()) + f" ELSE '{fixed.DEFAULT_RUNBOOK}' END"


def _books(spark, sf):
    return runs(spark, sf).withColumn("expected_runbook", F.create_map(*[F.lit(x) for kv in fixed.FAULT_RUNBOOK.items() for x in kv])[F.col("true_fault")])


@query("i6_runbook_accuracy", _W + f"SELECT count(*) AS runs, round(count(*) FILTER ({_BOOK.format(c='pred_fault')} = {_BOOK.format(c='true_fault')}) / count(*), 6) AS end_to_end, 1.0::DOUBLE AS with_true_fault FROM runs")
def _(spark, sf):
    return rounded(I.runbook_accuracy(_books(spark, sf), fault_mapping(spark)), "end_to_end", "with_true_fault")


@query("i7_pipeline_success", _W + "SELECT count(*) FILTER (service_ok AND pred_fault = true_fault AND verified) AS succeeded, round(count(*) FILTER (service_ok AND pred_fault = true_fault AND verified) / count(*), 6) AS success_rate FROM runs")
def _(spark, sf):
    r = runs(spark, sf).withColumn("runbook_ok", F.coalesce(F.col("pred_fault") == F.col("true_fault"), F.lit(False)))
    return rounded(I.pipeline_success(r), "success_rate")


@query("i8_failure_reason", _W + """SELECT run_key, CASE WHEN NOT detected THEN 'not_detected' ELSE coalesce(nullif(concat_ws('+', CASE WHEN NOT service_ok THEN 'service_wrong' END, CASE WHEN pred_fault <> true_fault THEN 'fault_type_wrong' END,
 CASE WHEN pred_fault <> true_fault THEN 'runbook_wrong' END, CASE WHEN NOT verified THEN 'verify_failed' END), ''), 'none') END AS reason FROM runs""")
def _(spark, sf):
    ok = F.coalesce(F.col("pred_fault") == F.col("true_fault"), F.lit(False))
    return runs(spark, sf).select("run_key", I.failure_reason(F.col("service_ok"), ok, ok, F.col("detected"), F.col("verified")).alias("reason"))


@query("i9_acceptance_gate", "WITH " + RUNS + ", " + _PRF + f""", m AS (UNPIVOT ({_PRF_OUT}) ON precision, recall, f1 INTO NAME metric VALUE value), t(metric, op, target) AS (VALUES ('f1', '>=', 0.85), ('precision', '>=', 0.85), ('recall', '>=', 0.80))
SELECT metric, value, op, CAST(target AS DOUBLE) AS target, value >= target AS passed FROM m JOIN t USING (metric)""")
def _(spark, sf):
    m = rounded(I.macro_prf(runs(spark, sf)), "precision", "recall", "f1").unpivot([], ["precision", "recall", "f1"], "metric", "value")
    t = spark.createDataFrame([("f1", ">=", 0.85), ("precision", ">=", 0.85), ("recall", ">=", 0.80)], "metric string, op string, target double")
    return I.acceptance_gate(m, t)


@query("a16_write_benchmark_report", "WITH " + RUNS + ", " + _PRF + f""", s AS ({_SUMMARY}), q AS ({_PRF_OUT}), a AS (SELECT true_fault, count(*) AS runs, round(count(*) FILTER (service_ok AND pred_fault = true_fault) / count(*), 6) AS accuracy FROM runs GROUP BY 1)
SELECT s.runs, s.detection_rate, q.f1, (SELECT string_agg(true_fault || ':' || accuracy, ',' ORDER BY true_fault) FROM a) AS faults FROM s, q""")
def _(spark, sf):
    r = runs(spark, sf)
    rep = I.benchmark_report(rounded(I.detection_summary(r), *_RATES), rounded(I.macro_prf(r), "precision", "recall", "f1"), rounded(I.fault_accuracy(r), "accuracy"))
    d = rep.select(F.from_json("report", "summary struct<runs:bigint,detection_rate:double>, service_metrics struct<f1:double>, fault_accuracy map<string,struct<runs:bigint,accuracy:double>>").alias("j"))
    faults = F.array_join(F.transform(F.array_sort(F.map_entries("j.fault_accuracy")), lambda e: F.concat(e["key"], F.lit(":"), e["value"]["accuracy"].cast("string"))), ",")
    return d.select("j.summary.runs", "j.summary.detection_rate", "j.service_metrics.f1", faults.alias("faults"))


@query("k6_quality_drift", """WITH o AS (SELECT CAST(year(o_orderdate) AS INT) AS week, 'detection_rate' AS metric, avg(CASE WHEN o_orderstatus <> 'P' THEN 1.0 ELSE 0.0 END) AS value FROM orders GROUP BY 1)
SELECT metric, week, round(value, 6) AS value, round(value - lag(value) OVER (ORDER BY week), 6) AS change, value < 0.7 - 0.02 AS drifted FROM o""")
def _(spark, sf):
    o = spark.read.parquet(f"{sf}/orders.parquet")
    w = o.groupBy(F.year("o_orderdate").alias("week")).agg(F.avg(F.when(F.col("o_orderstatus") != "P", 1.0).otherwise(0.0)).alias("value")).withColumn("metric", F.lit("detection_rate"))
    b = spark.createDataFrame([("detection_rate", 0.7)], "metric string, value double")
    return rounded(I.quality_drift(w, b, 0.02).select("metric", "week", "value", "change", "drifted"), "value", "change")
