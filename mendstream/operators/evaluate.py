"""Accuracy, latency and acceptance reports over labelled runs."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from mendstream import fixed


def ratio(n: Column, d: Column) -> Column:
    return F.coalesce(F.try_divide(n, d), F.lit(0.0))


def stratified_sample(runs: DataFrame, n: int, faults: list[str] = fixed.SAMPLE_FAULTS, seed: int = 42) -> DataFrame:
    """``n // 6`` runs per fault (at least one) in the order of a seeded hash, then sorted and cut to ``n``."""
    per = max(1, n // len(faults))
    draw = F.row_number().over(W.partitionBy("fault").orderBy(F.md5(F.concat(F.lit(f"{seed}#"), "run_key")), "run_key"))
    picked = runs.where(F.col("fault").isin(faults)).withColumn("_r", draw).where(F.col("_r") <= per).drop("_r")
    return picked.orderBy("run_key").limit(n)


def detection_summary(runs: DataFrame) -> DataFrame:
    """One row: rates over all runs and over detected runs, mean delay, confidence and flagged points.

    Needs ``detected, service_ok, in_top_k, delay_s, confidence, n_flagged``.
    """
    hit = F.col("detected")
    return runs.agg(
        F.count("*").alias("runs"), F.count_if(hit).alias("detected"),
        ratio(F.count_if(hit), F.count("*")).alias("detection_rate"),
        ratio(F.count_if(hit & F.col("service_ok")), F.count("*")).alias("top1_all"),
        ratio(F.count_if(hit & F.col("service_ok")), F.count_if(hit)).alias("top1_detected"),
        ratio(F.count_if(hit & F.col("in_top_k")), F.count("*")).alias("topk_all"),
        F.coalesce(F.avg(F.when(hit, F.col("delay_s"))), F.lit(0.0)).alias("mean_delay_s"),
        F.coalesce(F.avg(F.when(hit, F.col("confidence"))), F.lit(0.0)).alias("mean_confidence"),
        F.sum("n_flagged").alias("flagged_points"),
    )


def macro_prf(df: DataFrame, true: str = "y_true", pred: str = "y_pred") -> DataFrame:
    """Macro precision, recall and F1 over the true labels; a null prediction is a wrong label, 0 where undefined."""
    pairs = df.groupBy(F.col(true).alias("t"), F.coalesce(pred, F.lit("none")).alias("p")).agg(F.count("*").alias("n"))
    by_true = pairs.groupBy(F.col("t").alias("label")).agg(
        F.sum("n").alias("support"), F.sum(F.when(F.col("t") == F.col("p"), F.col("n")).otherwise(0)).alias("tp"))
    by_pred = pairs.groupBy(F.col("p").alias("label")).agg(F.sum("n").alias("predicted"))
    per = by_true.join(by_pred, "label", "left").select(
        ratio(F.col("tp"), F.coalesce("predicted", F.lit(0))).alias("p"), ratio(F.col("tp"), F.col("support")).alias("r"))
    f1 = ratio(2 * F.col("p") * F.col("r"), F.col("p") + F.col("r"))
    return per.agg(F.avg("p").alias("precision"), F.avg("r").alias("recall"), F.avg(f1).alias("f1"))


def confusion(df: DataFrame, true: str = "true_fault", pred: str = "pred_fault") -> DataFrame:
    """Counts of true x predicted in long form."""
    return df.groupBy(F.col(true).alias("true_label"), F.coalesce(pred, F.lit("none")).alias("pred_label")).agg(F.count("*").alias("n"))


def confusion_wide(df: DataFrame, labels: list[str], true: str = "true_fault", pred: str = "pred_fault") -> DataFrame:
    wide = df.groupBy(F.col(true).alias("true_label")).pivot(pred, labels).count()
    return wide.fillna(0, labels)


def fault_accuracy(df: DataFrame) -> DataFrame:
    """Per true fault: share of runs with both service and fault right."""
    return df.groupBy("true_fault").agg(
        F.count("*").alias("runs"), ratio(F.count_if(F.col("service_ok") & (F.col("pred_fault") == F.col("true_fault"))), F.count("*")).alias("accuracy"))


def latency_summary(df: DataFrame, by: list[str], col: str = "latency_ms", limit: float = 500.0) -> DataFrame:
    """Mean (2 digits) and p99 = ``sorted[int(0.99 n) - 1]``; one value is its own p99.

    Counts per whole millisecond find the slot of the p99 element; only the rows of that slot are
    looked at one by one. No list of a group is built.
    """
    d = df.withColumn("_x", F.col(col).cast("double")).withColumn("_ms", F.floor("_x"))
    slots = d.groupBy(*by, "_ms").agg(F.count("*").alias("_n"), F.sum("_x").alias("_s"))
    group, up = W.partitionBy(*by), W.partitionBy(*by).orderBy("_ms").rowsBetween(W.unboundedPreceding, 0)
    slots = slots.withColumn("_cum", F.sum("_n").over(up)).withColumn("n", F.sum("_n").over(group))
    slots = slots.withColumn("mean_ms", F.round(F.sum("_s").over(group) / F.col("n"), 2))
    want = F.greatest(F.lit(1), F.floor(F.col("n") * 0.99))
    slot = slots.where((F.col("_cum") >= want) & (F.col("_cum") - F.col("_n") < want))
    slot = slot.select(*by, "_ms", "n", "mean_ms", (want - (F.col("_cum") - F.col("_n"))).alias("_k"))
    inside = d.join(slot, [*by, "_ms"]).groupBy(*by, "_ms", "n", "mean_ms", "_k", "_x").agg(F.count("*").alias("_m"))
    at = W.partitionBy(*by).orderBy("_x").rowsBetween(W.unboundedPreceding, 0)
    out = inside.withColumn("_c", F.sum("_m").over(at)).where(F.col("_c") >= F.col("_k"))
    out = out.groupBy(*by, "n", "mean_ms").agg(F.min("_x").alias("p99_ms"))
    return out.withColumn("passed", F.col("p99_ms") < limit)


def runbook_accuracy(runs: DataFrame, mapping: DataFrame, default: str = fixed.DEFAULT_RUNBOOK) -> DataFrame:
    """Share of right runbooks for the predicted fault, and for the true fault (upper bound)."""
    m = F.broadcast(mapping)
    d = runs.join(m.select(F.col("fault").alias("pred_fault"), F.col("runbook").alias("_p")), "pred_fault", "left")
    d = d.join(m.select(F.col("fault").alias("true_fault"), F.col("runbook").alias("_t")), "true_fault", "left")
    p, t = F.coalesce("_p", F.lit(default)), F.coalesce("_t", F.lit(default))
    return d.agg(
        F.count("*").alias("runs"), ratio(F.count_if(p == F.col("expected_runbook")), F.count("*")).alias("end_to_end"),
        ratio(F.count_if(t == F.col("expected_runbook")), F.count("*")).alias("with_true_fault"))


def pipeline_success(runs: DataFrame) -> DataFrame:
    ok = F.col("service_ok") & F.col("runbook_ok") & F.col("verified")
    return runs.agg(F.count_if(ok).alias("succeeded"), ratio(F.count_if(ok), F.count("*")).alias("success_rate"))


def failure_reason(service_ok: Column, fault_ok: Column, runbook_ok: Column, detected: Column | None = None, verified: Column | None = None) -> Column:
    """Names of what went wrong joined with ``+``, or ``none``."""
    parts = [F.when(~service_ok, "service_wrong"), F.when(~fault_ok, "fault_type_wrong"), F.when(~runbook_ok, "runbook_wrong")]
    if verified is not None:
        parts.append(F.when(~verified, "verify_failed"))
    joined = F.coalesce(F.nullif(F.array_join(F.array_compact(F.array(*parts)), "+"), F.lit("")), F.lit("none"))
    return joined if detected is None else F.when(~detected, "not_detected").otherwise(joined)


def acceptance_gate(metrics: DataFrame, targets: DataFrame) -> DataFrame:
    """Measured values against targets (``metric, op, target``)."""
    v, t = F.col("value"), F.col("target")
    ok = F.when(F.col("op") == ">=", v >= t).when(F.col("op") == "<", v < t).otherwise(v <= t)
    return metrics.join(F.broadcast(targets), "metric").withColumn("passed", ok)


def benchmark_report(summary: DataFrame, prf: DataFrame, per_fault: DataFrame) -> DataFrame:
    """The three aggregates as one nested JSON document (one row each, or one per fault)."""
    parts = summary.select(F.struct(*summary.columns).alias("summary"))
    parts = parts.unionByName(prf.select(F.struct(*prf.columns).alias("service_metrics")), allowMissingColumns=True)
    # one row per fault family
    entries = F.array_sort(F.collect_list(F.struct("true_fault", F.struct("runs", "accuracy"))))
    parts = parts.unionByName(per_fault.agg(F.map_from_entries(entries).alias("fault_accuracy")), allowMissingColumns=True)
    names = ["summary", "service_metrics", "fault_accuracy"]
    return parts.agg(*[F.first(n, ignorenulls=True).alias(n) for n in names]).select(F.to_json(F.struct(*names)).alias("report"))


def quality_drift(weekly: DataFrame, baseline: DataFrame, tolerance: float = 0.05) -> DataFrame:
    """Weekly metric values against the baseline and the week before (``week, metric, value``)."""
    prev = F.lag("value").over(W.partitionBy("metric").orderBy("week"))
    d = weekly.withColumn("previous", prev).join(F.broadcast(baseline.select("metric", F.col("value").alias("baseline"))), "metric", "left")
    return d.withColumn("change", F.col("value") - F.col("previous")).withColumn("drifted", F.col("value") < F.col("baseline") - tolerance)
