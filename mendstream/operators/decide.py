"""Runbook choice, plans, safety gates, verification and attempts."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from mendstream import fixed
from mendstream.functions.scalars import render_deployment, render_target
from mendstream.operators.scans import forward_fill, with_block
from mendstream.session import bounded
from mendstream.sources.profile import FLAT, catalog_runbooks


def match_runbook(contexts: DataFrame, mapping: DataFrame, runbooks: DataFrame, default: str = fixed.DEFAULT_RUNBOOK,
                  always_default: bool = False) -> DataFrame:
    """Runbook of the fault; unknown faults and missing runbooks take the default one, the built-in default where the books have none.

    ``mapping``: fault, runbook; ``runbooks``: name and the runbook fields (both small configuration). Where they carry ``profile_name``, contexts
    must carry it too and take the mapping and books of their profile.
    """
    by = lambda df: [c for c in ["profile_name"] if c in df.columns]
    for df in (mapping, runbooks):
        if by(df) and not by(contexts):
            raise ValueError("contexts need profile_name, as mapping or runbooks are kept by profile")
    books = runbooks.select(*by(runbooks), F.col("name").alias("matched_runbook"), F.struct(*FLAT).alias("book"))
    if always_default:
        named = contexts.withColumn("matched_runbook", F.lit(default))
    else:
        dim = mapping.select(*by(mapping), F.col("fault").alias("suspected_fault_type"), F.col("runbook").alias("_runbook"))
        named = contexts.join(dim, [*by(mapping), "suspected_fault_type"], "left")
        known = books.select(*by(books), F.col("matched_runbook").alias("_runbook"), F.lit(True).alias("_known"))
        named = named.join(known, [*by(books), "_runbook"], "left")
        named = named.withColumn("matched_runbook", F.when(F.col("_known"), F.col("_runbook")).otherwise(default)).drop("_runbook", "_known")
    found = named.join(books, [*by(books), "matched_runbook"], "left")
    found = found.withColumn("matched_runbook", F.when(F.col("book").isNull(), fixed.DEFAULT_RUNBOOK).otherwise(F.col("matched_runbook")))
    last = catalog_runbooks(contexts.sparkSession, only_default=True).select(F.col("name").alias("matched_runbook"), F.struct(*FLAT).alias("_default"))
    return found.join(last, "matched_runbook", "left").withColumn("book", F.coalesce("book", "_default")).drop("_default")


def render_plan(matched: DataFrame) -> DataFrame:
    """Steps with target, namespace and secret name filled in; the namespace joins the allow-list if absent.

    Needs ``target_service, namespace`` and ``book`` (see :func:`match_runbook`).
    """
    service, space = F.col("target_service"), F.col("namespace")
    deployment = F.coalesce(F.col("deployment"), render_deployment(service)) if "deployment" in matched.columns else render_deployment(service)

    def params(p: Column) -> Column:
        p = F.when(F.map_contains_key(p, F.lit("namespace")), p).otherwise(F.map_concat(p, F.create_map(F.lit("namespace"), space)))
        return F.transform_values(p, lambda k, v: F.when(k == "secret_name", F.replace(v, F.lit("{service}"), service)).otherwise(v))

    plan = F.transform("book.action_plan", lambda s: F.struct(
        s["step"].alias("step"), s["action"].alias("action"),
        render_target(s["target"], service, deployment).alias("target"), params(s["params"]).alias("params")))
    blast = F.struct(
        F.col("book.max_pod_impact_pct").alias("max_pod_impact_pct"), F.col("book.circuit_breaker_error_rate").alias("circuit_breaker_error_rate"),
        F.array_union(F.coalesce("book.allowed_namespaces", F.array(*[F.lit(n[0]) for n in fixed.NAMESPACES])), F.array(space)).alias("allowed_namespaces"))
    verify = F.struct(F.col("book.window_seconds").alias("window_seconds"), F.col("book.success_conditions").alias("success_conditions"))
    return matched.withColumns({
        "pattern_type": F.col("book.pattern_type"), "action_plan": plan, "blast_radius_config": blast, "verify_policy": verify,
    }).drop("book")


def blast_radius_gate(plans: DataFrame, allowed: list[str]) -> DataFrame:
    """Adds ``allowed``: only the listed namespaces may be acted on."""
    return plans.withColumn("allowed", F.array_contains(F.array(*[F.lit(a) for a in allowed]), F.col("namespace")))


def lane(pattern_type: Column) -> Column:
    return F.when(pattern_type == "deferred", "slow").otherwise("fast")


def verify_action(actions: DataFrame, points: DataFrame, error: float = fixed.VERIFY_ERROR,
                  latency: float = fixed.VERIFY_LATENCY, regression: float = fixed.VERIFY_REGRESSION, seconds: int | None = None) -> DataFrame:
    """Success, regression, next action and reason of each executed action.

    ``points`` (``action_id, seq, service, signal_name, value_num``) is the telemetry after the action. Only
    breaching points are kept before the grouping, and each adds one line to the reason in arrival order.
    With ``seconds`` the points are those of the tenant (``tenant_id, t`` instead of ``action_id``), and an action (``tenant_id, at`` more) is judged by those
    in ``(at, at + seconds]``: no row is made of an action and a point, what is stored grows with either table alone.
    """
    a = actions.withColumn("_svc", F.element_at(F.split("target", "/"), -1))
    err, lat = F.col("signal_name").contains("error"), F.col("signal_name").contains("latency")
    said = [F.col("signal_name"), F.col("value_num").cast("string")]
    keys = ["action_id"]
    if seconds:  # a window lies in the block of ``at`` and the next one
        keys, block = ["tenant_id", "_block"], lambda t: F.expr(f"({t} - pmod({t}, {seconds})) div {seconds}")
        a = a.withColumn("_block", block("at"))
        points = points.withColumn("_block", F.explode(F.array(block("t"), block("t") - 1)))

    def line(kind: int, sub: int, sentence: str, *parts: Column) -> Column:
        return F.struct(F.lit(kind).alias("k"), F.col("seq"), F.lit(sub).alias("j"), F.format_string(sentence, *parts).alias("s"), F.col("service"), (F.col("t") if seconds else F.lit(None)).alias("t"))

    lines = F.array_compact(F.array(
        F.when(err & (F.col("value_num") > error), line(0, 0, fixed.HIGH_ERROR, *said)),
        F.when(lat & (F.col("value_num") > latency), line(0, 1, fixed.HIGH_LATENCY, *said)),
        F.when(err & (F.col("value_num") > regression), line(1, 0, fixed.OTHER_REGRESSION, F.col("service"), *said)),
    ))
    found = points.select(*keys, F.explode(lines).alias("l")).groupBy(*keys).agg(F.array_sort(F.collect_list("l")).alias("l"))

    def of_action(x: Column) -> Column:
        fits = F.when(x["k"] == 0, x["service"] == F.col("_svc")).otherwise(x["service"] != F.col("_svc"))
        return fits & (x["t"] > F.col("at")) & (x["t"] <= F.col("at") + seconds) if seconds else fits

    d = a.join(found, keys, "left").withColumn("l", F.when(F.col("status") != "FAILED", F.filter("l", of_action)))
    d = d.withColumns({"_regressed": F.coalesce(F.exists("l", lambda x: x["k"] == 1), F.lit(False)), "_clean": F.coalesce(F.size("l") == 0, F.lit(True))})
    failed, regressed, clean = F.col("status") == "FAILED", F.col("_regressed"), F.col("_clean") | F.col("l").isNull()
    joined = F.array_join(F.transform("l", lambda x: x["s"]), "; ")
    return d.select(
        *actions.columns,
        (~failed & clean).alias("success"), (~failed & regressed).alias("regression_detected"),
        F.when(failed, "RETRY").when(clean, "DONE").when(regressed, "ROLLBACK").otherwise("ESCALATE").alias("next_action"),
        F.when(failed, F.format_string(fixed.ACTION_FAILED, "action", "target"))
        .when(clean, fixed.ACTION_CLEAN)
        .when(regressed, F.format_string(fixed.ACTION_REGRESSED, joined))
        .otherwise(F.format_string(fixed.ACTION_UNRECOVERED, joined)).alias("reason"),
    )


def success_conditions(plans: DataFrame, points: DataFrame, seconds: int | None = None) -> DataFrame:
    """Each condition of a plan evaluated on the newest point of its signal; null where there is none.

    ``plans``: ``plan_id, target_service, conditions``; ``points``: ``plan_id, service, signal_name, t, seq, value_num``.
    With ``seconds`` the points are those of the tenant (``tenant_id`` instead of ``plan_id``), and a plan (``tenant_id, at`` more) takes the newest
    in ``(at, at + seconds]``: the last value of the series before its end, found by a blocked forward fill.
    """
    pattern = r"^\s*(\w+)\s*(==|<=|>=|<|>)\s*(\S+)\s*$"
    c = plans.select("plan_id", "target_service", *(["tenant_id", "at"] if seconds else []), F.posexplode("conditions").alias("ord", "condition"))
    c = c.select("*", F.regexp_extract("condition", pattern, 1).alias("signal_name"), F.regexp_extract("condition", pattern, 2).alias("op"),
                 F.regexp_extract("condition", pattern, 3).alias("_v"))
    wanted = F.when(F.lower("_v") == "true", 1.0).when(F.lower("_v") == "false", 0.0).otherwise(F.col("_v").try_cast("double"))
    c = c.withColumn("wanted", wanted).drop("_v")
    p = points.withColumnRenamed("service", "target_service")
    if seconds is None:
        latest = p.groupBy("plan_id", "target_service", "signal_name").agg(F.max_by("value_num", F.struct("t", "seq")).alias("value"))
        d = c.join(latest, ["plan_id", "target_service", "signal_name"], "left")
    else:
        key = ["tenant_id", "target_service", "signal_name"]
        named = p.join(bounded(c.select("signal_name").distinct()), "signal_name", "left_semi")
        known = named.groupBy(*key, "t").agg(F.struct("t", F.max_by("value_num", "seq").alias("v")).alias("_p")).withColumn("_ask", F.lit(False))
        asked = c.withColumns({"t": F.col("at") + seconds, "_ask": F.lit(True)})
        both = asked.unionByName(known, allowMissingColumns=True).withColumn("_o", F.struct("t", "_ask"))  # a point of the last second counts
        d = forward_fill(with_block(both, "t", 86400), key, "_o", "_p", "block").where("_ask")
        d = d.withColumn("value", F.when(F.col("_p.t") > F.col("at"), F.col("_p.v"))).select(*[x for x in c.columns if x not in ("tenant_id", "at")], "value")
    v, w, op = F.col("value"), F.col("wanted"), F.col("op")
    met = F.when(op == "==", v == w).when(op == "<", v < w).when(op == "<=", v <= w).when(op == ">", v > w).when(op == ">=", v >= w)
    return d.withColumn("met", met)


# -- attempts -------------------------------------------------------------------------------------


def fault_order(current: Column, ranked: Column, catalog: list[str] = list(fixed.FAULT_RUNBOOK)) -> Column:
    """The current fault, then the ranked ones, then the rest of the catalog."""
    rest = F.array(*[F.lit(f) for f in catalog])
    return F.array_distinct(F.array_compact(F.concat(F.array(current), F.coalesce(ranked, F.array().cast("array<string>")), rest)))


def attempt_plan(contexts: DataFrame, catalog: list[str] = list(fixed.FAULT_RUNBOOK)) -> DataFrame:
    """Ordered attempts: the predicted service first, then the other top services, each with all faults in order.

    ``contexts``: ``run_key, target_service, suspected_fault_type, service_top_k, ranked``.
    """
    services = F.array_distinct(F.concat(F.array("target_service"), F.coalesce("service_top_k", F.array().cast("array<string>"))))
    d = contexts.select("run_key", F.posexplode(services).alias("service_ord", "service"), fault_order(F.col("suspected_fault_type"), F.col("ranked"), catalog).alias("_f"))
    d = d.select("run_key", "service_ord", "service", F.posexplode("_f").alias("fault_ord", "fault"), F.size("_f").alias("_n"))
    phase = (
        F.when((F.col("service_ord") == 0) & (F.col("fault_ord") == 0), "first_choice")
        .when(F.col("service_ord") == 0, "same_service_other_fault")
        .when(F.col("fault_ord") == 0, "other_service_same_fault").otherwise("other_service_other_fault")
    )
    return d.select("run_key", (F.col("service_ord") * F.col("_n") + F.col("fault_ord") + 1).alias("attempt"), "service", "fault", phase.alias("phase"))


def first_success(attempts: DataFrame, truth: DataFrame) -> DataFrame:
    """Outcome of each attempt by the label, kept up to the first success of the run."""
    d = attempts.join(truth.select("run_key", "target_service", "true_fault"), "run_key")
    right = F.col("service") == F.col("target_service")
    outcome = F.when(right & (F.col("fault") == F.col("true_fault")), "DONE").when(right, "ESCALATE").otherwise("ROLLBACK")
    d = d.withColumn("next_action", outcome)
    done = d.groupBy("run_key").agg(F.min(F.when(F.col("next_action") == "DONE", F.col("attempt"))).alias("_done"))
    return (
        d.join(done, "run_key").where(F.col("_done").isNull() | (F.col("attempt") <= F.col("_done")))
        .drop("_done", "target_service", "true_fault")
    )


def rollback_rows(snapshots: DataFrame, allowed: list[str]) -> DataFrame:
    """Restore document of each snapshot, or the reason why there is none."""
    memory = (F.coalesce("memory_limit_mb", F.lit(0)) != 0) & (F.coalesce("container_name", F.lit("")) != "")
    mb = lambda c: F.concat(F.col(c).cast("string"), F.lit("Mi"))
    limits = F.struct(F.when(memory, mb("memory_limit_mb")).alias("memory"), F.nullif(F.col("cpu_limit"), F.lit("")).alias("cpu"))
    requests = F.when(F.coalesce("memory_request_mb", F.lit(0)) != 0, F.struct(mb("memory_request_mb").alias("memory")))
    container = F.struct(F.col("container_name").alias("name"), F.struct(limits.alias("limits"), requests.alias("requests")).alias("resources"))
    template = F.when(memory, F.struct(F.struct(F.array(container).alias("containers")).alias("spec")))
    body = F.to_json(F.struct(F.struct(F.col("replicas"), template.alias("template")).alias("spec")), {"ignoreNullFields": "true"})
    urgent = F.col("pattern_type") == "urgent"
    error = (
        F.when(~F.col("namespace").isin(allowed), "namespace not allowed")
        .when(urgent & F.col("replicas").isNull() & ~memory, "nothing to restore")
        .when(~urgent & (F.coalesce("git_commit_sha", F.lit("")) == ""), "git_commit_sha is missing")
    )
    document = F.when(urgent, body).otherwise(F.to_json(F.struct(F.col("git_commit_sha").alias("revert"))))
    d = snapshots.withColumn("error", error)
    return d.withColumn("document", F.when(F.col("error").isNull(), document))


def worker_outcome(events: DataFrame) -> DataFrame:
    """Terminal state of one alert from its joined stage columns, whether it counts as a breaker failure,
    and the escalation reason. Needs ``known_tenant, breaker_open, exception, anomaly_detected, plan_size, exec_status,
    success, next_action, dry_run``."""
    bad_verify = ~F.coalesce("success", F.lit(False)) | F.col("next_action").isin("ROLLBACK", "ESCALATE")
    state = (
        F.when(~F.col("known_tenant"), "UNKNOWN_NAMESPACE").when(F.col("breaker_open"), "SKIPPED_CB")
        .when(F.col("exception"), "EXCEPTION").when(~F.coalesce("anomaly_detected", F.lit(False)), "NO_ANOMALY")
        .when(F.coalesce("plan_size", F.lit(0)) == 0, "EMPTY_PLAN").when(F.col("exec_status") == "FAILED", "EXEC_FAILED")
        .when(bad_verify, "VERIFY_FAILED").when(F.col("dry_run"), "DRY_RUN").otherwise("COMPLETED")
    )
    d = events.withColumn("outcome", state)
    o = F.col("outcome")
    return d.withColumns({
        "message_status": F.when(o.isin("EXCEPTION", "EMPTY_PLAN", "EXEC_FAILED", "VERIFY_FAILED"), "FAILED").when(o == "NO_ANOMALY", "COMPLETED")
        .when(o.isin("DRY_RUN", "COMPLETED"), o),
        "breaker_failure": o.isin("EXCEPTION", "EXEC_FAILED", "VERIFY_FAILED"),
        "rollback": F.coalesce((o == "VERIFY_FAILED") & (F.col("next_action") == "ROLLBACK"), F.lit(False)),
        "escalation": F.when(o == "SKIPPED_CB", "CB_OPEN").when(o.isin("EXCEPTION", "EMPTY_PLAN", "EXEC_FAILED", "VERIFY_FAILED"), o),
    })


def next_retry_context(d: DataFrame) -> DataFrame:
    """The executed context: a corrected context with a service overrides the detected one field by field.

    Needs the structs ``detected`` and ``corrected`` with the same fields.
    """
    fields = d.schema["detected"].dataType.fieldNames()
    use = F.col("corrected.target_service").isNotNull() & (F.col("corrected.target_service") != "")
    merged = F.struct(*[F.coalesce(F.when(use, F.col(f"corrected.{f}")), F.col(f"detected.{f}")).alias(f) for f in fields])
    return d.withColumn("context", merged)


# -- documented gates -------------------------------------------------------------------------------


def confidence_gate(decisions: DataFrame, least: float = 0.6) -> DataFrame:
    return decisions.withColumn("gate", F.when(F.col("confidence") < least, "ESCALATE").otherwise("ACT"))


def patch_limit_gate(plans: DataFrame, snapshots: DataFrame, growth: float = 0.5,
                     system_namespaces: list[str] = ["kube-system", "kube-public"]) -> DataFrame:
    """A limit may grow by at most half per patch, measured on the newest snapshot; system namespaces never."""
    newest = snapshots.groupBy("namespace", "deployment").agg(F.max_by("memory_limit_mb", "t").alias("current_mb"))
    d = plans.join(newest, ["namespace", "deployment"], "left")
    gate = (
        F.when(F.col("namespace").isin(system_namespaces), "system_namespace")
        .when(F.col("current_mb").isNull(), "no_snapshot")
        .when(F.col("memory_limit_mb") > F.col("current_mb") * (1 + growth), "growth_over_limit").otherwise("allowed")
    )
    return d.withColumn("gate", gate)


def fallback_reason(calls: DataFrame, slow_ms: int = 2500, budget_ms: int = 2000) -> DataFrame:
    """Why a decision was rule-based; null when the model's answer was used."""
    code = F.col("status_code")
    return calls.withColumn("fallback_reason", F.when(F.col("cost_cap_exceeded"), "cost_cap_exceeded")
                            .when((code == 429) & (F.col("elapsed_ms") + F.col("retry_wait_ms") > budget_ms), "throttled")
                            .when(code.isNull() | (code >= 500) | (F.col("elapsed_ms") > slow_ms), "unavailable")
                            .when(~F.col("parsed"), "unparsable"))
