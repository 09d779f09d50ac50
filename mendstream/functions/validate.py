"""Rule arrays: every failed rule of a row as data, rows split by whether any failed."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from mendstream import fixed
from mendstream.session import bounded

UUID = "^[0-9a-fA-F]{8}-?[0-9a-fA-F]{4}-?[0-9a-fA-F]{4}-?[0-9a-fA-F]{4}-?[0-9a-fA-F]{12}$"
RFC3339 = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})?)?$"


def is_uuid(c: Column) -> Column:
    return F.coalesce(c.rlike(UUID), F.lit(False))


def _failed(rules: list[tuple[str, Column]]) -> Column:
    """Names of the rules whose condition is true, in order."""
    return F.array_compact(F.array(*[F.when(F.coalesce(bad, F.lit(False)), F.lit(name)) for name, bad in rules]))


def _first(rules: list[tuple[str, Column]]) -> Column:
    return F.coalesce(*[F.when(F.coalesce(bad, F.lit(False)), F.lit(name)) for name, bad in rules])


def telemetry_errors(signals: list[str] = fixed.SIGNAL_NAMES) -> Column:
    """Broken rules of a point with columns ts, tenant_id, service, signal_name, value_num,
    value_str, labels and extra_keys (names outside the contract)."""
    log = F.col("signal_name").isin(fixed.LOG_SIGNAL_NAMES)
    ts = F.col("ts")
    good_ts = ts.rlike(RFC3339) & F.try_to_timestamp(ts).isNotNull()
    missing = ts.isNull() | F.col("tenant_id").isNull() | F.col("service").isNull() | F.col("signal_name").isNull() | (
        F.col("value_num").isNull() & F.col("value_str").isNull())
    return _failed([
        ("missing_field", missing),
        ("extra_field", F.size("extra_keys") > 0),
        ("ts", ts.isNotNull() & ~good_ts),
        ("tenant_id", F.col("tenant_id").isNotNull() & ~is_uuid(F.col("tenant_id"))),
        ("signal_name", ~F.col("signal_name").isin(signals)),
        ("labels_system", F.col("labels").isNotNull() & ~F.map_contains_key("labels", F.lit("system"))),
        ("value_type", F.when(log, F.col("value_str").isNull() & F.col("value_num").isNotNull())
         .otherwise(F.col("value_num").isNull() & F.col("value_str").isNotNull())),
    ])


def validate_telemetry(df: DataFrame, signals: list[str] = fixed.SIGNAL_NAMES) -> tuple[DataFrame, DataFrame]:
    checked = df.withColumn("errors", telemetry_errors(signals))
    return checked.where(F.size("errors") == 0).drop("errors"), checked.where(F.size("errors") > 0)


def tenant_isolation(points: DataFrame, requests: DataFrame) -> DataFrame:
    """403 rows: points (with their index) whose tenant is not the request's tenant."""
    return (
        points.join(requests.select("request_id", F.col("tenant_id").alias("request_tenant")), "request_id")
        .where(F.col("tenant_id") != F.col("request_tenant"))
        .select("request_id", "point_index", "tenant_id", "request_tenant", F.lit(403).alias("status_code"))
    )


def envelope_error(stage: str = "detect") -> Column:
    """First broken rule of a request envelope; the correlation id is optional for detect only."""
    dry = F.lower(F.trim("x_dry_run_mode"))
    h, b = F.col("x_correlation_id"), F.col("correlation_id")
    if stage == "detect":
        corr_bad = h.isNotNull() & (h != "") & ~is_uuid(h)
        corr_diff = h.isNotNull() & (h != "") & b.isNotNull() & (b != "") & (h != b)
    else:
        corr_bad, corr_diff = ~is_uuid(h), ~h.eqNullSafe(b)
    return _first([
        ("tenant_header_not_uuid", ~is_uuid(F.col("x_tenant_id"))),
        ("correlation_header_not_uuid", corr_bad),
        ("idempotency_header_not_uuid", ~is_uuid(F.col("idempotency_header"))),
        ("idempotency_body_not_uuid", ~is_uuid(F.col("idempotency_key"))),
        ("idempotency_mismatch", F.col("idempotency_header") != F.col("idempotency_key")),
        ("dry_run_header_invalid", ~F.coalesce(dry.isin("true", "false"), F.lit(False))),
        ("dry_run_mismatch", (dry == "true") != F.col("dry_run_mode")),
        ("correlation_mismatch", corr_diff),
    ])


def alert_outcome(alerts: DataFrame, namespaces: DataFrame) -> DataFrame:
    """Row-level admission: ignored (with the reason), violation or admitted.

    The whole payload is not given up at its first violation; each alert gets its own outcome.
    """
    dim = bounded(namespaces.select("namespace", F.col("tenant_id").alias("expected_tenant")))
    outcome = (
        F.when(F.col("status") != "firing", "ignored_not_firing")
        .when(~F.col("alertname").isin(fixed.ADMITTED_ALERTS), "ignored_alert_name")
        .when(F.col("namespace").isNull() | (F.col("namespace") == ""), "ignored_no_namespace")
        .when(F.col("expected_tenant").isNull(), "ignored_unknown_namespace")
        .when(~F.col("request_tenant").eqNullSafe(F.col("expected_tenant")), "violation")
        .otherwise("admitted")
    )
    return alerts.join(dim, "namespace", "left").withColumn("outcome", outcome)


DECISION = """detect_assessment struct<is_detect_output_plausible:boolean,assessment_reason:string>,
 corrected_anomaly_context struct<target_service:string,suspected_fault_type:string,namespace:string,deployment:string>,
 matched_runbook string, pattern_type string,
 action_plan array<struct<step:int,action:string,target:string,params:map<string,string>>>,
 blast_radius_config struct<max_pod_impact_pct:double,circuit_breaker_error_rate:double,allowed_namespaces:array<string>>,
 verify_policy struct<window_seconds:bigint,success_conditions:array<string>>"""


def validate_decision(df: DataFrame, services: list[str], allowed_namespaces: list[str],
                      fault_runbook: dict[str, str] = fixed.FAULT_RUNBOOK, runbooks: list[str] | None = None,
                      raw: str = "raw") -> DataFrame:
    """Checks a decision text against the profile. Adds ``decision``, ``reject_reason`` (null when
    valid) and the executed service, fault, namespace and runbook, which fall back to the rule-based
    choice on rejection. Needs ``target_service, suspected_fault_type, namespace`` of the context."""
    from mendstream.functions.scalars import extract_json, lookup, render_deployment

    runbooks = runbooks or [r[0] for r in fixed.RUNBOOKS]
    d = df.withColumn("_json", extract_json(F.col(raw))).withColumn("decision", F.from_json("_json", DECISION))
    keys = F.json_object_keys("_json")
    need = F.array(*[F.lit(k) for k in fixed.DECISION_KEYS])
    c, dec = F.col("decision.corrected_anomaly_context"), F.col("decision")
    service = F.coalesce(F.nullif(c["target_service"], F.lit("")), F.col("target_service"))
    fault = c["suspected_fault_type"]
    space = F.coalesce(F.nullif(c["namespace"], F.lit("")), F.col("namespace"))
    own, default = F.concat(F.lit("deployment/"), service), render_deployment(service)
    given = render_deployment(F.col("target_service"))
    deployment = F.coalesce(F.nullif(c["deployment"], F.lit("")), default)
    expected = lookup(fault, fault_runbook, F.lit(fixed.DEFAULT_RUNBOOK))
    plan, blast = dec["action_plan"], dec["blast_radius_config"]

    def any_step(bad):
        return F.exists(plan, lambda s: F.coalesce(bad(s), F.lit(True)))

    step_space = lambda s: F.coalesce(s["params"]["namespace"], space)
    reason = _first([
        ("not_json", F.col("_json").isNull() | keys.isNull()),
        ("missing_keys", F.size(F.array_except(need, keys)) > 0),
        ("extra_keys", F.size(F.array_except(keys, need)) > 0),
        ("pattern_type", ~F.coalesce(dec["pattern_type"].isin(fixed.PATTERN_TYPES), F.lit(False))),
        ("corrected_context", c.isNull()),
        ("service", ~F.coalesce(service.isin(services), F.lit(False))),
        ("fault_type", ~F.coalesce(fault.isin(list(fault_runbook)), F.lit(False))),
        ("namespace", ~F.coalesce(space.isin(allowed_namespaces), F.lit(False))),
        ("deployment", ~deployment.isin(given, default, own)),
        ("assessment", dec["detect_assessment"]["is_detect_output_plausible"].isNull()
         | (F.trim(F.coalesce(dec["detect_assessment"]["assessment_reason"], F.lit(""))) == "")),
        ("unknown_runbook", ~F.coalesce(dec["matched_runbook"].isin(runbooks), F.lit(False))),
        ("runbook_mismatch", dec["matched_runbook"] != expected),
        ("empty_plan", F.coalesce(F.size(plan), F.lit(0)) <= 0),
        ("step_fields", any_step(lambda s: s["step"].isNull() | s["action"].isNull() | s["target"].isNull() | s["params"].isNull())),
        ("action", any_step(lambda s: ~s["action"].isin(fixed.ACTIONS))),
        ("target", any_step(lambda s: ~s["target"].isin(deployment, own))),
        ("step_namespace", any_step(lambda s: step_space(s) != space)),
        ("blast_radius", blast["max_pod_impact_pct"].isNull() | blast["circuit_breaker_error_rate"].isNull() | blast["allowed_namespaces"].isNull()),
        ("blast_namespace", ~F.array_contains(blast["allowed_namespaces"], space)),
        ("verify_policy", dec["verify_policy"]["window_seconds"].isNull()),
    ])
    d = d.withColumn("reject_reason", reason)
    ok = F.col("reject_reason").isNull()
    rule = lookup(F.col("suspected_fault_type"), fault_runbook, F.lit(fixed.DEFAULT_RUNBOOK))
    return d.select(
        *df.columns, "decision", "reject_reason",
        F.when(ok, service).otherwise(F.col("target_service")).alias("exec_service"),
        F.when(ok, fault).otherwise(F.col("suspected_fault_type")).alias("exec_fault"),
        F.when(ok, space).otherwise(F.col("namespace")).alias("exec_namespace"),
        F.when(ok, dec["matched_runbook"]).otherwise(rule).alias("exec_runbook"),
    )


RANKING = "fault_type_ranking array<struct<suspected_fault_type:string,confidence:double,reason:string>>"


def validate_fault_ranking(df: DataFrame, faults: list[str] | None = None, raw: str = "raw") -> DataFrame:
    """``reject_reason`` and the ranking: known faults, first of a repeated fault kept, by confidence."""
    faults = faults or list(fixed.FAULT_RUNBOOK)
    from mendstream.functions.scalars import extract_json

    d = df.withColumn("_json", extract_json(F.col(raw))).withColumn("_r", F.from_json("_json", RANKING)["fault_type_ranking"])
    keys = F.json_object_keys("_json")
    need = F.array(F.lit("fault_type_ranking"))
    # a repeated fault is skipped before its confidence and reason are looked at
    numbered = F.transform("_r", lambda x, i: F.struct(x.alias("x"), i.alias("i")))
    names = F.transform("_r", lambda x: x["suspected_fault_type"])
    firsts = F.filter(numbered, lambda s: F.array_position(names, s["x"]["suspected_fault_type"]) == s["i"] + 1)
    d = d.withColumn("_f", firsts)
    reason = _first([
        ("not_json", F.col("_json").isNull() | keys.isNull()),
        ("missing_keys", F.size(F.array_except(need, keys)) > 0),
        ("extra_keys", F.size(F.array_except(keys, need)) > 0),
        ("empty_ranking", F.coalesce(F.size("_r"), F.lit(0)) <= 0),
        ("fault_type", F.exists("_r", lambda x: ~F.coalesce(x["suspected_fault_type"].isin(faults), F.lit(False)))),
        ("confidence", F.exists("_f", lambda s: ~F.coalesce(s["x"]["confidence"].between(0.0, 1.0), F.lit(False)))),
        ("reason", F.exists("_f", lambda s: F.trim(F.coalesce(s["x"]["reason"], F.lit(""))) == "")),
    ])
    ordered = F.array_sort(F.transform("_f", lambda s: F.struct(
        (-s["x"]["confidence"]).alias("neg"), s["i"].alias("i"), s["x"]["suspected_fault_type"].alias("fault"),
        F.trim(s["x"]["reason"]).alias("reason"))))
    ranking = F.transform(ordered, lambda s: F.struct(s["fault"].alias("suspected_fault_type"), (-s["neg"]).alias("confidence"), s["reason"].alias("reason")))
    return d.withColumn("reject_reason", reason).withColumn(
        "ranking", F.when(F.col("reject_reason").isNull(), ranking)).drop("_json", "_r", "_f")


def validate_fault_choice(df: DataFrame, faults: list[str] | None = None, raw: str = "raw") -> DataFrame:
    """Single-label form: one fault with confidence and reason."""
    faults = faults or list(fixed.FAULT_RUNBOOK)
    from mendstream.functions.scalars import extract_json

    d = df.withColumn("_json", extract_json(F.col(raw)))
    d = d.withColumn("choice", F.from_json("_json", "suspected_fault_type string, confidence double, reason string"))
    keys, need = F.json_object_keys("_json"), F.array(*[F.lit(k) for k in ("suspected_fault_type", "confidence", "reason")])
    c = F.col("choice")
    return d.withColumn("reject_reason", _first([
        ("not_json", F.col("_json").isNull() | keys.isNull()),
        ("missing_keys", F.size(F.array_except(need, keys)) > 0),
        ("extra_keys", F.size(F.array_except(keys, need)) > 0),
        ("fault_type", ~F.coalesce(c["suspected_fault_type"].isin(faults), F.lit(False))),
        ("confidence", ~F.coalesce(c["confidence"].between(0.0, 1.0), F.lit(False))),
        ("reason", F.trim(F.coalesce(c["reason"], F.lit(""))) == ""),
    ])).drop("_json")


def response_error(body: Column, stage: str) -> Column:
    """First schema violation of a stage response given as JSON text; null when it conforms."""
    v = F.try_parse_json(body)

    def kind(path: str) -> Column:
        return F.schema_of_variant(F.try_variant_get(v, path, "variant"))

    def typed(path: str, *prefixes: str) -> Column:
        # an absent field has no type and breaks no type rule
        k = kind(path)
        bad = F.lit(True)
        for p in prefixes:
            bad = bad & ~k.startswith(p)
        return k.isNotNull() & bad

    number = ("BIGINT", "DOUBLE", "DECIMAL", "FLOAT")
    bad_body = ("body", F.coalesce(~F.schema_of_variant(v).startswith("OBJECT"), F.lit(True)))
    if stage == "detect":
        ctx = kind("$.anomaly_context")
        rules = [
            bad_body,
            ("anomaly_detected", kind("$.anomaly_detected").isNull() | typed("$.anomaly_detected", "BOOLEAN")),
            ("severity", typed("$.severity", *number)),
            ("confidence", typed("$.confidence", *number)),
            ("reasoning", typed("$.reasoning", "STRING")),
            ("anomaly_context", typed("$.anomaly_context", "OBJECT")),
            *[(f"anomaly_context.{f}", ctx.startswith("OBJECT") & (kind(f"$.anomaly_context.{f}").isNull() | typed(f"$.anomaly_context.{f}", "STRING")))
              for f in ("target_service", "namespace", "deployment")],
            ("anomaly_context.trigger_value", typed("$.anomaly_context.trigger_value", *number)),
        ]
    elif stage == "decide":
        steps = F.from_json(F.try_variant_get(v, "$.action_plan", "string"), "array<struct<action:string,target:string>>")
        rules = [
            bad_body,
            ("pattern_type", ~F.coalesce(F.try_variant_get(v, "$.pattern_type", "string").isin(fixed.PATTERN_TYPES), F.lit(False))),
            ("action_plan", kind("$.action_plan").isNull() | typed("$.action_plan", "ARRAY")),
            ("action_plan.step", F.exists(steps, lambda s: s["action"].isNull() | s["target"].isNull())),
            ("matched_runbook", typed("$.matched_runbook", "STRING")),
            ("blast_radius_config", typed("$.blast_radius_config", "OBJECT")),
            ("verify_policy", typed("$.verify_policy", "OBJECT")),
            ("dry_run_mode", typed("$.dry_run_mode", "BOOLEAN")),
        ]
    else:
        rules = [
            bad_body,
            ("success", kind("$.success").isNull() | typed("$.success", "BOOLEAN")),
            ("regression_detected", typed("$.regression_detected", "BOOLEAN")),
            ("next_action", ~F.coalesce(F.try_variant_get(v, "$.next_action", "string").isin(fixed.NEXT_ACTIONS), F.lit(False))),
        ]
    return _first(rules)


def split_by(df: DataFrame, error: Column) -> tuple[DataFrame, DataFrame]:
    checked = df.withColumn("error", error)
    return checked.where("error IS NULL").drop("error"), checked.where("error IS NOT NULL")
