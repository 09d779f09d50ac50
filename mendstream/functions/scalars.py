"""Column -> Column functions: names, units, labels and text of the healing loop."""
from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from mendstream import fixed


def lookup(key: Column, table: dict[str, str], default: Column | None = None) -> Column:
    """Small constant mapping as one map literal."""
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    hit = F.create_map(*pairs)[key]
    return hit if default is None else F.coalesce(hit, default)


def pod_service_name(labels: Column, pod: Column, keys: list[str] = fixed.SERVICE_LABEL_KEYS) -> Column:
    """First non-empty label of the ordered list, else the pod name without its random suffix."""
    found = [F.when(labels[k] != "", labels[k]) for k in keys]
    return F.coalesce(*found, F.regexp_replace(pod, fixed.POD_SUFFIX, ""))


def series_name(service: Column, signal: Column, services: list[str],
                shared: tuple[str, ...] = ("redis", "frontend")) -> Column:
    """The signal itself if it already starts with a service name, else ``service_signal``."""
    starts = [signal.startswith(s) for s in services if s not in shared]
    return F.when(reduce(lambda a, b: a | b, starts, F.lit(False)), signal).otherwise(F.concat_ws("_", service, signal))


def _any_of(tokens: list[str]) -> str:
    return "|".join(re.escape(t) for t in tokens)


def fault_groups(text: Column, families: dict[str, list[str]] = fixed.FAULT_TOKENS) -> Column:
    """All families with a token inside the text, in family order."""
    low = F.lower(text)
    return F.array_compact(F.array(*[F.when(low.rlike(_any_of(tokens)), F.lit(name)) for name, tokens in families.items()]))


def _prefix(services: list[str]) -> str:
    """A known service, the longest first, that ends at an underscore or at the end of the text."""
    known = _any_of(sorted((s.lower() for s in services), key=len, reverse=True))
    return f"(?:{known})(?=_|$)" if services else "(?!)"


def series_service(series: Column, services: list[str]) -> Column:
    """Longest known service that prefixes the series, else the text before the first underscore."""
    if not services:
        return F.substring_index(series, "_", 1)
    found = F.regexp_extract(F.lower(series), f"^({_prefix(services)})", 1)
    return lookup(found, {s.lower(): s for s in services}, F.substring_index(series, "_", 1))


def series_suffix(series: Column, service: Column) -> Column:
    low, svc = F.lower(series), F.lower(service)
    return F.when(low.startswith(F.concat(svc, F.lit("_"))), low.substr(F.length(svc) + 2, F.length(low))).otherwise(low)


def series_fault(series: Column, services: list[str], families: dict[str, list[str]] = fixed.FAULT_TOKENS) -> Column:
    """First matching family of the part after the service; cpu when there is none."""
    rest = F.regexp_replace(F.lower(series), f"^(?:{_prefix(services)}|[^_]*)_?", "")
    hits = [F.when(rest.rlike(_any_of(tokens)), F.lit(name)) for name, tokens in families.items()]
    return F.coalesce(*hits, F.lit("cpu"))


def is_kpi(series: Column) -> Column:
    low = F.lower(series)
    return low.contains("latency") | low.contains("error")


def is_resource(series: Column) -> Column:
    return ~is_kpi(series) & ~series.contains("queue-master") & ~series.contains("rabbitmq_")


def fault_suffix(service_fault: Column) -> Column:
    return F.substring_index(service_fault, "_", -1)


def contract_signal(fault: Column) -> Column:
    return lookup(fault, fixed.FAULT_CONTRACT_SIGNAL, F.lit("service_error_rate"))


def contract_value(fault: Column, raw: Column) -> Column:
    """Raw dataset value in contract units: bytes, milliseconds or a share in [0, 1]."""
    return (
        F.when(fault.isin("cpu", "mem", "disk"), F.greatest(raw, F.lit(1.0)) * 1024 * 1024)
        .when(fault == "delay", F.greatest(raw, F.lit(1.0)) * 1000.0)
        .when(fault.isin("loss", "socket"), F.greatest(F.lit(0.0), F.least(raw, F.lit(1.0))))
        .otherwise(raw)
    )


def alert_signal(alertname: Column) -> Column:
    return lookup(alertname, fixed.ALERT_SIGNAL, F.lit(fixed.DEFAULT_ALERT_SIGNAL))


def alert_labels(namespace: Column, service: Column, alertname: Column, pod: Column, container: Column,
                 system: Column | None = None) -> Column:
    """Point labels of an alert; ``system`` defaults to the namespace in capitals without its prefix."""
    system = system if system is not None else F.upper(F.regexp_replace(namespace, "^tenant-", ""))
    return F.create_map(
        F.lit("system"), system, F.lit("namespace"), namespace, F.lit("deployment"), service,
        F.lit("alertname"), alertname,
        F.lit("pod_name"), F.coalesce(pod, F.concat(service, F.lit("-pod"))),
        F.lit("container"), F.coalesce(container, F.lit("main")),
    )


def lock_key(tenant: Column, namespace: Column, service: Column, alertname: Column) -> Column:
    return F.sha2(F.concat_ws("#", tenant, namespace, service, alertname), 256)


def memory_mb(quantity: Column) -> Column:
    """Kubernetes memory quantity in MB; null for other units."""
    q = F.trim(quantity)
    num = F.regexp_extract(q, r"^([0-9]+(?:\.[0-9]+)?)(?:Gi|Mi|Ki|G|M)$", 1)
    whole = F.regexp_extract(q, r"^([0-9]+)(?:Mi|Ki|M)$", 1)
    d, i = num.try_cast("double"), whole.try_cast("long")
    return (
        F.when(q.endswith("Gi"), F.floor(d * 1024))
        .when(q.endswith("Mi"), i)
        .when(q.endswith("Ki"), F.when(i.isNotNull(), F.greatest(F.lit(1), F.floor(i / 1024))))
        .when(q.endswith("G"), F.floor(d * 1000))
        .when(q.endswith("M"), i)
        .cast("long")
    )


def mask_log(text: Column) -> Column:
    return reduce(lambda c, rule: F.regexp_replace(c, rule[0], rule[1]), fixed.LOG_MASKS, text)


def is_error_log(pattern: Column, level: Column) -> Column:
    return pattern.rlike("(?i)" + fixed.LOG_ERROR_KEYWORDS) | F.lower(F.coalesce(level, F.lit(""))).isin(fixed.LOG_ERROR_LEVELS)


def render_deployment(service: Column, template: str = fixed.TARGET_TEMPLATE) -> Column:
    return F.replace(F.lit(template), F.lit("{{target_service}}"), service)


def render_target(template: Column, service: Column, deployment: Column) -> Column:
    """Fill the target; anything that is not a deployment becomes the deployment."""
    filled = F.replace(F.coalesce(template, deployment), F.lit("{{target_service}}"), service)
    return F.when(filled.startswith("deployment/"), filled).otherwise(deployment)


def clip_reason(text: Column, limit: int = 300) -> Column:
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, limit - 3), F.lit("..."))).otherwise(text)


def correlated_reason(text: Column, correlated: Column) -> Column:
    return F.when(correlated, clip_reason(F.concat(F.lit("[CORRELATED ALERT] "), text))).otherwise(text)


def extract_json(text: Column) -> Column:
    """The JSON object inside fenced or noisy text; null if there is none."""
    clean = F.trim(text)
    fenced = F.trim(F.substring_index(F.regexp_replace(clean, r"^```(json)?", ""), "```", 1))
    clean = F.when(clean.startswith("```"), fenced).otherwise(clean)
    found = F.regexp_extract(clean, r"(?s)(\{.*\})", 1)
    return F.when(clean.startswith("{") & clean.endswith("}"), clean).otherwise(F.nullif(found, F.lit("")))


def reported_status(status: Column) -> Column:
    return F.when(status == "DRY_RUN", "COMPLETED").otherwise(status)


def reported_seconds(seconds: Column) -> Column:
    """Whole seconds, halves to even."""
    return F.bround(seconds, 0).cast("long")


def pod_to_workload(pod: Column) -> Column:
    return F.regexp_extract(pod, fixed.WORKLOAD_PATTERN, 1)


def call_outcome(status_code: Column, attempt: Column, retry_after: Column | None = None) -> Column:
    """Error class, whether to try again, and the wait in seconds, for the 0-based ``attempt``.

    A null status is a connection error and is handled as 500.
    """
    code = F.coalesce(status_code, F.lit(500))
    retry = (code == 500) & (attempt < len(fixed.RETRY_WAITS))
    name = (
        F.when(code == 200, "ok").when(code == 400, "bad_request").when(code == 403, "tenant_mismatch")
        .when(code == 409, "idempotency_conflict").when(code == 429, "rate_limited").when(code == 503, "unavailable")
        .when(code == 500, "server_error").otherwise("unexpected")
    )
    after = F.coalesce(retry_after.try_cast("int") if retry_after is not None else F.lit(None).cast("int"), F.lit(fixed.RATE_LIMIT_WAIT))
    wait = F.when(code == 429, after).when(retry, F.element_at(F.array(*[F.lit(w) for w in fixed.RETRY_WAITS]), attempt + 1))
    return F.struct(name.alias("outcome"), retry.alias("retry"), wait.cast("int").alias("wait_seconds"))


def action_patch(action: Column, params: Column, container: Column, restarted_at: Column,
                 restart_annotation: str = "self-heal/restart-at") -> Column:
    """Patch document as JSON text, or the reason why there is none.

    Memory patches set limits only; a requested memory reservation is left out on purpose.
    """
    limit = params["memory_limit_mb"].try_cast("long")
    memory = F.to_json(F.struct(F.struct(F.struct(F.struct(F.array(F.struct(
        container.alias("name"),
        F.struct(F.struct(F.concat(limit.cast("string"), F.lit("Mi")).alias("memory")).alias("limits")).alias("resources"),
    )).alias("containers")).alias("spec")).alias("template")).alias("spec")))
    replicas = params["replicas"].try_cast("int")
    scale = F.to_json(F.struct(F.struct(replicas.alias("replicas")).alias("spec")))
    restart = F.to_json(F.struct(F.struct(F.struct(F.struct(F.create_map(
        F.lit(restart_annotation), restarted_at.cast("string")
    ).alias("annotations")).alias("metadata")).alias("template")).alias("spec")))
    patch = (
        F.when((action == "PATCH_MEMORY_LIMIT") & (F.coalesce(limit, F.lit(0)) != 0), memory)
        .when((action == "SCALE_REPLICAS") & replicas.isNotNull(), scale)
        .when(action == "RESTART_DEPLOYMENT", restart)
    )
    error = (
        F.when((action == "PATCH_MEMORY_LIMIT") & (F.coalesce(limit, F.lit(0)) == 0), "memory_limit_mb is missing")
        .when((action == "SCALE_REPLICAS") & replicas.isNull(), "replicas is missing")
        .when(~action.isin("PATCH_MEMORY_LIMIT", "SCALE_REPLICAS", "RESTART_DEPLOYMENT"), F.concat(F.lit("unsupported action: "), action))
    )
    return F.struct(patch.alias("patch"), error.alias("error"))


def dims_from_config(df: DataFrame, kind: str, col: str = "config") -> DataFrame:
    """Configuration text as dimension rows: ``floats`` k:v,..  ``patterns`` k:a|b;..  ``list`` a,b,.."""
    text = F.col(col)
    if kind == "list":
        return df.select(*[c for c in df.columns if c != col], F.posexplode(F.split(text, ",")).alias("ord", "item")) \
            .withColumn("item", F.trim("item")).where("item <> ''")
    sep = "," if kind == "floats" else ";"
    rows = df.select(*[c for c in df.columns if c != col], F.posexplode(F.split(text, sep)).alias("ord", "item")) \
        .where(F.col("item").contains(":"))
    key = F.trim(F.substring_index("item", ":", 1))
    rest = F.expr("substring(item, locate(':', item) + 1)")
    if kind == "floats":
        return rows.select("*", key.alias("key"), F.trim(rest).try_cast("double").alias("value")).drop("item").where("value IS NOT NULL")
    tokens = F.filter(F.transform(F.split(rest, r"\|"), lambda x: F.lower(F.trim(x))), lambda x: x != "")
    return rows.select("*", key.alias("key"), tokens.alias("tokens")).drop("item").where(F.size("tokens") > 0)
