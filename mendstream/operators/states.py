"""Stateful rules as batch operators: cooldown, incidents, breaker, cost, rate limits.

The streaming forms of the first two are in ``mendstream.streaming.stateful``.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from mendstream import fixed
from mendstream.operators.graph import service_parts
from mendstream.operators.scans import fold_sorted, forward_fill, greedy_spacing, join_same, running_sum, with_block
from mendstream.operators.timeseries import WIN, rolling_range
from mendstream.session import bounded, reuse


def cooldown_dedup(alerts: DataFrame, cooldowns: DataFrame, key: list[str], by: str = "namespace",
                   default: int = fixed.DEFAULT_COOLDOWN) -> DataFrame:
    """Adds ``accepted``: the first alert of the key, then each first one later than the last accepted
    alert by more than the cooldown. Rejected alerts do not extend it.

    Alerts are reduced to the first one per (key, second) before the fold, so a key has at most
    one row per second whatever its volume. Alerts that miss a part of the key share the key with a null there.
    """
    dim = bounded(cooldowns.select(by, F.col("cooldown").cast("long")))
    d = alerts.join(dim, by, "left").withColumn("_gap", F.coalesce("cooldown", F.lit(default)) + 1).drop("cooldown")
    firsts = reuse(d.groupBy(*key, "t").agg(F.min("alert_id").alias("alert_id"), F.max("_gap").alias("_g")))
    taken = greedy_spacing(firsts.select(*key, "t", "_g"), key, "t", "_g")
    hit = join_same(firsts.drop("_g"), taken, [*key, "t"]).withColumn("accepted", F.lit(True))
    return join_same(d.drop("_gap"), hit, [*key, "t", "alert_id"], "left").withColumn("accepted", F.coalesce("accepted", F.lit(False)))


def detection_candidates(flags: DataFrame, start: DataFrame, gap: int = 5, limit: int = 8) -> DataFrame:
    """Flagged rows at least ``gap`` rows after the last accepted one, the first ``limit`` of a window."""
    rows = (
        flags.join(start, WIN).where(F.col("is_anomaly") & (F.col("row") >= F.col("search_start")))
        .select(*WIN, F.col("row").cast("long").alias("row"), F.lit(gap).alias("_g")).distinct()
    )
    ok = greedy_spacing(rows, WIN, "row", "_g", block_seconds=4096)
    n = F.row_number().over(W.partitionBy(*WIN).orderBy("row"))
    return ok.withColumn("candidate", n).where(F.col("candidate") <= limit)


# -- incidents ---------------------------------------------------------------------------------


def correlate_incidents(alerts: DataFrame, edges: DataFrame, closes: DataFrame | None = None,
                        block: int = 3600) -> DataFrame:
    """Role of every alert (``root``, ``duplicate``, ``symptom``) and its incident, per tenant.

    In time order: an alert on the root of an active incident is a duplicate; else, if its service
    depends on an active root, a symptom (the oldest such incident); else it opens one. A close event
    (``tenant_id, service, t``) resolves the active incident of that root.

    Services of different connected parts of the dependency graph never meet, so every (tenant, part) is a history of its own.
    Between two closes of a part its active set only grows, so every alert of a service after its
    first one repeats the first one's fate. Only the first alert per (tenant, part, close count, service)
    and the closes go through the ordered fold; all other alerts are labelled by a join.
    """
    key = ["tenant_id", "service", "t"]
    own = ["tenant_id", "part"]
    dim = bounded(reuse(service_parts(edges)))
    # a service without edges is a part of its own
    placed = lambda d: d.join(dim, "service", "left").withColumn("part", F.coalesce("part", "service"))
    secs = placed(alerts.groupBy(*key).agg(F.min("alert_id").alias("first_id"))).drop("depends")
    if closes is None:
        secs = secs.withColumn("epoch", F.lit(-1).cast("long"))
        closed = None
    else:
        closed = placed(closes.select(*key).distinct()).drop("depends")
        marks = closed.groupBy(*own, "t").agg(F.lit(None).cast("string").alias("service")).withColumn("_c", F.col("t"))
        # the epoch of an alert is the time of the last close at or before it
        both = secs.withColumn("_c", F.lit(None).cast("long")).withColumn("_o", F.col("t") * 2 + 1).unionByName(
            marks.withColumn("_o", F.col("t") * 2), allowMissingColumns=True)
        both = forward_fill(with_block(both, "t", block), own, "_o", "_c", "block", out="epoch")
        secs = both.where("first_id IS NOT NULL").select(*key, "part", "first_id", F.coalesce("epoch", F.lit(-1)).alias("epoch"))
    secs = reuse(secs)
    firsts = secs.groupBy(*own, "epoch", "service").agg(F.min(F.struct("t", "first_id")).alias("f"))
    firsts = firsts.select(*own, "epoch", "service", F.col("f.t").alias("t"), F.col("f.first_id").alias("first_id"))
    steps = firsts.withColumn("kind", F.lit(1))
    if closed is not None:
        steps = steps.unionByName(closed.withColumn("kind", F.lit(0)), allowMissingColumns=True)
    steps = steps.join(dim.drop("part"), "service", "left").select(
        *own, "t", "kind", F.coalesce("first_id", F.lit(-1)).alias("first_id"), F.coalesce("epoch", F.lit(-1)).alias("epoch"),
        "service", F.concat_ws(",", "depends").alias("depends"))

    def step(active: dict[str, int], r):
        if r.kind == 0:
            active.pop(r.service, None)
            return None
        if r.service in active:
            role, root = "duplicate", r.service
        else:
            needs = set(r.depends.split(","))
            root = next((s for s in active if s in needs), None)
            role = "symptom" if root else "root"
            if root is None:
                root = r.service
                active[root] = r.t
        return (r.tenant_id, r.epoch, r.service, role, root, active[root], r.first_id)

    fate = fold_sorted(steps, own, ["t", "kind", "first_id"], step, dict,
                       "tenant_id string, epoch long, service string, role0 string, root_service string, start_time long, opened_by long")
    labelled = join_same(secs.select(*key, "epoch"), fate, ["tenant_id", "epoch", "service"]).drop("epoch")
    role = F.when((F.col("role0") == "root") & (F.col("alert_id") != F.col("opened_by")), "duplicate").otherwise(F.col("role0"))
    return (
        join_same(alerts, labelled, key)
        .withColumn("role", role)
        .withColumn("incident_id", incident_id("tenant_id", "root_service", "start_time"))
        .drop("role0", "opened_by")
    )


def incident_id(*cols: str) -> Column:
    return F.substring(F.sha2(F.concat_ws("#", *cols), 256), 1, 32)


def incident_table(labelled: DataFrame, closes: DataFrame | None = None) -> DataFrame:
    """One row per incident with its symptoms; ``closed_at`` is the first close of its root after the start."""
    inc = labelled.groupBy("tenant_id", "incident_id", "root_service", "start_time").agg(
        F.array_sort(F.collect_set(F.when(F.col("role") == "symptom", F.col("service")))).alias("symptoms"),
        F.count_if(F.col("role") == "duplicate").alias("duplicates"),
    )
    if closes is None:
        return inc.withColumn("closed_at", F.lit(None).cast("long")).withColumn("status", F.lit("active"))
    # a root has one active incident at a time: its next close is the next event in time order
    ev = inc.select("tenant_id", F.col("root_service").alias("service"), F.col("start_time").alias("t"), F.lit(None).cast("long").alias("c")).unionByName(
        closes.select("tenant_id", "service", "t", F.col("t").alias("c")))
    ev = ev.withColumn("_o", -(F.col("t") * 2 + F.when(F.col("c").isNull(), 1).otherwise(0))).withColumn("_neg", -F.col("t")).distinct()
    ev = forward_fill(with_block(ev, "_neg", 86400), ["tenant_id", "service"], "_o", "c", "block", out="closed_at")
    ends = ev.where("c IS NULL").select("tenant_id", F.col("service").alias("root_service"), F.col("t").alias("start_time"), "closed_at")
    return join_same(inc, ends, ["tenant_id", "root_service", "start_time"], "left").withColumn(
        "status", F.when(F.col("closed_at").isNull(), "active").otherwise("resolved"))


def decide_once(requests: DataFrame, incidents: DataFrame) -> DataFrame:
    """First decide for the root passes; later ones and other services are suppressed with the reason.

    ``requests``: ``request_id, incident_id, service, t``; ``incidents``: ``incident_id, root_service``.
    """
    d = requests.join(incidents.select("incident_id", "root_service"), "incident_id", "left")
    root = F.col("service") == F.col("root_service")
    first = (
        d.where(root).groupBy("incident_id").agg(F.min(F.struct("t", "request_id")).alias("_f"))
        .select("incident_id", F.col("_f.request_id").alias("_first"))
    )
    reason = (
        F.when(F.col("root_service").isNull(), F.lit(None))
        .when(~root, F.format_string(fixed.SYMPTOM_SUPPRESSED, "root_service"))
        .when(F.col("request_id") != F.col("_first"), fixed.DUPLICATE_SUPPRESSED)
    )
    d = d.join(first, "incident_id", "left").withColumn("suppression_reason", reason).drop("_first")
    off = F.col("suppression_reason").isNotNull()
    return (
        d.withColumn("suppressed", off)
        .withColumn("matched_runbook", F.when(off, fixed.SUPPRESSED_RUNBOOK))
        .withColumn("verify_window_seconds", F.when(off, fixed.SUPPRESSED_VERIFY_SECONDS))
    )


# -- breaker, cost, limits ------------------------------------------------------------------------

BREAKER_KEY = ["tenant_id", "namespace", "service"]


def breaker_openings(failures: DataFrame, limit: int = fixed.BREAKER_FAILURES, window: int = fixed.BREAKER_WINDOW) -> DataFrame:
    """Seconds at which a key has at least ``limit`` failures in the last ``window`` seconds, with the count."""
    per_second = failures.groupBy(*BREAKER_KEY, "t").agg(F.count("*").alias("n"))
    rolled = rolling_range(per_second, BREAKER_KEY, window, {"failure_count": F.sum("n")})
    return rolled.where(F.col("failure_count") >= limit).drop("n")


def circuit_breaker(failures: DataFrame, alerts: DataFrame, reset_after: int | None = None,
                    limit: int = fixed.BREAKER_FAILURES, window: int = fixed.BREAKER_WINDOW) -> DataFrame:
    """Adds ``breaker_open`` and ``opened_at``. Without ``reset_after`` an open breaker stays open."""
    opens = breaker_openings(failures, limit, window)
    if reset_after is None:
        first = opens.groupBy(*BREAKER_KEY).agg(F.min("t").alias("opened_at"))
        return join_same(alerts, first, BREAKER_KEY, "left").withColumn(
            "breaker_open", F.coalesce(F.col("opened_at") <= F.col("t"), F.lit(False)))
    marks = opens.select(*BREAKER_KEY, "t", F.lit(None).cast("long").alias("alert_id"), F.col("t").alias("_at"))
    both = alerts.withColumn("_at", F.lit(None).cast("long")).unionByName(marks, allowMissingColumns=True)
    # an opening in the same second counts for the alerts of that second
    both = both.withColumn("_o", F.struct("t", F.col("_at").isNull().alias("a"), "alert_id"))
    both = forward_fill(with_block(both, "t", 86400), BREAKER_KEY, "_o", "_at", "block", out="opened_at")
    return both.where("_at IS NULL").drop("_at", "_o", "block").withColumn(
        "breaker_open", F.coalesce(F.col("t") - F.col("opened_at") < reset_after, F.lit(False)))


def call_cost(provider: Column, input_tokens: Column, output_tokens: Column) -> Column:
    cost = F.lit(None).cast("double")
    for name, rate_in, rate_out in fixed.PROVIDER_RATES:
        cost = F.when(provider == name, input_tokens * rate_in / 1e6 + output_tokens * rate_out / 1e6).otherwise(cost)
    return cost


def daily_cost_cap(calls: DataFrame, cap: float = fixed.DAILY_COST_CAP, block: int = 900) -> DataFrame:
    """Running cost per tenant and UTC day; a call is capped if the cost before it reached the cap."""
    d = calls.withColumn("day", F.expr("t div 86400"))
    d = with_block(d, "t", block)
    d = running_sum(d, ["tenant_id", "day"], ["t", "call_id"], F.col("cost"), "block", "cost_before", exclusive=True)
    return d.withColumn("cost_cap_exceeded", F.col("cost_before") >= cap).drop("block")


def cost_alerts(calls: DataFrame, cap: float = fixed.DAILY_COST_CAP, warn: float = fixed.COST_WARN_SHARE) -> DataFrame:
    """First time a tenant-day passes the warning share and the cap."""
    d = daily_cost_cap(calls, cap).withColumn("after", F.col("cost_before") + F.col("cost"))
    return (
        d.groupBy("tenant_id", "day")
        .agg(F.min(F.when(F.col("after") >= cap * warn, F.col("t"))).alias("warned_at"),
             F.min(F.when(F.col("after") >= cap, F.col("t"))).alias("capped_at"))
        .where("warned_at IS NOT NULL")
    )


def idempotency_dedup(requests: DataFrame, stage: str = "decide") -> DataFrame:
    """``conflict`` marks every later use of an idempotency key of a tenant within the stage."""
    key = ["tenant_id", "idempotency_key"]
    firsts = requests.where(F.col("stage") == stage).groupBy(*key).agg(F.min(F.struct("t", "request_id")).alias("_f"))
    d = requests.join(firsts, key, "left")
    later = (F.col("stage") == stage) & (F.col("request_id") != F.col("_f.request_id"))
    return d.withColumn("conflict", F.coalesce(later, F.lit(False))).drop("_f")


def tier_rate_limit(requests: DataFrame, tiers: DataFrame, seconds: int = 60, default: int = fixed.TIER_LIMITS[-1][1]) -> DataFrame:
    """Adds ``allowed``: the first ``limit`` requests of the tenant's tier per window; unlisted tenants have the ``default`` limit.

    Per-second counts decide the border second of each window; only that second's
    requests are ranked, all others follow from the counts.
    """
    dim = bounded(tiers.select("tenant_id", "rate_limit"))
    d = requests.withColumn("slot", F.expr(f"t div {seconds}"))
    per = d.groupBy("tenant_id", "slot", "t").agg(F.count("*").alias("n"))
    before = W.partitionBy("tenant_id", "slot").orderBy("t").rowsBetween(W.unboundedPreceding, -1)
    per = per.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).join(dim, "tenant_id", "left")
    per = per.withColumn("rate_limit", F.coalesce("rate_limit", F.lit(default)))
    d = join_same(d, per, ["tenant_id", "slot", "t"])
    border = (F.col("before") < F.col("rate_limit")) & (F.col("before") + F.col("n") > F.col("rate_limit"))
    ranked = d.where(border).withColumn("_r", F.row_number().over(W.partitionBy("tenant_id", "slot", "t").orderBy("request_id")))
    inside = d.where(~border).withColumn("allowed", F.col("before") < F.col("rate_limit"))
    edge = ranked.withColumn("allowed", F.col("before") + F.col("_r") <= F.col("rate_limit")).drop("_r")
    return inside.unionByName(edge).drop("n", "before")


def malformed_rate(checked: DataFrame, seconds: int = 300, limit: float = 0.005) -> DataFrame:
    """Share of rejected points per tumbling window; needs ``t`` and the ``errors`` array."""
    return (
        checked.groupBy(F.expr(f"(t div {seconds}) * {seconds}").alias("window_start"))
        .agg(F.count("*").alias("n"), F.count_if(F.size("errors") > 0).alias("rejected"))
        .withColumn("share", F.col("rejected") / F.col("n"))
        .withColumn("alert", F.col("share") > limit)
    )


def telemetry_sla(points: DataFrame, limits: DataFrame) -> DataFrame:
    """Per tenant, signal and second: volume over the limit and points that arrived too late."""
    dim = F.broadcast(limits.select("signal_name", "max_delay", "max_per_second"))
    per = points.join(dim, "signal_name").groupBy("tenant_id", "signal_name", "t").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("received_t") - F.col("t") >= F.col("max_delay")).alias("late"),
        F.max("max_per_second").alias("max_per_second"),
    )
    return per.withColumn("over_volume", F.col("n") > F.col("max_per_second")).where("over_volume OR late > 0").drop("max_per_second")
