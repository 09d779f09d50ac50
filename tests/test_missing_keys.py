"""Rows with missing keys, unlisted tenants, several profiles and non-finite points keep a defined result."""
import math

import numpy as np
import pytest

from mendstream import fixed
from mendstream.operators import audit as J, decide as H, detectors as D, states as S, timeseries as TS
from mendstream.operators.scans import forward_fill, running_sum, with_block
from mendstream.sources.profile import FLAT, catalog_runbooks, flat_runbooks
from pyspark.sql import functions as F

ALERT = "alert_id long, tenant_id string, namespace string, service string, t long"


def test_cooldown_accepts_alerts_without_a_key(spark):
    alerts = spark.createDataFrame([(1, "a", None, None, 0), (2, "a", None, None, 100), (3, "a", None, None, 301), (4, "a", "n", "s", 5)], ALERT)
    cool = spark.createDataFrame([("n", 60)], "namespace string, cooldown int")
    got = {r.alert_id: r.accepted for r in S.cooldown_dedup(alerts, cool, ["namespace", "service"], default=300).collect()}
    assert got == {1: True, 2: False, 3: True, 4: True}


def test_runs_of_a_missing_number(spark):
    alerts = spark.createDataFrame([(1, None, 0), (2, None, 5), (3, 7, 0), (4, None, 400)], "alert_id long, k long, t long").withColumn("namespace", F.lit("n"))
    cool = spark.createDataFrame([("n", 60)], "namespace string, cooldown int")
    got = {r.alert_id: r.accepted for r in S.cooldown_dedup(alerts, cool, ["k"]).collect()}
    assert got == {1: True, 2: False, 3: True, 4: True}


@pytest.mark.parametrize("closing", [False, True])
def test_incidents_keep_alerts_without_service_or_tenant(spark, closing):
    alerts = spark.createDataFrame([(1, "a", "n", None, 0), (2, "a", "n", None, 9), (3, None, "n", "s", 3), (4, None, "n", "w", 4)], ALERT)
    edges = spark.createDataFrame([("w", "s")], "service string, depends_on string")
    closes = spark.createDataFrame([("a", None, 5)], "tenant_id string, service string, t long") if closing else None
    got = {r.alert_id: r.role for r in S.correlate_incidents(alerts, edges, closes).collect()}
    assert got == {1: "root", 2: "root" if closing else "duplicate", 3: "root", 4: "symptom"}


def test_unlisted_tenants_have_the_default_limit(spark):
    rows = [(i, tenant, 0) for tenant in ("a", "b", None) for i in range({"a": 0, "b": 10}.get(tenant, 20), {"a": 5, "b": 15}.get(tenant, 25))]
    tiers = spark.createDataFrame([("a", 4)], "tenant_id string, rate_limit int")
    got = S.tier_rate_limit(spark.createDataFrame(rows, "request_id long, tenant_id string, t long"), tiers, default=2).collect()
    assert len(got) == 15
    assert sorted(r.request_id for r in got if r.allowed) == [0, 1, 2, 3, 10, 11, 20, 21]


def test_scans_keep_missing_keys(spark):
    df = with_block(spark.createDataFrame([(None, 0, 1), (None, 100, None), ("k", 100, None)], "k string, t long, v long"), "t", 50)
    assert {(r.k, r.t): r.f for r in forward_fill(df, ["k"], "t", "v", "block", out="f").collect()} == {(None, 0): 1, (None, 100): 1, ("k", 100): None}
    assert {(r.k, r.t): r.s for r in running_sum(df, ["k"], ["t"], F.lit(1), "block", "s").collect()} == {(None, 0): 1, (None, 100): 2, ("k", 100): 1}


def test_runbooks_by_profile(spark):
    one = catalog_runbooks(spark, only_default=True)
    books = one.withColumn("profile_name", F.lit("p")).unionByName(one.withColumn("profile_name", F.lit("q")).withColumn("name", F.lit("Own")))
    mapping = spark.createDataFrame([("p", "cpu", "Gone"), ("q", "cpu", "Own")], "profile_name string, fault string, runbook string")
    rows = [(1, "p", "cpu"), (2, "q", "cpu"), (3, "q", "odd"), (4, "q", None), (5, None, "cpu")]
    ctx = spark.createDataFrame(rows, "id int, profile_name string, suspected_fault_type string")
    got = H.match_runbook(ctx, mapping, books).collect()
    d = fixed.DEFAULT_RUNBOOK
    assert {r.id: r.matched_runbook for r in got} == {1: d, 2: "Own", 3: d, 4: d, 5: d} and len(got) == 5
    assert all(r.book is not None for r in got)
    with pytest.raises(ValueError):
        H.match_runbook(ctx.drop("profile_name"), mapping, books)
    nested = books.select("profile_name", "name", "pattern_type", "action_plan", F.struct("max_pod_impact_pct", "circuit_breaker_error_rate", "allowed_namespaces").alias("blast_radius_config"),
                          F.struct("window_seconds", "success_conditions").alias("verify_policy"))
    assert flat_runbooks(nested).columns == ["profile_name", *FLAT]


def test_book_without_namespaces_takes_the_default_list(spark):
    books = catalog_runbooks(spark, only_default=True).withColumn("allowed_namespaces", F.lit(None).cast("array<string>"))
    ctx = spark.createDataFrame([("cpu", "svc", "mine")], "suspected_fault_type string, target_service string, namespace string")
    plan = H.render_plan(H.match_runbook(ctx, spark.createDataFrame([], "fault string, runbook string"), books)).first()
    assert plan.blast_radius_config.allowed_namespaces == [*[n[0] for n in fixed.NAMESPACES], "mine"]


def test_rollout_counts_calls_without_status_or_limit(spark):
    calls = spark.createDataFrame([(0, "/a", 200, 1.0), (0, "/a", None, 1.0), (0, "/a", None, 1.0), (0, "/b", 200, 1.0)], "t long, endpoint string, status_code int, latency_ms double")
    got = {r.endpoint: (round(r.share_5xx, 3), r.abort) for r in J.rollout_gate(calls, spark.createDataFrame([("/a", 5)], "endpoint string, p99_limit_ms int")).collect()}
    assert got == {"/a": (0.667, True), "/b": (0.0, False)}


def plain_modes(x, hazard):
    """Run lengths straight from the definition, each scale matrix inverted anew."""
    n, d = x.shape
    log_r, modes = np.zeros(1), []
    for t in range(n):
        modes.append(int(np.argmax(log_r)))
        grown = []
        for r, lr in enumerate(log_r):
            mu, psi, kappa, nu = np.zeros(d), np.eye(d), 1.0, d + 1.0
            for v in x[t - r : t]:
                psi = psi + kappa / (kappa + 1) * np.outer(v - mu, v - mu)
                mu, kappa, nu = (kappa * mu + v) / (kappa + 1), kappa + 1, nu + 1
            dof = nu - d + 1
            shape = psi * (kappa + 1) / (kappa * dof)
            dist = (x[t] - mu) @ np.linalg.inv(shape) @ (x[t] - mu)
            grown.append(lr + math.lgamma((dof + d) / 2) - math.lgamma(dof / 2) - d / 2 * math.log(dof * math.pi) - 0.5 * math.log(np.linalg.det(shape)) - (dof + d) / 2 * math.log1p(dist / dof))
        log_r = np.array([np.logaddexp.reduce(grown) - math.log(hazard), *(g + math.log1p(-1 / hazard) for g in grown)])
        log_r -= np.logaddexp.reduce(log_r)
    return modes


def test_run_lengths_equal_the_definition():
    x = np.random.default_rng(3).random((70, 3)) * 0.1
    x[40:] += 0.7
    assert D.run_length_modes(x, 50).tolist() == plain_modes(x, 50)


def test_long_runs_are_kept():
    x = np.random.default_rng(4).random((900, 1)) * 0.1
    assert D.run_length_modes(x, 50).max() > 600


def test_non_finite_points_do_not_flag_a_window(spark):
    rows = [("x", 0, i, i, 300, "a_cpu", float("inf") if i == 20 else float("nan") if i == 40 else 0.1 + (i % 7) * 0.001) for i in range(300)]
    df = TS.baseline_split(TS.clean_non_finite(spark.createDataFrame(rows, "tenant_id string, window_id long, t long, row int, n_rows int, series string, v double")))
    flagged = D.bocpd_detect(df).where("is_anomaly").count()
    assert flagged < 30
