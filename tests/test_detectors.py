"""Properties of the detectors and of log templates."""
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from mendstream.operators import detectors as D, templates as TP, timeseries as TS
from mendstream.plans.detect import first_anomalies, trigger_metric

DDL = "tenant_id string, window_id long, t long, row int, n_rows int, series string, v double"


def window(step, n=150, start=135, seed=5, who=("pay",)):
    """150 seconds of four services; the last 15 seconds are raised for one of them."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        for s in ("cart", "pay", "ship", "mail"):
            up = step and s in who and i >= start
            rows += [("x", 0, i, i, n, f"{s}_cpu", 0.15 + rng.random() * 0.01 + (0.8 if up else 0)),
                     ("x", 0, i, i, n, f"{s}_service_error_rate", 0.5 if up else 0.0),
                     ("x", 0, i, i, n, f"{s}_service_latency_p95", 0.02 + rng.random() * 0.001 + (2.0 if up else 0))]
    return rows


def test_step_is_a_change_point(spark):
    df = TS.baseline_split(spark.createDataFrame(window(True), DDL))
    flags = D.bocpd_detect(df).where("is_anomaly").select("row").toPandas()["row"]
    assert ((flags >= 133) & (flags <= 149)).any(), list(flags)


@pytest.mark.parametrize("detect", [D.rrcf_detect, D.iforest_detect])
def test_lone_spike_scores_highest(spark, detect):
    df = TS.baseline_split(spark.createDataFrame(window(True, start=149, who=("cart", "pay", "ship", "mail")), DDL))
    out = detect(D.resource_series(df), k=3.0)
    assert out.orderBy(F.desc("score")).first().row == 149
    assert out.where("row = 149").first().is_anomaly


@pytest.mark.parametrize("name", ["bocpd", "rrcf", "iforest"])
def test_constant_is_never_flagged(spark, name):
    df = TS.baseline_split(spark.createDataFrame([("x", 0, i, i, 60, "a_cpu", 1.0) for i in range(60)], DDL))
    assert D.DETECTORS[name](df).where("is_anomaly").count() == 0


@pytest.mark.parametrize("v", [0.0, 0.1, 0.3, 123.456])
def test_constant_kpi_is_never_flagged(spark, v):
    df = TS.baseline_split(spark.createDataFrame([("x", 0, i, i, 300, "a_error", v) for i in range(300)], DDL))
    for rows in (300, None):
        assert D.ewma_detect(df, max_rows=rows, block_rows=64 if rows is None else None).where("is_anomaly").count() == 0


def test_results_do_not_depend_on_partitioning(spark):
    df = spark.createDataFrame(window(True), DDL)
    a = D.detect(TS.baseline_split(df.repartition(7)), "bocpd", max_rows=150).orderBy("row").collect()
    b = D.detect(TS.baseline_split(df.orderBy(F.rand(3)).coalesce(1)), "bocpd", max_rows=150).orderBy("row").collect()
    assert a == b


def test_detect_and_trigger(spark):
    pts = [(r[2], r[0], r[5].split("_")[0], r[5], r[6], i) for i, r in enumerate(window(True))]
    df = spark.createDataFrame(pts, "t long, tenant_id string, service string, signal_name string, value_num double, seq int")
    row = first_anomalies(df, 1, 3600).first()
    assert 120 <= row.anomaly_row <= 137 and 0.4 <= row.severity <= 0.95
    split = TS.baseline_split(spark.createDataFrame(window(True), DDL))
    at = spark.createDataFrame([("x", 0, 136)], "tenant_id string, window_id long, anomaly_row int")
    assert trigger_metric(split, at).first().trigger_metric.startswith("pay_")


def test_ten_thousand_point_window(spark):
    rows = [("x", 0, i, i, 10000, "pay_service_error_rate", 0.0 if i < 9990 else 0.9) for i in range(10000)]
    out = D.ewma_detect(TS.baseline_split(spark.createDataFrame(rows, DDL)))
    assert out.where("is_anomaly").agg(F.min("row")).first()[0] == 9990


def test_run_length_restarts_at_a_mean_shift():
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(0, 0.05, (80, 2)), rng.normal(1, 0.05, (40, 2))])
    flags = D.change_points(D.run_length_modes(x, 50))
    assert flags[78:90].any() and not flags[20:78].any()
    assert not D.change_points(D.run_length_modes(rng.normal(0, 1, (200, 1)), 1e6))[60:].any()


def logs(spark, rows):
    return spark.createDataFrame([(i, "x", 0, c, m, "info") for i, (c, m) in enumerate(rows)], "seq long, tenant_id string, t long, container_name string, message string, level string")


def test_templates_merge_and_stay_apart(spark):
    rows = [("cart", f"user {w} logged in from 10.0.0.{i}") for i, w in enumerate(["ann", "bob", "cid"])] + [("cart", "disk full"), ("pay", "user ann logged in from 10.0.0.9")]
    msgs, tpl = TP.mine_templates(logs(spark, rows))
    got = {(r.container_name, r.pattern): r.n for r in tpl.collect()}
    assert got == {("cart", "cart user <*> logged in from <IP>"): 3, ("cart", "cart disk full"): 1, ("pay", "pay user ann logged in from <IP>"): 1}
    assert msgs.count() == 5


def test_large_leaf_gives_the_same_templates(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    rows = [("hot", f"job {word()} done in time by worker") for _ in range(300)] + [("hot", f"lock lost on table {word()} again now") for _ in range(300)]
    one = {r.pattern: r.n for r in TP.mine_templates(logs(spark, rows))[1].collect()}
    many = {r.pattern: r.n for r in TP.mine_templates(logs(spark, rows).repartition(7))[1].collect()}
    assert one == many == {"hot job <*> done in time by worker": 300, "hot lock lost on table <*> again now": 300}
