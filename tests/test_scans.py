"""Blocked scans against plain loops, with hot keys and block borders."""
import random

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from mendstream.operators import scans, states as S, timeseries as TS
from mendstream.operators.detectors import ewma


def greedy(ts, gap):
    out, last = [], None
    for t in sorted(set(ts)):
        if last is None or t >= last + gap:
            out.append(t)
            last = t
    return out


@given(st.lists(st.integers(0, 500), min_size=1, max_size=120), st.integers(1, 20), st.integers(20, 60))
@settings(max_examples=200, deadline=None)
def test_block_transfer_is_greedy(ts, gap, width):
    """Chaining the block tables gives the last accepted item of the plain loop."""
    allowed, last = 0, None
    for b in sorted({t // width for t in ts}):
        items = sorted({t for t in ts if t // width == b})
        allowed = max(allowed, b * width)
        for e, l in zip(*scans._block_transfer(items, gap, b * width)):
            if e >= allowed:
                last, allowed = l, l + gap
                break
    assert last == greedy(ts, gap)[-1]


def test_greedy_spacing_hot_key(spark):
    rng = random.Random(1)
    rows = [("hot", t) for t in sorted(rng.sample(range(30000), 6000))] + [(f"k{i}", rng.randrange(30000)) for i in range(500)]
    rows = sorted(set(rows))
    df = spark.createDataFrame(rows, "key string, t long").withColumn("g", F.lit(37))
    got = {}
    for r in scans.greedy_spacing(df, ["key"], "t", "g", block_seconds=1000).collect():
        got.setdefault(r.key, []).append(r.t)
    for k in {r[0] for r in rows}:
        assert sorted(got[k]) == greedy([t for kk, t in rows if kk == k], 37), k


def test_forward_fill_and_running_sum(spark):
    rng = random.Random(2)
    rows = [("a" if rng.random() < 0.7 else "b", t, rng.random() if rng.random() < 0.3 else None) for t in range(400)]
    df = scans.with_block(spark.createDataFrame(rows, "key string, t long, v double"), "t", 50)
    filled = scans.forward_fill(df, ["key"], "t", "v", "block", out="f")
    summed = scans.running_sum(filled, ["key"], ["t"], F.coalesce("v", F.lit(0.0)), "block", "s", exclusive=True).toPandas()
    for _, g in summed.sort_values("t").groupby("key"):
        pd.testing.assert_series_equal(g["v"].ffill(), g["f"], check_names=False)
        assert (g["v"].fillna(0).cumsum().shift(fill_value=0) - g["s"]).abs().max() < 1e-9


def test_rolling_range_sees_over_block_borders(spark):
    rows = [("a", t) for t in range(0, 500, 7)]
    df = spark.createDataFrame(rows, "key string, t long")
    got = {r.t: r.n for r in TS.rolling_range(df, ["key"], 100, {"n": F.count("*")}, block=60).collect()}
    assert got == {t: sum(1 for _, u in rows if t - 100 < u <= t) for _, t in rows}


def test_rolling_range_equals_plain_loop_without_sliding_frames(spark):
    """Sum, maximum and first value, before 1970 too and with rows of one second; no frame slides, as it would be walked again for every row."""
    rng = random.Random(5)
    rows = [(rng.choice(["a", "b", None]), rng.randrange(-300, 900), rng.choice([None, 1, 2, 3, 4])) for _ in range(700)]
    df = spark.createDataFrame(rows, "key string, t long, v long")
    for seconds in (1, 7, 100, 5000):
        d = TS.rolling_range(df, ["key"], seconds, {"s": F.sum("v"), "n": F.count("*"), "m": (F.max("v"), F.greatest), "f": (F.min("t"), lambda a, b: a)})
        got = sorted(map(str, map(tuple, d.collect())))
        want = []
        for k, t, v in rows:
            near = [(u, x) for j, u, x in rows if j == k and t - seconds < u <= t]
            known = [x for _, x in near if x is not None]
            want.append(str((k, t, v, sum(known) if known else None, len(near), max(known, default=None), min(u for u, _ in near))))
        assert got == sorted(want), seconds
    frames = d._jdf.queryExecution().optimizedPlan().toString()
    assert "unboundedpreceding$(), currentrow$()" in frames and frames.count("specifiedwindowframe") == frames.count("unboundedpreceding$(), currentrow$()")


@pytest.mark.parametrize("alpha,block", [(0.1, 64), (0.5, 16), (0.1, None)])
def test_ewma_matches_pandas(spark, alpha, block):
    rng = random.Random(3)
    x = [rng.gauss(10, 3) for _ in range(10000)]
    df = spark.createDataFrame([("t", 0, "s", i, float(v)) for i, v in enumerate(x)], "tenant_id string, window_id long, series string, row int, v double")
    got = ewma(df, alpha, block_rows=block).orderBy("row").toPandas()["ewma"]
    want = pd.Series(x).ewm(alpha=alpha, adjust=False).mean()
    assert (got - want).abs().max() < 1e-9


EDGES = [("a", "b"), ("a", "c"), ("b", "c"), ("d", "a")]


def fold(events):
    """The rule as a plain loop: (t, kind, id, service) in order."""
    needs = {}
    for s, d in EDGES:
        needs.setdefault(s, set()).add(d)
    active, out = {}, {}
    for t, kind, i, s in sorted(events):
        if kind == 0:
            active.pop(s, None)
            continue
        if s in active:
            role, root = "duplicate", s
        else:
            root = next((r for r in active if r in needs.get(s, ())), None)
            role = "symptom" if root else "root"
            if root is None:
                root = s
                active[s] = t
        out[i] = (role, root, active[root])
    return out


@given(st.lists(st.tuples(st.integers(0, 40), st.sampled_from([0, 1, 1, 1]), st.sampled_from("abcd")), min_size=1, max_size=60))
@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_incidents_equal_the_fold(spark, items):
    events = [(t * 600, kind, i, s) for i, (t, kind, s) in enumerate(items)]
    al = spark.createDataFrame([(i, "x", t, s) for t, k, i, s in events if k == 1], "alert_id long, tenant_id string, t long, service string")
    cl = spark.createDataFrame([("x", s, t) for t, k, _, s in events if k == 0], "tenant_id string, service string, t long")
    ed = spark.createDataFrame(EDGES, "service string, depends_on string")
    got = {r.alert_id: (r.role, r.root_service, r.start_time) for r in S.correlate_incidents(al, ed, cl).collect()}
    assert got == fold(events)


def test_incident_table_closes(spark):
    al = spark.createDataFrame([(1, "x", 10, "c"), (2, "x", 20, "b"), (3, "x", 40, "c")], "alert_id long, tenant_id string, t long, service string")
    cl = spark.createDataFrame([("x", "c", 30)], "tenant_id string, service string, t long")
    ed = spark.createDataFrame(EDGES, "service string, depends_on string")
    rows = {r.start_time: r for r in S.incident_table(S.correlate_incidents(al, ed, cl), cl).collect()}
    assert rows[10].closed_at == 30 and rows[10].symptoms == ["b"] and rows[10].status == "resolved"
    assert rows[40].closed_at is None and rows[40].status == "active"
