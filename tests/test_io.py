"""Readers and sinks on real files, and streams against the batch rule."""
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from mendstream.operators import audit as J, states as S
from mendstream.sources import profile as P, readers as R, sinks
from mendstream.streaming import stateful as ST


@pytest.fixture()
def runs(tmp_path):
    for service, fault, run in (("cart", "cpu", "1"), ("pay-api", "mem", "2")):
        d = tmp_path / f"{service}_{fault}" / run
        d.mkdir(parents=True)
        (d / "simple_metrics.csv").write_text(f"time,{service}_cpu,db_mem\n2,0.5,\n1,0.25,NaN\n3,x,7\n")
        (d / "metrics.csv").write_text("time\n")
        (d / "logs.csv").write_text('timestamp,container_name,message,level\n1700000000123456789,cart,"two, ""quoted""\nlines",error\n1700000001,cart,plain,info\n')
        if run == "1":
            (d / "inject_time.txt").write_text("1700000000\n")
    (tmp_path / "cart_cpu" / "latest").mkdir()
    (tmp_path / "cart_cpu" / "latest" / "logs.csv").write_text("x\n")
    return str(tmp_path)


def test_metric_and_log_runs(spark, runs):
    m = {(r.run_key, r.t, r.signal_name): (r.service, r.value_num) for r in R.read_metric_runs(spark, runs).collect()}
    assert m[("cart_cpu/1", 2, "cart_cpu")] == ("cart", 0.5) and m[("pay-api_mem/2", 3, "db_mem")] == ("db", 7.0)
    assert len(m) == 6
    lg = R.read_log_runs(spark, runs).where("run_key = 'cart_cpu/1'").orderBy("t").collect()
    assert [(r.t, r.value_str, r.labels["level"]) for r in lg] == [(1700000000, 'two, "quoted"\nlines', "error"), (1700000001, "plain", "info")]
    both = R.load_telemetry(spark, "benchmark_fixture", root=runs)
    assert both.count() == 6 + 4


def test_time_in_any_column_and_chosen_signals_in_one_scan(spark, tmp_path):
    d = tmp_path / "a_cpu" / "1"
    d.mkdir(parents=True)
    (d / "simple_metrics.csv").write_text("a_cpu, time ,a_mem\r\n0.5,7,1\r\n,8,2\r\n")
    df = R.read_metric_runs(spark, str(tmp_path))
    assert sorted((r.t, r.signal_name, r.value_num) for r in df.collect()) == [(7, "a_cpu", 0.5), (7, "a_mem", 1.0), (8, "a_mem", 2.0)]
    assert df._jdf.queryExecution().executedPlan().toString().count("Scan text") == 1
    assert [r.value_num for r in R.read_metric_runs(spark, str(tmp_path), signals=["a_cpu"]).collect()] == [0.5]


@pytest.mark.parametrize("files", [100, 0])
def test_metric_file_is_read_by_many_tasks(spark, tmp_path, files, monkeypatch):
    """Ranges of a few bytes: each meets the header of its file, wherever the file begins."""
    monkeypatch.setattr(R, "FILES", files)
    for run, head in (("1", "time,a_cpu"), ("2", "a_cpu,time")):
        d = tmp_path / "a_cpu" / run
        d.mkdir(parents=True)
        (d / "simple_metrics.csv").write_text(head + "\n" + "".join(f"{i},{i + 1000}\n" for i in range(200)))
    small = {"spark.sql.files.maxPartitionBytes": "256", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        df = R.read_metric_runs(spark, str(tmp_path))
        parts, got = df.rdd.getNumPartitions(), df.collect()
    finally:
        for k in small:
            spark.conf.unset(k)
    want = {("a_cpu/1", i, float(i + 1000)) for i in range(200)} | {("a_cpu/2", i + 1000, float(i)) for i in range(200)}
    assert {(r.run_key, r.t, r.value_num) for r in got} == want and len(got) == 400
    assert parts > 4


def test_run_files_are_written_line_by_line(spark, tmp_path, monkeypatch):
    """The header first, then each row as it comes: no row holds a file."""
    from checks import sources

    longest = []
    text = sources._written
    monkeypatch.setattr(sources, "_written", lambda df, root, name: (longest.append(df.agg(F.max(F.length("value"))).first()[0]), text(df, root, name)))
    monkeypatch.setattr(sources, "scratch_dir", lambda _: str(tmp_path))
    root = sources._run_folders(spark, "/root/testdata/sf0.001")
    assert max(longest) < 100
    points = R.load_telemetry(spark, "benchmark_fixture", root=root)
    assert points.where("value_num is not null").count() == points.where("value_str is not null").count() == 1000


@pytest.mark.parametrize("ranges", [100_000, 0])
def test_quoted_csv_over_many_ranges(spark, tmp_path, ranges, monkeypatch):
    """Ranges of a few bytes cut records anywhere, inside quotes too."""
    import csv

    from mendstream.sources import quoted

    monkeypatch.setattr(quoted, "RANGES", ranges)
    rng = random.Random(7)
    want = []
    for f in range(3):
        rows = [[str(i), "".join(rng.choice('ab",\n ') for _ in range(rng.randrange(30))), rng.choice(["", "x", "two\n\nlines"])] for i in range(40)]
        order = rng.sample(range(3), 3)
        with open(tmp_path / f"{f}.csv", "w", newline="") as out:
            w = csv.writer(out, lineterminator="\n")
            w.writerows([[["id", "text", "tag"][i] for i in order], *[[r[i] for i in order] for r in rows]])
        want += [(f"{f}.csv", *[c or None for c in r]) for r in rows]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "97b")
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    try:
        got = [(os.path.basename(r.path), r.id, r.text, r.tag, r.other) for r in quoted.read_quoted_csv(spark, str(tmp_path), ["id", "text", "tag", "other"]).collect()]
        assert quoted.quoted_lines(spark, str(tmp_path)).rdd.getNumPartitions() > 10
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
        spark.conf.set("spark.sql.files.openCostInBytes", old[1])
    key = lambda r: tuple(str(c) for c in r)
    assert sorted(got, key=key) == sorted([(*r, None) for r in want], key=key)


def test_an_absent_runbook_file_is_passed_over(spark, tmp_path):
    assert P.load_runbooks(spark, None, str(tmp_path / "none.json")).count() == 7


def test_percentiles_without_a_group_list(spark):
    from mendstream.operators.quantiles import exact_percentile

    rng = random.Random(1)
    rows = [(rng.choice(["a", "b", None]), rng.choice([5.0, 5.25, rng.uniform(-3, 40)])) for _ in range(3000)] + [("one", 2.5), ("none", None)]
    df = spark.createDataFrame(rows, "k string, x double")
    for q in (0.0, 0.5, 0.99, 1.0):
        got = {r.k: r.p for r in exact_percentile(df, ["k"], "x", q, "p").collect()}
        want = {r.k: r.p for r in df.groupBy("k").agg(F.percentile("x", q).alias("p")).collect()}
        assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)


def test_ground_truth(spark, runs):
    g = {r.run_key: r for r in R.scan_ground_truth(spark, runs).collect()}
    assert set(g) == {"cart_cpu/1", "pay-api_mem/2"}
    assert g["cart_cpu/1"].inject_time == 1700000000 and g["pay-api_mem/2"].inject_time == 0
    assert g["pay-api_mem/2"].target_service == "pay-api" and g["pay-api_mem/2"].matched_runbook == "MemoryLeakRecoveryRunbook"
    assert [r.run_key for r in R.scan_ground_truth(spark, runs, strict=True).collect()] == ["cart_cpu/1"]


def test_unknown_source_kind(spark):
    with pytest.raises(ValueError):
        R.load_telemetry(spark, "carrier_pigeon")
    with pytest.raises(ValueError):
        R.load_telemetry(spark, "push", requests=None, source="k8s")


def test_profile_and_runbooks(spark, tmp_path):
    book = {"name": "R", "pattern_type": "urgent", "action_plan": [], "blast_radius_config": {"max_pod_impact_pct": 5}, "verify_policy": {"window_seconds": 9, "success_conditions": []}}
    (tmp_path / "p.json").write_text(json.dumps({"profile_name": "p", "services": ["a", "b"], "metric_types": ["cpu", "odd"], "fault_runbook_mapping": {"cpu": "R"},
                                                 "dependency_graph": {"a": ["b"]}, "runbooks": {"R": book}}, indent=1))
    (tmp_path / "r.json").write_text(json.dumps({"R": book}))
    d = P.load_platform_profile(spark, str(tmp_path / "p.json"))
    assert d["settings"].first().default_service == "a"
    assert [r.fault for r in d["faults"].collect()] == ["cpu"]
    assert P.load_runbooks(spark, d["runbooks"]).first().window_seconds == 9
    assert P.load_runbooks(spark, d["runbooks"].where("false"), str(tmp_path / "r.json")).first().max_pod_impact_pct == 5
    assert P.load_runbooks(spark).count() == 7 and P.load_runbooks(spark, catalog=False).count() == 1


def test_audit_sink_layout(spark, tmp_path):
    rows = spark.createDataFrame([("t1", "c1", 1700000000, "pw ops@example.com"), ("t2", "c2", 1700090000, "x")], "tenant_id string, correlation_id string, epoch long, alert_payload string")
    sinks.write_audit(J.audit_events({"incident": rows}), str(tmp_path / "a"))
    assert (tmp_path / "a" / "tenant_id=t1" / "year=2023" / "month=11" / "day=14").is_dir()
    assert "[SCRUBBED]" in spark.read.json(str(tmp_path / "a")).where("tenant_id = 't1'").first().details


def shuffled(spark, tmp_path, df, parts, seed, by=7200):
    """``df`` (with ``t``) as a stream of ``parts`` files whose rows lie up to ``by`` seconds out of order; a last file lets the watermark pass."""
    rng = random.Random(seed)
    rows = sorted(df.collect(), key=lambda r: r.t + rng.uniform(0, by))
    src = tmp_path / "src"
    src.mkdir()
    n = -(-len(rows) // parts)
    for i in range(parts + 1):
        some = rows[i * n : (i + 1) * n]
        part = spark.createDataFrame(some, df.schema) if some else df.limit(1).withColumn("t", F.lit(4 * 10**9)).withColumns({c: F.lit("last") for c, k in df.dtypes if k == "string"})
        part.withColumn("ts", F.timestamp_seconds("t")).coalesce(1).write.parquet(str(tmp_path / f"p{i}"))
        (file,) = (tmp_path / f"p{i}").glob("part*.parquet")
        file.rename(src / f"{i:03d}.parquet")
        os.utime(src / f"{i:03d}.parquet", (10**9 + i, 10**9 + i))
    return spark.readStream.schema(spark.read.parquet(str(src)).schema).option("maxFilesPerTrigger", 1).parquet(str(src))


def drained(df, tmp_path):
    """What the stream returns, and the rows that its last stateful operator still holds."""
    q = df.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination()
    held = [o["numRowsTotal"] for o in q.lastProgress["stateOperators"] if "transformWithState" in o["operatorName"]]
    return df.sparkSession.read.parquet(str(tmp_path / "out")), held


def test_stream_cooldown_equals_batch_in_any_order(spark, sf, tmp_path):
    from mendstream.plans import fixtures as X

    a = X.alerts(spark, sf).select(F.concat_ws("/", "namespace", "service").alias("lock_key"), "alert_id", "t", F.lit(90000).alias("cooldown").cast("long"))
    got, held = drained(ST.stream_cooldown(shuffled(spark, tmp_path, a, 4, 1), late="3 hours"), tmp_path)
    dims = spark.createDataFrame([("x", 90000)], "namespace string, cooldown int")
    want = S.cooldown_dedup(a.drop("cooldown").withColumn("namespace", F.lit("x")), dims, ["lock_key"])
    assert {(r.alert_id, r.accepted) for r in got.collect()} == {(r.alert_id, r.accepted) for r in want.collect()}
    assert held == [0]  # every cooldown is over


def test_stream_incidents_equal_batch_in_any_order(spark, sf, tmp_path):
    from mendstream.plans import fixtures as X

    al = X.alerts(spark, sf)
    cl = X.telemetry(spark, sf).where("signal_name = 'mem' AND k >= 60").select("tenant_id", "service", "t")
    ev = al.select("tenant_id", "t", F.lit(1).alias("kind"), "alert_id", "service").unionByName(cl.select("tenant_id", "t", F.lit(0).alias("kind"), F.lit(-1).cast("long").alias("alert_id"), "service"))
    got, _ = drained(ST.stream_incidents(shuffled(spark, tmp_path, ev, 3, 2), X.edges(spark), late="3 hours"), tmp_path)
    want = S.correlate_incidents(al, X.edges(spark), cl)
    cols = ["alert_id", "role", "root_service", "start_time"]
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect()))


def test_stream_incidents_gives_the_last_second(spark, tmp_path):
    """Alerts of the last second of the stream too, and nothing of the row that ends it."""
    import checks

    checks.load()
    at = "timestamp'2024-01-01 00:00:00'"
    e = spark.range(30).select(F.col("id").alias("event_id"), F.col("id").alias("user_id"), F.lit("error").alias("event_type"), F.lit(1.0).alias("value"),
                               F.expr(f"timestampadd(MILLISECOND, 100 * id, {at})").alias("ts"), F.lit('{"k": 1}').alias("props"))
    e.coalesce(1).write.parquet(str(tmp_path / "some"))
    (file,) = (tmp_path / "some").glob("part*.parquet")
    (tmp_path / "sf").mkdir()
    file.rename(tmp_path / "sf" / "events.parquet")
    got = checks.QUERIES["g2_stream_incidents"](spark, str(tmp_path / "sf")).collect()
    assert sorted(r.alert_id for r in got) == list(range(30))


def test_incident_state_holds_no_frames_of_a_micro_batch(monkeypatch):
    """Frames are let go as they come, and what is handed on comes in pieces; a root stays active over micro-batches."""
    import weakref

    import pandas as pd

    class Active(dict):
        iterator, updateValue, removeKey = dict.items, dict.__setitem__, dict.__delitem__

    monkeypatch.setattr(ST, "OUT_ROWS", 7)
    seen, roots = [], Active()
    p = ST.Incidents()
    p.init(type("Handle", (), {"getMapState": lambda *_: roots})())

    def frames(first):
        for i in range(10):
            assert all(f() is None for f in seen[:-1])
            pdf = pd.DataFrame([("x", "p", "a" if j % 2 else "b", 1, [first + 100 - 10 * i - j, 1000], ["b"] if j % 2 else [], first + 100 - 10 * i - j) for j in range(10)],
                               columns=["tenant_id", "part", "service", "kind", "alert_ids", "depends", "t"])
            seen.append(weakref.ref(pdf))
            yield pdf
            del pdf

    for first in (0, 100):
        out = list(p.handleInputRows(("x", "p"), frames(first), None))
        assert max(map(len, out)) <= 7
        d = pd.concat(out)
        assert d["t"].tolist() == list(range(first + 1, first + 101)) and [a[0] for a in d["alert_ids"]] == d["t"].tolist()
        want = {(s, "root") for s in "ab"} | {(s, "duplicate") for s in "ab"} if not first else {(s, "duplicate") for s in "ab"}
        assert set(zip(d["service"], d["role"])) == want
    assert roots == {("a",): (1, 0), ("b",): (2, 1)}


def test_stream_forest_equals_one_pass_in_any_order(spark, tmp_path):
    from mendstream.operators.forests import LiveForest

    rng = random.Random(5)
    rows = [("x", 10**9 + i, i, [rng.random(), rng.random() + (9.0 if i == 55 else 0.0)]) for i in range(70)]
    df = spark.createDataFrame(rows, "tenant_id string, t long, seq long, x array<double>")
    got, _ = drained(ST.stream_rrcf(shuffled(spark, tmp_path, df, 3, 4, by=8), trees=5, sample=30, late="20 seconds"), tmp_path)
    forest = LiveForest(5, 30, 42)
    want = {r[1]: forest.score(r[3]) for r in rows}
    assert {r.t: r.score for r in got.collect()} == want
    assert max(list(want)[35:], key=want.get) == 10**9 + 55


def test_one_tenant_is_folded_in_as_many_parts_as_its_graph_has(spark):
    from mendstream.operators.graph import service_parts

    edges = spark.createDataFrame([("a", "b"), ("c", "b"), ("d", "c"), ("x", "y"), ("z", "z"), (None, "b")], "service string, depends_on string")
    assert {r.service: (r.part, list(r.depends)) for r in service_parts(edges).collect()} == {
        "a": ("a", ["b"]), "b": ("a", []), "c": ("a", ["b"]), "d": ("a", ["c"]), "x": ("x", ["y"]), "y": ("x", []), "z": ("z", ["z"])}
    rng = random.Random(3)
    alerts = spark.createDataFrame([("t", i, i // 3, rng.choice("abcdxyzw")) for i in range(300)], "tenant_id string, alert_id long, t long, service string")
    closes = spark.createDataFrame([("t", rng.choice("abcdxyzw"), 5 * i) for i in range(20)], "tenant_id string, service string, t long")
    got = {r.alert_id: (r.role, r.root_service, r.start_time) for r in S.correlate_incidents(alerts, edges, closes).collect()}
    up = {"a": "b", "c": "b", "d": "c", "x": "y", "z": "z"}
    active, want = {}, {}
    for _, kind, i, s, t in sorted([(r.t, 1, r.alert_id, r.service, r.t) for r in alerts.collect()] + [(r.t, 0, -1, r.service, r.t) for r in closes.collect()]):
        if not kind:
            active.pop(s, None)
            continue
        role = "duplicate" if s in active else "symptom" if up.get(s) in active else "root"
        root = up[s] if role == "symptom" else s
        want[i] = (role, root, active.setdefault(root, t))
    assert got == want
