"""C: binning, alignment and window functions."""
from pyspark.sql import functions as F

from checks import query
from checks.ctes import ALERTS, BINS, EV, GRID, LIVE, LOGS, STATS, TEL, Z, with_
from checks.views import anchors, grid, kept, plain, rounded, split
from mendstream.functions.scalars import series_name
from mendstream.operators import templates as TP, timeseries as TS
from mendstream.plans import fixtures as X
from mendstream.plans.detect import trigger_metric
from mendstream.session import reuse


@query("c1_bin_points", with_(BINS) + "SELECT * FROM bins")
def _(spark, sf):
    p = X.telemetry(spark, sf).withColumn("series", series_name(F.col("service"), F.col("signal_name"), X.SERVICES))
    return TS.bin_points(p, X.BIN, X.WINDOW)


@query("c2_align_series", with_(GRID) + "SELECT * FROM grid")
def _(spark, sf):
    return plain(grid(spark, sf))


# one window over the whole history, filled block by block
@query("c2_align_history", with_(TEL, """b AS (SELECT tenant_id, CAST(0 AS BIGINT) AS window_id, (t // 3600) * 3600 AS t, service || '_' || signal_name AS series,
    arg_max(value_num, seq) AS v FROM tel WHERE value_num IS NOT NULL GROUP BY 1, 2, 3, 4),
  ti AS (SELECT tenant_id, t, CAST(row_number() OVER (PARTITION BY tenant_id ORDER BY t) - 1 AS INT) AS row FROM (SELECT DISTINCT tenant_id, t FROM b))""") + """
SELECT tenant_id, CAST(0 AS BIGINT) AS window_id, t, row, series, coalesce(last_value(v IGNORE NULLS) OVER (PARTITION BY tenant_id, series ORDER BY t ROWS UNBOUNDED PRECEDING), 0) AS v
FROM ti JOIN (SELECT DISTINCT tenant_id, series FROM b) USING (tenant_id) LEFT JOIN b USING (tenant_id, t, series)""")
def _(spark, sf):
    p = X.telemetry(spark, sf).withColumn("series", series_name(F.col("service"), F.col("signal_name"), X.SERVICES))
    return plain(TS.align_series(reuse(TS.bin_points(p, X.BIN)), block=86400))


# every 7th sample becomes NaN, every 11th infinite
_DIRTY = GRID + """, dirty AS (SELECT * REPLACE (CASE WHEN row % 7 = 3 THEN 'nan'::DOUBLE WHEN row % 11 < 2 THEN 'inf'::DOUBLE ELSE v END AS v) FROM grid)"""


def _dirty(spark, sf):
    return grid(spark, sf).withColumn("v", F.when(F.col("row") % 7 == 3, float("nan")).when(F.col("row") % 11 < 2, float("inf")).otherwise(F.col("v")))


_FILL = """SELECT tenant_id, window_id, t, row, series, coalesce(last_value(x IGNORE NULLS) OVER w, first_value(x IGNORE NULLS) OVER a, 0) AS v FROM cleaned
WINDOW w AS (PARTITION BY tenant_id, window_id, series ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
 a AS (PARTITION BY tenant_id, window_id, series ORDER BY t ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"""


@query("c3_clean_non_finite", with_(_DIRTY, "cleaned AS (SELECT *, CASE WHEN isnan(v) THEN 0.0 WHEN isinf(v) THEN NULL ELSE v END AS x FROM dirty)") + _FILL)
def _(spark, sf):
    return plain(TS.clean_non_finite(_dirty(spark, sf)))


@query("c3_clean_non_finite_rca", with_(_DIRTY, "cleaned AS (SELECT *, CASE WHEN isnan(v) OR isinf(v) THEN NULL ELSE v END AS x FROM dirty)") + _FILL)
def _(spark, sf):
    return plain(TS.clean_non_finite(_dirty(spark, sf), mode="rca"))


@query("c4_minmax_scale", with_(GRID, "r AS (SELECT *, min(v) OVER p AS lo, max(v) OVER p AS hi FROM grid WINDOW p AS (PARTITION BY tenant_id, window_id, series))")
       + "SELECT tenant_id, window_id, t, row, series, round(CASE WHEN hi - lo > 1e-6 THEN (v - lo) / (hi - lo) ELSE 0 END, 6) AS v FROM r WHERE lo < hi")
def _(spark, sf):
    return rounded(plain(TS.minmax_scale(TS.drop_constant(grid(spark, sf)))), "v")


@query("c5_baseline_split", with_(LIVE) + "SELECT tenant_id, window_id, row, series, baseline_len, is_baseline FROM split")
def _(spark, sf):
    return split(spark, sf).select("tenant_id", "window_id", "row", "series", "baseline_len", "is_baseline")


@query("c5_baseline_split_sliced", with_(LIVE) + """SELECT tenant_id, window_id, row, series, CAST(least(100, anomaly_row) AS INT) AS baseline_len,
  row < least(100, anomaly_row) AS is_baseline FROM grid JOIN anchors USING (tenant_id, window_id)""")
def _(spark, sf):
    a = anchors(split(spark, sf)).withColumnRenamed("anomaly_row", "inject_row")
    d = TS.baseline_split(grid(spark, sf), "sliced", a.select(*TS.WIN, "inject_row"))
    return d.select("tenant_id", "window_id", "row", "series", "baseline_len", "is_baseline")


# means of few-digit values fall on rounding borders; their square roots do not
@query("c6_baseline_stats", with_(STATS) + "SELECT tenant_id, window_id, series, round(sqrt(mean), 6) AS root_mean, round(std, 6) AS std, round(sqrt(reg_std), 6) AS root_reg_std FROM stats")
def _(spark, sf):
    d = TS.baseline_stats(split(spark, sf))
    return d.select(*TS.SERIES, F.round(F.sqrt("mean"), 6).alias("root_mean"), F.round("std", 6).alias("std"), F.round(F.sqrt("reg_std"), 6).alias("root_reg_std"))


@query("c7_deviation", with_(Z) + "SELECT tenant_id, window_id, series, round(z, 6) AS z FROM zs")
def _(spark, sf):
    d = kept(spark, sf)
    return rounded(TS.deviation(d, TS.baseline_stats(d), anchors(d)), "z")


@query("c8_rolling_mean", with_(LIVE, "sl AS (SELECT g.* FROM grid g JOIN anchors USING (tenant_id, window_id) WHERE row BETWEEN anomaly_row - 30 AND anomaly_row + 10)")
       + """SELECT tenant_id, window_id, t, row, series, round(sqrt(avg(v) OVER (PARTITION BY tenant_id, window_id, series ORDER BY row ROWS BETWEEN 14 PRECEDING AND CURRENT ROW)), 6) AS root_v FROM sl""")
def _(spark, sf):
    d = kept(spark, sf)
    r = TS.rolling_mean(TS.slice_around(plain(d), anchors(d), 30, 10))
    return r.select(*TS.WIN, "t", "row", "series", F.round(F.sqrt("v"), 6).alias("root_v"))


@query("c9_slice_around", with_(LIVE) + "SELECT g.* FROM grid g JOIN anchors USING (tenant_id, window_id) WHERE g.row BETWEEN anomaly_row - 120 AND anomaly_row + 30")
def _(spark, sf):
    d = kept(spark, sf)
    return TS.slice_around(plain(d), anchors(d), 120, 30)


@query("c9_slice_seconds", with_(LIVE) + "SELECT g.* FROM grid g JOIN anchors USING (tenant_id, window_id) WHERE g.t BETWEEN anchor_t - 43200 AND anchor_t + 10800")
def _(spark, sf):
    d = kept(spark, sf)
    return TS.slice_around(plain(d), anchors(d), 43200, 10800, by="t")


@query("c10_first_row_at_or_after", with_(GRID, "a AS (SELECT tenant_id, window_id, max(t) - CASE WHEN window_id % 2 = 0 THEN 5000 ELSE -5000 END AS anchor_t FROM grid GROUP BY 1, 2)") + """
SELECT tenant_id, window_id, CAST(coalesce(min(row) FILTER (t >= anchor_t), max(row) + 1 - 100) AS INT) AS inject_row FROM grid JOIN a USING (tenant_id, window_id) GROUP BY 1, 2""")
def _(spark, sf):
    g = grid(spark, sf)
    a = g.groupBy(*TS.WIN).agg((F.max("t") - F.when(F.col("window_id") % 2 == 0, 5000).otherwise(-5000)).alias("anchor_t"))
    return TS.first_row_at_or_after(g, a)


# flags for C11 and C12: a row is flagged when its largest error rate is above 0.19
_FLAGS = LIVE + """, fl AS (SELECT tenant_id, window_id, row, t, max(v) > 0.19 AS is_anomaly FROM grid WHERE series LIKE '%error%' GROUP BY 1, 2, 3, 4)"""


def _flags(g):
    return g.where(F.col("series").contains("error")).groupBy(*TS.WIN, "row", "t").agg((F.max("v") > 0.19).alias("is_anomaly"))


@query("c11_first_detection", with_(_FLAGS) + """SELECT tenant_id, window_id, CAST(coalesce(min(row) FILTER (is_anomaly AND row >= baseline_len), -1) AS INT) AS anomaly_row,
  count(*) FILTER (is_anomaly) AS n_flagged FROM fl JOIN wins USING (tenant_id, window_id) GROUP BY 1, 2""")
def _(spark, sf):
    d = kept(spark, sf)
    start = d.groupBy(*TS.WIN).agg(F.min("baseline_len").alias("search_start"))
    return TS.first_detection(_flags(d), start)


@query("c12_detection_candidates", "WITH RECURSIVE " + _FLAGS + """, f AS (SELECT tenant_id, window_id, row FROM fl JOIN anchors USING (tenant_id, window_id) WHERE is_anomaly AND row >= greatest(0, anomaly_row - 30)),
  acc AS (SELECT tenant_id, window_id, min(row) AS row, 1 AS n FROM f GROUP BY 1, 2
    UNION ALL SELECT a.tenant_id, a.window_id, min(f.row), a.n + 1 FROM acc a JOIN f ON f.tenant_id = a.tenant_id AND f.window_id = a.window_id AND f.row >= a.row + 5 WHERE a.n < 8
    GROUP BY a.tenant_id, a.window_id, a.n)
SELECT tenant_id, window_id, CAST(row AS BIGINT) AS row, CAST(n AS INT) AS candidate FROM acc""")
def _(spark, sf):
    from mendstream.operators.states import detection_candidates

    d = kept(spark, sf)
    start = anchors(d).select(*TS.WIN, F.greatest(F.lit(0), F.col("anomaly_row") - 30).alias("search_start"))
    return detection_candidates(_flags(d), start)


_SAMPLES = TEL + """, sm AS (SELECT seq, t, tenant_id, service, value_num AS v FROM tel WHERE signal_name = 'cpu')"""


def _samples(spark, sf, signal="cpu"):
    return X.telemetry(spark, sf).where(F.col("signal_name") == signal).select("seq", "t", "tenant_id", "service", F.col("value_num").alias("v"))


@query("c13_resample", with_(_SAMPLES, """e AS (SELECT tenant_id, service, unnest(generate_series(((t + 1799) // 1800) * 1800, ((t + 7199) // 1800) * 1800, 1800)) AS st, t, seq, v FROM sm)""")
       + "SELECT tenant_id, service, st AS t, arg_max(v, (t, seq)) AS v FROM e GROUP BY 1, 2, 3")
def _(spark, sf):
    return TS.resample(_samples(spark, sf), 1800, 7200, ["tenant_id", "service"])


# whole values so that neighbouring samples repeat; one sample per second
_COUNTER = _SAMPLES + """, cn AS (SELECT tenant_id, service, t, floor(arg_max(v, seq) / 40) AS v FROM sm GROUP BY 1, 2, 3),
  pr AS (SELECT *, lag(v) OVER (PARTITION BY tenant_id, service ORDER BY t) AS pv, lag(t) OVER (PARTITION BY tenant_id, service ORDER BY t) AS pt FROM cn)"""


def _counter(spark, sf):
    s = _samples(spark, sf)
    return s.groupBy("tenant_id", "service", "t").agg(F.floor(F.max_by("v", "seq") / 40).cast("double").alias("v"))


@query("c14_counter_changes", with_(_COUNTER) + """SELECT a.tenant_id, a.service, a.t, any_value(a.v) AS v, count(*) FILTER (b.pt > a.t - 7200 AND b.v <> b.pv) AS changes
FROM pr a JOIN pr b ON a.tenant_id = b.tenant_id AND a.service = b.service AND b.t <= a.t AND b.t > a.t - 7200 GROUP BY 1, 2, 3""")
def _(spark, sf):
    return TS.counter_changes(_counter(spark, sf), ["tenant_id", "service"], 7200)


@query("c14_counter_rate", with_(_COUNTER) + """SELECT a.tenant_id, a.service, a.t, round(coalesce(sum(CASE WHEN b.v < b.pv THEN b.v ELSE b.v - b.pv END) FILTER (b.pt > a.t - 7200), 0) / 7200, 9) AS rate
FROM pr a JOIN pr b ON a.tenant_id = b.tenant_id AND a.service = b.service AND b.t <= a.t AND b.t > a.t - 7200 GROUP BY 1, 2, 3""")
def _(spark, sf):
    return rounded(TS.counter_rate(_counter(spark, sf), ["tenant_id", "service"], 7200).select("tenant_id", "service", "t", "rate"), "rate", digits=9)


@query("c15_max_over_time", with_(_COUNTER) + """SELECT tenant_id, service, t, v, max(v) OVER (PARTITION BY tenant_id, service ORDER BY t RANGE BETWEEN 7199 PRECEDING AND CURRENT ROW) AS max_v FROM cn""")
def _(spark, sf):
    return TS.max_over_time(_counter(spark, sf), ["tenant_id", "service"], 7200)


@query("c15_sum_or_zero", with_(_SAMPLES) + "SELECT tenant_id, round(coalesce(sum(v) FILTER (v > 150), 0), 6) AS total FROM sm GROUP BY 1")
def _(spark, sf):
    s = _samples(spark, sf).withColumn("v", F.when(F.col("v") > 150, F.col("v")))
    return rounded(TS.sum_or_zero(s, ["tenant_id"], "v"), "total")


_BACKLOG = _COUNTER + """, bk AS (SELECT tenant_id, service, t, v, v > 0 AS cond, lag(v > 0) OVER (PARTITION BY tenant_id, service ORDER BY t) AS pc FROM cn),
  ac AS (SELECT *, CASE WHEN cond THEN last_value(CASE WHEN cond AND NOT coalesce(pc, FALSE) THEN t END IGNORE NULLS) OVER (PARTITION BY tenant_id, service ORDER BY t ROWS UNBOUNDED PRECEDING) END AS active_since FROM bk)"""


@query("c16_alert_for", with_(_BACKLOG) + "SELECT tenant_id, service, t, v, cond, active_since, coalesce(t - active_since >= 7200, FALSE) AS firing FROM ac")
def _(spark, sf):
    return TS.alert_for(TS.backlog_alert(_counter(spark, sf), above=0.0), ["tenant_id", "service"], 7200)


@query("c17_ratio_alert", with_(EV) + """SELECT 'tenant-' || (user_id % 4) AS namespace, 'svc' || (user_id % 6) AS deployment, t, arg_max(k % 4, event_id) AS available, arg_max(k % 5, event_id) AS desired,
  round(CASE WHEN arg_max(k % 5, event_id) = 0 THEN NULL ELSE arg_max(k % 4, event_id) / arg_max(k % 5, event_id) END, 6) AS ratio,
  coalesce(CASE WHEN arg_max(k % 5, event_id) = 0 THEN NULL ELSE arg_max(k % 4, event_id) / arg_max(k % 5, event_id) END < 0.5, FALSE) AS cond FROM ev GROUP BY 1, 2, 3""")
def _(spark, sf):
    e = X.events(spark, sf).groupBy(F.concat(F.lit("tenant-"), F.col("user_id") % 4).alias("namespace"), F.concat(F.lit("svc"), F.col("user_id") % 6).alias("deployment"), "t")
    both = e.agg(F.max_by(F.col("k") % 4, "event_id").alias("available"), F.max_by(F.col("k") % 5, "event_id").alias("desired"))
    return rounded(TS.ratio_alert(both.drop("desired"), both.drop("available")), "ratio")


@query("c17_backlog_alert", with_(_SAMPLES) + "SELECT *, v > 100 AS cond FROM sm")
def _(spark, sf):
    return TS.backlog_alert(_samples(spark, sf))


@query("c17_oom_alert", with_(_COUNTER, "ch AS (SELECT a.tenant_id, a.service, a.t, any_value(a.v) AS v, count(*) FILTER (b.pt > a.t - 7200 AND b.v <> b.pv) AS changes FROM pr a JOIN pr b ON a.tenant_id = b.tenant_id AND a.service = b.service AND b.t <= a.t AND b.t > a.t - 7200 GROUP BY 1, 2, 3)") + """
SELECT tenant_id AS namespace, service AS pod, t, v, changes FROM ch WHERE changes > 0 AND EXISTS (SELECT 1 FROM ev WHERE k = 7 AND 'tenant-' || (user_id % 4) = ch.tenant_id AND 'svc' || (user_id % 6) = ch.service)""")
def _(spark, sf):
    r = _counter(spark, sf).withColumnsRenamed({"tenant_id": "namespace", "service": "pod"})
    why = X.events(spark, sf).select(F.concat(F.lit("tenant-"), F.col("user_id") % 4).alias("namespace"), F.concat(F.lit("svc"), F.col("user_id") % 6).alias("pod"),
                                     F.when(F.col("k") == 7, "OOMKilled").otherwise("Error").alias("reason"))
    return TS.oom_alert(r, why, 7200)


@query("c18_histogram_quantile", with_(TEL, """bd AS (SELECT unnest([10.0, 25.0, 50.0, 100.0, 200.0, 400.0])::DOUBLE AS le),
  b AS (SELECT service, le, count(*) FILTER (value_num <= le) AS n FROM tel, bd WHERE signal_name = 'service_latency_p95' GROUP BY 1, 2),
  c AS (SELECT *, coalesce(lag(le) OVER w, 0) AS lo, coalesce(lag(n) OVER w, 0) AS below, max(n) OVER (PARTITION BY service) AS total FROM b WINDOW w AS (PARTITION BY service ORDER BY le))""") + """
SELECT service, round(arg_min(lo + (le - lo) * (0.99 * total - below) / (n - below), le), 6) AS quantile FROM c WHERE n >= 0.99 * total AND total > 0 GROUP BY 1""")
def _(spark, sf):
    from mendstream.operators.audit import duration_histogram

    s = X.telemetry(spark, sf).where("signal_name = 'service_latency_p95'")
    b = duration_histogram(s, "service", "value_num", [10.0, 25.0, 50.0, 100.0, 200.0, 400.0], with_inf=False)
    return rounded(TS.histogram_quantile(b, ["service"], 0.99), "quantile")


@query("c19_trigger_metric", with_(LIVE, """p AS (SELECT tenant_id, window_id, series, avg(v) FILTER (is_baseline) AS mean, stddev_samp(v) FILTER (is_baseline) AS std, max(v) FILTER (row = anomaly_row) AS trigger_value
    FROM split JOIN anchors USING (tenant_id, window_id) WHERE series LIKE CASE WHEN tenant_id IN ('tenant-0', 'tenant-2') THEN 'svc2%' ELSE 'svc3%' END GROUP BY 1, 2, 3),
  d AS (SELECT *, abs(trigger_value - mean) / std AS dev FROM p WHERE std > 0)""") + """
SELECT tenant_id, window_id, series AS trigger_metric, trigger_value, round(dev, 6) AS dev FROM (SELECT *, row_number() OVER (PARTITION BY tenant_id, window_id ORDER BY dev DESC, series) AS r FROM d WHERE dev > 0) WHERE r = 1""")
def _(spark, sf):
    d = kept(spark, sf)
    a = anchors(d)
    svc = a.select(*TS.WIN, F.when(F.col("tenant_id").isin("tenant-0", "tenant-2"), "svc2").otherwise("svc3").alias("target_service"))
    return rounded(trigger_metric(d, a, svc), "dev")


@query("c20_evidence", with_(LIVE, LOGS[len(EV) + 2:], """p AS (SELECT tenant_id, window_id, series, avg(v) FILTER (is_baseline) AS m, stddev_samp(v) FILTER (is_baseline) AS s, max(v) FILTER (row = anomaly_row) AS cur
    FROM split JOIN anchors USING (tenant_id, window_id) WHERE series LIKE 'svc2%' GROUP BY 1, 2, 3),
  z AS (SELECT tenant_id, window_id, series, round(CASE WHEN s > 0 THEN abs(cur - m) / s ELSE 0 END, 4) AS z FROM p),
  m AS (SELECT tenant_id, window_id, row_number() OVER (PARTITION BY tenant_id, window_id ORDER BY z DESC, series) AS rank, 'metric' AS kind, series AS item, z FROM z),
  l AS (SELECT tenant_id, t // 432000 AS window_id, row_number() OVER (PARTITION BY tenant_id, t // 432000 ORDER BY t, seq) AS rank, 'log' AS kind, message AS item, NULL::DOUBLE AS z FROM lg
    WHERE container_name = 'svc2' AND (tenant_id, t // 432000) IN (SELECT (tenant_id, window_id) FROM anchors))""") + """
SELECT tenant_id, window_id, CAST(rank AS INT) AS rank, kind, item, z FROM m WHERE rank <= 12 UNION ALL SELECT tenant_id, window_id, CAST(rank AS INT), kind, item, z FROM l WHERE rank <= 8""")
def _(spark, sf):
    from mendstream.operators.rca import evidence

    d = kept(spark, sf)
    a = anchors(d).withColumn("target_service", F.lit("svc2"))
    lg = X.logs(spark, sf).withColumn("window_id", F.expr(f"t div {X.WINDOW}"))
    return evidence(d, a, lg)


@query("c21_select_signal_window", with_(TEL, ALERTS[len(EV) + 2:]) + """
SELECT a.alert_id, p.service AS pod, p.signal_name, p.seq, p.t, p.value_num FROM al0 a JOIN tel p ON p.service = a.service AND p.t BETWEEN a.t - 1800 AND a.t
  AND p.signal_name IN (CASE WHEN a.k % 2 = 0 THEN 'cpu' ELSE 'service_latency_p95' END, 'mem')""")
def _(spark, sf):
    pts = X.telemetry(spark, sf).select(F.col("service").alias("pod"), "signal_name", "seq", "t", "value_num")
    al = X.alerts(spark, sf).select("alert_id", F.col("service").alias("pod"), F.when(F.col("k") % 2 == 0, "cpu").otherwise("service_latency_p95").alias("signal_name"),
                                    (F.col("t") - 1800).alias("from_t"), F.col("t").alias("to_t"))
    return TS.select_signal_window(pts, al, "mem", bucket=1800)


@query("c23_backlog_over_time", with_(TEL, ALERTS[len(EV) + 2:], """q AS (SELECT (t // 21600) * 21600 AS bucket, max(value_num) AS backlog FROM tel WHERE signal_name = 'mem' GROUP BY 1),
  f AS (SELECT (t // 21600) * 21600 AS bucket, count(*) AS firing FROM al0 WHERE status = 'firing' GROUP BY 1)""") + """
SELECT bucket, coalesce(backlog, 0) AS backlog, coalesce(firing, 0) AS firing FROM q FULL JOIN f USING (bucket)""")
def _(spark, sf):
    return TS.backlog_over_time(_samples(spark, sf, "mem"), X.alerts(spark, sf), 21600)


# template ids are hashes of the two message shapes of each container
@query("c22_template_counts", with_(GRID, LOGS[len(EV) + 2:], """sh AS (SELECT tenant_id, container_name, e, CASE WHEN e THEN 'svc<NUM> request <NUM> failed after <NUM> ms from <IP>' ELSE 'svc<NUM> ' || CASE WHEN count(DISTINCT event_type) > 1 THEN '<*>' ELSE any_value(event_type) END || ' ok user <NUM>' END AS pattern
    FROM (SELECT 'tenant-' || (user_id % 4) AS tenant_id, 'svc' || (user_id % 6) AS container_name, event_type = 'error' AS e, event_type FROM events) GROUP BY 1, 2, 3),
  lc AS (SELECT lg.tenant_id, lg.t // 432000 AS window_id, (lg.t // 3600) * 3600 AS t, sha256(lg.tenant_id || '#' || lg.container_name || '#' || pattern)[:16] AS template_id, count(*)::DOUBLE AS n FROM lg JOIN sh ON sh.tenant_id = lg.tenant_id AND sh.container_name = lg.container_name AND e = (level = 'error') GROUP BY 1, 2, 3, 4)""") + """
SELECT tenant_id, window_id, t, row, template_id, coalesce(n, 0) AS n FROM times JOIN (SELECT DISTINCT tenant_id, window_id, template_id FROM lc) USING (tenant_id, window_id) LEFT JOIN lc USING (tenant_id, window_id, t, template_id)""")
def _(spark, sf):
    lg = X.logs(spark, sf)
    msgs, _t = TP.mine_templates(lg)
    counts = TP.template_counts(lg, msgs, X.BIN, X.WINDOW)
    times = grid(spark, sf).groupBy(*TS.WIN, "t", "row").agg(F.lit(1).alias("_n")).drop("_n")
    return TP.dense_counts(counts, times)
