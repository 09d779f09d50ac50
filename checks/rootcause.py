"""E: scaling, ranking, correlation, service and fault scores, root cause."""
from pyspark.sql import functions as F

from checks import query
from checks.ctes import EV, LOGS, Z, with_
from checks.views import anchors, kept, plain, rounded, split
from mendstream import fixed
from mendstream.operators import rca as R, templates as TP, timeseries as TS
from mendstream.plans import fixtures as X
from mendstream.session import reuse

WIN = TS.WIN
_SVCS = ["svc0", "svc1", "svc2", "svc3", "svc4", "svc5"]

# scaled series, ranks by (x - median) / IQR
RANK = Z + """, sc0 AS (SELECT tenant_id, window_id, series, greatest(coalesce(stddev_samp(v), 0), 0.05 * abs(avg(v)) + 0.05) AS s FROM grid GROUP BY 1, 2, 3),
  scaled AS (SELECT g.tenant_id, g.window_id, g.t, g.row, g.series, v / s AS v FROM grid g JOIN sc0 USING (tenant_id, window_id, series)),
  q AS (SELECT tenant_id, window_id, series, quantile_cont(v, [0.25, 0.5, 0.75]) FILTER (row < anomaly_row) AS q, max(v) FILTER (row >= anomaly_row) AS top FROM scaled JOIN anchors USING (tenant_id, window_id) GROUP BY 1, 2, 3),
  rk0 AS (SELECT tenant_id, window_id, series, (top - q[2]) / CASE WHEN q[3] - q[1] = 0 THEN 1 ELSE q[3] - q[1] END AS score FROM q),
  ranks AS (SELECT *, CAST(row_number() OVER (PARTITION BY tenant_id, window_id ORDER BY score DESC, series) AS INT) AS rank FROM rk0)"""
# templates of the fixture: one error and one plain shape per container
CORR = Z + ", " + LOGS[len(EV) + 2:] + """, lb AS (SELECT tenant_id, t // 432000 AS window_id, (t // 3600) * 3600 AS t, container_name || CASE WHEN level = 'error' THEN ' E' ELSE ' P' END AS tpl, count(*) AS n FROM lg GROUP BY 1, 2, 3, 4),
  tn AS (SELECT DISTINCT tenant_id, window_id, tpl FROM lb),
  lgrid AS (SELECT ti.tenant_id, ti.window_id, ti.row, tpl, coalesce(n, 0) AS n FROM times ti JOIN tn USING (tenant_id, window_id) LEFT JOIN lb USING (tenant_id, window_id, t, tpl)),
  ms AS (SELECT g.tenant_id, g.window_id, g.row, series, avg(v) OVER (PARTITION BY g.tenant_id, g.window_id, series ORDER BY g.row ROWS BETWEEN 14 PRECEDING AND CURRENT ROW) AS x FROM grid g JOIN anchors USING (tenant_id, window_id) WHERE g.row BETWEEN anomaly_row - 30 AND anomaly_row + 10),
  ls AS (SELECT g.tenant_id, g.window_id, g.row, tpl, avg(n) OVER (PARTITION BY g.tenant_id, g.window_id, tpl ORDER BY g.row ROWS BETWEEN 14 PRECEDING AND CURRENT ROW) AS y FROM lgrid g JOIN anchors USING (tenant_id, window_id) WHERE g.row BETWEEN anomaly_row - 30 AND anomaly_row + 10),
  cr AS (SELECT tenant_id, window_id, series, tpl, CASE WHEN stddev_pop(x) < 1e-9 OR stddev_pop(y) < 1e-9 THEN 0 ELSE corr(x, y) END AS r FROM ms JOIN ls USING (tenant_id, window_id, row) GROUP BY 1, 2, 3, 4)"""
_WEIGHT = "CASE fault WHEN 'cpu' THEN 1.2 WHEN 'mem' THEN 2.0 WHEN 'disk' THEN 3.5 WHEN 'socket' THEN 5.5 WHEN 'loss' THEN 3.2 ELSE 0.9 END::DOUBLE"
_ORD = "CASE fault WHEN 'cpu' THEN 0 WHEN 'mem' THEN 1 WHEN 'disk' THEN 2 WHEN 'socket' THEN 3 WHEN 'loss' THEN 4 ELSE 5 END"
# families of the fixture's four metric names; "duration"-like tokens do not occur, error_rate is loss, latency_p95 is delay
_FAM = "CASE WHEN {x} LIKE '%error%' THEN 'loss' WHEN {x} LIKE '%latency%' THEN 'delay' WHEN {x} LIKE '%mem' THEN 'mem' ELSE 'cpu' END"
SERVICE = CORR + f""", parts AS (SELECT tenant_id, window_id, series[:4] AS service, {_FAM.format(x='series')} AS fault, least(500, z) AS score FROM zs WHERE z > 3
   UNION ALL SELECT tenant_id, window_id, series[:4], {_FAM.format(x='series')}, abs(r) * CASE WHEN tpl[:4] = series[:4] THEN 3 ELSE 1 END * 15 FROM cr WHERE abs(r) >= 0.4 AND tpl LIKE '% E'),
  svc AS (SELECT tenant_id, window_id, service, coalesce(score, 0) AS score FROM (SELECT * FROM (SELECT DISTINCT tenant_id, window_id FROM zs), (SELECT unnest(['svc0', 'svc1', 'svc2', 'svc3', 'svc4', 'svc5']) AS service))
     LEFT JOIN (SELECT tenant_id, window_id, service, sum(score) AS score FROM parts GROUP BY 1, 2, 3) USING (tenant_id, window_id, service)),
  svr AS (SELECT *, CAST(row_number() OVER (PARTITION BY tenant_id, window_id ORDER BY score DESC, service) AS INT) AS position FROM svc)"""
# fault of the best-ranked service: deviations, ranks and one error template ("failed" has no family token; "connection" etc. do not occur)
FAULT = RANK + f""", best AS (SELECT tenant_id, window_id, series[:4] AS target_service FROM ranks WHERE rank = 1),
  fp AS (SELECT tenant_id, window_id, {_FAM.format(x='series')} AS fault, series, z, 0 AS rank FROM zs JOIN best USING (tenant_id, window_id) WHERE series[:4] = target_service AND z > 0
    UNION ALL SELECT tenant_id, window_id, {_FAM.format(x='series')}, series, 0, rank FROM ranks JOIN best USING (tenant_id, window_id) WHERE series[:4] = target_service),
  fs AS (SELECT tenant_id, window_id, fault, sum(CASE WHEN rank = 0 THEN least(500, z) * {_WEIGHT} ELSE 1.5 / rank END) AS score, coalesce(arg_min(series, -z) FILTER (rank = 0), arg_min(series, rank) FILTER (rank > 0)) AS lead,
    coalesce(max(z) FILTER (rank = 0), 0) AS lead_z FROM fp GROUP BY 1, 2, 3),
  fb AS (SELECT *, row_number() OVER (PARTITION BY tenant_id, window_id ORDER BY score DESC, {_ORD}) AS n FROM fs)"""


def _z(d, a):
    return reuse(TS.deviation(d, TS.baseline_stats(d), a))


def _ranks(d, a):
    return reuse(R.robust_rank(R.scale_series(d), a))


def _logs(spark, sf, d):
    """Template counts on the metric rows, and the templates."""
    lg = X.logs(spark, sf)
    msgs, tpl = TP.mine_templates(lg)
    times = d.groupBy(*WIN, "t", "row").agg(F.lit(1).alias("_n")).drop("_n")
    return TP.dense_counts(TP.template_counts(lg, msgs, X.BIN, X.WINDOW), times), tpl


def _corr(spark, sf, d, a):
    counts, tpl = _logs(spark, sf, d)
    return reuse(R.metric_log_correlation(d, counts, a)), tpl


@query("e1_scale_series", with_(RANK) + "SELECT tenant_id, window_id, t, row, series, round(v, 6) AS v FROM scaled")
def _(spark, sf):
    return rounded(plain(R.scale_series(split(spark, sf))), "v")


@query("e2_robust_rank", with_(RANK) + "SELECT tenant_id, window_id, series, round(score, 6) AS score, rank FROM ranks")
def _(spark, sf):
    d = kept(spark, sf)
    return rounded(_ranks(d, anchors(d)), "score")


@query("e3_service_topk", with_(RANK) + """SELECT * FROM (SELECT tenant_id, window_id, series[:4] AS service, min(rank) AS best_rank, CAST(row_number() OVER (PARTITION BY tenant_id, window_id ORDER BY min(rank)) AS INT) AS position FROM ranks GROUP BY 1, 2, 3) WHERE position <= 5""")
def _(spark, sf):
    d = kept(spark, sf)
    return R.service_topk(_ranks(d, anchors(d)), _SVCS)


@query("e4_metric_log_correlation", with_(CORR) + "SELECT tenant_id, window_id, series, tpl AS template, round(r, 6) + 0.0 AS r FROM cr")
def _(spark, sf):
    d = kept(spark, sf)
    c, tpl = _corr(spark, sf, d, anchors(d))
    name = F.concat("container_name", F.when(F.col("is_error"), " E").otherwise(" P"))
    c = c.join(tpl.select("tenant_id", "template_id", name.alias("template")), ["tenant_id", "template_id"])
    return c.select(*TS.SERIES, "template", (F.round("r", 6) + 0.0).alias("r"))


@query("e5_service_scores", with_(SERVICE) + "SELECT tenant_id, window_id, service, round(score, 6) AS score, position FROM svr")
def _(spark, sf):
    d = kept(spark, sf)
    a = anchors(d)
    c, tpl = _corr(spark, sf, d, a)
    return rounded(R.service_scores(_z(d, a), c, tpl, _SVCS), "score")


def _inferred(d, a):
    ranks = _ranks(d, a)
    best = R.service_topk(ranks, _SVCS).where("position = 1").select(*WIN, F.col("service").alias("target_service"))
    return R.infer_fault(best, _z(d, a), ranks, None, _SVCS), ranks


@query("e6_infer_fault", with_(FAULT) + """SELECT tenant_id, window_id, target_service, fault, round(score, 6) AS fault_score, lead, round(lead_z, 6) AS lead_z FROM fb JOIN best USING (tenant_id, window_id) WHERE n = 1""")
def _(spark, sf):
    d = kept(spark, sf)
    return rounded(_inferred(d, anchors(d))[0].drop("scores"), "fault_score", "lead_z")


# a high bar, so that some windows fall back
@query("e7_fault_fallback", with_(FAULT) + f"""SELECT tenant_id, window_id, target_service, CASE WHEN score >= 6 THEN fault ELSE {_FAM.format(x='top')} END AS fault, CASE WHEN score >= 6 THEN lead ELSE top END AS lead
FROM fb JOIN best USING (tenant_id, window_id) JOIN (SELECT tenant_id, window_id, series AS top FROM ranks WHERE rank = 1) USING (tenant_id, window_id) WHERE n = 1""")
def _(spark, sf):
    d = kept(spark, sf)
    inf, ranks = _inferred(d, anchors(d))
    return R.fault_fallback(inf, ranks, _SVCS, least=6.0).select(*WIN, "target_service", "fault", "lead")


@query("e8_rca_confidence", with_(EV) + """SELECT event_id, round(CASE WHEN event_type = 'click' THEN 0.90 WHEN value - 20 > 0 THEN least(0.95, 0.70 + (value - 20) / 200) ELSE 0.5 END, 6) AS confidence FROM ev""")
def _(spark, sf):
    e = X.events(spark, sf)
    c = R.rca_confidence(F.when(F.col("event_type") == "click", "rank").otherwise("score"), F.col("value") - 20)
    return rounded(e.select("event_id", c.alias("confidence")), "confidence")


_REASON = """'Diagnosed ' || target_service || ' (' || fault || ') as root cause from aggregated fault evidence led by ''' || lead || ''' (z=' || printf('%.1f', lead_z) || ', scores=' || sc || '). Top candidates: ' || c || '.'"""


@query("e9_rca_reason", with_(FAULT) + f""", x AS (SELECT tenant_id, window_id, string_agg(fault || ':' || printf('%.1f', score), ',' ORDER BY n) FILTER (n <= 3) AS sc FROM fb GROUP BY 1, 2),
  c AS (SELECT tenant_id, window_id, string_agg(series, ', ' ORDER BY rank) AS c FROM ranks WHERE rank <= 3 GROUP BY 1, 2)
SELECT tenant_id, window_id, {_REASON} AS reasoning FROM fb JOIN best USING (tenant_id, window_id) JOIN x USING (tenant_id, window_id) JOIN c USING (tenant_id, window_id) WHERE n = 1""")
def _(spark, sf):
    d = kept(spark, sf)
    a = anchors(d)
    return R.rca_rank(d, a, _z(d, a), None, _SVCS).select(*WIN, "reasoning")


@query("e10_rca_rank", with_(FAULT) + """SELECT tenant_id, window_id, 'rank' AS engine, target_service, fault, 0.9 AS confidence, k AS service_top_k FROM fb JOIN best USING (tenant_id, window_id)
JOIN (SELECT tenant_id, window_id, string_agg(s, ',' ORDER BY r) FILTER (n <= 5) AS k FROM (SELECT tenant_id, window_id, series[:4] AS s, min(rank) AS r, row_number() OVER (PARTITION BY tenant_id, window_id ORDER BY min(rank)) AS n FROM ranks GROUP BY 1, 2, 3) GROUP BY 1, 2) USING (tenant_id, window_id) WHERE n = 1""")
def _(spark, sf):
    d = kept(spark, sf)
    a = anchors(d)
    z = _z(d, a)
    out = R.rca(R.rca_rank(d, a, z, None, _SVCS), R.rca_score(z, None, None, _SVCS))
    return out.select(*WIN, "engine", "target_service", "fault", "confidence", F.array_join("service_top_k", ",").alias("service_top_k"))


@query("e10_rca_score", with_(SERVICE) + """SELECT tenant_id, window_id, 'score' AS engine, CASE WHEN score > 0 THEN service ELSE 'svc0' END AS target_service,
  round(CASE WHEN score > 0 THEN least(0.95, 0.70 + score / 200) ELSE 0.5 END, 6) AS confidence FROM svr WHERE position = 1""")
def _(spark, sf):
    d = kept(spark, sf)
    a = anchors(d)
    c, tpl = _corr(spark, sf, d, a)
    out = R.rca_score(_z(d, a), c, tpl.withColumn("window_id", F.explode(F.array(F.lit(-1).cast("long")))), _SVCS)
    return rounded(out.select(*WIN, "engine", "target_service", "confidence"), "confidence")
