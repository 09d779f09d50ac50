"""D: detectors and log templates."""
from pyspark.sql import Window as W, functions as F

from checks import query
from checks.ctes import EV, LIVE, with_
from checks.views import kept, rounded, split
from mendstream.operators import detectors as D, forests as FO, templates as TP, timeseries as TS
from mendstream.plans import fixtures as X
from mendstream.plans.detect import first_anomalies
from mendstream.session import reuse

# Averages of two-digit values fall on rounding borders; their square roots do not.
# The moving average by recursion over the rows of each KPI series
_EWMA = LIVE + """, kp AS (SELECT * FROM split WHERE series LIKE '%latency%' OR series LIKE '%error%'),
  ew AS (SELECT tenant_id, window_id, series, row, v, v AS y FROM kp WHERE row = 0
    UNION ALL SELECT k.tenant_id, k.window_id, k.series, k.row, k.v, e.y + 0.1 * (k.v - e.y) FROM ew e JOIN kp k
      ON k.tenant_id = e.tenant_id AND k.window_id = e.window_id AND k.series = e.series AND k.row = e.row + 1),
  rs AS (SELECT e.*, e.v - e.y AS res, k.is_baseline FROM ew e JOIN kp k USING (tenant_id, window_id, series, row)),
  sd AS (SELECT tenant_id, window_id, series, CASE WHEN coalesce(stddev_samp(res) FILTER (is_baseline), 0) = 0 THEN 1e-6 ELSE stddev_samp(res) FILTER (is_baseline) END AS s FROM rs GROUP BY 1, 2, 3),
  det AS (SELECT r.*, abs(res) > {k} * s AS is_anomaly, abs(res) / s AS score FROM rs r JOIN sd USING (tenant_id, window_id, series))"""


@query("d1_ewma_detect", "WITH RECURSIVE " + _EWMA.format(k="5.0") + " SELECT tenant_id, window_id, series, row, round(sqrt(y), 6) AS ewma, round(score, 6) AS score, is_anomaly FROM det")
def _(spark, sf):
    d = D.ewma_detect(D.kpi_series(split(spark, sf)), max_rows=120)
    return rounded(d.select("tenant_id", "window_id", "series", "row", F.sqrt("ewma").alias("ewma"), "score", "is_anomaly"), "ewma", "score")


# the same with a carry between blocks of 32 rows
@query("d1_ewma_blocked", "WITH RECURSIVE " + _EWMA.format(k="3.0") + " SELECT tenant_id, window_id, series, row, round(sqrt(y), 6) AS ewma, round(score, 6) AS score, is_anomaly FROM det")
def _(spark, sf):
    d = D.ewma_detect(D.kpi_series(split(spark, sf)), k=3.0, block_rows=32)
    return rounded(d.select("tenant_id", "window_id", "series", "row", F.sqrt("ewma").alias("ewma"), "score", "is_anomaly"), "ewma", "score")


@query("d5_combine_flags", "WITH RECURSIVE " + _EWMA.format(k="3.0") + """ SELECT tenant_id, window_id, row, t, bool_or(is_anomaly) AS is_anomaly FROM (
  SELECT tenant_id, window_id, row, is_anomaly FROM det UNION ALL SELECT tenant_id, window_id, row, v > 280 FROM split WHERE series LIKE '%mem')
  JOIN (SELECT DISTINCT tenant_id, window_id, row, t FROM grid) USING (tenant_id, window_id, row) GROUP BY 1, 2, 3, 4""")
def _(spark, sf):
    d = kept(spark, sf)
    kpi = D.ewma_detect(D.kpi_series(d), k=3.0, max_rows=120)
    other = d.where(F.col("series").endswith("mem")).withColumn("is_anomaly", F.col("v") > 280).withColumn("score", F.lit(0.0))
    return D.combine_flags(other, kpi).drop("score")


@query("d6_severity", with_(EV) + "SELECT event_id, round(least(0.95, greatest(0.4, abs(value / 100 - 0.5) * 2)), 6) AS severity FROM ev")
def _(spark, sf):
    e = X.events(spark, sf)
    return rounded(e.select("event_id", D.severity(F.col("value") / 100 - 0.5).alias("severity")), "severity")


@query("b8_split_kpi_resource", with_(LIVE) + """SELECT DISTINCT tenant_id, window_id, series, CASE WHEN series LIKE '%latency%' OR series LIKE '%error%' THEN 'kpi' ELSE 'resource' END AS kind FROM split""")
def _(spark, sf):
    d = kept(spark, sf)
    kpi, res = D.kpi_series(d), D.resource_series(d)
    names = lambda x, k: x.select(*TS.SERIES, F.lit(k).alias("kind")).distinct()
    return names(kpi, "kpi").unionByName(names(res, "resource"))


@query("d2_iforest_detect")
def _(spark, sf):
    return rounded(D.iforest_detect(D.resource_series(split(spark, sf))), "score")


@query("d3_rrcf_detect")
def _(spark, sf):
    return rounded(D.rrcf_detect(D.resource_series(split(spark, sf))), "score")


# every row has a score; none is displaced by more than all other rows of its window
@query("d3_rrcf_rows", with_(LIVE) + "SELECT DISTINCT tenant_id, window_id, row, t, true AS in_range FROM split")
def _(spark, sf):
    d = split(spark, sf)
    n = d.select("tenant_id", "window_id", "n_rows").distinct()
    return D.rrcf_detect(d, trees=20).join(n, TS.WIN).select("tenant_id", "window_id", "row", "t", F.col("score").between(0, F.col("n_rows") - 1).alias("in_range"))


_PATH = "CASE WHEN {n} <= 1 THEN 0 WHEN {n} = 2 THEN 1 ELSE 2 * (ln({n} - 1) + 0.5772156649) - 2 * ({n} - 1) / {n}::DOUBLE END"


# scores from given nodes: tree k cuts the k-th series of the window at its baseline mean
@query("d2_forest_scores", with_(LIVE) + f""", s AS (SELECT tenant_id, window_id, series, CAST(row_number() OVER (PARTITION BY tenant_id, window_id ORDER BY series) AS INT) - 1 AS k FROM (SELECT DISTINCT tenant_id, window_id, series FROM split)),
  c AS (SELECT tenant_id, window_id, series, round(avg(v) FILTER (is_baseline), 6) AS cut FROM split GROUP BY 1, 2, 3),
  n AS (SELECT tenant_id, window_id, series, any_value(cut) AS cut, count(*) FILTER (is_baseline AND v < cut) AS low, count(*) FILTER (is_baseline AND v >= cut) AS high, count(*) FILTER (is_baseline) AS m FROM split JOIN c USING (tenant_id, window_id, series) JOIN s USING (tenant_id, window_id, series) WHERE k < 5 GROUP BY 1, 2, 3),
  w AS (SELECT tenant_id, window_id, row, any_value(t) AS t, avg(1 + CASE WHEN v < cut THEN {_PATH.format(n='low')} ELSE {_PATH.format(n='high')} END) AS d, any_value({_PATH.format(n='m')}) AS p FROM split JOIN n USING (tenant_id, window_id, series) GROUP BY 1, 2, 3)
SELECT tenant_id, window_id, row, t, round(pow(2, -d / p), 6) AS score FROM w""")
def _(spark, sf):
    d = kept(spark, sf)
    cut = d.groupBy(*TS.SERIES).agg(F.round(F.avg(F.when(F.col("is_baseline"), F.col("v"))), 6).alias("cut"))
    tree = (F.row_number().over(W.partitionBy(*TS.WIN).orderBy("series")) - 1).cast("int")
    roots = cut.withColumn("tree", tree).where("tree < 5")
    base = d.where("is_baseline").join(roots, TS.SERIES).groupBy(*TS.WIN, "tree", "cut").agg(F.count("*").cast("int").alias("m"), F.count_if(F.col("v") < F.col("cut")).cast("int").alias("low"))
    leaf = lambda node, size: F.struct(F.lit(node).alias("node"), F.lit(-1).alias("feature"), F.lit(-1).alias("low"), F.lit(-1).alias("high"), size.alias("size"), F.lit(1).alias("depth"))
    root = F.struct(F.lit(0).alias("node"), F.col("tree").alias("feature"), F.lit(1).alias("low"), F.lit(2).alias("high"), F.col("m").alias("size"), F.lit(0).alias("depth"))
    nodes = base.select(*TS.WIN, F.col("tree").alias("block"), "tree", "cut", F.explode(F.array(root, leaf(1, F.col("low")), leaf(2, F.col("m") - F.col("low")))).alias("n")).select(*TS.WIN, "block", "tree", "cut", "n.*")
    return rounded(FO.forest_scores(FO.row_vectors(d), reuse(nodes)).drop("is_baseline"), "score")


@query("d4_bocpd_detect")
def _(spark, sf):
    return D.bocpd_detect(split(spark, sf))


@query("d7_first_anomalies")
def _(spark, sf):
    return first_anomalies(X.telemetry(spark, sf), X.BIN, X.WINDOW)


# the fixture's messages have two shapes per container, so the templates can be named in advance
@query("d8_mine_templates", """SELECT 'tenant-' || (user_id % 4) AS tenant_id, 'svc' || (user_id % 6) AS container_name,
  CASE WHEN event_type = 'error' THEN 'svc<NUM> request <NUM> failed after <NUM> ms from <IP>'
    ELSE 'svc<NUM> ' || CASE WHEN count(DISTINCT event_type) > 1 THEN '<*>' ELSE any_value(event_type) END || ' ok user <NUM>' END AS pattern,
  event_type = 'error' AS is_error, count(*) AS n FROM events GROUP BY 1, 2, event_type = 'error', CASE WHEN event_type = 'error' THEN 1 ELSE 0 END,
  CASE WHEN event_type = 'error' THEN event_type END""")
def _(spark, sf):
    _m, t = TP.mine_templates(X.logs(spark, sf))
    return t.select("tenant_id", "container_name", "pattern", "is_error", "n")
