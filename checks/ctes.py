"""The fixture views in SQL, as common table expressions to put in front of an oracle."""

EV = """ev AS (SELECT event_id, user_id, event_type, value, CAST(floor(epoch(ts)) AS BIGINT) AS t,
  CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events)"""
TEL = EV + """, tel AS (SELECT event_id AS seq, t, 'tenant-' || (user_id % 4) AS tenant_id, 'svc' || (user_id % 6) AS service,
  CASE event_type WHEN 'error' THEN 'service_error_rate' WHEN 'view' THEN 'service_latency_p95' WHEN 'click' THEN 'cpu'
    WHEN 'purchase' THEN 'mem' ELSE 'application_log_event' END AS signal_name,
  CASE event_type WHEN 'error' THEN round(value / 500, 6) WHEN 'signup' THEN NULL ELSE value END AS value_num, k FROM ev)"""
LOGS = EV + """, lg AS (SELECT event_id AS seq, t, 'tenant-' || (user_id % 4) AS tenant_id, 'svc' || (user_id % 6) AS container_name,
  CASE WHEN event_type = 'error' THEN 'request ' || event_id || ' failed after ' || CAST(floor(value) AS BIGINT) || ' ms from 10.0.0.' || user_id
    ELSE event_type || ' ok user ' || user_id END AS message,
  CASE WHEN event_type = 'error' THEN 'error' ELSE 'info' END AS level FROM ev)"""
ALERT_BODY = """al0 AS (SELECT event_id AS alert_id, t, 'tenant-' || (user_id % 4) AS tenant_id,
  ['tenant-payment', 'tenant-checkout', 'other'][user_id % 3 + 1] AS namespace, 'svc' || (user_id % 6) AS service,
  ['PodOOMKilled', 'PodCrashLooping', 'ServiceStuck', 'SQSQueueBacklog', 'HighLoad'][k % 5 + 1] AS alertname,
  CASE WHEN event_id % 10 = 0 THEN 'resolved' ELSE 'firing' END AS status, k FROM ev WHERE event_type = 'error')"""
ALERTS = EV + ", " + ALERT_BODY
EDGES = """edges(service, depends_on) AS (VALUES ('svc0','svc2'),('svc0','svc4'),('svc2','svc4'),('svc1','svc3'),('svc1','svc5'),('svc3','svc5'))"""
BINS = TEL + """, bins AS (SELECT tenant_id, t // 432000 AS window_id, (t // 3600) * 3600 AS t, service || '_' || signal_name AS series,
  arg_max(value_num, seq) AS v FROM tel WHERE value_num IS NOT NULL GROUP BY 1, 2, 3, 4)"""
GRID = BINS + """, times AS (SELECT tenant_id, window_id, t, CAST(row_number() OVER (PARTITION BY tenant_id, window_id ORDER BY t) - 1 AS INT) AS row
    FROM (SELECT DISTINCT tenant_id, window_id, t FROM bins)),
  names AS (SELECT DISTINCT tenant_id, window_id, series FROM bins),
  grid AS (SELECT tenant_id, window_id, t, row, series, coalesce(last_value(v IGNORE NULLS) OVER (
      PARTITION BY tenant_id, window_id, series ORDER BY t ROWS UNBOUNDED PRECEDING), 0) AS v
    FROM times JOIN names USING (tenant_id, window_id) LEFT JOIN bins USING (tenant_id, window_id, t, series))"""
# baseline and the anomaly row: the row after the baseline with the largest error-rate value
LIVE = GRID + """, wins AS (SELECT tenant_id, window_id, CAST(max(row) + 1 AS INT) AS n, CAST(greatest(10, floor((max(row) + 1) * 0.8)) AS INT) AS baseline_len FROM grid GROUP BY 1, 2),
  split AS (SELECT g.*, w.baseline_len, g.row < w.baseline_len AS is_baseline FROM grid g JOIN wins w USING (tenant_id, window_id)),
  anchors AS (SELECT tenant_id, window_id, row AS anomaly_row, t AS anchor_t FROM (SELECT *, row_number() OVER (PARTITION BY tenant_id, window_id
     ORDER BY v DESC, row, series) AS rn FROM split WHERE NOT is_baseline AND series LIKE '%error%') WHERE rn = 1)"""
STATS = LIVE + """, st0 AS (SELECT tenant_id, window_id, series, coalesce(avg(v) FILTER (is_baseline), 0) AS mean,
     coalesce(stddev_samp(v) FILTER (is_baseline), 0) AS std FROM split GROUP BY 1, 2, 3),
  stats AS (SELECT *, greatest(std, 0.05 * abs(mean) + 0.05) AS reg_std FROM st0)"""
Z = STATS + """, zs AS (SELECT tenant_id, window_id, series, max(abs(v - mean) / reg_std) AS z FROM grid JOIN anchors USING (tenant_id, window_id)
    JOIN stats USING (tenant_id, window_id, series) WHERE row BETWEEN anomaly_row AND anomaly_row + 30 GROUP BY 1, 2, 3)"""


def with_(*parts: str) -> str:
    return "WITH " + ", ".join(parts) + " "
