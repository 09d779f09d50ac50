"""G: the streaming forms, run over the events table as a stream and compared with the batch rule."""
import uuid

from pyspark.sql import functions as F

from checks import query
from checks.ctes import ALERTS, EV, TEL, with_
from checks.states import FOLD
from mendstream.functions.scalars import series_name
from mendstream.plans import fixtures as X
from mendstream.session import ROCKSDB, reuse, scratch_dir
from mendstream.streaming import stateful as ST


def source(spark, sf):
    """The events file as a stream, with the columns of the event view."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    raw = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    ts = F.col("ts").cast("timestamp")
    return raw.select("event_id", "user_id", "event_type", "value", ts.alias("ts"), F.unix_seconds(ts).alias("t"), F.get_json_object("props", "$.k").cast("int").alias("k"),
                      F.concat(F.lit("tenant-"), F.col("user_id") % 4).alias("tenant_id"), F.concat(F.lit("svc"), F.col("user_id") % 6).alias("service"))


def run(df, mode="append", finish=None):
    """Drain the stream into files and read them back; ``finish`` (see ``ending``) is called after a first drain and the rest drained then."""
    spark = df.sparkSession
    root = f"{scratch_dir(spark)}/stream-{uuid.uuid4()}"
    for before in [None, finish] if finish else [None]:
        if before:
            before()
        q = df.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/state").outputMode(mode).trigger(availableNow=True).start()
        q.awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{root}/out")


def ending(rows, ts="ts"):
    """``rows`` and a call that ends them: a last row after all times, without values, lets the watermark pass every second before it and stays open itself.
    The columns of ``rows`` must be nullable, as those of the last row are, since keys keep their type in the state."""
    spark = rows.sparkSession
    folder = f"{scratch_dir(spark)}/end-{uuid.uuid4()}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(path)
    last = spark.range(1).select(*[(F.lit("9999-12-31") if c == ts else F.lit(None)).cast(k).alias(c) for c, k in rows.dtypes])
    return rows.unionByName(spark.readStream.schema(last.schema).parquet(folder)), lambda: last.write.mode("append").parquet(folder)


@query("g1_stream_cooldown", "WITH RECURSIVE " + ALERTS + """, acc AS (SELECT namespace, service, min(t) AS t FROM al0 GROUP BY 1, 2
    UNION ALL SELECT a.namespace, a.service, min(f.t) FROM acc a JOIN al0 f USING (namespace, service) WHERE f.t > a.t + 25000 GROUP BY a.namespace, a.service, a.t),
  f AS (SELECT namespace, service, t, min(alert_id) AS alert_id FROM al0 GROUP BY 1, 2, 3)
SELECT namespace || '/' || service AS lock_key, alert_id, t, alert_id IN (SELECT f.alert_id FROM f JOIN acc USING (namespace, service, t)) AS accepted FROM al0
WHERE t + 1 <= (SELECT epoch(max(ts)) FROM events WHERE event_type = 'error')""")
def _(spark, sf):
    spaces = F.array(F.lit("tenant-payment"), F.lit("tenant-checkout"), F.lit("other"))
    a = source(spark, sf).where("event_type = 'error'").select(
        F.concat_ws("/", F.element_at(spaces, (F.col("user_id") % 3 + 1).cast("int")), "service").alias("lock_key"), F.col("event_id").alias("alert_id"), "ts", F.lit(25000).alias("cooldown"))
    return run(ST.stream_cooldown(a, late="0 seconds"))


@query("g2_stream_incidents", "WITH RECURSIVE " + FOLD + " SELECT tenant_id, alert_id, t, service, role, root_service, start_time FROM fo WHERE role <> ''")
def _(spark, sf):
    s = source(spark, sf)
    ev = s.where("event_type = 'error' OR (event_type = 'purchase' AND k >= 80)").select(
        "tenant_id", "ts", F.when(F.col("event_type") == "error", 1).when(F.col("event_type") == "purchase", 0).alias("kind"), F.col("event_id").alias("alert_id"), "service")
    ev, finish = ending(ev)
    return run(ST.stream_incidents(ev, X.edges(spark), late="0 seconds"), finish=finish)


@query("d1_stream_ewma", "WITH RECURSIVE " + TEL + """, b AS (SELECT tenant_id, service, t, seq, value_num AS v FROM tel WHERE signal_name = 'service_latency_p95'),
  n AS (SELECT *, row_number() OVER (PARTITION BY tenant_id, service ORDER BY t, seq) AS i FROM b),
  ew AS (SELECT tenant_id, service, t, seq, i, v AS y FROM n WHERE i = 1 UNION ALL SELECT n.tenant_id, n.service, n.t, n.seq, n.i, 0.1 * n.v + 0.9 * ew.y FROM ew JOIN n ON n.tenant_id = ew.tenant_id AND n.service = ew.service AND n.i = ew.i + 1)
SELECT tenant_id, service AS series, t, seq, round(sqrt(y), 6) AS ewma FROM ew""")
def _(spark, sf):
    p = source(spark, sf).where("event_type = 'view'").select("tenant_id", F.col("service").alias("series"), "t", F.col("event_id").alias("seq"), F.col("value").alias("v"))
    return run(ST.stream_ewma(p)).select("tenant_id", "series", "t", "seq", F.round(F.sqrt("ewma"), 6).alias("ewma"))


# seconds and windows that the watermark has not passed stay open: the watermark has not passed its end
@query("g9_stream_malformed", with_(EV) + """SELECT (t // 21600) * 21600 AS window_start, count(*) AS n, count(*) FILTER (k = 0) AS rejected, count(*) FILTER (k = 0) / count(*) > 0.005 AS alert FROM ev GROUP BY 1 HAVING (t // 21600) * 21600 + 21600 <= (SELECT max(t) FROM ev)""")
def _(spark, sf):
    s = source(spark, sf).withColumn("errors", F.when(F.col("k") == 0, F.array(F.lit("ts"))).otherwise(F.array().cast("array<string>")))
    return run(ST.stream_malformed_rate(s, window="6 hours", late="0 seconds"))


@query("g7_stream_idempotency", with_(EV) + "SELECT 'tenant-' || (user_id % 4) AS tenant_id, 'key-' || k AS idempotency_key, count(DISTINCT user_id % 4) AS n FROM ev GROUP BY 1, 2")
def _(spark, sf):
    s = source(spark, sf).select("tenant_id", F.concat(F.lit("key-"), F.col("k")).alias("idempotency_key"), "ts")
    return run(ST.stream_idempotency(s, within="60 days")).groupBy("tenant_id", "idempotency_key").agg(F.count("*").alias("n"))


# seconds the watermark (one minute behind) has not passed stay open
@query("g10_stream_volume", with_(EV) + "SELECT t, 'tenant-' || (user_id % 4) AS tenant_id, event_type AS signal_name, count(*) AS n FROM ev GROUP BY 1, 2, 3 HAVING t + 1 <= (SELECT epoch(max(ts)) FROM events) - 60")
def _(spark, sf):
    return run(ST.stream_volume(source(spark, sf).withColumnRenamed("event_type", "signal_name")))


@query("g12_late_rows", with_(EV) + "SELECT event_id FROM ev WHERE k > 60")
def _(spark, sf):
    s = source(spark, sf).withColumn("received_at", F.timestamp_seconds(F.unix_seconds("ts") + F.col("k")))
    return run(ST.late_rows(s).select("event_id"))


# five-day windows every two and a half days, each closed window through the batch detector
@query("g11_stream_detect")
def _(spark, sf):
    from mendstream.operators import detectors as D, timeseries as TS

    root = f"{scratch_dir(spark)}/stream-{uuid.uuid4()}"
    tel = source(spark, sf).where("event_type <> 'signup'")
    signal = F.when(F.col("event_type") == "error", "service_error_rate").when(F.col("event_type") == "view", "service_latency_p95").when(F.col("event_type") == "click", "cpu").otherwise("mem")
    pts = tel.select("ts", "t", "tenant_id", series_name(F.col("service"), signal, X.SERVICES).alias("series"), F.col("value").alias("value_num"), F.col("event_id").alias("seq"))

    def detect(bins):
        df = reuse(TS.baseline_split(TS.align_series(reuse(bins))))
        flags = D.detect(df, None, max_rows=120)
        start = df.groupBy(*TS.WIN).agg(F.min("baseline_len").alias("search_start"))
        return TS.first_detection(flags, start)

    def write(df, batch_id):
        df.write.mode("overwrite").parquet(f"{root}/out/batch={batch_id}")

    q = ST.stream_detect(pts, detect, write, f"{root}/state", window="120 hours", slide="60 hours", late="1 hour", width=X.BIN).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(f"{root}/out").select("tenant_id", "window_id", "anomaly_row", "n_flagged")
