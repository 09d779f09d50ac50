"""Structured Streaming forms of the stateful rules."""
from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from mendstream import fixed
from mendstream.operators.forests import LiveForest
from mendstream.operators.graph import service_parts
from mendstream.plans.verdict import verdicts
from mendstream.session import bounded, exists, reuse

OUT_ROWS = 10_000  # rows that a stateful rule hands on at once


def closed_seconds(rows: DataFrame, ts: str, late: str, keys: list[str], *aggs) -> DataFrame:
    """One row per second and key, handed on once the watermark has passed the second: ``at`` (its event time), ``t`` and ``aggs``.

    This is the ordering buffer of the rules below. Micro-batches may bring rows in any order within ``late``; what leaves here is complete, never older than what left
    before, and summed before the shuffle, so a busy key holds one row a second.
    """
    per = rows.withWatermark(ts, late).groupBy(F.window(ts, "1 second").alias("w"), *keys).agg(*aggs)
    return per.select(F.window_time("w").alias("at"), F.unix_seconds("w.start").alias("t"), *[c for c in per.columns if c != "w"])


class Cooldown(StatefulProcessor):
    """Accepts the first alert more than the cooldown after the last accepted one of the key. The state is that one's time, dropped by an
    event-time timer when the cooldown is over."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "t long, until long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # the closed seconds of one key since the last micro-batch
        pdf = pd.concat(list(rows)).sort_values("t")
        last, until = self.last.get() if self.last.exists() else (None, None)
        before, flags = until, []
        for t, gap in zip(pdf["t"], pdf["cooldown"]):
            ok = last is None or t > last + gap
            flags.append(bool(ok))
            if ok:
                last, until = int(t), (int(t) + int(gap) + 1) * 1000
        if until != before:
            if before is not None:
                self.handle.deleteTimer(before)
            self.last.update((last, until))
            self.handle.registerTimer(until)
        yield pdf[["lock_key", "alert_ids", "t"]].assign(accepted=flags)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.last.clear()
        yield pd.DataFrame({"lock_key": pd.Series(dtype=str), "alert_ids": pd.Series(dtype=object), "t": pd.Series(dtype="int64"), "accepted": pd.Series(dtype=bool)})

    def close(self) -> None:
        pass


def stream_cooldown(alerts: DataFrame, ts: str = "ts", late: str = "1 minute") -> DataFrame:
    """``alerts``: ``lock_key, alert_id, ts, cooldown`` as a stream, in any order within ``late``: ``lock_key, alert_id, t, accepted`` of every
    alert whose second the watermark has passed.

    The answer is that of the batch rule on the same alerts. Alerts later than the watermark are dropped, as with every window of the stream.
    """
    rows = alerts.select(ts, "lock_key", "alert_id", F.col("cooldown").cast("long").alias("cooldown"))
    per = closed_seconds(rows, ts, late, ["lock_key"], F.max("cooldown").alias("cooldown"), F.array_sort(F.collect_list("alert_id")).alias("alert_ids"))
    kept = per.groupBy("lock_key").transformWithStateInPandas(Cooldown(), "lock_key string, alert_ids array<long>, t long, accepted boolean", "Append", "EventTime")
    each = kept.select("lock_key", F.posexplode("alert_ids").alias("n", "alert_id"), "t", "accepted")
    return each.select("lock_key", "alert_id", "t", (F.col("accepted") & (F.col("n") == 0)).alias("accepted"))


class Incidents(StatefulProcessor):
    """Active incidents of one connected part of a tenant's services: root service -> start time and creation order. The state is empty when
    all are closed."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.active = handle.getMapState("active", "service string", "start long, ord long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # the closed seconds of one part since the last micro-batch, a row for each service; held as flat numbers, a few bytes a row
        names: dict[str, int] = {}
        depends, tenant, held = [], None, []
        for pdf in rows:
            for service, needs in zip(pdf["service"], pdf["depends"]):
                if service not in names:
                    names[service] = len(names)
                    depends.append(list(needs))
            tenant = pdf["tenant_id"].iloc[0]
            ids = [np.asarray(x, np.int64) for x in pdf["alert_ids"]]
            code = np.fromiter((names[s] for s in pdf["service"]), np.int32, len(pdf))
            held.append((pdf["t"].to_numpy(np.int64), pdf["kind"].to_numpy(np.int8), code, np.fromiter(map(len, ids), np.int32, len(ids)), np.concatenate(ids)))
        t, kind, code, size, ids = (np.concatenate(c) for c in zip(*held))
        del held
        at = np.cumsum(size, dtype=np.int64) - size
        order = np.lexsort((np.append(ids, 0)[at], kind, t))
        service = list(names)
        roots = {k[0]: (v[0], v[1]) for k, v in self.active.iterator()}
        kept, n = set(roots), max((o for _, o in roots.values()), default=-1) + 1
        for some in np.array_split(order, -(-len(order) // OUT_ROWS)):
            out = []
            for i in some.tolist():
                own = service[code[i]]
                if kind[i] == 0:
                    roots.pop(own, None)
                    continue
                if own in roots:
                    role, root = "duplicate", own
                else:
                    up = sorted((roots[s][1], s) for s in depends[code[i]] if s in roots)
                    role, root = ("symptom", up[0][1]) if up else ("root", own)
                    if role == "root":
                        roots[root] = (int(t[i]), n)
                        n += 1
                out.append((tenant, ids[at[i] : at[i] + size[i]].tolist(), int(t[i]), own, role, root, roots[root][0]))
            yield pd.DataFrame(out, columns=["tenant_id", "alert_ids", "t", "service", "role", "root_service", "start_time"])
        for s in kept - set(roots):
            self.active.removeKey((s,))
        for s, v in roots.items():
            self.active.updateValue((s,), v)

    def close(self) -> None:
        pass


def stream_incidents(events: DataFrame, edges: DataFrame, ts: str = "ts", late: str = "1 minute") -> DataFrame:
    """``events``: ``tenant_id, ts, kind (0 close, 1 alert), alert_id, service`` as a stream in any order within ``late``; ``edges``: ``service, depends_on`` as a table.

    Every alert whose second the watermark has passed with its role and incident, as the batch rule gives them. The state of a tenant is split by the connected
    parts of the dependency graph.
    """
    parts = bounded(reuse(service_parts(edges)))
    rows = events.select(ts, "tenant_id", "kind", "service", "alert_id").join(parts, "service", "left")
    rows = rows.withColumn("part", F.coalesce("part", "service"))
    per = closed_seconds(rows, ts, late, ["tenant_id", "part", "service", "kind"], F.array_sort(F.collect_list("alert_id")).alias("alert_ids"), F.coalesce(F.first("depends"), F.array().cast("array<string>")).alias("depends"))
    fate = per.groupBy("tenant_id", "part").transformWithStateInPandas(
        Incidents(), "tenant_id string, alert_ids array<long>, t long, service string, role string, root_service string, start_time long", "Append", "EventTime")
    each = fate.select("tenant_id", F.posexplode("alert_ids").alias("n", "alert_id"), "t", "service", "role", "root_service", "start_time")
    return each.withColumn("role", F.when((F.col("role") == "root") & (F.col("n") > 0), "duplicate").otherwise(F.col("role"))).drop("n")


class MovingAverage(StatefulProcessor):
    """Moving average and the residual per series; the state is the last average."""

    def __init__(self, alpha: float):
        self.alpha = alpha

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.y = handle.getValueState("y", "y double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows)).sort_values(["t", "seq"])
        y = self.y.get()[0] if self.y.exists() else None
        out = []
        for v in pdf["v"]:
            y = float(v) if y is None else self.alpha * float(v) + (1 - self.alpha) * y
            out.append(y)
        self.y.update((y,))
        yield pdf[["tenant_id", "series", "t", "seq", "v"]].assign(ewma=out)

    def close(self) -> None:
        pass


def stream_ewma(points: DataFrame, alpha: float = fixed.EWMA_ALPHA) -> DataFrame:
    return points.select("tenant_id", "series", "t", "seq", "v").groupBy("tenant_id", "series").transformWithStateInPandas(
        MovingAverage(alpha), "tenant_id string, series string, t long, seq long, v double, ewma double", "Append", "None")


class CutForest(StatefulProcessor):
    """Random cut forest of one key's live points; the state is the forest."""

    def __init__(self, trees: int, sample: int, seed: int):
        self.options = trees, sample, seed

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("forest", "data binary, width int")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # the closed seconds of one key since the last micro-batch
        pdf = pd.concat(list(rows)).sort_values("t")
        forest, width, scores = None, None, []
        if self.state.exists():
            data, width = self.state.get()
            forest = LiveForest.load(bytes(data))
        for x in pdf["x"]:
            if forest is None or len(x) != width:  # other series than before: a forest of their own
                forest, width = LiveForest(*self.options), len(x)
            scores.append(forest.score(x))
        self.state.update((forest.dump(), width))
        yield pdf[["tenant_id", "t"]].assign(score=scores)

    def close(self) -> None:
        pass


def stream_rrcf(vectors: DataFrame, trees: int = 40, sample: int = fixed.FOREST_SAMPLE, seed: int = 42, ts: str = "ts", late: str = "1 minute") -> DataFrame:
    """Displacement of every second's last vector (``tenant_id, ts, seq, x``) among the last ``sample`` of its tenant, in event time whatever the order of arrival within ``late``."""
    rows = vectors.select(ts, "tenant_id", "seq", "x")
    per = closed_seconds(rows, ts, late, ["tenant_id"], F.max_by("x", "seq").alias("x"))
    return per.groupBy("tenant_id").transformWithStateInPandas(CutForest(trees, sample, seed), "tenant_id string, t long, score double", "Append", "EventTime")


# -- window queries -------------------------------------------------------------------------------------------


def stream_malformed_rate(checked: DataFrame, ts: str = "ts", window: str = "5 minutes", late: str = "1 minute", limit: float = 0.005) -> DataFrame:
    """Rejected share per tumbling window behind a watermark; needs ``errors``."""
    per = checked.withWatermark(ts, late).groupBy(F.window(ts, window).alias("w")).agg(
        F.count("*").alias("n"), F.count_if(F.size("errors") > 0).alias("rejected"))
    return per.select(F.unix_seconds("w.start").alias("window_start"), "n", "rejected", (F.col("rejected") / F.col("n") > limit).alias("alert"))


def stream_volume(points: DataFrame, ts: str = "ts", late: str = "1 minute") -> DataFrame:
    """Points per tenant, signal and second behind a watermark."""
    per = points.withWatermark(ts, late).groupBy(F.window(ts, "1 second").alias("w"), "tenant_id", "signal_name").agg(F.count("*").alias("n"))
    return per.select(F.unix_seconds("w.start").alias("t"), "tenant_id", "signal_name", "n")


def stream_idempotency(requests: DataFrame, ts: str = "ts", within: str = "1 day") -> DataFrame:
    """First use of every idempotency key within the watermark."""
    return requests.withWatermark(ts, within).dropDuplicatesWithinWatermark(["tenant_id", "idempotency_key"])


def late_rows(points: DataFrame, ts: str = "ts", arrived: str = "received_at", late_seconds: int = 60) -> DataFrame:
    """Points that arrive later than the watermark allows, as a side output."""
    return points.where(F.unix_seconds(arrived) - F.unix_seconds(ts) > late_seconds)


def stream_detect(points: DataFrame, detect: Callable[[DataFrame], DataFrame], write: Callable[[DataFrame, int], None],
                  checkpoint: str, window: str = "150 seconds", slide: str = "15 seconds", late: str = "30 seconds", width: int = 1):
    """Sliding windows of points, each closed window handed to the batch operators.

    Points are reduced to the last value per (window, second, series) in the state, so state and output per
    window are bounded by seconds x series. ``detect`` gets bins ``tenant_id, window_id, t, series, v``.
    """
    bins = (
        points.withWatermark("ts", late)
        .groupBy(F.window("ts", window, slide).alias("w"), "tenant_id", F.expr(f"(t div {width}) * {width}").alias("t"), "series")
        .agg(F.max_by("value_num", "seq").alias("v"))
        .select("tenant_id", F.unix_seconds("w.start").alias("window_id"), "t", "series", "v")
    )

    def each(df: DataFrame, batch_id: int) -> None:
        write(detect(df), batch_id)

    return bins.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(each)


def stream_verdicts(events: DataFrame, services: DataFrame, edges: DataFrame, out: str, checkpoint: str, window: str = "150 seconds", slide: str = "15 seconds",
                    late: str = "30 seconds", width: int = 1, **options):
    """The whole detect flow on every window that the stream closes, as a ``DataStreamWriter``; ``options`` as in ``plans.verdict.verdicts``.

    ``events``: ``ts, t, seq, tenant_id, series, value_num`` for points and ``container_name, masked, level`` for log lines, with nulls in the other kind. In the state both are
    reduced to one row per (window, bin, name). A micro-batch hands its closed windows to the batch plan and writes ``out/batch=<id>``, which a repeated batch overwrites.
    Incidents go on across batches: of what earlier batches wrote only the roots matter, as duplicates and symptoms open nothing. Windows close in the order of their
    ends, so earlier batches hold no later alert.
    """
    per = (
        events.withWatermark("ts", late)
        .groupBy(F.window("ts", window, slide).alias("w"), "tenant_id", F.expr(f"(t div {width}) * {width}").alias("t"), "series", "container_name", "masked")
        .agg(F.max_by("value_num", F.when(F.col("value_num").isNotNull(), F.col("seq"))).alias("v"), F.count("*").alias("n"), F.min("seq").alias("first_seq"), F.min_by("level", "seq").alias("level"))
        .select("tenant_id", F.unix_seconds("w.start").alias("window_id"), "t", "series", "container_name", "masked", "v", "n", "first_seq", "level")
    )

    def each(df: DataFrame, batch_id: int) -> None:
        closed = reuse(df)
        if closed.isEmpty():
            return
        spark = df.sparkSession
        bins = closed.where("series is not null and v is not null").select("tenant_id", "window_id", "t", "series", "v")
        lines = closed.where("masked is not null").select("tenant_id", "window_id", "t", "container_name", "masked", "n", "first_seq", "level")
        earlier = None
        if batch_id and exists(spark, out):
            before = spark.read.schema(VERDICT).option("basePath", out).parquet(out).where(F.col("batch") < batch_id)
            earlier = before.where("role = 'root'").select("tenant_id", F.col("target_service").alias("service"), F.col("end_t").alias("t"), F.col("window_id").alias("alert_id"))
        ends = bins.groupBy("tenant_id", "window_id").agg(F.max("t").alias("end_t"))
        verdicts(bins, lines, services, edges, earlier=earlier, **options).join(ends, ["tenant_id", "window_id"]).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return per.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(each)


VERDICT = """tenant_id string, window_id long, anomaly_detected boolean, anomaly_row int, t long, severity double, target_service string, fault string, service_top_k array<string>,
 trigger_metric string, trigger_value double, confidence double, reasoning string, role string, root_service string, incident_id string, end_t long, batch long"""
