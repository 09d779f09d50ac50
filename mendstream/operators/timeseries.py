"""Binning, alignment and per-series statistics on the long layout.

Aligned frame: ``tenant_id, window_id, t, row, n_rows, series, v`` (``row`` counts from 0, ``n_rows`` is the window's length). A window is one
fixed-length stretch of bins, so a (window, series) group has at most
``window length / bin width`` rows whatever the raw volume is.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from mendstream import fixed
from mendstream.operators.scans import forward_fill, with_block, with_halo

WIN = ["tenant_id", "window_id"]
SERIES = [*WIN, "series"]


def bin_points(df: DataFrame, width: int = 1, window: int | None = None) -> DataFrame:
    """Last written value per (tenant, window, bin, series); ``seq`` is the arrival order."""
    t = F.expr(f"(t div {width}) * {width}")
    w = F.expr(f"t div {window}") if window else F.lit(0).cast("long")
    return (
        df.where(F.col("value_num").isNotNull())
        .groupBy("tenant_id", w.alias("window_id"), t.alias("t"), "series")
        .agg(F.max_by("value_num", "seq").alias("v"))
    )


def align_series(bins: DataFrame, block: int | None = None) -> DataFrame:
    """Dense grid: every bin seen in the window x every series, filled forward, then 0.

    ``block`` (seconds) switches to the blocked fill for windows that span a whole history. ``bins`` is read
    three times: pass a kept frame (``session.reuse``) so that the points behind it are read once.
    """
    times = bins.groupBy(*WIN, "t").agg(F.lit(1).alias("_n")).drop("_n")
    times = times.withColumn("row", F.row_number().over(W.partitionBy(*WIN).orderBy("t")) - 1)
    times = times.withColumn("n_rows", F.count("*").over(W.partitionBy(*WIN)).cast("int"))
    names = bins.select(*SERIES).distinct()
    grid = times.join(names, WIN).join(bins, [*SERIES, "t"], "left")
    if block:
        filled = forward_fill(with_block(grid, "t", block), SERIES, "t", "v", "block").drop("block")
    else:
        w = W.partitionBy(*SERIES).orderBy("t").rowsBetween(W.unboundedPreceding, 0)
        filled = grid.withColumn("v", F.last("v", ignorenulls=True).over(w))
    return filled.select(*WIN, "t", "row", "n_rows", "series", F.coalesce("v", F.lit(0.0)).alias("v"))


def clean_non_finite(df: DataFrame, mode: str = "detector") -> DataFrame:
    """``detector``: NaN -> 0, then infinities -> previous, next, 0. ``rca``: NaN is filled as well."""
    inf = F.col("v").isin(float("inf"), float("-inf"))
    nan = F.isnan("v") | F.col("v").isNull()
    if mode == "detector":
        x = F.when(nan, 0.0).when(~inf, F.col("v"))
    else:
        x = F.when(~nan & ~inf, F.col("v"))
    back = W.partitionBy(*SERIES).orderBy("t").rowsBetween(W.unboundedPreceding, 0)
    ahead = W.partitionBy(*SERIES).orderBy("t").rowsBetween(0, W.unboundedFollowing)
    df = df.withColumn("_x", x)
    return df.withColumn(
        "v",
        F.coalesce(F.last("_x", ignorenulls=True).over(back), F.first("_x", ignorenulls=True).over(ahead), F.lit(0.0)),
    ).drop("_x")


def drop_constant(df: DataFrame) -> DataFrame:
    w = W.partitionBy(*SERIES)
    return (
        df.withColumn("_lo", F.min("v").over(w)).withColumn("_hi", F.max("v").over(w))
        .where("_lo < _hi").drop("_lo", "_hi")
    )


def minmax_scale(df: DataFrame) -> DataFrame:
    w = W.partitionBy(*SERIES)
    lo, hi = F.min("v").over(w), F.max("v").over(w)
    return (
        df.withColumn("_lo", lo).withColumn("_hi", hi)
        .withColumn("v", F.when(F.col("_hi") - F.col("_lo") > 1e-6, (F.col("v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo"))).otherwise(0.0))
        .drop("_lo", "_hi")
    )


def baseline_rows(n: Column, mode: str = "live", inject_row: Column | None = None, fixed_rows: int = fixed.BASELINE_ROWS) -> Column:
    """Baseline length for a window of ``n`` rows."""
    if mode == "live":
        return F.greatest(F.lit(10), F.floor(n * 0.8)).cast("int")
    if mode == "batch":
        return F.lit(fixed_rows)
    return F.least(F.lit(fixed_rows), inject_row).cast("int")


def baseline_split(df: DataFrame, mode: str = "live", anchors: DataFrame | None = None) -> DataFrame:
    """Adds ``baseline_len`` and ``is_baseline``; ``sliced`` mode takes ``inject_row`` from ``anchors``."""
    n = F.col("n_rows")
    if mode == "sliced":
        d = df.join(anchors.select(*WIN, "inject_row"), WIN)
        d = d.withColumn("baseline_len", baseline_rows(n, mode, F.col("inject_row"))).drop("inject_row")
    else:
        d = df.withColumn("baseline_len", baseline_rows(n, mode))
    return d.withColumn("is_baseline", F.col("row") < F.col("baseline_len"))


def regularised(std: Column, mean: Column, multiplier: float = fixed.STD_REG_MULTIPLIER, additive: float = fixed.STD_REG_ADDITIVE) -> Column:
    return F.greatest(F.coalesce(std, F.lit(0.0)), multiplier * F.abs(mean) + additive)


def baseline_stats(df: DataFrame) -> DataFrame:
    """Mean, sample std and regularised std of the baseline rows per series."""
    base = F.when(F.col("is_baseline"), F.col("v"))
    stats = df.groupBy(*SERIES).agg(
        F.coalesce(F.avg(base), F.lit(0.0)).alias("mean"), F.coalesce(F.stddev_samp(base), F.lit(0.0)).alias("std")
    )
    return stats.withColumn("reg_std", regularised(F.col("std"), F.col("mean")))


def deviation(df: DataFrame, stats: DataFrame, anchors: DataFrame, after: int = fixed.DEVIATION_ROWS) -> DataFrame:
    """Largest |z| per series over rows ``[a, a + after]`` of each window's anomaly row."""
    z = F.abs(F.col("v") - F.col("mean")) / F.col("reg_std")
    return (
        df.join(anchors.select(*WIN, "anomaly_row"), WIN)
        .where(F.col("row").between(F.col("anomaly_row"), F.col("anomaly_row") + after))
        .join(stats, SERIES)
        .groupBy(*SERIES).agg(F.max(z).alias("z"))
    )


def rolling_mean(df: DataFrame, rows: int = fixed.SMOOTHING_ROWS) -> DataFrame:
    """Trailing mean with at least one row; slice first, the mean restarts at the slice start."""
    w = W.partitionBy(*SERIES).orderBy("row").rowsBetween(-(rows - 1), 0)
    return df.withColumn("v", F.avg("v").over(w))


def slice_around(df: DataFrame, anchors: DataFrame, before: int, after: int, by: str = "row") -> DataFrame:
    """Rows within ``[anchor - before, anchor + after]`` of the window's anchor (``by`` row or t)."""
    a = {"row": "anomaly_row", "t": "anchor_t"}[by]
    return (
        df.join(anchors.select(*WIN, a), WIN)
        .where(F.col(by).between(F.col(a) - before, F.col(a) + after)).drop(a)
    )


def first_row_at_or_after(df: DataFrame, anchors: DataFrame, mode: str = "batch") -> DataFrame:
    """First row with ``t >= anchor_t``; none -> ``n - 100`` (batch) or the last row (slice)."""
    fallback = F.col("n") - 100 if mode == "batch" else F.col("n") - 1
    return (
        df.join(anchors.select(*WIN, "anchor_t"), WIN)
        .groupBy(*WIN)
        .agg(F.min(F.when(F.col("t") >= F.col("anchor_t"), F.col("row"))).alias("hit"), F.max("n_rows").alias("n"))
        .select(*WIN, F.coalesce("hit", fallback).alias("inject_row"))
    )


def first_detection(flags: DataFrame, start: DataFrame) -> DataFrame:
    """First flagged row at or after ``search_start`` and the flagged-row count; -1 if none."""
    hit = F.when(F.col("is_anomaly") & (F.col("row") >= F.col("search_start")), F.col("row"))
    return (
        flags.join(start, WIN).groupBy(*WIN)
        .agg(F.coalesce(F.min(hit), F.lit(-1)).alias("anomaly_row"), F.count_if("is_anomaly").alias("n_flagged"))
    )


def resample(df: DataFrame, step: int, lookback: int, keys: list[str], block: int = 86400) -> DataFrame:
    """Value at every multiple of ``step``: the newest sample under ``lookback`` seconds old; no interpolation.

    Samples are first reduced to one per step cell, then each spreads only up to the next one,
    so exactly the output rows are produced.
    """
    cell = F.expr(f"((t + {step - 1}) div {step}) * {step}")
    cells = df.groupBy(*keys, cell.alias("cell")).agg(F.max(F.struct("t", "seq", "v")).alias("s"))
    cells = cells.select(*keys, "cell", F.col("s.t").alias("t"), F.col("s.v").alias("v"), (-F.col("cell")).alias("_neg"))
    ahead = forward_fill(with_block(cells, "_neg", block), keys, "_neg", "cell", "block", out="_next", before_only=True)
    last = F.least(F.expr(f"((t + {lookback - 1}) div {step}) * {step}"), F.coalesce(F.col("_next") - step, F.lit(2**62)))
    return (
        ahead.where(last >= F.col("cell"))
        .select(*keys, F.explode(F.sequence(F.col("cell"), last, F.lit(step).cast("long"))).alias("t"), "v")
    )


def added(earlier: Column, later: Column) -> Column:
    return F.coalesce(earlier + later, earlier, later)


def rolling_range(df: DataFrame, keys: list[str], seconds: int, aggs: dict[str, Column | tuple[Column, Callable[[Column, Column], Column]]], block: int | None = None) -> DataFrame:
    """Aggregates over the rows of the key in ``(t - seconds, t]``. An entry is an aggregate whose parts add up, or an aggregate and the rule that
    merges the part of the earlier rows with that of the later ones; the aggregate must not depend on the order of its rows.

    Blocks are as long as the window (``block`` is accepted, but no longer cuts anything). A window is then the end of the block before and the beginning of the row's own: running aggregates from both
    sides of each border give the two parts, so a row costs the same whatever the window holds.
    """
    rules = {name: a if isinstance(a, tuple) else (a, added) for name, a in aggs.items()}
    rows = with_halo(df, "t", seconds, seconds, "_block", "_halo").repartition(*keys, "_block")
    away = F.when(F.col("_halo"), -F.col("t")).otherwise(F.col("t"))
    part = W.partitionBy(*keys, "_block", "_halo").orderBy(away).rangeBetween(W.unboundedPreceding, W.currentRow)
    rows = rows.select("*", *[agg.over(part).alias(f"_p_{name}") for name, (agg, _) in rules.items()])
    rows = rows.withColumn("_part", F.struct(*[f"_p_{name}" for name in rules])).drop(*[f"_p_{name}" for name in rules])
    # the earliest row of the block before that is inside the window comes last before the row
    start = F.when(F.col("_halo"), F.col("t")).otherwise(F.col("t") - (seconds - 1))
    down = W.partitionBy(*keys, "_block").orderBy(start.desc(), F.col("_halo").desc()).rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = rows.withColumn("_before", F.last(F.when(F.col("_halo"), F.col("_part")), ignorenulls=True).over(down)).where(~F.col("_halo"))
    both = lambda name: (F.col(f"_before._p_{name}"), F.col(f"_part._p_{name}"))
    merged = [F.when(F.col("_before").isNull(), both(name)[1]).otherwise(merge(*both(name))).alias(name) for name, (_, merge) in rules.items()]
    return rows.select(*df.columns, *merged)


def counter_changes(df: DataFrame, keys: list[str], seconds: int = 300) -> DataFrame:
    """Number of value changes between samples that lie within ``(t - seconds, t]``."""
    d = with_previous_time(df, keys)
    # a change counts only while both samples of the pair are inside the window
    pairs = d.withColumn("changed", ((F.col("v") != F.col("prev_v")) & F.col("prev_v").isNotNull()).cast("int"))
    return _pair_window(pairs, keys, seconds, "changed", "changes")


def counter_rate(df: DataFrame, keys: list[str], seconds: int = 300) -> DataFrame:
    """Per-second increase within ``(t - seconds, t]``; a drop counts as a restart from zero."""
    d = with_previous_time(df, keys)
    inc = F.when(F.col("prev_v").isNull(), 0.0).when(F.col("v") < F.col("prev_v"), F.col("v")).otherwise(F.col("v") - F.col("prev_v"))
    out = _pair_window(d.withColumn("inc", inc), keys, seconds, "inc", "increase")
    return out.withColumn("rate", F.col("increase") / seconds)


def with_previous_time(df: DataFrame, keys: list[str], block: int = 86400) -> DataFrame:
    d = df.withColumn("_s", F.struct(F.col("t").alias("t"), F.col("v").alias("v")))
    d = forward_fill(with_block(d, "t", block), keys, "t", "_s", "block", out="_p", before_only=True)
    return d.select(*keys, "t", "v", F.col("_p.t").alias("prev_t"), F.col("_p.v").alias("prev_v"))


def _pair_window(d: DataFrame, keys: list[str], seconds: int, col: str, out: str) -> DataFrame:
    earliest = lambda earlier, later: earlier
    # the first sample inside the window has its partner outside, so its own step is taken off
    w = rolling_range(d, keys, seconds, {"_sum": F.sum(col), "_first": (F.min_by(col, "t"), earliest), "_t0": (F.min_by("prev_t", "t"), earliest)})
    outside = F.col("_t0").isNotNull() & (F.col("_t0") <= F.col("t") - seconds)
    return w.select(*keys, "t", "v", (F.col("_sum") - F.when(outside, F.col("_first")).otherwise(F.lit(0))).alias(out))


def max_over_time(df: DataFrame, keys: list[str], seconds: int = 300) -> DataFrame:
    return rolling_range(df, keys, seconds, {"max_v": (F.max("v"), F.greatest)})


def sum_or_zero(df: DataFrame, by: list[str], col: str) -> DataFrame:
    return df.groupBy(*by).agg(F.coalesce(F.sum(col), F.lit(0.0)).alias("total"))


def alert_for(df: DataFrame, keys: list[str], duration: int, block: int = 86400) -> DataFrame:
    """Samples at which ``cond`` has held without a break for ``duration`` seconds.

    The hold starts at the first true sample after a false one, found with two blocked fills.
    """
    d = df.withColumn("_c", F.struct(F.col("cond").alias("c")))
    d = forward_fill(with_block(d, "t", block), keys, "t", "_c", "block", out="_pc", before_only=True)
    starts = F.col("cond") & ~F.coalesce(F.col("_pc.c"), F.lit(False))
    d = d.withColumn("_st", F.when(starts, F.col("t")))
    d = forward_fill(d, keys, "t", "_st", "block", out="active_since")
    d = d.withColumn("active_since", F.when(F.col("cond"), F.col("active_since")))
    held = F.coalesce(F.col("t") - F.col("active_since") >= duration, F.lit(False))
    return d.withColumn("firing", held).drop("_pc", "_st", "_c", "block")


def ratio_alert(available: DataFrame, desired: DataFrame, below: float = 0.5) -> DataFrame:
    """Deployments with available / desired replicas under ``below`` (no alert where desired is 0)."""
    j = available.join(desired, ["namespace", "deployment", "t"])
    ratio = F.try_divide(F.col("available"), F.col("desired"))
    return j.withColumn("ratio", ratio).withColumn("cond", F.coalesce(ratio < below, F.lit(False)))


def backlog_alert(queue: DataFrame, above: float = 100.0) -> DataFrame:
    return queue.withColumn("cond", F.col("v") > above)


def oom_alert(restarts: DataFrame, reasons: DataFrame, seconds: int = 300) -> DataFrame:
    """Pods whose restart counter changed and whose last exit reason is out-of-memory."""
    changed = counter_changes(restarts, ["namespace", "pod"], seconds).where("changes > 0")
    oom = reasons.where((F.col("reason") == "OOMKilled") & F.col("namespace").startswith("tenant-")).select("namespace", "pod").distinct()
    return changed.where(F.col("namespace").startswith("tenant-")).join(oom, ["namespace", "pod"], "left_semi")


def histogram_quantile(buckets: DataFrame, keys: list[str], q: float) -> DataFrame:
    """Quantile from cumulative buckets (``le``, ``n``) by linear interpolation inside the bucket."""
    w = W.partitionBy(*keys).orderBy("le")
    b = (
        buckets.withColumn("_lo", F.coalesce(F.lag("le").over(w), F.lit(0.0)))
        .withColumn("_below", F.coalesce(F.lag("n").over(w), F.lit(0)))
        .withColumn("_total", F.max("n").over(W.partitionBy(*keys)))
    )
    rank = q * F.col("_total")
    inf = F.col("le") == float("inf")
    at = F.when(inf, F.col("_lo")).otherwise(
        F.col("_lo") + (F.col("le") - F.col("_lo")) * F.try_divide(rank - F.col("_below"), F.col("n") - F.col("_below"))
    )
    return (
        b.where((F.col("n") >= rank) & (F.col("_total") > 0))
        .groupBy(*keys).agg(F.min_by(at, F.col("le")).alias("quantile"))
    )


def select_signal_window(points: DataFrame, alerts: DataFrame, extra: str = "container_resource_usage",
                         bucket: int = 600) -> DataFrame:
    """Primary-signal points and the memory-signal points of exactly the alert's pod.

    Both sides carry a time bucket as join key, so a busy pod is spread over its buckets.
    """
    a = alerts.select("alert_id", "pod", "signal_name", "from_t", "to_t")
    want = a.unionByName(a.withColumn("signal_name", F.lit(extra)))
    want = want.withColumn("_b", F.explode(F.expr(f"sequence(from_t div {bucket}, to_t div {bucket})")))
    return (
        points.withColumn("_b", F.expr(f"t div {bucket}")).join(want, ["pod", "signal_name", "_b"])
        .where(F.col("t").between(F.col("from_t"), F.col("to_t"))).drop("from_t", "to_t", "_b")
    )


def backlog_over_time(points: DataFrame, alerts: DataFrame, seconds: int) -> DataFrame:
    """Queue backlog (max) and firing alerts per time bucket, 0 where there is none."""
    b = F.expr(f"(t div {seconds}) * {seconds}").alias("bucket")
    q = points.groupBy(b).agg(F.max("v").alias("backlog"), F.lit(0).cast("long").alias("firing"))
    f = alerts.where("status = 'firing'").groupBy(b).agg(F.lit(0.0).alias("backlog"), F.count("*").alias("firing"))
    return q.unionByName(f).groupBy("bucket").agg(F.max("backlog").alias("backlog"), F.max("firing").alias("firing"))
