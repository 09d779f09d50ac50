"""Anomaly detectors on the aligned frame.

Every detector takes the aligned frame with ``is_baseline`` (see ``baseline_split``) and returns
``is_anomaly`` and ``score``: per series for the moving-average detector, per row of the window for the
multivariate ones.
"""
from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from mendstream import fixed
from mendstream.functions.scalars import is_kpi, is_resource
from mendstream.operators.forests import iforest_detect, rrcf_detect
from mendstream.operators.scans import map_runs
from mendstream.operators.timeseries import SERIES, WIN

FLAGS = "tenant_id string, window_id long, row int, t long, is_anomaly boolean, score double"
# (1 - alpha)^-j must stay finite inside one block
MAX_EXPONENT = 600.0


def ewma(df: DataFrame, alpha: float = fixed.EWMA_ALPHA, max_rows: int | None = None,
         block_rows: int | None = None, out: str = "ewma") -> DataFrame:
    """Moving average ``y0 = x0, y = a x + (1 - a) y`` per series.

    The step is an affine map, so a block of rows is one window sum plus a carry. With
    ``max_rows`` known to fit one block no carry is needed; otherwise one row per block is
    chained per series and joined back. ``row`` numbers the rows of a window from 0.
    """
    keep = 1.0 - alpha
    fits = int(MAX_EXPONENT / -math.log(keep)) if keep > 0 else 1
    block_rows = min(block_rows or fits, fits)
    single = max_rows is not None and max_rows <= block_rows
    j = F.col("row").cast("double") if single else F.expr(f"row % {block_rows}").cast("double")
    d = df if single else df.withColumn("_b", F.expr(f"row div {block_rows}"))
    d = d.withColumn("_j", j)
    w = W.partitionBy(*SERIES, *([] if single else ["_b"])).orderBy("row").rowsBetween(W.unboundedPreceding, 0)
    # values are taken relative to the first one of the scan, which makes the average of a constant exact
    d = d.withColumn("_x0", F.first("v").over(w))
    scaled = (F.col("v") - F.col("_x0")) * alpha * F.pow(F.lit(keep), -F.col("_j"))
    d = d.withColumn("_loc", F.pow(F.lit(keep), F.col("_j")) * F.sum(scaled).over(w))
    if single:
        return d.withColumn(out, F.col("_x0") + F.col("_loc")).drop("_j", "_loc", "_x0")

    blocks = d.groupBy(*SERIES, "_b").agg(
        F.max_by("_loc", "row").alias("c"), F.count("*").alias("n"), F.min_by("v", "row").alias("x0"))

    def chain(key: tuple, items: list[tuple]):
        y = float(items[0][3])
        for b, c, n, x0 in items:
            yield (*key, int(b), y)
            y = float(x0) + keep ** int(n) * (y - float(x0)) + float(c)

    carries = map_runs(blocks, SERIES, ["_b"], chain, "tenant_id string, window_id long, series string, _b long, _carry double")
    return (
        d.join(carries, [*SERIES, "_b"])
        .withColumn(out, F.col("_x0") + F.col("_loc") + F.pow(F.lit(keep), F.col("_j") + 1) * (F.col("_carry") - F.col("_x0")))
        .drop("_b", "_j", "_loc", "_carry", "_x0")
    )


def ewma_detect(df: DataFrame, alpha: float = fixed.EWMA_ALPHA, k: float = fixed.EWMA_THRESHOLD,
                max_rows: int | None = None, block_rows: int | None = None) -> DataFrame:
    """Flag |x - y| > k * std, with the sample std of the baseline residuals (1e-6 if 0 or missing)."""
    d = ewma(df, alpha, max_rows, block_rows).withColumn("_res", F.col("v") - F.col("ewma"))
    spread = F.stddev_samp(F.when(F.col("is_baseline"), F.col("_res")))
    if max_rows is not None:
        # a short series stays in the partition the scan put it in
        d = d.withColumn("_s", spread.over(W.partitionBy(*SERIES)))
    else:
        d = d.join(d.groupBy(*SERIES).agg(spread.alias("_s")), SERIES)
    d = d.withColumn("_s", F.when(F.coalesce("_s", F.lit(0.0)) == 0, 1e-6).otherwise(F.col("_s")))
    return (
        d.withColumn("is_anomaly", F.abs("_res") > k * F.col("_s"))
        .withColumn("score", F.abs("_res") / F.col("_s"))
        .drop("_res", "_s")
    )


def kpi_series(df: DataFrame) -> DataFrame:
    return df.where(is_kpi(F.col("series")))


def resource_series(df: DataFrame) -> DataFrame:
    """Resource series of each window; a window without any keeps all its series."""
    mark = df.withColumn("_r", is_resource(F.col("series")))
    some = mark.groupBy(*WIN).agg(F.max("_r").alias("_some"))
    return mark.join(some, WIN).where("_r OR NOT _some").drop("_r", "_some")


def combine_flags(multivariate: DataFrame | None, kpi: DataFrame) -> DataFrame:
    """Row flag: the multivariate flag or any KPI flag; ``score`` is the multivariate score."""
    cols = [*WIN, "row", "t", "is_anomaly", "score"]
    parts = kpi.withColumn("score", F.lit(0.0)).select(*cols)
    if multivariate is not None:
        parts = multivariate.select(*cols).unionByName(parts)
    return parts.groupBy(*WIN, "row", "t").agg(F.bool_or("is_anomaly").alias("is_anomaly"), F.max("score").alias("score"))


def severity(score: Column) -> Column:
    return F.greatest(F.lit(0.4), F.least(F.lit(0.95), F.abs(score) * 2.0))


# -- multivariate detectors: one window is one group, at most window length rows long -----------


def _per_window(df: DataFrame, score: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """Run ``score(matrix, baseline mask) -> (flags, scores)`` on the row x series matrix of each window."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        wide = pdf.pivot_table(index="row", columns="series", values="v", aggfunc="first").sort_index().fillna(0.0)
        meta = pdf.drop_duplicates("row").set_index("row").sort_index()
        flags, scores = score(wide.to_numpy(float), meta["is_baseline"].to_numpy(bool))
        return pd.DataFrame({
            "tenant_id": pdf["tenant_id"].iloc[0], "window_id": pdf["window_id"].iloc[0], "row": wide.index,
            "t": meta["t"].to_numpy(), "is_anomaly": flags, "score": scores,
        })

    cols = df.select(*SERIES, "row", "t", "v", "is_baseline")
    # heavy on CPU, light on bytes: a given number of partitions is not merged by size at run time
    spark = df.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism * 2)
    return cols.repartition(tasks, *WIN).groupBy(*WIN).applyInPandas(run, FLAGS)


def run_length_modes(x: np.ndarray, hazard: float) -> np.ndarray:
    """Most likely run length before each row (Adams & MacKay 2007, multivariate t predictive).

    Prior: mean 0, scale matrix I, kappa 1, d + 1 degrees of freedom. Every run length of the window with a weight above zero is kept; the inverse
    and log-determinant of each scale matrix follow its rank-one updates, so a row costs d * d per run length.
    """
    n, d = x.shape
    ages = np.arange(n + 1.0)
    kappas, dofs = 1.0 + ages, 2.0 + ages  # by run length
    gammas = np.array([math.lgamma((f + d) / 2) - math.lgamma(f / 2) for f in dofs]) - d / 2 * np.log(dofs * math.pi)
    widths = (kappas + 1) / (kappas * dofs)
    stay, leave = math.log1p(-1.0 / hazard), -math.log(hazard)
    # one entry per row at which a run may have begun, the newest last, updated in place
    born, mu, inverse, logdet, log_r = np.zeros(16, int), np.zeros((16, d)), np.zeros((16, d, d)), np.zeros(16), np.zeros(16)
    inverse[0], k = np.eye(d), 1
    modes = np.zeros(n, int)
    for t in range(n):
        age = t - born[:k]
        modes[t] = age[k - 1 - int(np.argmax(log_r[:k][::-1]))]
        kappa, dof, wide = kappas[age], dofs[age], widths[age]
        diff = x[t] - mu[:k]
        reach = np.einsum("rij,rj->ri", inverse[:k], diff)
        dist = np.einsum("ri,ri->r", diff, reach)
        grown = log_r[:k] + gammas[age] - 0.5 * (logdet[:k] + d * np.log(wide)) - (dof + d) / 2 * np.log1p(dist / (wide * dof))
        fresh = np.logaddexp.reduce(grown) + leave
        whole = np.logaddexp(np.logaddexp.reduce(grown) + stay, fresh)
        share = kappa / (kappa + 1)
        shrink = share / (1 + share * dist)
        for i in range(0, k, 256):  # no copy of all matrices
            j = min(k, i + 256)
            inverse[i:j] -= shrink[i:j, None, None] * reach[i:j, :, None] * reach[i:j, None, :]
        logdet[:k] += np.log1p(share * dist)
        mu[:k] += diff / (kappa + 1)[:, None]
        log_r[:k] = grown + stay - whole
        alive = np.exp(log_r[:k]) > 0  # a run whose weight is zero never comes back
        if 2 * int(alive.sum()) < k:
            for a in (born, mu, inverse, logdet, log_r):
                a[: alive.sum()] = a[:k][alive]
            k = int(alive.sum())
        if k == len(born):
            born, mu, inverse, logdet, log_r = (np.concatenate([a, np.zeros_like(a)]) for a in (born, mu, inverse, logdet, log_r))
        born[k], mu[k], inverse[k], logdet[k], log_r[k] = t + 1, 0.0, np.eye(d), 0.0, fresh - whole
        k += 1
    return modes


def change_points(modes: np.ndarray) -> np.ndarray:
    """Rows at which the most likely run does not simply grow by one."""
    flags = np.zeros(len(modes), bool)
    flags[1:] = modes[1:] != modes[:-1] + 1
    return flags


def bocpd_detect(df: DataFrame, hazard: float = fixed.HAZARD) -> DataFrame:
    """Change points of the scaled, non-constant resource series."""

    def score(x: np.ndarray, base: np.ndarray):
        span = x.max(0) - x.min(0)
        x = x[:, span > 0]
        if x.shape[1] == 0:
            return np.zeros(len(x), bool), np.zeros(len(x))
        span = x.max(0) - x.min(0)
        x = np.where(span > 1e-6, (x - x.min(0)) / np.where(span > 1e-6, span, 1.0), 0.0)
        flags = change_points(run_length_modes(x, hazard))
        return flags, flags.astype(float)

    return _per_window(resource_series(df), score)


DETECTORS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "bocpd": bocpd_detect, "rrcf": rrcf_detect, "iforest": iforest_detect,
}


def detect(df: DataFrame, detector: str | None = "bocpd", max_rows: int | None = None, kpi_limit: float = fixed.EWMA_THRESHOLD) -> DataFrame:
    """Combined row flags of one multivariate detector (or none) and the KPI moving average."""
    multivariate = DETECTORS[detector](df) if detector else None
    return combine_flags(multivariate, ewma_detect(kpi_series(df), k=kpi_limit, max_rows=max_rows))
