"""URL filter by the ratio of two character language models.

Domain rules decide the urls they fit. All urls that a rule decides teach two models, one of accepted and one of rejected urls:
variable-order Markov models over host and path with Witten-Bell smoothing. After a context of k characters, the next character has
(c + w * p) / (n + t): c its count, n the context's visits, t its distinct followers, p the probability after the context of k - 1
characters, w = t; below the empty context all bytes are alike. A model keeps a context and character if it is at least one in
``SHARE`` of all characters of its kind, so no model has more than ``SHARE`` rows an order, however large the table; what a context
loses by that joins w, and the probabilities still sum to one.

A url without a rule is accepted if its log-likelihood difference per character is at least a threshold. That is calibrated on ruled
urls that the models had not seen: one in ``FOLDS`` by hash of the url is held out, models of the others score them, and the
threshold is where both kinds are told apart best. The models that judge are then learned from all ruled urls.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from mendstream.llm.common import batch_rows, chunks, column, flat

ORDER = 4  # longest context
SHARE = 1 << 18  # a model keeps what is at least one in so many of its characters
FOLDS = 5
BITS = 9  # of a character: its byte plus 1; 0 stands before the text
HELD = 1 << 20  # distinct character runs a task sums up before it hands them on
BINS, SPAN = 2000, 10.0  # histogram of differences from -SPAN to SPAN nats a character
RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without "://"."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring({0}, instr({0}, '://') + 3)".format("_url")))
    host = F.translate(F.regexp_extract(F.coalesce(rest, F.lit("")), r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(F.coalesce(rest, F.lit("")), r"^[^/?#]*([^?#]*)", 1)
    return host, path


def matched_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, or null."""
    found = None
    for verdict, rule in sorted(rules, key=lambda r: -len(r[1])):
        name, _, tail = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + tail)
        hit = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, hit) if found is None else found.when(fits, hit)
    return found


def runs(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Each character with the ``ORDER`` before it, packed into a number; its low bits are the character."""
    age = np.arange(len(buf)) - np.repeat(off[:-1], np.diff(off))  # characters of the text before this one
    out = buf.astype(np.int64) + 1
    for k in range(1, ORDER + 1):
        has = np.flatnonzero(age >= k)
        out[has] |= (buf[has - k].astype(np.int64) + 1) << (BITS * k)
    return out


def merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and their summed counts."""
    found, at = np.unique(np.concatenate(keys), return_inverse=True)
    return found, np.bincount(at, weights=np.concatenate(counts), minlength=len(found)).astype(np.int64)


class Model:
    """Witten-Bell probabilities from the kept rows of one kind: (order, run, c, n), n the visits of the run's context."""

    def __init__(self, order: np.ndarray, run: np.ndarray, c: np.ndarray, n: np.ndarray):
        self.orders = []
        for k in range(ORDER + 1):
            own = np.flatnonzero(order == k)
            own = own[np.argsort(run[own])]
            ctx, first, t = np.unique(run[own] >> BITS, return_index=True, return_counts=True)
            kept = np.add.reduceat(c[own], first) if len(own) else np.zeros(0)
            visits = n[own][first].astype(float)
            self.orders.append((run[own], c[own].astype(float), ctx, visits + t, t + visits - kept))

    def probability(self, run: np.ndarray) -> np.ndarray:
        prob = np.full(len(run), 1 / 256)
        for k, (pairs, c, ctx, size, weight) in enumerate(self.orders):
            if not len(pairs):
                continue
            pair = run & ((1 << (BITS * (k + 1))) - 1)
            at = np.minimum(np.searchsorted(ctx, pair >> BITS), len(ctx) - 1)
            known = ctx[at] == pair >> BITS
            to = np.minimum(np.searchsorted(pairs, pair), len(pairs) - 1)
            seen = np.where(pairs[to] == pair, c[to], 0.0)
            prob = np.where(known, (seen + weight[at] * prob) / size[at], prob)
        return prob


def learn(urls: DataFrame) -> list[Model]:
    """Models of rejected and accepted urls, from _key and _kind (0 or 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = [], []

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(keys[0] & ((1 << 62) - 1)), pa.array((keys[0] >> 62).astype(np.int32)), pa.array(counts[0])], names=["run", "kind", "c"])

        for batch in batches:
            kind = np.asarray(column(batch, "_kind"))
            whole, offs = flat(column(batch, "_key"))
            for i, j in chunks(offs):
                found = runs(whole[offs[i] : offs[j]], offs[i : j + 1] - offs[i]) | np.repeat(kind[i:j].astype(np.int64) << 62, np.diff(offs[i : j + 1]))
                keys.append(found)
                counts.append(np.ones(len(found)))
                key, count = merged(keys, counts)
                keys[:], counts[:] = [key], [count]
                if len(key) > HELD:
                    yield out()
                    keys.clear()
                    counts.clear()
        if keys:
            yield out()

    found = batch_rows(urls, 4096).mapInArrow(run, "run long, kind int, c long").groupBy("kind", "run").agg(F.sum("c").alias("c"))
    orders = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.expr(f"run & {(1 << (BITS * (k + 1))) - 1}L").alias("r")) for k in range(ORDER + 1)]))
    grams = found.select("kind", orders.alias("o"), "c").groupBy("kind", F.col("o.k").alias("k"), F.col("o.r").alias("run")).agg(F.sum("c").alias("c"))
    beside = Window.partitionBy("kind", "k", F.expr(f"shiftright(run, {BITS})"))  # a context has 256 followers at most
    size = {r._kind: int(r.n or 0) for r in urls.groupBy("_kind").agg(F.sum(F.octet_length("_key")).alias("n")).collect()}
    enough = F.col("c") * SHARE >= F.when(F.col("kind") == 0, size.get(0, 0)).otherwise(size.get(1, 0))
    rows = grams.withColumn("n", F.sum("c").over(beside)).where(enough).toPandas()  # at most SHARE rows an order and kind
    return [Model(*(rows.loc[rows.kind == v, f].to_numpy(np.int64) for f in ("k", "run", "c", "n"))) for v in (0, 1)]


def log_ratio(buf: np.ndarray, off: np.ndarray, models: list[Model]) -> np.ndarray:
    """Mean log-likelihood difference, accepted minus rejected, per character of each text; 0 for empty texts."""
    size = np.diff(off)
    found, at = np.unique(runs(buf, off), return_inverse=True)
    diff = np.log(models[1].probability(found)) - np.log(models[0].probability(found))
    return np.bincount(np.repeat(np.arange(len(size)), size), weights=diff[at], minlength=len(size)) / np.maximum(size, 1)


def scored(rows: DataFrame, models: list[Model]) -> DataFrame:
    told = rows.sparkSession.sparkContext.broadcast(models)
    kept = rows.columns
    schema = StructType([*rows.schema.fields, StructField("_ratio", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole, offs = flat(column(batch, "_key"))
            out = np.zeros(batch.num_rows)
            for i, j in chunks(offs, 1 << 19):
                out[i:j] = log_ratio(whole[offs[i] : offs[j]], offs[i : j + 1] - offs[i], told.value)
            yield pa.RecordBatch.from_arrays([*[column(batch, c) for c in kept], pa.array(out)], names=schema.names)

    return batch_rows(rows, 4096).mapInArrow(run, schema)


def threshold(ruled: DataFrame) -> float:
    """Where the share of accepted urls below plus that of rejected ones at or above is least; the middle of such places."""
    place = F.least(F.greatest(F.floor((F.col("_ratio") + SPAN) / (2 * SPAN) * BINS), F.lit(0)), F.lit(BINS - 1)).cast("int")
    hist = np.zeros((2, BINS))
    for r in ruled.groupBy("_kind", place.alias("b")).count().collect():  # at most 2 * BINS rows
        hist[r._kind, r.b] = r["count"]
    if not hist[0].sum() or not hist[1].sum():
        return 0.0
    wrong = np.append(0, np.cumsum(hist[1])) / hist[1].sum() + 1 - np.append(0, np.cumsum(hist[0])) / hist[0].sum()
    best = np.flatnonzero(np.isclose(wrong, wrong.min()))
    return float(best[0] + best[-1]) / 2 / BINS * 2 * SPAN - SPAN


def judge(df: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: list[tuple[str, str]] = RULES) -> DataFrame:
    """One row per row of ``df``: the id, host, path, rule, verdict and the log-likelihood difference per character.

    A null url, or one without "://", has an empty host and path and no rule. With held-out urls of one kind only, or none, the
    threshold is 0. The difference of an empty host and path is 0. Equal urls get equal verdicts, and repeated rows count as often as
    they stand; a difference equal to the threshold is accepted. An empty table gives no rows. Rules are few and given; other
    columns, whatever their names, are not read.
    """
    host, path = host_path(F.col("_url"))
    rows = df.select(F.col(id_col), F.col(url_col).alias("_url")).withColumn("host", host).withColumn("path", path)
    rows = rows.withColumn("_rule", matched_rule(F.col("host"), F.col("path"), rules)).withColumn("_key", F.concat("host", "path"))
    rows = rows.withColumn("_kind", F.when(F.col("_rule").isNull(), -1).otherwise((F.col("_rule.verdict") == "allow").cast("int")).cast("int"))
    rows = rows.select(id_col, "host", "path", F.col("_rule.rule").alias("rule"), "_key", "_kind")
    ruled = rows.where("_kind >= 0").select("_key", "_kind")
    held = F.pmod(F.xxhash64("_key"), F.lit(FOLDS)) == 0
    limit = threshold(scored(ruled.where(held), learn(ruled.where(~held))))
    out = scored(rows, learn(ruled))
    said = F.when(F.col("_kind") >= 0, F.when(F.col("_kind") == 1, "allow").otherwise("block")).otherwise(F.when(F.col("_ratio") >= limit, "allow").otherwise("block"))
    return out.select(id_col, "host", "path", "rule", said.alias("verdict"), F.col("_ratio").alias("ratio"))


def op10(spark, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"))
