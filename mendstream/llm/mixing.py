"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Texts are cut into blocks of ``words`` words. Each source's target says how many whole passes over its blocks the mix takes and how many
words more; the words more come from the first blocks of a pseudo-random permutation of the source, so every
source has an exact quota of blocks. A binary tree over the output shards splits the quotas of all sources together, half and
half, by multivariate-hypergeometric draws; its leaves say how many blocks of each source a shard holds. Shards draw disjoint
ranges of the permuted blocks and put them in a random order of their own.

All draws come from hashes and a seed, so reruns agree. Ranks inside a source are counted by buckets of the permutation, so
no source meets in one task.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F

from mendstream.llm.common import fresh, reuse

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
BUCKETS = 4096  # of a source's permutation
WHOLE = 1 << 40  # words of a block that holds any document
UNIT = 500_000_000  # more blocks than this are drawn by groups of blocks
SHARD = 1 << 27  # words of an output shard


def targets(sizes: DataFrame, share: float = 1.5, repeat: float = 2.0, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """_source, source_size, target. ``sizes`` has one row per source.

    Sources by code point, null last, weigh ``weights`` in turn and share ``share`` of all words; none gets more than ``repeat`` times its
    words, and the excess goes to the others by weight until none is above. One task orders the sources, not the rows.
    """
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_n") % len(weights) + 1).cast("int"))
    all_ = W.partitionBy()
    s = sizes.withColumn("_n", F.row_number().over(all_.orderBy(F.col("_source").isNull(), "_source")) - 1).withColumn("_w", weight)
    s = s.withColumn("_cap", repeat * F.col("source_size")).withColumn("_ratio", F.col("_cap") / F.col("_w"))
    by = W.orderBy("_ratio", "_n").rowsBetween(W.unboundedPreceding, -1)
    s = s.withColumn("_left", share * F.sum("source_size").over(all_) - F.coalesce(F.sum("_cap").over(by), F.lit(0.0)))
    s = s.withColumn("_level", F.col("_left") / (F.sum("_w").over(all_) - F.coalesce(F.sum("_w").over(by), F.lit(0.0))))
    level = F.min(F.when(F.col("_ratio") > F.col("_level"), F.struct("_ratio", "_n", "_level"))).over(all_)["_level"]  # at the first source below its cap
    return s.withColumn("target", F.coalesce(F.least("_cap", level * F.col("_w")), F.col("_cap"))).select("_source", "source_size", "target")


def split_tree(quota: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """Blocks of each source (rows) in each shard: quotas split in two again and again by hypergeometric draws."""
    rng = np.random.default_rng(seed)
    out = np.zeros((len(quota), shards), np.int64)

    def split(q: np.ndarray, lo: int, hi: int) -> None:
        if hi - lo == 1:
            out[:, lo] = q
            return
        mid = (lo + hi) // 2
        total = int(q.sum())
        take = total * (mid - lo) // (hi - lo)
        group = max(1, -(-total // UNIT))
        left, rest, units = np.zeros_like(q), take // group, int((q // group).sum())
        for i, n in enumerate((q // group).tolist()):
            got = int(rng.hypergeometric(n, units - n, min(rest, units))) if n and rest and units else 0
            left[i], rest, units = got * group, rest - got, units - n
        short = take - int(left.sum())
        for i in range(len(q)):  # what groups of blocks leave over
            more = max(0, min(short, int(q[i] - left[i])))
            left[i] += more
            short -= more
        split(left, lo, mid)
        split(q - left, mid, hi)

    split(quota.astype(np.int64), 0, shards)
    return out


def mix_blocks(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", words: int = 128, shards: int | None = None, seed: int = 11, share: float = 1.5, repeat: float = 2.0, weights: tuple[int, ...] = WEIGHTS) -> tuple[DataFrame, DataFrame]:
    """(mix, documents).

    mix: one row per draw of a block: _row, _id, _h, _source, block, words, shard, place (its order in that shard). documents: one row per row of ``df``:
    _row (its number), _id, _h, size, source_size, target, taken (the words of its blocks that the shards drew). Null texts and texts without
    words have size 0 and no blocks; null is a source of its own. Equal rows are rows of their own. ``shards``: by default one for each ``SHARD`` words of the mix, 64 at least.
    """
    sized = df.select(F.col(id_col).alias("_id"), F.col(source_col).alias("_source"), F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD)).cast("long").alias("size"), F.xxhash64(id_col, text_col).alias("_h"))
    sized = reuse(sized.withColumn("_row", F.monotonically_increasing_id()))  # written once, so a row keeps its number
    goal = reuse(targets(sized.groupBy("_source").agg(F.sum("size").alias("source_size")), share, repeat, weights))
    if shards is None:
        shards = max(64, -(-int(goal.agg(F.sum("target")).first()[0] or 0) // SHARD))
    blocks = sized.where("size > 0").withColumn("block", F.explode(F.sequence(F.lit(0), ((F.col("size") - 1) / words).cast("long"))))
    blocks = blocks.withColumn("words", F.least(F.lit(words), F.col("size") - F.col("block") * words))
    blocks = blocks.withColumn("_key", F.xxhash64("_id", "_h", "block", F.lit(seed))).withColumn("_bucket", F.expr(f"shiftrightunsigned(_key, {64 - (BUCKETS.bit_length() - 1)})").cast("int"))
    part = W.partitionBy("_source").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    base = blocks.groupBy("_source", "_bucket").agg(F.sum("words").alias("w"), F.count("*").alias("c"))
    base = base.withColumn("_w0", F.coalesce(F.sum("w").over(part), F.lit(0))).withColumn("_c0", F.coalesce(F.sum("c").over(part), F.lit(0))).withColumn("_all", F.sum("c").over(W.partitionBy("_source")))
    base = base.join(goal, base["_source"].eqNullSafe(goal["_source"])).select(base["_source"], "_bucket", "_w0", "_c0", "_all", F.floor(F.col("target") / F.col("source_size")).alias("_passes"), (F.col("target") - F.floor(F.col("target") / F.col("source_size")) * F.col("source_size")).alias("_more"))
    local = W.partitionBy("_source", "_bucket").orderBy("_key", "_id", "_h", "block", "_row").rowsBetween(W.unboundedPreceding, 0)
    ranked = blocks.withColumn("_lw", F.sum("words").over(local)).withColumn("_lc", F.count("*").over(local))
    ranked = ranked.join(base, ranked["_source"].eqNullSafe(base["_source"]) & (ranked["_bucket"] == base["_bucket"])).select(ranked["*"], "_w0", "_c0", "_all", "_passes", "_more")
    # the last block is taken if more than half of it is missing
    ranked = ranked.withColumn("copies", (F.col("_passes") + (F.col("_w0") + F.col("_lw") - F.col("words") / 2 <= F.col("_more")).cast("long")).cast("long"))
    ranked = ranked.withColumn("_rank", F.col("_c0") + F.col("_lc") - 1)
    # copies of a block are as many draws of its source: the k-th pass follows all blocks of the passes before it
    draws = reuse(ranked.where("copies > 0").select("_row", "_id", "_h", "_source", "block", "words", "_key", F.explode(F.transform(F.sequence(F.lit(0), (F.col("copies") - 1).cast("int")), lambda k: k * F.col("_all") + F.col("_rank"))).alias("_draw")))
    quota = draws.groupBy("_source").agg(F.count("*").alias("q"))

    def tree(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_source", na_position="last")
        ends = np.cumsum(split_tree(pdf["q"].to_numpy(), shards, seed), axis=1)
        starts = np.concatenate([np.zeros((len(ends), 1), np.int64), ends[:, :-1]], axis=1)
        at, shard = np.nonzero(ends > starts)
        return pd.DataFrame({"_source": pdf["_source"].to_numpy()[at], "shard": shard, "_lo": starts[at, shard], "_hi": ends[at, shard], "_width": np.maximum(pdf["q"].to_numpy()[at] // shards, 1)})

    kind = df.schema[source_col].dataType.simpleString()
    leaves = reuse(quota.withColumn("_one", F.lit(1)).groupBy("_one").applyInPandas(tree, f"_source {kind}, shard int, _lo long, _hi long, _width long"))  # one row per source
    # a leaf draws a range of its source's permuted blocks; ranges are found by cells of a mean leaf's width
    cells = leaves.withColumn("_cell", F.explode(F.sequence(F.expr("_lo div _width"), F.expr("(_hi - 1) div _width"))))
    widths = leaves.groupBy("_source").agg(F.max("_width").alias("_width"))
    drawn = draws.join(widths, draws["_source"].eqNullSafe(widths["_source"])).select(draws["*"], F.expr("_draw div _width").alias("_cell"))
    hit = drawn["_source"].eqNullSafe(cells["_source"]) & (drawn["_cell"] == cells["_cell"]) & (drawn["_draw"] >= cells["_lo"]) & (drawn["_draw"] < cells["_hi"])
    mix = drawn.join(cells, hit).select("_row", "_id", "_h", drawn["_source"], "block", "words", "shard", F.xxhash64("_key", "_draw", F.lit(seed)).alias("place"))
    taken = mix.groupBy("_row").agg(F.sum("words").alias("taken"))
    docs = sized.join(goal, sized["_source"].eqNullSafe(goal["_source"])).select(sized["*"], "source_size", "target")
    docs = docs.join(taken, "_row", "left").select("_row", "_id", "_h", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
    return mix, docs


def mix_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """Whole documents as the mix takes them: a block is a document, a document stands there once for each draw, in the order of
    its shard. Columns as in ``df``; texts without words are no part of a mix. Of rows equal in id, text and source one stands for all: it comes as often as
    they are drawn together, which is at most twice for each of them. ``options`` as in ``mix_blocks``."""
    mix, docs = mix_blocks(df, id_col, text_col, source_col, words=WHOLE, **options)
    plan = mix.select(F.col("_id").alias("_mid"), F.col("_h").alias("_mh"), F.col("_source").alias("_ms"), F.col("shard").alias("_mshard"), F.col("place").alias("_mplace"))
    own, shard, place = fresh(df, "_dh"), fresh(df, "_shard"), fresh(df, "_place")
    keyed = df.withColumn(own, F.xxhash64(id_col, text_col))
    if not docs.where("size > 0").groupBy("_id", "_h").count().where("count > 1").isEmpty():
        keyed = keyed.dropDuplicates([id_col, own, source_col])
    joined = keyed.join(plan, keyed[id_col].eqNullSafe(plan["_mid"]) & (keyed[own] == plan["_mh"]) & keyed[source_col].eqNullSafe(plan["_ms"]))
    rows = joined.select(*[keyed[c] for c in df.columns], plan["_mshard"].alias(shard), plan["_mplace"].alias(place))
    return rows.repartition(shard).sortWithinPartitions(shard, place, id_col).select(*df.columns)


def op6(spark, sf_dir: str) -> DataFrame:
    _, docs = mix_blocks(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return docs.select(F.col("_id").alias("doc_id"), "size", "source_size", "target", "taken")
