"""Document fingerprints by locally consistent parsing.

A text is cut into phrases by deterministic coin tossing: each symbol gets a label from the lowest bit in which it differs from its
left neighbour, twice more from the labels, and phrases begin at local maxima of the labels. Where a phrase begins depends on
a few symbols around it only, so equal substrings are cut alike, wherever they stand. A phrase is named by a hash of its symbols;
the names are the symbols of the next level. Runs of one symbol are folded first.

The fingerprint keeps, for each of four levels, the least hash of the names in each of some bins (four bytes; 0: no name). Names
of the lowest level are short, so long texts share them whatever they say; it has the fewest bins.
Likeness is the share of equal bins among those that are filled in either. Equal texts have equal fingerprints.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from mendstream.llm.common import U, batch_rows, column, fetch_key, mix

BINS = (8, 24, 40, 24)  # of the four levels; phrases have about 3, 9, 27 and 81 characters


def _toss() -> np.ndarray:
    """Label of a small symbol after another: twice the place of the lowest bit in which they differ, plus that bit."""
    a, b = np.meshgrid(np.arange(128), np.arange(128), indexing="ij")
    d = a ^ b
    low = np.bitwise_count(((d & -d) - 1).astype(np.uint64))
    return np.where(d == 0, 0, 2 * low + ((b >> np.where(d == 0, 0, low)) & 1)).astype(np.uint8)


def next_level(sym: np.ndarray, text: np.ndarray, level: int, toss: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the phrases of ``sym``, and the text each belongs to. ``text`` numbers the text of each symbol, ascending."""
    first = np.ones(len(sym), bool)
    first[1:] = text[1:] != text[:-1]
    new = first.copy()
    new[1:] |= sym[1:] != sym[:-1]
    at = np.flatnonzero(new)
    run = np.diff(np.append(at, len(sym)))
    sym, text, first = sym[at], text[at], first[at]
    long = run > 1
    sym[long] = mix(sym[long] * U(3) + run[long].astype(U))
    prev = np.append(U(0), sym[:-1])
    d = sym ^ prev
    d[first] = U(1)
    d[d == 0] = U(1)
    low = np.bitwise_count((d & (~d + U(1))) - U(1))
    label = (2 * low + ((sym >> low.astype(U)) & U(1)).astype(np.uint8)).astype(np.uint8)
    for _ in range(2):
        before = np.append(np.uint8(0), label[:-1])
        before[first] = 127 - label[first]
        label = toss[before, label]
    begin = first.copy()
    begin[1:-1] |= (label[1:-1] > label[:-2]) & (label[1:-1] >= label[2:]) & ~first[2:]
    begin[1:] &= first[1:] | ~begin[:-1]  # no phrase of one symbol before a maximum
    start = np.flatnonzero(begin)
    size = np.diff(np.append(start, len(sym)))
    place = np.arange(len(sym)) - np.repeat(start, size)
    part = mix(sym + place.astype(U) * U(0x9E3779B97F4A7C15))
    return mix(np.add.reduceat(part, start) + U(level)), text[start]


def sketches(texts: list[str], toss: np.ndarray, limit: int = 1 << 20) -> np.ndarray:
    """Fingerprint of each text as a row of four-byte bins."""
    width = sum(BINS)
    out = np.full((len(texts), width), 1 << 33, np.int64)
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j]) <= limit):
            size += len(texts[j])
            j += 1
        sym = np.frombuffer("".join(texts[i:j]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(U)
        text = np.repeat(np.arange(i, j), [len(t) for t in texts[i:j]])
        base = 0
        for level, bins in enumerate(BINS):
            if len(sym):
                sym, text = next_level(sym, text, level, toss)
                spread = mix(sym ^ U(0xA5A5A5A5 + level))
                value = (spread & U(0xFFFFFFFF)).astype(np.int64)
                bin_ = ((spread >> U(32)) % U(bins)).astype(np.int64)
                np.minimum.at(out.reshape(-1), text * width + base + bin_, np.maximum(value, 1))
            base += bins
        i = j
    out[out == 1 << 33] = 0
    return out.astype(">u4")


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal bins among the filled ones, row by row; two empty fingerprints are alike."""
    filled = ((a > 0) | (b > 0)).sum(axis=1)
    return np.where(filled == 0, 1.0, ((a == b) & (a > 0)).sum(axis=1) / np.maximum(filled, 1))


def with_next(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows dealt into id ranges (_range), in descending order inside each; the first row of the range that follows
    stands at the end (_extra = 1), after the last range the first row of all. Null ids come last.

    Only the range limits and one key per range reach the driver; a text moves once.
    """
    spark = df.sparkSession
    n = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"), fetch_key(id_col, text_col).alias("_h"))
    ids = rows.select("_id").where("_id is not null")
    limits = sorted(set(ids.approxQuantile("_id", [k / n for k in range(1, n)], 0.2 / n) if n > 1 else []), reverse=True)
    limit = F.array(*[F.lit(int(x)).cast("long") for x in limits])
    place = F.when(F.col("_id").isNull(), len(limits) + 1).otherwise(F.size(F.filter(limit, lambda b: b > F.col("_id"))) if limits else F.lit(0))
    rows = rows.withColumn("_range", place.cast("int"))
    order = F.struct(F.col("_id").isNull().alias("z"), (-F.col("_id")).alias("i"), "_h")
    tops = rows.groupBy("_range").agg(F.min(order).alias("o")).orderBy("_range").collect()
    to = spark.createDataFrame([(r._range, r.o.i, r.o._h, tops[k - 1]._range) for k, r in enumerate(tops)], "_r int, _i long, _hh long, _to int")
    to = rows.join(F.broadcast(to), (rows["_range"] == to["_r"]) & (-rows["_id"]).eqNullSafe(to["_i"]) & (rows["_h"] == to["_hh"]), "left")
    both = F.array(F.struct(F.col("_range"), F.lit(0).alias("_extra")), F.struct(F.col("_to").alias("_range"), F.lit(1).alias("_extra")))
    one = F.array(F.struct(F.col("_range"), F.lit(0).alias("_extra")))
    dealt = to.select("_id", "_text", "_h", F.explode(F.when(F.col("_to").isNotNull(), both).otherwise(one)).alias("_d")).select("_d._range", "_d._extra", "_id", "_text", "_h")
    return dealt.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "_range").sortWithinPartitions("_range", "_extra", F.col("_id").desc_nulls_last(), "_h")


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: the id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last floor(n / 2) code points replaced by the first as many of the next text in descending order of
    id, of the first text after the last. Null texts are empty; null ids come last, equal ids in order of a hash of the row.
    Ids are integers. Other columns are not read.
    """
    rows = with_next(batch_rows(df), id_col, text_col)
    id_type = df.schema[id_col].dataType
    schema = StructType([StructField(id_col, id_type), StructField("n_chars", LongType()), StructField("edited_sha256", StringType()), StructField("fingerprint", StringType()), StructField("edited_fingerprint", StringType()), StructField("near_edited", DoubleType()), StructField("near_next", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toss = _toss()
        held = None  # the last row of the batch before, with its fingerprint
        for batch in batches:
            ids, ranges, extra, texts = (column(batch, c).to_pylist() for c in ("_id", "_range", "_extra", "_text"))
            own = sketches(texts, toss)
            if held:
                ids, ranges, extra, texts = [held[0], *ids], [held[1], *ranges], [held[2], *extra], [held[3], *texts]
                own = np.concatenate([held[4], own])
            held = (ids[-1], ranges[-1], extra[-1], texts[-1], own[-1:])
            use = [k for k in range(len(ids) - 1) if not extra[k]]  # its next row is of the same range
            if not use:
                continue
            sizes = [len(texts[k]) for k in use]
            edited = [texts[k][: n - n // 2] + texts[k + 1][: n // 2] for k, n in zip(use, sizes)]
            changed = sketches(edited, toss)
            at = np.array(use)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([ids[k] for k in use], schema_id),
                    pa.array(sizes, pa.int64()),
                    pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]),
                    pa.array([own[k].tobytes().hex() for k in use]),
                    pa.array([x.tobytes().hex() for x in changed]),
                    pa.array(likeness(own[at], changed)),
                    pa.array(likeness(own[at], own[at + 1])),
                ],
                names=schema.names,
            )

    schema_id = {"bigint": pa.int64(), "int": pa.int32(), "smallint": pa.int16(), "tinyint": pa.int8()}[id_type.simpleString()]
    return rows.mapInArrow(run, schema)


def op2(spark, sf_dir: str) -> DataFrame:
    return fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
