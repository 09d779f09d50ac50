"""Quality by supervised subword embeddings.

Every word, every run of 3 to 5 bytes inside a word with its neighbours, and every word bigram that repeats one word (as one
mark, whatever the word) is hashed to one of ``BUCKETS`` rows of a vector table. A text is the mean of its vectors; a linear layer and softmax give the score. Table and layer are learned together by stochastic gradient descent in
numpy on a bounded sample of the labelled rows (``limit`` texts of each label, by hash of the id), whole texts.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from mendstream.llm.common import U, batch_rows, chunks, column, flat, mix, powers, prefix_hash, span_hash, word_bounds
from mendstream.llm.toxicity import training_ids

BUCKETS, DIMS, GRAMS = 1 << 16, 8, (3, 4, 5)
REPEAT = U(12345)  # bucket of a word bigram that repeats one word


def buckets(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text number, bucket) of each word, repeated word, and run of bytes that touches no white space but at its ends."""
    if not len(buf):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    pw, inv = powers(len(buf) + 1)
    h = prefix_hash(buf, pw)
    start, end = word_bounds(buf, off)
    text = np.searchsorted(off, start, "right") - 1
    word = span_hash(h, inv, start, end)
    again = np.flatnonzero((word[1:] == word[:-1]) & (text[1:] == text[:-1])) + 1
    docs, found = [text, text[again]], [word >> U(48), np.full(len(again), REPEAT, U)]
    inside = np.zeros(len(buf) + 1, np.int32)
    np.add.at(inside, start, 1)
    np.add.at(inside, end, -1)
    blank = np.append(0, np.cumsum(np.cumsum(inside[:-1]) == 0))
    of = np.repeat(np.arange(len(off) - 1), np.diff(off))
    for n in GRAMS:
        at = np.arange(max(0, len(buf) - n + 1))
        at = at[(blank[at + n - 1] == blank[at + 1]) & (of[at] == of[at + n - 1])] if len(at) else at
        docs.append(of[at])
        found.append(mix((h[at + n] - h[at]) * inv[at] + U(n)) >> U(48))
    return np.concatenate(docs), np.concatenate(found).astype(np.int64) % BUCKETS


def train(bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = 5, rate: float = 1.0, batch: int = 32, seed: int = 7) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(vectors, layer, constants) from bags of (bucket, share of the text)."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIMS, 1 / DIMS, (BUCKETS, DIMS)).astype(np.float32)
    layer, bias = np.zeros((DIMS, 2), np.float32), np.zeros(2, np.float32)
    layer[:, 1] = rng.uniform(-0.1, 0.1, DIMS)
    steps, done = epochs * -(-len(bags) // batch), 0
    for _ in range(epochs):
        order = rng.permutation(len(bags))
        for i in range(0, len(order), batch):
            pick = order[i : i + batch]
            ids = np.concatenate([bags[k][0] for k in pick])
            share = np.concatenate([bags[k][1] for k in pick])
            row = np.repeat(np.arange(len(pick)), [len(bags[k][0]) for k in pick])
            mean = np.stack([np.bincount(row, weights=vectors[ids, k] * share, minlength=len(pick)) for k in range(DIMS)], axis=1).astype(np.float32)
            z = mean @ layer + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(pick)), labels[pick]] -= 1
            lr = rate * (1 - done / steps)
            back = (p @ layer.T).astype(np.float32)
            layer -= lr * (mean.T @ p) / len(pick)
            bias -= lr * p.mean(axis=0)
            for k in range(DIMS):
                vectors[:, k] -= (lr * 20) * np.bincount(ids, weights=back[row, k] * share, minlength=BUCKETS).astype(np.float32)
            done += 1
    return vectors, layer, bias


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", held_out: str = "false", limit: int = 3000) -> tuple[np.ndarray, float]:
    """(logit of each bucket, constant): softmax of two classes over a mean of vectors is a logistic function of a mean of numbers."""
    ids = training_ids(labels, id_col, label_col, held_out, limit).cache()
    sample = docs.select(F.col(id_col).alias("_tid"), F.col(text_col).alias("_text")).join(F.broadcast(ids), "_tid")  # at most 2 * limit rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole, offs = flat(column(batch, "_text"))
            bags = []
            for i, j in chunks(offs):
                doc, bucket = buckets(whole[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
                for d in range(j - i):
                    c = np.bincount(bucket[doc == d], minlength=BUCKETS)
                    at = np.flatnonzero(c)
                    bags.append((at.astype(np.uint16).tobytes(), (c[at] / max(1, c.sum())).astype(np.float32).tobytes()))
            yield pa.RecordBatch.from_arrays([column(batch, "_tid"), pa.array([b[0] for b in bags], pa.binary()), pa.array([b[1] for b in bags], pa.binary()), column(batch, "_label")], names=["tid", "ids", "share", "y"])

    tid = docs.schema[id_col].dataType.simpleString()
    rows = batch_rows(sample, 64).mapInArrow(run, f"tid {tid}, ids binary, share binary, y int").collect()
    ids.unpersist()
    rows.sort(key=lambda r: (r.tid, r.y))
    if not rows:
        return np.zeros(BUCKETS), 0.0
    y = np.array([r.y for r in rows])
    bags = [(np.frombuffer(r.ids, np.uint16).astype(np.int64), np.frombuffer(r.share, np.float32)) for r in rows]
    vectors, layer, bias = train(bags, y)
    return (vectors @ (layer[:, 1] - layer[:, 0])).astype(np.float64), float(bias[1] - bias[0])


def score(df: DataFrame, model: tuple[np.ndarray, float], text_col: str = "text", out_col: str = "score") -> DataFrame:
    """``df`` with the quality of each text, 0 to 1; null texts count as empty and get the constant. ``out_col`` replaces a column of that name."""
    told = df.sparkSession.sparkContext.broadcast(model)
    kept = [f for f in df.schema.fields if f.name != out_col]
    schema = StructType([*kept, StructField(out_col, DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logit, bias = told.value
        for batch in batches:
            whole, offs = flat(column(batch, text_col))
            out = np.zeros(batch.num_rows)
            for i, j in chunks(offs, 1 << 20):
                doc, bucket = buckets(whole[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
                n = np.bincount(doc, minlength=j - i)
                out[i:j] = np.bincount(doc, weights=logit[bucket], minlength=j - i) / np.maximum(n, 1)
            p = 1 / (1 + np.exp(-np.clip(out + bias, -30, 30)))
            yield pa.RecordBatch.from_arrays([*[column(batch, f.name) for f in kept], pa.array(p)], names=schema.names)

    return batch_rows(df).mapInArrow(run, schema)


HELD_OUT = "crc32(cast(doc_id as string)) % 5 = 0"
THRESHOLD = 0.3


def op8(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), held_out=HELD_OUT)
    return score(docs, model).select("doc_id", F.expr(HELD_OUT).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
