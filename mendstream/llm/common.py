"""Text buffers, rolling hashes and column helpers shared by the operators of this subpackage.

Texts reach Python workers as Arrow batches; functions work on the UTF-8 buffer of a batch without
building Python strings. Null texts count as empty.
"""
from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from mendstream.session import TABLES, release, reuse

U = np.uint64
BASE = U(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2^64
BASE_INV = U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
CHUNK = 1 << 21  # bytes of text handled at once by array code
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

__all__ = ["BASE", "CHUNK", "TABLES", "U", "batch_rows", "chunks", "column", "fetch_key", "flat", "fresh", "mix", "powers", "prefix_hash", "release", "reuse", "same", "span_hash", "tidy", "word_bounds", "word_hashes"]


def batch_rows(df: DataFrame, rows: int = 512) -> DataFrame:
    """Small Arrow batches, so a batch of very long texts still fits a worker."""
    df.sparkSession.conf.set(BATCH, rows)
    return df


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of each table or count made inside go when it is done, not when the driver happens to collect its garbage."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def fetch_key(id_col: str, text_col: str) -> Column:
    """Tells rows apart that share an id; equal for rows equal in both columns."""
    return F.xxhash64(F.col(id_col), F.col(text_col))


def same(left: DataFrame, right: DataFrame, cols: list[str]) -> Column:
    """Equality of ``cols`` that also matches nulls."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & left[c].eqNullSafe(right[c])
    return cond


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary array; nulls are empty."""
    if texts.null_count:
        texts = texts.cast(pa.large_binary()).fill_null(b"")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offs, data = texts.buffers()
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offs, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return buf[off[0] : off[-1]], off - off[0]


def chunks(off: np.ndarray, limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``limit`` bytes each, one row at least."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        yield i, j
        i = j


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = x ^ (x >> U(32))
    x = x * U(0xD6E8FEB86659FD93)
    x = x ^ (x >> U(32))
    x = x * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n-1 of the base and of its inverse modulo 2^64."""
    out = []
    for b in (BASE, BASE_INV):
        p = np.full(max(n, 1), b, U)
        p[0] = 1
        out.append(np.cumprod(p))
    return out[0], out[1]


def prefix_hash(symbols: np.ndarray, pw: np.ndarray) -> np.ndarray:
    """Prefix sums of symbols weighted by powers: h[j] - h[i] is a hash of [i, j) shifted by i."""
    h = np.zeros(len(symbols) + 1, U)
    np.cumsum(mix(np.arange(256, dtype=U) + U(1))[symbols] * pw[: len(symbols)], out=h[1:])
    return h


def span_hash(h: np.ndarray, inv: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix((h[end] - h[start]) * inv[start] + (end - start).astype(U))


def word_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each non-empty span: the sum of its bytes, each mixed together with its place. No structure of the bytes makes two spans meet, as it can with a polynomial."""
    size = end - start
    first = np.cumsum(size) - size
    place = np.arange(int(size.sum())) - np.repeat(first, size)
    mixed = mix(buf[np.repeat(start, size) + place].astype(U) | ((place.astype(U) + U(1)) << U(8)))
    return mix(np.add.reduceat(mixed, first) + size.astype(U))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, longer where ``df`` has such a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def word_bounds(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes other than space and tab to carriage return; no run spans two texts."""
    word = np.ones(len(buf) + 2, bool)
    word[0] = word[-1] = False
    word[1:-1] = ~((buf == 32) | ((buf >= 9) & (buf <= 13)))
    step = word[1:] != word[:-1]
    cut = off[1:-1]
    cut = np.unique(cut[(cut > 0) & (cut < len(buf))])
    inside = cut[word[cut] & word[cut + 1]]  # a text ends and the next one begins inside a run
    at = np.flatnonzero(step)
    starts, ends = at[0::2], at[1::2]
    if len(inside):
        starts, ends = np.sort(np.concatenate([starts, inside])), np.sort(np.concatenate([ends, inside]))
    return starts, ends
