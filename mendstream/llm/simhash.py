"""Near-duplicate texts by SimHash fingerprints, candidates filtered by the pigeonring principle.

A fingerprint has 64 bits, cut into segments that stand on a ring. If two fingerprints differ in at most ``bits`` bits, then from
some segment on every chain of consecutive segments differs in at most its proportional share of ``bits``: none in the
first of five segments for four bits, one in the first two, two in the first three, three in the first four.

1. Each distinct fingerprint is dealt once for each segment, by the segment's value: the first link of a chain, which must agree.
2. A cell of fingerprints that agree there is compared in sorted runs; chains over budget go before the full Hamming check.
3. A cell of more than ``CELL`` members is not compared but dealt again with one segment more: stored fingerprints under their
   own value, probing ones under every value that the chain's budget allows. With all segments dealt a cell stores one
   fingerprint, so no group of near copies or common value meets in one task, and no pair is left out.
Every cell returns a forest of its links instead of all pairs; components of the forests are those of the links.
"""
from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BooleanType, IntegerType, LongType, StructField, StructType

from mendstream.llm.common import U, batch_rows, column, flat, reuse
from mendstream.llm.components import components

SEED = 42
BITS = 64
CELL = 4096  # members of a cell that is compared as it is
LINKS = 1 << 20  # links that are held before they become a forest
COUNT = 1 << 18  # shingles whose bits are counted at once
PIECE = 1 << 20  # bytes whose words are listed at once
GAP = re.compile(rb"[\x20\x09-\x0D]")


def squeezed(text: bytes) -> bytes:
    """Lower-cased words with one blank between them; the text is taken apart in pieces, as a list of all words would be far larger than it."""
    parts, at = [], 0
    while at < len(text):
        gap = GAP.search(text, at + PIECE)
        end = gap.start() if gap else len(text)
        parts.append(b" ".join(text[at:end].lower().split()))
        at = end
    return b" ".join([p for p in parts if p])


def fingerprint(text: bytes, words: int) -> int:
    """Majority of the bits of the XXH64 hashes of all ``words``-word shingles; 0 without words."""
    joined = squeezed(text)
    if not joined:
        return 0
    blank = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    k = min(words, len(blank) + 1)
    first, last = np.append(0, blank + 1)[: len(blank) + 2 - k], np.append(blank, len(joined))[k - 1 :]
    digest, ones = xxhash.xxh64_digest, np.zeros(BITS, np.int64)
    for at in range(0, len(first), COUNT):
        spans = zip(first[at : at + COUNT].tolist(), last[at : at + COUNT].tolist())
        hashes = np.frombuffer(b"".join([digest(joined[a:b], SEED) for a, b in spans]), np.uint8)
        ones += np.unpackbits(hashes).reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(first)).tobytes(), "big")


def fingerprints(df: DataFrame, text_col: str = "text", words: int = 4, out_col: str = "fingerprint") -> DataFrame:
    """``df`` with the fingerprint of each whole text as a signed 64-bit number. A-Z are lower-cased, words are runs of anything but
    space and tab to carriage return. Fewer words than ``words`` are one shingle; null texts and texts without words have
    fingerprint 0. ``out_col`` replaces a column of that name."""
    kept = [f for f in df.schema.fields if f.name != out_col]
    schema = StructType([*kept, StructField(out_col, LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, off = flat(column(batch, text_col))
            prints = np.array([fingerprint(buf[a:b].tobytes(), words) for a, b in zip(off[:-1].tolist(), off[1:].tolist())], U)
            yield pa.RecordBatch.from_arrays([*[column(batch, f.name) for f in kept], pa.array(prints.view(np.int64))], names=schema.names)

    return batch_rows(df).mapInArrow(run, schema)


def segments(bits: int) -> list[np.ndarray]:
    """Bit numbers of each of the ``bits`` + 1 segments, whose sizes differ by one at most."""
    return np.array_split(np.arange(BITS), bits + 1)


def chain_masks(bits: int, start: int) -> list[tuple[np.uint64, int]]:
    """(mask, budget) of the chains of 1, 2, ... segments from ``start`` on around the ring."""
    parts, mask, out = segments(bits), 0, []
    m = len(parts)
    for length in range(1, m + 1):
        mask |= sum(1 << int(b) for b in parts[(start + length - 1) % m])
        out.append((U(mask), length * bits // m))
    return out


def linked(x: np.ndarray, chains: list[tuple[np.uint64, int]], bits: int) -> np.ndarray:
    """Which differences ``x`` stay within every chain's budget, then within ``bits``."""
    at = np.arange(len(x))
    for mask, budget in chains[1:-1]:
        at = at[np.bitwise_count(x[at] & mask) <= budget]
    return at[np.bitwise_count(x[at]) <= bits]


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, least node of its component) for the nodes of the links (a, b)."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, root[left], low)
        np.minimum.at(new, root[right], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    keep = root != np.arange(len(nodes))
    return nodes[keep], nodes[root[keep]]


def compare(bits: int) -> Callable:
    """Function of batches sorted by (start, key, probe) that yields a forest of the links of each cell.

    The members of a cell may be spread over batches; a cell of ``CELL`` rows at most is held. Probing rows meet stored ones, stored ones each other.
    """
    chains = [chain_masks(bits, s) for s in range(bits + 1)]

    def links(start: np.ndarray, key: np.ndarray, print_: np.ndarray, probe: np.ndarray) -> pa.RecordBatch:
        new = np.append(True, (key[1:] != key[:-1]) | (start[1:] != start[:-1]))
        last = np.append(np.flatnonzero(new)[1:], len(key))[np.cumsum(new) - 1]  # where the row's cell ends
        a = b = np.zeros(0, U)
        found, held = [], 0
        for s in np.unique(start).tolist():
            at, d = np.flatnonzero(~probe & (start == s)), 1  # stored rows come first in a cell
            while len(at := at[at + d < last[at]]):
                hit = at[linked(print_[at] ^ print_[at + d], chains[s], bits)]
                found.append((print_[hit], print_[hit + d]))
                held += len(hit)
                d += 1
                if held > LINKS:
                    a, b = forest(*map(np.concatenate, zip((a, b), *found)))
                    found, held = [], 0
        if held:
            a, b = forest(*map(np.concatenate, zip((a, b), *found)))
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            cols = [np.asarray(column(batch, "start")), np.asarray(column(batch, "key")), np.asarray(column(batch, "print")).view(U), column(batch, "probe").to_numpy(zero_copy_only=False)]
            if held is not None:
                cols = [np.concatenate(x) for x in zip(held, cols)]
            before = np.flatnonzero((cols[0] != cols[0][-1]) | (cols[1] != cols[1][-1]))  # rows of cells that are complete
            open_ = int(before[-1]) + 1 if len(before) else 0
            if open_:
                yield links(*[c[:open_] for c in cols])
            held = [c[open_:] for c in cols]
        if held is not None and len(held[0]):
            yield links(*held)

    return run


CELLS = StructType([StructField("start", IntegerType()), StructField("key", LongType()), StructField("print", LongType()), StructField("probe", BooleanType()), StructField("used", IntegerType()), StructField("length", IntegerType())])


def deal(bits: int) -> Callable:
    """Function of batches that adds the next segment of the chain to the key: stored rows once, probing rows once for each value within budget.

    Column ``used`` holds the bits by which a probing row already differs, ``length`` the segments in the key.
    """
    parts = segments(bits)
    m = len(parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start, length, used = (np.asarray(column(batch, c)) for c in ("start", "length", "used"))
            key, prints, probe = np.asarray(column(batch, "key")).view(U), np.asarray(column(batch, "print")).view(U), column(batch, "probe").to_numpy(zero_copy_only=False)
            for s, n in {*zip(start.tolist(), length.tolist())}:
                here = (start == s) & (length == n)
                part = parts[(s + n) % m]
                mask, budget = U(sum(1 << int(b) for b in part)), (n + 1) * bits // m
                for more in range(budget + 1):
                    # a stored row stays stored under its own value and probes all others within budget
                    at = np.flatnonzero(here & (used + more <= budget))
                    for flips in combinations(part.tolist(), more) if len(at) else ():
                        moved = (prints[at] ^ U(sum(1 << b for b in flips))) & mask
                        cols = [start[at], (key[at] | moved).view(np.int64), prints[at].view(np.int64), probe[at] | (more > 0), used[at] + np.int32(more), length[at] + np.int32(1)]
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=CELLS.names)

    return run


def near_links(prints: DataFrame, bits: int = 4, cell: int = CELL) -> DataFrame:
    """(a, b): links whose components are those of all pairs of distinct values of ``print`` that differ in at most ``bits`` bits.

    The key of a cell holds the bits of the chain's segments in their places. Each round deals only cells that are too large to be compared
    as they are; there are at most ``bits`` rounds more, and none is needed while values spread evenly.
    """
    firsts = [sum(1 << int(b) for b in part) for part in segments(bits)]
    signed = [m - (1 << BITS) if m >> (BITS - 1) else m for m in firsts]
    starts = F.explode(F.array(*[F.struct(F.lit(s).alias("start"), F.col("print").bitwiseAND(F.lit(m)).alias("key")) for s, m in enumerate(signed)]))
    rows = prints.select("print").distinct().withColumn("at", starts)
    rows = reuse(rows.select("at.start", "at.key", "print", F.lit(False).alias("probe"), F.lit(0).alias("used"), F.lit(1).alias("length")))
    found = None
    for length in range(1, bits + 2):
        size = rows.groupBy("start", "key").agg(F.count("*").alias("_n"), F.sum((~F.col("probe")).cast("long")).alias("_stored"))
        if length > 1:  # probing rows that meet nothing go
            rows = rows.join(size.where("_stored > 0 and _n > 1").select("start", "key"), ["start", "key"], "left_semi")
        # with all segments dealt a cell has one stored row, and nothing is left to deal
        large = reuse(size.where(f"_n > {cell} and _stored > 0").select("start", "key")) if length <= bits else size.select("start", "key").limit(0)
        small = rows.join(large, ["start", "key"], "left_anti").repartition("start", "key").sortWithinPartitions("start", "key", "probe")
        links = batch_rows(small, 1 << 15).mapInArrow(compare(bits), "a long, b long")
        found = links if found is None else found.unionByName(links)
        if large.isEmpty():
            break
        rows = reuse(batch_rows(rows.join(large, ["start", "key"]).select(*CELLS.names), 1 << 12).mapInArrow(deal(bits), CELLS))
    return found


def simhash_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, bits: int = 4) -> DataFrame:
    """One row per row of ``df``: _id, fingerprint (signed), component_id, the least id reachable by links of texts whose fingerprints differ in at
    most ``bits`` bits.

    Null texts and texts without words share fingerprint 0 and are linked like any other. Rows that repeat an id or a text are rows of
    their own with the same component. A null id is never a component's id unless all its ids are null. An empty table gives no rows; other columns of ``df``
    play no part, whatever their names.
    """
    docs = reuse(fingerprints(df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")), "_text", words, "print").select("_id", "print"))
    nodes = docs.groupBy("print").agg(F.min("_id").alias("low"))
    links = near_links(nodes, bits)
    label = reuse(components(links))
    named = nodes.join(label, nodes["print"] == label["node"], "left").select("print", "low", F.coalesce("label", "print").alias("label"))
    low = named.groupBy("label").agg(F.min("low").alias("component_id"))
    named = named.join(low, "label").select("print", "component_id")
    return docs.join(named, "print").select("_id", F.col("print").alias("fingerprint"), "component_id")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, bits: int = 4) -> DataFrame:
    """The least id of each component, as column ``id_col``: what a filter keeps. Equal ids give one row."""
    return simhash_components(df, id_col, text_col, words, bits).select(F.col("component_id").alias(id_col)).distinct()


def op11(spark, sf_dir: str) -> DataFrame:
    found = simhash_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select(F.col("_id").alias("doc_id"), F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")
