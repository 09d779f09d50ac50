"""Alignment of two tokenizers over a corpus by inverted pair bitmaps.

Every text is cut by a byte-level vocabulary (A) and a piece model (B). Where a token of each ends at the same byte, the two are linked, and the tokens between
two such places form a group. Each pair of ids has a posting list: for every chunk of documents a compressed bitmap of those that link the pair, kept as
planes: plane j holds the documents in whose number of links bit j is set. Planes OR-merged and popcounted give document counts, planes
popcounted by weight give link counts. The counts are joined to the postings, and the postings return them to the documents of their chunk as scores:
no row is ever written for a link, or for a pair of a document.

A chunk is 2^16 documents of one task, numbered as they are written to a shared table; what is counted reads that table, so a task that
runs again changes no number. A chunk's postings are flushed when they reach ``ENTRIES``; pieces of a bitmap are OR-merged after the shuffle.
A pair that occurs in all chunks is spread by chunk, and the join to the counts may be split as the counts have one row a pair.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructField, StructType

from mendstream.llm.bpe import Encoder, Vocabulary
from mendstream.llm.common import batch_rows, chunks, column, reuse

CHUNK_BITS = 16
DENSE = 4096  # members from which a plane is a plain bitmap of a chunk
ENTRIES = 1 << 21  # (document, pair) entries that a task holds before it flushes them
TOGETHER = 1 << 21  # characters that are tokenized at once


class Pair:
    """The two tokenizers in a worker, with the bytes of each token."""

    def __init__(self, vocabulary: dict, path_b: str):
        import sentencepiece

        v = Vocabulary(vocabulary)
        v.special = {}  # their strings in a text are plain text
        self.a, self.b = Encoder(v), sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_a = v.token
        pieces = [self.b.id_to_piece(i) for i in range(len(self.b))]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.size_a, self.size_b = (np.array([len(t) for t in x]) for x in (self.bytes_a, self.bytes_b))
        # decimals with what follows them: inside a group, at its end
        self.ends_a = np.array([f"{i}{c}" for c in ",|" for i in range(len(self.bytes_a))], object)
        self.ends_b = np.array([f"{i}{c}" for c in ",;" for i in range(len(self.bytes_b))], object)

    def encode(self, texts: list[str | None]) -> tuple[list, list]:
        """Ids of A and of B for each text; none where a text is null, empty or not what its tokens spell."""
        known = [i for i, t in enumerate(texts) if t]
        spaced = [" " + texts[i] for i in known]
        a, b = self.a.encode(spaced)[0] if known else [], self.b.encode([texts[i] for i in known], num_threads=1)
        ids_a, ids_b = [[] for _ in texts], [[] for _ in texts]
        for i, want, x, y in zip(known, spaced, a, b):
            want = want.encode()
            if b"".join(map(self.bytes_a.__getitem__, x)) == want and b"".join(map(self.bytes_b.__getitem__, y)) == want:
                ids_a[i], ids_b[i] = x, y
        return ids_a, ids_b

    def align(self, texts: list[str | None]) -> dict[str, np.ndarray]:
        """Per text n_a, n_b, n_groups and sha256 of its groups; per link the text's number and the two ids. A token has at least one byte, so a link is a group's end."""
        lists_a, lists_b = self.encode(texts)
        n_a, n_b = (np.array([len(x) for x in lists], np.int64) for lists in (lists_a, lists_b))
        a, b = (np.fromiter(chain.from_iterable(lists), np.int64, int(n.sum())) for lists, n in ((lists_a, n_a), (lists_b, n_b)))
        stop_a, stop_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])  # both count the same bytes, so texts end together
        end_a, end_b = np.isin(stop_a, stop_b, assume_unique=True), np.isin(stop_b, stop_a, assume_unique=True)
        group_a, group_b = np.cumsum(end_a) - end_a, np.cumsum(end_b) - end_b
        doc = np.repeat(np.arange(len(texts)), n_a)[end_a]
        n_groups = np.bincount(doc, minlength=len(texts))
        total = int(end_a.sum())
        size_a, size_b = np.bincount(group_a, minlength=total), np.bincount(group_b, minlength=total)
        said = np.empty(len(a) + len(b), object)
        said[np.arange(len(a)) + (np.cumsum(size_b) - size_b)[group_a]] = self.ends_a[a + end_a * len(self.bytes_a)]
        said[np.arange(len(b)) + np.cumsum(size_a)[group_b]] = self.ends_b[b + end_b * len(self.bytes_b)]
        at = np.append(0, np.cumsum(n_a + n_b)).tolist()
        sha = [hashlib.sha256("".join(said[i:j].tolist())[:-1].encode()).hexdigest() if i < j else "" for i, j in zip(at, at[1:])]
        return {"n_a": n_a, "n_b": n_b, "n_groups": n_groups, "sha": sha, "doc": doc, "a": a[end_a], "b": b[end_b]}


def planes(pair: np.ndarray, bit: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """(pairs, their postings) of entries that are sorted by pair and bit.

    Postings are words of 16 bits; each plane is its weight's exponent, the number of its members (0 means 2^16) and its members, or from ``DENSE`` on all 2^16 bits.
    """
    top = int(times.max()).bit_length()
    at = [np.flatnonzero((times >> j) & 1) for j in range(top)]
    entry, level = np.concatenate(at), np.repeat(np.arange(top), [len(x) for x in at])
    o = np.lexsort((entry, level, pair[entry]))
    entry, level = entry[o], level[o]
    new = np.append(True, (pair[entry][1:] != pair[entry][:-1]) | (level[1:] != level[:-1]))
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(entry)))
    dense = count >= DENSE
    size = 2 + np.where(dense, (1 << CHUNK_BITS) // 16, count)
    to = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), np.uint16)
    out[to], out[to + 1] = level[first], count & 0xFFFF
    spot = np.repeat(to + 2 - first, count) + np.arange(len(entry))
    sparse = ~np.repeat(dense, count)
    out[spot[sparse]] = bit[entry[sparse]]
    for k in np.flatnonzero(dense):
        full = np.zeros(1 << CHUNK_BITS, np.uint8)
        full[bit[entry[first[k] : first[k] + count[k]]]] = 1
        out[to[k] + 2 : to[k] + size[k]] = np.packbits(full, bitorder="little").view(np.uint16)
    names, row = np.unique(pair[entry[first]], return_index=True)
    edge = 2 * np.append(to[row], len(out)).astype(np.int32)
    return names, pa.Array.from_buffers(pa.binary(), len(names), [None, pa.py_buffer(edge.tobytes()), pa.py_buffer(out.tobytes())])


def members(postings: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, bit, weight) of all members of all planes of an array of postings, plane after plane."""
    off = np.frombuffer(postings.buffers()[1], np.int32)[postings.offset : postings.offset + len(postings) + 1].astype(np.int64) // 2
    words = np.frombuffer(postings.buffers()[2], np.uint16)
    row, at = np.arange(len(postings)), off[:-1].copy()
    stop = off[1:]
    while True:
        live = at < stop[row]
        row, at = row[live], at[live]
        if not len(row):
            return
        level, count = words[at].astype(np.int64), words[at + 1].astype(np.int64)
        count[count == 0] = 1 << CHUNK_BITS
        dense = count >= DENSE
        few = np.where(dense, 0, count)
        end = np.cumsum(few)
        spot = np.arange(int(end[-1])) + np.repeat(at + 2 - (end - few), few)
        yield np.repeat(row, few), words[spot].astype(np.int64), np.repeat(1 << level, few)
        for k in np.flatnonzero(dense):
            bits = np.flatnonzero(np.unpackbits(words[at[k] + 2 : at[k] + 2 + (1 << CHUNK_BITS) // 16].view(np.uint8), bitorder="little"))
            yield np.full(len(bits), row[k]), bits, np.full(len(bits), 1 << level[k])
        at = at + 2 + np.where(dense, (1 << CHUNK_BITS) // 16, count)


def index(df: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One table of two kinds of rows. Documents: _id, chunk, bit, n_a, n_b, n_groups, sha. Pieces of postings: chunk, a, b, postings, links."""
    rows = df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    vocabulary = df.sparkSession.sparkContext.broadcast(Vocabulary.read(path_a))  # of a fixed size
    long_ = [StructField(c, LongType()) for c in ("n_a", "n_b", "n_groups")]
    schema = StructType([rows.schema["_id"], StructField("chunk", LongType()), StructField("bit", IntegerType()), *long_, StructField("sha", StringType()), StructField("a", IntegerType()), StructField("b", IntegerType()), StructField("postings", BinaryType()), StructField("links", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = Pair(vocabulary.value, path_b)
        base, done, held, size = TaskContext.get().partitionId() << 32, 0, [], 0
        width = len(pair.bytes_b)

        def none(n: int, names: list[str]) -> list[pa.Array]:
            return [pa.nulls(n, kinds[c]) for c in names]

        def flush(chunk: int) -> pa.RecordBatch:
            key, bit, times = (np.concatenate(x) for x in zip(*held))
            o = np.lexsort((bit, key))
            names, postings = planes(key[o], bit[o], times[o])
            links = np.add.reduceat(times[o], np.flatnonzero(np.append(True, key[o][1:] != key[o][:-1])))
            n = len(names)
            return pa.RecordBatch.from_arrays([*none(n, ["_id"]), pa.array(np.full(n, chunk)), *none(n, ["bit", "n_a", "n_b", "n_groups", "sha"]), pa.array((names // width).astype(np.int32)), pa.array((names % width).astype(np.int32)), postings, pa.array(links)], names=schema.names)

        for batch in batches:
            kinds = {"_id": column(batch, "_id").type, "bit": pa.int32(), "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "sha": pa.string(), "a": pa.int32(), "b": pa.int32(), "postings": pa.binary(), "links": pa.int64()}
            texts = column(batch, "_text").to_pylist()
            for i, j in chunks(np.append(0, np.cumsum([len(t or "") for t in texts])), TOGETHER):
                while i < j:
                    k = min(j, i + (1 << CHUNK_BITS) - (done & 0xFFFF))
                    got, n = pair.align(texts[i:k]), k - i
                    chunk = base + (done >> CHUNK_BITS)
                    entry, times = np.unique((got["doc"] * len(pair.bytes_a) + got["a"]) * width + got["b"], return_counts=True)
                    if len(entry):
                        held.append((entry % (len(pair.bytes_a) * width), (entry // (len(pair.bytes_a) * width) + (done & 0xFFFF)).astype(np.uint16), times.astype(np.int64)))
                        size += len(entry)
                    yield pa.RecordBatch.from_arrays([column(batch, "_id").slice(i, n), pa.array(np.full(n, chunk)), pa.array(((done & 0xFFFF) + np.arange(n)).astype(np.int32)), *[pa.array(got[c]) for c in ("n_a", "n_b", "n_groups")], pa.array(got["sha"], pa.string()), *none(n, ["a", "b", "postings", "links"])], names=schema.names)
                    done, i = done + n, k
                    if held and (size > ENTRIES or not done & 0xFFFF):
                        yield flush(chunk)
                        held, size = [], 0
        if held:
            yield flush(chunk)

    return batch_rows(rows).mapInArrow(run, schema)


def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces sorted by (a, b, chunk): documents and links of each pair and chunk, from its OR-merged planes."""
    held = None
    for batch in batches:
        held = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        held = held.combine_chunks()
        key = np.stack([np.asarray(held.column(c).chunk(0)) for c in ("a", "b", "chunk")])
        new = np.append(True, (key[:, 1:] != key[:, :-1]).any(axis=0))
        cut = int(np.flatnonzero(new)[-1])  # the last bitmap may go on
        if cut:
            yield popcounts(held.slice(0, cut), np.cumsum(new[:cut]) - 1)
        held = held.slice(cut)
    if held is not None and held.num_rows:
        yield popcounts(held, np.zeros(held.num_rows, np.int64))


def popcounts(rows: pa.Table, bitmap: np.ndarray) -> pa.RecordBatch:
    n = int(bitmap[-1]) + 1
    docs, links = np.zeros(n, np.int64), np.zeros(n, np.int64)
    seen = []
    for row, bit, weight in members(rows.column("postings").combine_chunks()):
        np.add.at(links, bitmap[row], weight)
        seen.append((bitmap[row] << CHUNK_BITS) | bit)
    found = np.unique(np.concatenate(seen))  # a document stands in several planes
    np.add.at(docs, found >> CHUNK_BITS, 1)
    first = np.searchsorted(bitmap, np.arange(n))
    a, b = (rows.column(c).combine_chunks().take(pa.array(first)) for c in ("a", "b"))
    return pa.RecordBatch.from_arrays([a, b, pa.array(docs), pa.array(links)], names=["a", "b", "docs", "links"])


def pair_counts(indexed: DataFrame) -> DataFrame:
    """a, b, docs (documents that link the two ids), links. The table has at most one row for each pair of vocabulary entries."""
    pieces = indexed.where("postings is not null").select("a", "b", "chunk", "postings")
    pieces = pieces.repartition("a", "b", "chunk").sortWithinPartitions("a", "b", "chunk")
    each = batch_rows(pieces, 1 << 13).mapInArrow(merge, "a int, b int, docs long, links long")
    return each.groupBy("a", "b").agg(F.sum("docs").alias("docs"), F.sum("links").alias("links"))


def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Postings sorted by chunk, with the count of their pair and whether it is its b's best: sums for each document. Holds the sums of one chunk."""
    held, best, total, seen = None, None, None, None

    def out() -> pa.RecordBatch:
        at = np.flatnonzero(seen)
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(at), held)), pa.array(at.astype(np.int32)), pa.array(best[at]), pa.array(total[at])], names=["chunk", "bit", "n_best", "count_sum"])

    for batch in batches:
        chunk = np.asarray(column(batch, "chunk"))
        edge = np.flatnonzero(np.append(True, chunk[1:] != chunk[:-1])).tolist() + [len(chunk)]
        for i, j in zip(edge, edge[1:]):
            if chunk[i] != held:
                if held is not None:
                    yield out()
                held = int(chunk[i])
                best, total, seen = np.zeros(1 << CHUNK_BITS, np.int64), np.zeros(1 << CHUNK_BITS, np.int64), np.zeros(1 << CHUNK_BITS, bool)
            part = batch.slice(i, j - i)
            count, is_best = np.asarray(column(part, "count")), column(part, "best").to_numpy(zero_copy_only=False)
            for row, bit, weight in members(column(part, "postings")):
                np.add.at(total, bit, weight * count[row])
                np.add.at(best, bit, weight * is_best[row])
                seen[bit] = True
    if held is not None:
        yield out()


def alignment(df: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(documents, pairs).

    documents: one row per row of ``df``: _id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256. pairs: a, b, docs, links. ``path_a`` is a byte-level vocabulary file,
    ``path_b`` a piece model that the workers read, both of fixed size.

    Null and empty texts, and texts that the tokens of A or B do not spell exactly, have zeros and ''. Special strings in a text are plain text. Equal texts, repeated ids
    and null ids are rows of their own; an empty table gives no rows; other columns play no part, whatever their names. Texts are tokenized whole.
    """
    indexed = reuse(index(df, path_a, path_b, id_col, text_col))
    pairs = reuse(pair_counts(indexed))
    highest = pairs.groupBy("b").agg(F.max("links").alias("_most"))  # one row for each entry of B's vocabulary
    counts = pairs.join(F.broadcast(highest), "b").select("a", "b", F.col("links").alias("count"), (F.col("links") == F.col("_most")).alias("best"))
    postings = indexed.where("postings is not null").select("a", "b", "chunk", "postings").join(counts, ["a", "b"])
    postings = postings.select("chunk", "postings", "count", "best").repartition("chunk").sortWithinPartitions("chunk")
    found = batch_rows(postings, 1 << 13).mapInArrow(scores, "chunk long, bit int, n_best long, count_sum long")
    docs = indexed.where("bit is not null").join(found, ["chunk", "bit"], "left")
    zero = F.lit(0).cast("long")
    return docs.select("_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), F.col("sha").alias("groups_sha256")), pairs


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs, _ = alignment(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return docs.withColumnRenamed("_id", "doc_id")
