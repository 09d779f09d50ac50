"""Removal of repeated byte strings by prefix-free parsing.

A rolling hash over ``GRAM`` bytes sets the triggers: every string of ``length`` bytes belongs to the least
hash it contains, so two equal strings have the same trigger at the same place, wherever they stand. The
starts of strings with one trigger form a phrase; phrases overlap by ``length - 1`` bytes and so
together hold every string of a text exactly once. The distinct phrases are the dictionary, the phrases of
the texts in order are the parse.

Corpus order is (trigger, place, bytes), cut off at ``length`` bytes, as nothing longer decides. A phrase that
occurs twice in the parse has only repeated suffixes. A trigger that occurs once has none. What is left are
different phrases of one trigger: their suffixes are put in order and equal neighbours are repeats.

No unbounded group meets in one task: counts are summed before the shuffle, joins on a phrase may be split, and triggers with very many
phrases are dealt by (trigger, suffix). Texts move once, by document: the join that fetches phrases and the one that cuts the spans
share a shuffle.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, ShortType, StringType, StructField, StructType

from mendstream.llm.common import U, batch_rows, chunks, column, fetch_key, flat, mix, powers, prefix_hash, reuse, span_hash

GRAM = 32
TOGETHER = 4096  # different phrases of a trigger whose suffixes are put in order in one task; of more, every suffix becomes a row
POS = 27  # low bits that hold the place of a trigger inside a chunk


def parse_phrases(buf: np.ndarray, off: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Phrases of the texts in ``buf``: text number, start in ``buf``, number of strings, trigger, phrase hash, bytes to the trigger."""
    n, none = len(buf), np.zeros(0, np.int64)
    gram = min(GRAM, length)
    if n < length:
        return none, none, none, none.astype(U), none.astype(U), none
    if n >= 1 << POS:
        raise ValueError("a text longer than 128 MB")
    pw, inv = powers(n + 1)
    h = prefix_hash(buf, pw)
    grams = mix((h[gram:] - h[:-gram]) * inv[: n - gram + 1])
    place = np.arange(len(grams), dtype=U)
    least = (grams & ~U((1 << POS) - 1)) | place
    width, w = length - gram + 1, 1
    while 2 * w <= width:
        least = np.minimum(least[:-w], least[w:])
        w *= 2
    last = n - length + 1
    least = np.minimum(least[:last], least[width - w : width - w + last])
    ok = np.zeros(last + 1, np.int64)  # starts whose string stays inside its text
    has = off[1:] - off[:-1] >= length
    np.add.at(ok, off[:-1][has], 1)
    np.add.at(ok, off[1:][has] - length + 1, -1)
    at = np.flatnonzero(np.cumsum(ok[:-1]) > 0)
    if not len(at):
        return none, none, none, none.astype(U), none.astype(U), none
    trig = (least[at] & U((1 << POS) - 1)).astype(np.int64)
    first = np.ones(len(at), bool)
    first[1:] = (trig[1:] != trig[:-1]) | (at[1:] != at[:-1] + 1)
    where = np.flatnonzero(first)
    start, count = at[where], np.diff(np.append(where, len(at)))
    trig = trig[where]
    phrase = mix(span_hash(h, inv, start, start + count + length - 1) ^ mix((trig - start).astype(U) + U(7)))
    return np.searchsorted(off, start, "right") - 1, start, count, grams[trig], phrase, trig - start


def _merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of spans, touching ones joined."""
    if not len(start):
        return start, end
    o = np.argsort(start, kind="stable")
    start, reach = start[o], np.maximum.accumulate(end[o])
    new = np.ones(len(start), bool)
    new[1:] = start[1:] > reach[:-1]
    first = np.flatnonzero(new)
    return start[first], reach[np.append(first[1:] - 1, len(start) - 1)]


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def parse_table(docs: DataFrame, length: int) -> DataFrame:
    """The parse: a row per text and phrase with its number of occurrences there; where a phrase recurs inside a text,
    also rows with n = 0 for the bytes it covers, neighbours joined."""
    id_type = docs.schema["_id"].dataType
    schema = StructType([StructField("_id", id_type), StructField("_h", LongType()), StructField("trig", LongType()), StructField("phrase", LongType()), StructField("n", IntegerType()), StructField("start", IntegerType()), StructField("cnt", IntegerType()), StructField("rel", ShortType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = column(batch, "_id"), column(batch, "_h")
            whole, offs = flat(column(batch, "_text"))
            for i, j in chunks(offs):
                buf, off = whole[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
                doc, start, count, trig, phrase, rel = parse_phrases(buf, off, length)
                if not len(doc):
                    continue
                o = np.lexsort((phrase, trig, doc))
                d, t, p = doc[o], trig[o], phrase[o]
                new = np.ones(len(o), bool)
                new[1:] = (d[1:] != d[:-1]) | (t[1:] != t[:-1]) | (p[1:] != p[:-1])
                head = np.flatnonzero(new)
                times = np.diff(np.append(head, len(o)))
                again = np.zeros(len(o), bool)
                again[o] = np.repeat(times > 1, times)
                gap = doc[again]  # one byte between texts, so spans of neighbours do not touch
                s, e = _merged(start[again] + gap, start[again] + gap + count[again] + length - 1)
                sd = np.searchsorted(off + np.arange(len(off)), s, "right") - 1
                s, e = s - sd, e - sd
                lone = o[head]
                at = np.concatenate([doc[lone], sd])
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(at + i)),
                        keys.take(pa.array(at + i)),
                        pa.array(np.concatenate([_signed(trig[lone]), np.zeros(len(s), np.int64)])),
                        pa.array(np.concatenate([_signed(phrase[lone]), np.zeros(len(s), np.int64)])),
                        pa.array(np.concatenate([times, np.zeros(len(s), np.int64)]).astype(np.int32)),
                        pa.array((np.concatenate([start[lone], s]) - off[at]).astype(np.int32)),
                        pa.array(np.concatenate([count[lone], e - s]).astype(np.int32)),
                        pa.array(np.concatenate([rel[lone], np.zeros(len(s), np.int64)]).astype(np.int16)),
                    ],
                    names=schema.names,
                )

    return docs.mapInArrow(run, schema)


def _phrase_rows(picked: DataFrame, text_col: str) -> DataFrame:
    """Bytes of the dictionary phrases that stand in ``picked``, with all that is known about them."""
    fields = ("trig", "phrase", "single", "start", "cnt", "rel")
    schema = StructType([StructField("_sid", picked.schema["_sid"].dataType), StructField("_sh", LongType()), StructField("trig", LongType()), StructField("phrase", LongType()), StructField("single", IntegerType()), StructField("start", IntegerType()), StructField("cnt", IntegerType()), StructField("rel", ShortType()), StructField("bytes", BinaryType())])
    reach = "reach"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = column(batch, "_ex")
            buf, off = flat(column(batch, text_col))
            data = buf.tobytes()
            row = np.repeat(np.arange(batch.num_rows), np.diff(np.asarray(lists.offsets)))
            items = lists.flatten()
            start = off[row] + np.asarray(items.field("start"))
            end = start + np.asarray(items.field(reach))
            for i in range(0, len(row), 1 << 14):
                part = slice(i, i + (1 << 14))
                at = pa.array(row[part])
                yield pa.RecordBatch.from_arrays(
                    [column(batch, "_sid").take(at), column(batch, "_sh").take(at), *[items.field(f)[part] for f in fields], pa.array([data[x:y] for x, y in zip(start[part].tolist(), end[part].tolist())], pa.binary())],
                    names=schema.names,
                )

    return picked.mapInArrow(run, schema)


def suffix_ranks(buf: np.ndarray, length: int) -> np.ndarray:
    """Rank of every suffix of ``buf`` among all, cut off at ``length`` bytes; equal suffixes have equal ranks.

    The order of the first 8 bytes is that of a number; ranks of 2 w bytes follow from ranks of w bytes at two places. The last ``length`` - 1 places have no rank.
    """
    w = min(8, length)
    n = len(buf) - w + 1
    word = np.zeros(n, U)
    for k in range(w):
        word = (word << U(8)) | buf[k : k + n].astype(U)
    rank = np.unique(word, return_inverse=True)[1].astype(np.int64)
    while w < length:
        step = min(w, length - w)
        top = int(rank.max()) + 1
        rank = np.unique(rank[: len(rank) - step] * top + rank[step:], return_inverse=True)[1].astype(np.int64)
        w += step
    return rank


def _places(table: pa.Table | pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """Bytes of the given phrases in a row; of each suffix its row, its number inside the phrase, where it starts, and the place of the trigger."""
    texts = table.column("bytes")
    buf, off = flat(texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts)
    count, rel = np.asarray(table.column("cnt")).astype(np.int64), np.asarray(table.column("rel")).astype(np.int64)
    row = np.repeat(np.arange(len(count)), count)
    step = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    return buf, row, step, off[:-1][row] + step, rel[row] - step


def _suffixes(table: pa.Table | pa.RecordBatch, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All suffixes of the given phrases, cut off at ``length`` bytes: row, number inside the phrase, hash that also holds the place of the trigger."""
    buf, row, step, at, place = _places(table)
    pw, inv = powers(len(buf) + 1)
    suffix = span_hash(prefix_hash(buf, pw), inv, at, at + length)
    return row, step, mix(suffix + place.astype(U) * U(0x9E3779B97F4A7C15))


def _suffix_order(rows: DataFrame, length: int) -> DataFrame:
    """Spans (_sid, _sh, _from, _to) of phrases that occur once where a suffix equals one of another phrase of the trigger.

    Rows come sorted by trigger; the suffixes of whole triggers are put in order together and neighbours compared.
    """
    schema = StructType([StructField("_sid", rows.schema["_sid"].dataType), StructField("_sh", LongType()), StructField("_from", IntegerType()), StructField("_to", IntegerType())])

    def compare(table: pa.Table) -> pa.RecordBatch:
        buf, row, step, at, place = _places(table)
        suffix = suffix_ranks(buf, length)[at]
        trig, phrase = np.asarray(table.column("trig"))[row], np.asarray(table.column("phrase"))[row]
        o = np.lexsort((phrase, suffix, place, trig))  # the suffix array of the dictionary: trigger, place, bytes
        new = np.ones(len(o), bool)
        new[1:] = (trig[o][1:] != trig[o][:-1]) | (place[o][1:] != place[o][:-1]) | (suffix[o][1:] != suffix[o][:-1])
        head = np.flatnonzero(new)
        tail = np.append(head[1:], len(o)) - 1
        equal = np.zeros(len(o), bool)
        equal[o] = np.repeat(phrase[o][head] != phrase[o][tail], tail - head + 1)
        at = np.flatnonzero(equal & (np.asarray(table.column("single"))[row] == 1))
        begin = np.ones(len(at), bool)
        begin[1:] = (row[at][1:] != row[at][:-1]) | (step[at][1:] != step[at][:-1] + 1)
        first = np.flatnonzero(begin)
        last = np.append(first[1:], len(at))[: len(first)] - 1
        of = row[at[first]]
        start = np.asarray(table.column("start"))[of]
        take = pa.array(of)
        one = table.select(["_sid", "_sh"]).take(take).combine_chunks()
        ids = [one.column(c).combine_chunks() for c in ("_sid", "_sh")]
        return pa.RecordBatch.from_arrays([*ids, pa.array((start + step[at[first]]).astype(np.int32)), pa.array((start + step[at[last]] + length).astype(np.int32))], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # rows of a trigger that may go on
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([held, table]) if held is not None else table
            trig = np.asarray(table.column("trig"))
            k = int(np.searchsorted(trig, trig[-1]))
            if k:
                yield compare(table.slice(0, k).combine_chunks())
            held = table.slice(k).combine_chunks()
        if held is not None:
            yield compare(held)

    return rows.repartition("trig").sortWithinPartitions("trig").mapInArrow(run, schema)


def _suffix_rows(rows: DataFrame, length: int) -> DataFrame:
    """The same suffixes as rows, for triggers with too many phrases for one task."""
    schema = StructType([StructField("_sid", rows.schema["_sid"].dataType), StructField("_sh", LongType()), StructField("trig", LongType()), StructField("suffix", LongType()), StructField("phrase", LongType()), StructField("single", IntegerType()), StructField("start", IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, step, suffix = _suffixes(batch, length)
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays([*[column(batch, c).take(take) for c in ("_sid", "_sh", "trig")], pa.array(_signed(suffix)), column(batch, "phrase").take(take), column(batch, "single").take(take), pa.array((np.asarray(column(batch, "start"))[row] + step).astype(np.int32))], names=schema.names)

    return rows.mapInArrow(run, schema)


def repeated_spans(docs: DataFrame, id_col: str, text_col: str, length: int) -> DataFrame:
    """Byte spans covered by strings of ``length`` bytes that also start elsewhere: _sid, _sh, _from, _to. They may overlap.

    ``docs`` has all its columns and _h; it is joined as a whole, so that the caller's own join can use the same shuffle.
    """
    keys = [F.col("_id").alias("_sid"), F.col("_h").alias("_sh")]
    parse = reuse(parse_table(docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("binary").alias("_text"), "_h"), length))
    key = ["trig", "phrase"]
    phrases = parse.where("n > 0")
    busy = phrases.groupBy("trig").agg(F.sum("n").alias("c")).where("c > 1").select("trig")
    shared = reuse(phrases.join(busy, "trig", "left_semi"))
    book = reuse(shared.groupBy(*key).agg(F.sum("n").alias("total"), F.min(F.struct("_id", "_h", "start", "cnt", "rel")).alias("ex")))
    # triggers with different phrases, one of which at least occurs once: the others need no comparison
    several = reuse(book.groupBy("trig").agg(F.count("*").alias("c"), F.min("total").alias("least")).where("c > 1 and least = 1").select("trig", "c"))

    def rows_of(triggers: DataFrame) -> DataFrame:
        item = F.struct("trig", "phrase", (F.col("total") == 1).cast("int").alias("single"), F.col("ex.start").alias("start"), F.col("ex.cnt").alias("cnt"), F.col("ex.rel").alias("rel"), (F.col("ex.cnt") + (length - 1)).alias("reach"))
        examples = book.join(triggers.select("trig"), "trig", "left_semi").groupBy(F.col("ex._id").alias("_sid"), F.col("ex._h").alias("_sh")).agg(F.collect_list(item).alias("_ex"))
        return _phrase_rows(docs.join(examples.hint("merge"), _match(docs, examples, id_col)), text_col)

    small = _suffix_order(rows_of(several.where(F.col("c") <= TOGETHER)), length)
    inside = parse.where("n = 0").select(*keys, F.col("start").alias("_from"), (F.col("start") + F.col("cnt")).cast("int").alias("_to"))
    whole = shared.join(book.where("total > 1").select(*key), key, "left_semi").select(*keys, F.col("start").alias("_from"), (F.col("start") + F.col("cnt") + (length - 1)).cast("int").alias("_to"))
    spans = inside.unionAll(whole).unionAll(small)
    many = several.where(F.col("c") > TOGETHER)
    if not many.isEmpty():
        suffixes = _suffix_rows(rows_of(many), length)  # in the same plan, so that the texts are dealt once for all
        order = ["trig", "suffix"]
        repeats = suffixes.groupBy(*order).agg(F.min("phrase").alias("a"), F.max("phrase").alias("b")).where("a < b").select(*order)
        spans = spans.unionAll(suffixes.where("single = 1").join(repeats, order, "left_semi").select("_sid", "_sh", F.col("start").alias("_from"), (F.col("start") + length).cast("int").alias("_to")))
    return spans


def _match(docs: DataFrame, found: DataFrame, id_col: str):
    return docs[id_col].eqNullSafe(found["_sid"]) & (docs["_h"] == found["_sh"])


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200, as_text: bool = False) -> DataFrame:
    """``df`` with the bytes of every repeated string of ``length`` bytes taken out.

    Added columns: _n_bytes long, _n_removed long, _n_spans long (maximal removed runs), _kept binary (what is left; with ``as_text`` a string without
    the characters that were cut in two) and _kept_sha256. Null texts count as empty; all columns of ``df`` stay as they are. Repeats are judged on the input. The names
    above and _h, _ex, _sid, _sh, _spans must not be columns of ``df``.
    """
    docs = batch_rows(df).withColumn("_h", fetch_key(id_col, text_col))
    spans = repeated_spans(docs, id_col, text_col, length).groupBy("_sid", "_sh").agg(F.collect_list(F.struct("_from", "_to")).alias("_spans"))
    # the same join at every size: texts are dealt by document once, for the dictionary and for the cut
    joined = docs.join(spans.hint("merge"), _match(docs, spans, id_col), "left")
    kept = df.columns
    schema = StructType([*df.schema.fields, StructField("_n_bytes", LongType()), StructField("_n_removed", LongType()), StructField("_n_spans", LongType()), StructField("_kept", StringType() if as_text else BinaryType()), StructField("_kept_sha256", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, off = flat(column(batch, text_col))
            data = buf.tobytes()
            spans = column(batch, "_spans")
            sizes, removed, runs, out, digest = [], [], [], [], []
            for r in range(batch.num_rows):
                text = data[off[r] : off[r + 1]]
                s = spans[r]
                cut, pieces, at = (np.zeros(0, np.int64), np.zeros(0, np.int64)), [], 0
                if s.is_valid and len(s.values):
                    cut = _merged(np.asarray(s.values.field("_from")).astype(np.int64), np.asarray(s.values.field("_to")).astype(np.int64))
                for a, b in zip(cut[0].tolist(), cut[1].tolist()):
                    pieces.append(text[at:a])
                    at = b
                pieces.append(text[at:])
                rest = b"".join(pieces)
                sizes.append(len(text))
                removed.append(len(text) - len(rest))
                runs.append(len(cut[0]))
                out.append(rest.decode("utf-8", "ignore") if as_text else rest)
                digest.append(hashlib.sha256(rest).hexdigest())
            yield pa.RecordBatch.from_arrays([*[column(batch, c) for c in kept], pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(out, pa.string() if as_text else pa.binary()), pa.array(digest, pa.string())], names=schema.names)

    return joined.mapInArrow(run, schema)


def op7(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove_repeats(docs).select("doc_id", F.col("_n_bytes").alias("n_bytes"), F.col("_n_removed").alias("n_removed"), F.col("_n_spans").alias("n_spans"), F.col("_kept_sha256").alias("kept_sha256"))
