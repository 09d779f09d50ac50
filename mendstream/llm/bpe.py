"""Byte-pair encoding and decoding with a given vocabulary, in batched numpy merge rounds.

Texts are cut into words by array operations on code point classes. The symbols of all new words of a batch lie in
one flat array; each round looks up every adjacent pair by binary search over the sorted pair keys, finds the lowest rank
of each word and merges its occurrences from left to right, until no word has a known pair. The vocabulary file has a
fixed size and is read on the driver; its arrays are broadcast.
"""
from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from mendstream.llm.common import batch_rows, chunks, column

SPACES = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# Letters and numbers that Unicode 16 added, which Python's own tables may lack.
ADDED = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D40, 0x10D65), (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4),
    (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3),
    (0x116D0, 0x116E3), (0x11BC0, 0x11BE0), (0x11BF0, 0x11BF9), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16130, 0x16139), (0x16D40, 0x16D6C),
    (0x16D70, 0x16D79), (0x18CFF, 0x18CFF), (0x1CCF0, 0x1CCF9), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5FA),
]
# Endings that an apostrophe binds to.
ENDINGS = ["s", "t", "re", "ve", "m", "ll", "d"]
OTHER, LETTER, NUMBER, SPACE = range(4)
LONG = 1024  # bytes of a word that is merged by itself
CACHE = 1 << 18  # words kept with their tokens in a task; beyond it the cache starts anew


def char_classes() -> np.ndarray:
    """Letter, number, space or other for each code point."""
    known = "".join(c for c in map(chr, range(0x110000)) if unicodedata.category(c) not in ("Cn", "Cs"))
    known += "".join(chr(c) for a, b in ADDED for c in range(a, b + 1))
    out = np.zeros(0x110000, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}")):
        out[[ord(c) for c in regex.findall(pattern, known)]] = kind
    out[SPACES] = SPACE
    return out


def byte_chars() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Arrays of a byte-level vocabulary file: sorted pair keys with ranks and results, bytes of each token."""

    def __init__(self, parts: dict):
        """From what ``read`` returns: plain arrays and lists, so that workers need no copy of this class."""
        self.__dict__.update(parts)

    @classmethod
    def read(cls, path: str) -> dict:
        self = cls({})
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, byte_of = spec["model"]["vocab"], byte_chars()
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.size = max([*vocab.values(), *self.special.values()], default=-1) + 1
        self.token = [b""] * self.size
        for t, i in vocab.items():
            self.token[i] = bytes(byte_of[c] for c in t)
        for t, i in self.special.items():
            self.token[i] = t.encode()
        self.of_byte = np.zeros(256, np.int64)
        for c, b in byte_of.items():
            self.of_byte[b] = vocab[c]
        key = np.array([vocab[a] * self.size + vocab[b] for a, b in merges], np.int64)
        order = np.argsort(key, kind="stable")
        self.keys, self.ranks = key[order], order.astype(np.int64)
        self.results = np.array([vocab[a + b] for a, b in merges], np.int64)  # by rank
        self.classes = char_classes()
        return self.__dict__


def word_starts(codes: np.ndarray, classes: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Where words begin in an array of code points; ``cuts`` are the starts of texts.

    Words are runs of letters, of numbers or of other signs, each with one blank before it; an apostrophe with one of
    its endings; and white space, whose last character goes to what follows if that is a blank before a word.
    """
    n = len(codes)
    kind = classes[codes]
    begin = np.ones(n + 1, bool)
    begin[1:n] = kind[1:] != kind[:-1]
    text = np.zeros(n + 1, bool)
    text[cuts] = True
    text[n] = True
    begin |= text
    at = np.flatnonzero(begin[:n])
    end = np.append(at[1:], n)
    word = kind[at] != SPACE
    # a space run before a word: its last character stands apart, joined to the word if it is a blank
    before = np.zeros(len(at), bool)
    before[1:] = word[1:] & ~word[:-1] & ~text[at[1:]]
    last = at[before] - 1
    begin[last] = True
    blank = codes[last] == 32
    begin[at[before][blank]] = False
    joined = np.zeros(len(at), bool)
    joined[np.flatnonzero(before)[blank]] = True
    # an apostrophe alone, then letters that start with an ending
    i = np.flatnonzero((end - at == 1) & (codes[at] == 39) & ~joined)
    i = i[i + 1 < len(at)]
    i = i[(kind[at[i + 1]] == LETTER) & ~text[at[i + 1]]]
    if len(i):
        p, stop = at[i] + 1, end[i + 1]
        one = codes[p]
        two = np.where(p + 1 < stop, codes[np.minimum(p + 1, n - 1)], 0)
        size = np.zeros(len(i), np.int64)
        for e in ENDINGS:
            hit = (one == ord(e[0])) & ((two == ord(e[1])) if len(e) == 2 else True)
            size = np.where((size == 0) & hit, len(e), size)
        hit = size > 0
        begin[p[hit]] = False
        begin[p[hit] + size[hit]] = True
    return np.flatnonzero(begin[:n])


def merge_long(word: bytes, v: Vocabulary, rank_of: dict[int, int]) -> np.ndarray:
    """Token ids of one long word: a round would look at all of it for every merge, so its pairs wait in a heap by rank, then place, and a merge
    looks only at its neighbours."""
    sym = v.of_byte[np.frombuffer(word, np.uint8)].tolist()
    n = len(sym)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i) for i in range(n - 1) if (r := rank_of.get(sym[i] * v.size + sym[i + 1])) is not None]
    heapify(heap)
    results = v.results.tolist()
    while heap:
        rank, i = heappop(heap)
        j = after[i]
        if sym[i] < 0 or j >= n or rank_of.get(sym[i] * v.size + sym[j]) != rank:
            continue
        sym[i], sym[j] = results[rank], -1
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            if (r := rank_of.get(sym[i] * v.size + sym[k])) is not None:
                heappush(heap, (r, i))
        if (h := before[i]) >= 0 and (r := rank_of.get(sym[h] * v.size + sym[i])) is not None:
            heappush(heap, (r, h))
    return np.array([x for x in sym if x >= 0], np.int64)


def merge_rounds(words: list[bytes], v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all words in a row, and how many each word has."""
    lengths = np.array([len(w) for w in words], np.int64)
    long = np.flatnonzero(lengths > LONG)
    done_sym, done_owner = [], []
    if len(long):
        rank_of = dict(zip(v.keys.tolist(), v.ranks.tolist()))
        for k in long.tolist():
            done_sym.append(merge_long(words[k], v, rank_of))
            done_owner.append(np.full(len(done_sym[-1]), k))
    short = np.flatnonzero(lengths <= LONG)
    sym = v.of_byte[np.frombuffer(b"".join([words[k] for k in short.tolist()]) if len(long) else b"".join(words), np.uint8)]
    owner = np.repeat(short, lengths[short])
    none = len(v.keys)
    while len(sym):
        pair = np.where(owner[1:] == owner[:-1], sym[:-1] * v.size + sym[1:], -1)
        hit = np.minimum(np.searchsorted(v.keys, pair), none - 1) if none else np.zeros(len(pair), np.int64)
        rank = np.where(v.keys[hit] == pair, v.ranks[hit], none) if none else np.full(len(pair), 0)
        rank = np.append(rank, none)
        head = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        best = np.minimum.reduceat(rank, head)
        size = np.diff(np.append(head, len(sym)))
        over = np.repeat(best == none, size)
        if over.any():
            done_sym.append(sym[over])
            done_owner.append(owner[over])
            keep = ~over
            sym, owner, rank = sym[keep], owner[keep], rank[keep]
            best, size = best[best < none], size[best < none]
            if not len(sym):
                break
        m = np.flatnonzero(rank == np.repeat(best, size))
        run = np.append(True, m[1:] != m[:-1] + 1)
        first = np.maximum.accumulate(np.where(run, np.arange(len(m)), 0))
        m = m[(np.arange(len(m)) - first) % 2 == 0]  # of overlapping pairs every other one
        sym[m] = v.results[rank[m]]
        keep = np.ones(len(sym), bool)
        keep[m + 1] = False
        sym, owner = sym[keep], owner[keep]
    if not done_sym:
        return np.zeros(0, np.int64), np.zeros(len(words), np.int64)
    sym, owner = np.concatenate(done_sym), np.concatenate(done_owner)
    o = np.argsort(owner, kind="stable")
    return sym[o], np.bincount(owner, minlength=len(words))


class Encoder:
    """Encodes lists of texts; remembers words inside one task."""

    def __init__(self, v: Vocabulary):
        self.v = v
        self.split = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(v.special, key=len, reverse=True)) + ")") if v.special else None
        self.digits = [str(i) for i in range(v.size)]
        self.forget()

    def forget(self) -> None:
        """Only the special strings are known."""
        ids = list(self.v.special.values())
        self.known = {w: k for k, w in enumerate(self.v.special)}
        self.decimal = [str(i) for i in ids]
        self.ids = np.array(ids, np.int64)
        self.first = np.arange(len(ids) + 1)  # where the tokens of the k-th word begin

    def words(self, texts: list[str]) -> list[list[str]]:
        """Words of each text; special strings are words of their own."""
        parts, owner = [], []
        for i, t in enumerate(texts):
            for p in self.split.split(t) if self.split and self.split.search(t) else [t]:
                if p:
                    parts.append(p)
                    owner.append(i)
        out: list[list[str]] = [[] for _ in texts]
        if not parts:
            return out
        whole = "".join(parts)
        codes = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
        ends = np.cumsum([len(p) for p in parts])
        cuts = np.append(0, ends[:-1])
        at = word_starts(codes, self.v.classes, cuts)
        edge = np.searchsorted(at, ends).tolist()
        at = np.append(at, len(whole)).tolist()
        lo = 0
        for p, i, hi in zip(parts, owner, edge):
            if p in self.v.special:
                out[i].append(p)
            else:
                out[i].extend([whole[a:b] for a, b in zip(at[lo:hi], at[lo + 1 : hi + 1])])
            lo = hi
        return out

    def learn(self, words: list[str]) -> None:
        ids, sizes = merge_rounds([w.encode() for w in words], self.v)
        self.known.update(zip(words, range(len(self.decimal), len(self.decimal) + len(words))))
        text, at = [self.digits[i] for i in ids.tolist()], 0
        for n in sizes.tolist():
            self.decimal.append(text[at] if n == 1 else ",".join(text[at : at + n]))
            at += n
        self.first = np.append(self.first, self.first[-1] + np.cumsum(sizes))
        self.ids = np.append(self.ids, ids)

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[str]]:
        """For each text its ids, as numbers and as decimals joined by commas."""
        words = self.words(texts)
        if len(self.known) > CACHE:
            self.forget()
        new = [w for w in set(chain.from_iterable(words)) if w not in self.known]
        if new:
            self.learn(new)
        code_of, decimal_of = self.known.__getitem__, self.decimal.__getitem__
        codes = [list(map(code_of, ws)) for ws in words]
        decimals = [",".join(map(decimal_of, c)) for c in codes]
        code = np.fromiter(chain.from_iterable(codes), np.int64, sum(map(len, codes)))
        size = self.first[code + 1] - self.first[code]
        end = np.cumsum(size)
        flat = self.ids[np.arange(end[-1] if len(end) else 0) - np.repeat(end - size, size) + np.repeat(self.first[code], size)].tolist()
        edge = np.append(0, end)[np.cumsum([0, *map(len, codes)])].tolist()
        return [flat[a:b] for a, b in zip(edge, edge[1:])], decimals


def _text_batches(batch: pa.RecordBatch, name: str) -> Iterator[tuple[int, int, list[str]]]:
    texts = column(batch, name)
    values = [t or "" for t in texts.to_pylist()]
    sizes = np.concatenate([[0], np.cumsum([4 * len(t) for t in values])])
    for i, j in chunks(sizes, 1 << 23):
        yield i, j, values[i:j]


def encode(df: DataFrame, vocabulary: str, text_col: str = "text", out_col: str = "ids") -> DataFrame:
    """``df`` with the token ids of ``text_col``, array<int>. A null text has no ids. ``out_col`` replaces a column of that name."""
    v = df.sparkSession.sparkContext.broadcast(Vocabulary.read(vocabulary))
    kept = [f for f in df.schema.fields if f.name != out_col]
    schema = StructType([*kept, StructField(out_col, ArrayType(IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder(Vocabulary(v.value))
        for batch in batches:
            for i, j, texts in _text_batches(batch, text_col):
                ids, _ = enc.encode(texts)
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([*[column(part, f.name) for f in kept], pa.array(ids, pa.list_(pa.int32()))], names=schema.names)

    return batch_rows(df).mapInArrow(run, schema)


def decode(df: DataFrame, vocabulary: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``df`` with the text of the token ids; broken UTF-8 is replaced as usual, ids outside the vocabulary add nothing. Null ids: empty."""
    v = df.sparkSession.sparkContext.broadcast(Vocabulary.read(vocabulary))
    kept = [f for f in df.schema.fields if f.name != out_col]
    schema = StructType([*kept, StructField(out_col, StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = v.value["token"]
        for batch in batches:
            texts = [b"".join([token[i] for i in ids or () if i is not None and 0 <= i < len(token)]).decode("utf-8", "replace") for ids in column(batch, ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[column(batch, f.name) for f in kept], pa.array(texts, pa.string())], names=schema.names)

    return batch_rows(df).mapInArrow(run, schema)


def round_trip(df: DataFrame, vocabulary: str, text_col: str = "text", keep: list[str] = ()) -> DataFrame:
    """Encodes and decodes in one pass; returns ``keep`` and n_tokens, ids_sha256, decoded_sha256. Null texts count as empty."""
    v = df.sparkSession.sparkContext.broadcast(Vocabulary.read(vocabulary))
    rows = batch_rows(df).select(*keep, F.col(text_col).alias("_text"))
    schema = StructType([*[rows.schema[c] for c in keep], StructField("n_tokens", LongType()), StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder(Vocabulary(v.value))
        bytes_of = v.value["token"].__getitem__
        for batch in batches:
            for i, j, texts in _text_batches(batch, "_text"):
                sizes, digests, back = [], [], []
                for ids, decimals in zip(*enc.encode(texts)):
                    sizes.append(len(ids))
                    digests.append(hashlib.sha256(decimals.encode()).hexdigest())
                    text = b"".join(map(bytes_of, ids)).decode("utf-8", "replace")
                    back.append(hashlib.sha256(text.encode()).hexdigest())
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([*[column(part, c) for c in keep], pa.array(sizes, pa.int64()), pa.array(digests, pa.string()), pa.array(back, pa.string())], names=schema.names)

    return rows.mapInArrow(run, schema)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(spark.read.parquet(f"{sf_dir}/documents.parquet"), default_vocabulary(), keep=["doc_id"])
