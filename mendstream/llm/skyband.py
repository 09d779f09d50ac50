"""Divergence of sources within a language: distances between term profiles, and each source's most overrepresented terms by dominance skybands.

A term cannot be among the first k of its group if k others dominate it: with at least its count in the group, at most its count in the
language, and an earlier name. Every such term scores as much or more and wins ties, whatever the totals turn out to be. So

1. every partition keeps, in one pass over its sorted rows, the terms that fewer than k others of the group there dominate;
2. the skybands of all partitions are merged by the same pass over their union;
3. what is left, a superset of the first k, is scored with the exact totals and ranked.

Distances are summed from blocks of terms: a block holds the counts of all sources of a language for its terms and returns one number a pair of
sources, so pairs are never written out for each term.
"""
from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from mendstream.llm.common import batch_rows, column, flat, reuse

TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SCALE, SMOOTH = 1_000_000_000, 5
LETTERS = bytes([*range(0x61, 0x7B), *range(0x80, 0x100)])  # in lower-cased UTF-8
WORDS, GAP = re.compile(rb"[a-z\x80-\xff]+"), re.compile(rb"[^a-z\x80-\xff]")
PIECE, HELD = 1 << 20, 1 << 18  # bytes whose terms are listed at once, sums that a task holds
CELLS = 1 << 15  # counts in a block of terms
ROWS, GRID = 1024, 1 << 23  # rows that are held against a skyband at once, and comparisons


def sweep(by: list[str], k: int) -> Callable:
    """Function of batches sorted by ``by``, _high descending, _low and _name ascending: yields the rows that fewer than ``k`` rows of their group
    dominate, i.e. equal or better in both numbers and earlier in name. Holds one skyband."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, names, lows = None, np.zeros(0, object), np.zeros(0, np.int64)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                keys = list(zip(*(column(batch, c).to_pylist() for c in by)))
                name = np.array(column(batch, "_name").to_pylist(), object)
                low = np.asarray(column(batch, "_low"))
                edge = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
                keep = np.zeros(len(keys), bool)
                for start, end in zip(edge, edge[1:]):
                    if keys[start] != group:
                        group, names, lows = keys[start], np.zeros(0, object), np.zeros(0, np.int64)
                    i = start
                    while i < end:
                        j = min(end, i + max(1, GRID // (len(names) + 1)))
                        n, l = name[i:j], low[i:j]
                        before = np.searchsorted(names, n)  # skyband rows with an earlier name
                        count = ((np.arange(len(names)) < before[:, None]) & (lows <= l[:, None])).sum(axis=1) if len(names) else 0
                        order = np.argsort(n, kind="stable")
                        rank = np.empty(len(n), np.int64)
                        rank[order] = np.arange(len(n))
                        ok = count + (np.tri(len(n), k=-1, dtype=bool) & (rank < rank[:, None]) & (l <= l[:, None])).sum(axis=1) < k
                        keep[i:j] = ok
                        o = order[ok[order]]
                        to = np.searchsorted(names, n[o])
                        names, lows = np.insert(names, to, n[o]), np.insert(lows, to, l[o])
                        i = j
                yield batch.filter(pa.array(keep))

    return run


def skyband(df: DataFrame, by: list[str], high: str, low: str, name: str, k: int) -> DataFrame:
    """The rows of ``df`` that fewer than ``k`` other rows of their group dominate: at least their ``high``, at most their ``low`` and an earlier ``name``.

    ``name`` is unique within a group; ``by``, ``high``, ``low`` and ``name`` are not null. Columns as given here, others are left out. Each partition is swept first
    as it lies, so only skybands are shuffled; a group's skyband streams through one task, which holds what it keeps.
    """
    rows = df.select(*by, F.col(high).cast("long").alias("_high"), F.col(low).cast("long").alias("_low"), F.col(name).alias("_name"))
    order = [*by, F.desc("_high"), "_low", "_name"]
    own = batch_rows(rows.sortWithinPartitions(*order), 1 << 14).mapInArrow(sweep(by, k), rows.schema)
    merged = batch_rows(own.repartition(*by).sortWithinPartitions(*order), 1 << 14).mapInArrow(sweep(by, k), rows.schema)
    return merged.select(*by, F.col("_high").alias(high), F.col("_low").alias(low), F.col("_name").alias(name))


def term_counts(df: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """lang, source, term, n (occurrences), docs (rows with the term); null counts as ''.

    Terms are runs of ASCII letters and anything beyond ASCII, only A-Z lower-cased. A task adds up what it sees and hands its sums on
    whenever it holds ``HELD`` of them, so a common term is one row for many texts.
    """
    rows = df.select(*[F.coalesce(F.col(c), F.lit("")).alias(a) for c, a in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])

    def out(sums: dict) -> pa.RecordBatch:
        keys = [k for k, (n, _) in sums.items() for _ in range(len(n))]
        cols = [[k[0] for k in keys], [k[1] for k in keys], [t for n, _ in sums.values() for t in n], [c for n, _ in sums.values() for c in n.values()], [d[t] for n, d in sums.values() for t in n]]
        kinds = [pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64()]
        arrays = [pa.array(c, k) for c, k in zip(cols, kinds)]
        arrays[2] = arrays[2].cast(pa.string())
        return pa.RecordBatch.from_arrays(arrays, names=["lang", "source", "term", "n", "docs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict = {}
        for batch in batches:
            buf, off = flat(column(batch, "text"))
            for key, a, b in zip(zip(column(batch, "lang").to_pylist(), column(batch, "source").to_pylist()), off[:-1].tolist(), off[1:].tolist()):
                if key not in sums:
                    sums[key] = (Counter(), Counter())
                n, docs = sums[key]
                seen = set()
                while a < b:  # a very long text in pieces, cut behind a term
                    c = min(b, a + PIECE)
                    piece = buf[a:c].tobytes().lower()
                    tail = len(piece.rstrip(LETTERS)) if c < b else len(piece)
                    if not tail and c < b:  # one term longer than a piece
                        rest = GAP.search(buf[c:b].tobytes().lower())
                        c = c + rest.start() if rest else b
                        piece = buf[a:c].tobytes().lower()
                        tail = len(piece)
                    found = WORDS.findall(piece, 0, tail)
                    n.update(found)
                    seen.update(found)
                    a += tail
                docs.update(seen)
            if sum(len(n) for n, _ in sums.values()) > HELD:
                yield out(sums)
                sums = {}
        if sums:
            yield out(sums)

    each = batch_rows(rows).mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return each.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def smoothed(count: Column, total: Column, size: Column) -> Column:
    """1 + floor(10^9 (count + 5) / (total + 5 size)) as an exact whole number."""
    wide = [c.cast("decimal(38,0)") for c in (count, total, size)]
    top, bottom = (wide[0] + SMOOTH) * F.lit(SCALE).cast("decimal(10,0)"), wide[1] + wide[2] * SMOOTH
    return F.call_function("div", top, bottom) + 1


def distances(pdf_key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """Summed differences of all pairs of sources over one block of terms: left has (source, term, p), right each source with its p of an absent term."""
    sources = right["source"].to_numpy()
    n = len(sources)
    at = pd.Series(np.arange(n), index=sources)
    term, _ = pd.factorize(left["term"])
    grid = np.repeat(right["none"].to_numpy(np.int64)[:, None], term.max() + 1 if len(term) else 0, axis=1)
    if len(term):
        grid[at[left["source"]].to_numpy(), term] = left["p"].to_numpy(np.int64)
    i, j = np.triu_indices(n, 1)
    value = [np.abs(grid[k + 1 :] - grid[k]).sum(axis=1) for k in range(n - 1)]
    return pd.DataFrame({"lang": pdf_key[0], "source": sources[i], "item": sources[j], "value": np.concatenate(value) if value else np.zeros(0, np.int64)})


def divergence(df: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least_docs: int = 30, top: int = 50) -> DataFrame:
    """lang, source, part, item, value, rank.

    Part ``pair``: every other source of the language by the summed difference of smoothed term frequencies. Part ``term``: the ``top`` terms by how far their smoothed
    frequency in the group lies above that in the language, among terms of at least ``least_docs`` rows of the language. Null texts, languages and sources
    count as ''. A group without terms, or a language without such terms, still has its pairs (with 0 in the latter case). Repeated rows count each;
    ties go to the item that comes first in UTF-8; an empty table gives no rows; other columns play no part, whatever their names.
    """
    counts = term_counts(df, text_col, lang_col, source_col)
    whole = W.partitionBy("lang", "term")  # one row for each source of a language
    kept = counts.withColumn("all", F.sum("n").over(whole)).withColumn("_docs", F.sum("docs").over(whole)).where(F.col("_docs") >= least_docs)
    kept = reuse(kept.select("lang", "source", "term", "n", "all"))
    groups = df.select(F.coalesce(F.col(lang_col), F.lit("")).alias("lang"), F.coalesce(F.col(source_col), F.lit("")).alias("source")).distinct()
    by_lang = kept.groupBy("lang", "term").agg(F.first("all").alias("all")).groupBy("lang").agg(F.count("*").alias("size"), F.sum("all").alias("lang_total"))
    by_group = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    zero = F.lit(0).cast("long")
    groups = groups.join(by_group, ["lang", "source"], "left").join(by_lang, "lang", "left").fillna(0, ["total", "size", "lang_total"])
    per_lang = groups.groupBy("lang").agg(F.greatest(F.lit(1), F.ceil(F.count("*") * F.max("size") / CELLS)).cast("int").alias("blocks"))
    groups = reuse(groups.join(per_lang, "lang"))
    # pairs
    block = F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int")
    p = smoothed(F.col("n"), F.col("total"), F.col("size"))
    left = kept.join(groups, ["lang", "source"]).select("lang", "source", "term", p.alias("p"), block.alias("block"))
    none = F.when(F.col("size") > 0, smoothed(zero, F.col("total"), F.greatest("size", F.lit(1)))).otherwise(0)
    right = groups.select("lang", "source", none.alias("none"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    half = left.groupBy("lang", "block").cogroup(right.groupBy("lang", "block")).applyInPandas(distances, "lang string, source string, item string, value long")
    half = half.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    pairs = half.unionByName(half.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    ranks = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(ranks)).select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank")
    # terms
    band = skyband(kept, ["lang", "source"], "n", "all", "term", top).join(groups, ["lang", "source"])
    above = smoothed(F.col("n"), F.col("total"), F.col("size")) - smoothed(F.col("all"), F.col("lang_total"), F.col("size"))
    best = band.select("lang", "source", F.col("term").alias("item"), above.alias("value")).where("value > 0")
    best = best.withColumn("rank", F.row_number().over(ranks)).where(F.col("rank") <= top)
    return pairs.unionByName(best.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))


def op13(spark, sf_dir: str) -> DataFrame:
    return divergence(spark.read.parquet(f"{sf_dir}/documents.parquet").select("text", "lang", "source"))


SQL = rf"""
with d as (select row_number() over () as i, coalesce(lang, '') as lang, coalesce(source, '') as source,
    regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{TERM}') as ts from documents),
w as (select i, lang, source, unnest(ts) as term from d),
v as (select lang, term, count(*) as c from w group by lang, term having count(distinct i) >= 30),
vs as (select lang, count(*) as v, sum(c) as n from v group by lang),
g as (select distinct lang, source from d),
c as (select w.lang, w.source, w.term, count(*) as c from w join v using (lang, term) group by all),
n as (select g.lang, g.source, coalesce(sum(c.c), 0)::hugeint as n from g left join c using (lang, source) group by all),
p as (select n.lang, n.source, v.term, coalesce(c.c, 0) as c, 1 + (1000000000::hugeint * (coalesce(c.c, 0) + 5)) // (n.n + 5 * vs.v) as p,
    1 + (1000000000::hugeint * (v.c + 5)) // (vs.n::hugeint + 5 * vs.v) as q
    from n join v using (lang) join vs using (lang) left join c on c.lang = n.lang and c.source = n.source and c.term = v.term),
pairs as (select a.lang, a.source, 'pair' as part, b.source as item, coalesce(s.value, 0)::bigint as value
    from g a join g b on a.lang = b.lang and a.source <> b.source
    left join (select x.lang, x.source, y.source as item, sum(abs(x.p - y.p)) as value from p x join p y on x.lang = y.lang and x.term = y.term group by all) s
    on s.lang = a.lang and s.source = a.source and s.item = b.source),
terms as (select lang, source, 'term' as part, term as item, (p - q)::bigint as value from p where c > 0 and p > q),
r as (select *, row_number() over (partition by lang, source, part order by value desc, item) as rank from (select * from pairs union all select * from terms))
select lang, source, part, item, value, rank from r where part = 'pair' or rank <= 50
"""
