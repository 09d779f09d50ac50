"""Quoted CSV with line breaks inside quotes, read by many tasks.

The text reader splits a file into byte ranges at any line break. Whether a line begins inside quotes follows from the number of
quote signs before it, so

1. one pass counts quote signs and possible records of each range, summed before the shuffle;
2. a prefix sum over the few ranges of a file says in which state each range begins;
3. a second pass runs through the lines of a range from that state and numbers the records. A record that is one whole line is done; only lines of
   records that go over line breaks are brought together by file and record.
"""
from __future__ import annotations

import csv
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from mendstream.session import bounded, reuse

RANGES = 100_000  # ranges of all files up to which their states are broadcast
FIELD = 1 << 30  # bytes of a cell
STATES = pa.schema([("path", pa.string()), ("range", pa.int64()), ("turns", pa.int64()), ("outside", pa.int64()), ("within", pa.int64())])


def quoted_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """path, range (first byte of its part of the file), n (order within the range), line."""
    text = spark.read.option("lineSep", "\n").text(paths)
    return text.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("range"), F.monotonically_increasing_id().alias("n"), F.col("value").alias("line"))


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of ranges in order, with ``inside`` and ``base`` of their range: path, record (number within the file), n, line, whole."""
    here, inside, record = None, 0, 0
    for batch in batches:
        path, start, n, line, carry, base = (batch.column(i) for i in range(6))
        names, starts = path.to_pylist(), np.asarray(start)
        quotes = np.asarray(pc.fill_null(pc.count_substring(line, '"'), 0)).astype(np.int64)
        edge = [0, *(i for i in range(1, len(names)) if starts[i] != starts[i - 1] or names[i] != names[i - 1]), len(names)]
        number, whole = np.zeros(len(names), np.int64), np.zeros(len(names), bool)
        for i, j in zip(edge, edge[1:]):
            if (names[i], starts[i]) != here:
                here, inside, record = (names[i], starts[i]), carry[i].as_py(), base[i].as_py()
            after = (inside + np.cumsum(quotes[i:j])) % 2
            before = np.append(inside, after[:-1])
            opened = record + np.cumsum(before == 0)
            number[i:j], whole[i:j] = opened - 1, (before == 0) & (after == 0)
            inside, record = int(after[-1]), int(opened[-1])
        yield pa.RecordBatch.from_arrays([path, start, pa.array(number), n, line, pa.array(whole)], names=["path", "range", "record", "n", "line", "whole"])


def _summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per range: path, range, whether it turns the state, records that begin in it from outside and from inside quotes."""
    here, total, opened = None, 0, [0, 0]

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{"path": here[0], "range": here[1], "turns": total % 2, "outside": opened[0], "within": opened[1]}], STATES)

    for batch in batches:
        names, starts = batch.column(0).to_pylist(), np.asarray(batch.column(1))
        quotes = np.asarray(pc.fill_null(pc.count_substring(batch.column(2), '"'), 0)).astype(np.int64)
        edge = [0, *(i for i in range(1, len(names)) if starts[i] != starts[i - 1] or names[i] != names[i - 1]), len(names)]
        for i, j in zip(edge, edge[1:]):
            if (names[i], int(starts[i])) != here:
                if here:
                    yield out()
                here, total, opened = (names[i], int(starts[i])), 0, [0, 0]
            even = (total + np.cumsum(quotes[i:j]) - quotes[i:j]) % 2 == 0
            opened = [opened[0] + int(even.sum()), opened[1] + int((~even).sum())]
            total += int(quotes[i:j].sum())
    if here:
        yield out()


def quoted_records(lines: DataFrame) -> DataFrame:
    """path, record (number within the file, from 0), text of each record of ``quoted_lines``."""
    ranges = reuse(lines.select("path", "range", "line").mapInArrow(_summarise, "path string, range long, turns long, outside long, within long"))
    before = W.partitionBy("path").orderBy("range").rowsBetween(W.unboundedPreceding, -1)  # the ranges of one file
    ranges = ranges.withColumn("inside", F.coalesce(F.sum("turns").over(before), F.lit(0)) % 2)
    ranges = ranges.withColumn("base", F.coalesce(F.sum(F.when(F.col("inside") == 0, F.col("outside")).otherwise(F.col("within"))).over(before), F.lit(0)))
    ranges = reuse(ranges.select("path", "range", "inside", "base"))
    many = ranges.limit(RANGES + 1).count() > RANGES
    joined = lines.join(ranges if many else F.broadcast(ranges), ["path", "range"]).select("path", "range", "n", "line", "inside", "base")
    if many:  # a shuffle loses the order of the lines
        joined = joined.repartition("path", "range").sortWithinPartitions("path", "range", "n")
    numbered = joined.mapInArrow(_number, "path string, range long, record long, n long, line string, whole boolean")
    pieces = numbered.where("not whole").groupBy("path", "record").agg(F.array_sort(F.collect_list(F.struct("range", "n", "line"))).alias("_r"))  # the lines of one record
    pieces = pieces.select("path", "record", F.array_join(F.transform("_r", lambda r: r["line"]), "\n").alias("text"))
    return numbered.where("whole").select("path", "record", F.col("line").alias("text")).unionByName(pieces)


def read_quoted_csv(spark: SparkSession, paths: str | list[str], columns: list[str]) -> DataFrame:
    """path, record and ``columns`` as strings, found by the header of each file whatever its order; null where a cell is empty or a file has no such column."""
    records = reuse(quoted_records(quoted_lines(spark, paths)))
    heads = bounded(records.where("record = 0").select("path", F.col("text").alias("head")))
    rows = records.where("record > 0 and trim(text) <> ''").join(heads, "path")
    out = to_arrow_schema(StructType.fromDDL("path string, record long, " + ", ".join(f"{c} string" for c in columns)))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        csv.field_size_limit(FIELD)
        known: dict[str, list[int | None]] = {}
        for batch in batches:
            path, record, text, head = (batch.column(i).to_pylist() for i in range(4))
            cells = []
            for t, h in zip(text, head):
                if h not in known:
                    names = [c.strip() for c in next(csv.reader([h.rstrip("\r")]), [])]
                    known[h] = [names.index(c) if c in names else None for c in columns]
                row = next(csv.reader([t.rstrip("\r")]), [])
                cells.append([(row[i] or None) if i is not None and i < len(row) else None for i in known[h]])
            arrays = [pa.array(path, pa.string()), pa.array(record, pa.int64()), *[pa.array(c, pa.string()) for c in (zip(*cells) if cells else [[]] * len(columns))]]
            yield pa.RecordBatch.from_arrays(arrays, schema=out)

    return rows.select("path", "record", "text", "head").mapInArrow(parse, StructType.fromDDL("path string, record long, " + ", ".join(f"{c} string" for c in columns)))
