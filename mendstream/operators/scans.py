"""Ordered scans over long series, cut into time blocks.

A window function sorts one whole key in one task. For a key that may hold a third
of all rows these helpers split the key into time blocks, scan each block on its
own, carry one small row per block across the key, and join the carry back.
Block rows per key grow with the time span only, never with the row count.
"""
from __future__ import annotations

from collections import namedtuple
from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def join_same(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` in which null equals null, so rows with a missing key stay."""
    named = {k: f"_same_{k}" for k in keys}
    other = right.select(*[F.col(k).alias(n) for k, n in named.items()], *[c for c in right.columns if c not in named])
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(n)) for k, n in named.items()])
    return left.join(other, on, how).drop(*named.values())


def with_block(df: DataFrame, order: str, seconds: int, name: str = "block") -> DataFrame:
    return df.withColumn(name, F.expr(f"{order} div {int(seconds)}"))


def forward_fill(df: DataFrame, keys: list[str], order: str, col: str, block: str, out: str | None = None,
                 before_only: bool = False) -> DataFrame:
    """Last non-null ``col`` at or before each row; ``before_only`` excludes the row itself."""
    out = out or col
    end = -1 if before_only else 0
    local = W.partitionBy(*keys, block).orderBy(order).rowsBetween(W.unboundedPreceding, end)
    blocks = (
        df.groupBy(*keys, block)
        .agg(F.max_by(F.col(col), F.when(F.col(col).isNotNull(), F.col(order))).alias("_last"))
        .withColumn(
            "_carry",
            F.last("_last", ignorenulls=True).over(
                W.partitionBy(*keys).orderBy(block).rowsBetween(W.unboundedPreceding, -1)
            ),
        )
        .drop("_last")
    )
    return (
        join_same(df.withColumn("_local", F.last(col, ignorenulls=True).over(local)), blocks, [*keys, block])
        .withColumn(out, F.coalesce("_local", "_carry"))
        .drop("_local", "_carry")
    )


def running_sum(df: DataFrame, keys: list[str], order: list[str], value: Column, block: str, out: str,
                exclusive: bool = False) -> DataFrame:
    """Running sum of ``value`` per key, optionally before the current row."""
    end = -1 if exclusive else 0
    local = W.partitionBy(*keys, block).orderBy(*order).rowsBetween(W.unboundedPreceding, end)
    df = df.withColumn("_x", value)
    blocks = (
        df.groupBy(*keys, block)
        .agg(F.sum("_x").alias("_s"))
        .withColumn(
            "_base",
            F.coalesce(
                F.sum("_s").over(W.partitionBy(*keys).orderBy(block).rowsBetween(W.unboundedPreceding, -1)),
                F.lit(0),
            ),
        )
        .drop("_s")
    )
    return (
        join_same(df.withColumn("_local", F.coalesce(F.sum("_x").over(local), F.lit(0))), blocks, [*keys, block])
        .withColumn(out, F.col("_base") + F.col("_local"))
        .drop("_x", "_local", "_base")
    )


def with_halo(df: DataFrame, order: str, seconds: int, reach: int, name: str = "block",
              halo: str = "is_halo") -> DataFrame:
    """Copy each row into every later block that needs it for a look-back of ``reach`` seconds.

    A look-back partitioned by (key, block) then sees all rows it needs; rows marked ``is_halo`` are dropped after it.
    """
    floor = lambda x: F.expr(f"(({x}) - pmod({x}, {int(seconds)})) div {int(seconds)}")
    first, last = floor(order), floor(f"{order} + {int(reach)}")
    return (
        df.withColumn("_home", first)
        .withColumn(name, F.explode(F.sequence(F.col("_home"), last)))
        .withColumn(halo, F.col(name) != F.col("_home"))
        .drop("_home")
    )


# -- greedy spacing: accept an item only if it lies far enough after the last accepted one --


def _block_transfer(ts: list[int], gap: int, start: int) -> tuple[list[int], list[int]]:
    """For each possible first item of the block: the last item accepted from there."""
    n = len(ts)
    last = [0] * n
    nxt = n
    j = n
    for i in range(n - 1, -1, -1):
        while j > 0 and ts[j - 1] >= ts[i] + gap:
            j -= 1
        nxt = j
        last[i] = last[nxt] if nxt < n else ts[i]
    limit = start + gap
    entries = []
    for i in range(n):
        entries.append(i)
        if ts[i] >= limit:
            break
    return [ts[i] for i in entries], [last[i] for i in entries]


def map_runs(df: DataFrame, keys: list[str], order: list[str], fn: Callable[[tuple, list[tuple]], Iterable[tuple]],
             schema: str) -> DataFrame:
    """Apply ``fn(key, rows)`` to every run of equal keys, rows sorted by ``order``.

    For groups of a bounded size (one block, one row per block). Works through whole Arrow batches, so
    many small groups cost no call into pandas each; one group at a time is held. Null keys form one run.
    """
    n = len(keys)
    cols = [*keys, *[c for c in df.columns if c not in keys]]
    out_type = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, []
        for batch in batches:
            out: list[tuple] = []
            for row in zip(*[c.to_pylist() for c in batch.columns]):  # whole numbers stay exact beside nulls
                if row[:n] != current:
                    if held:
                        out.extend(fn(current, held))
                    current, held = row[:n], []
                held.append(row[n:])
            yield as_batch(out, out_type)
        if held:
            yield as_batch(list(fn(current, held)), out_type)

    return df.select(*cols).repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, schema)


def greedy_spacing(df: DataFrame, keys: list[str], order: str, gap: str, block_seconds: int = 86400) -> DataFrame:
    """Rows accepted by "at least ``gap`` after the last accepted row of the key".

    ``df`` must hold distinct (keys, order); ``order`` and ``gap`` are integers and
    ``gap`` is constant per key and at most ``block_seconds``. Each block is reduced to
    a table "first allowed time -> last accepted time" of at most gap + 1 entries; the tables
    are chained per key, and a second pass accepts inside each block from its true start.
    """
    key_ddl = ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in keys)
    rows = with_block(df.select(*keys, F.col(order).cast("long").alias("_t"), F.col(gap).cast("long").alias("_gap")), "_t", block_seconds)

    def summarise(key: tuple, items: list[tuple]) -> Iterator[tuple]:
        g = int(items[0][1])
        entry, last = _block_transfer([int(t) for t, _ in items], g, int(key[-1]) * block_seconds)
        yield (*key, g, entry, last)

    tables = map_runs(rows, [*keys, "block"], ["_t"], summarise, f"{key_ddl}, block long, _gap long, entry array<long>, last array<long>")

    def chain(key: tuple, items: list[tuple]) -> Iterator[tuple]:
        allowed = None
        for block, g, entry, last in items:
            start = int(block) * block_seconds
            allowed = start if allowed is None else max(allowed, start)
            yield (*key, int(block), allowed)
            for e, l in zip(entry, last):
                if e >= allowed:
                    allowed = int(l) + int(g)
                    break

    carry = map_runs(tables, keys, ["block"], chain, f"{key_ddl}, block long, _allowed long")

    def accept(key: tuple, items: list[tuple]) -> Iterator[tuple]:
        allowed = int(items[0][2])
        for t, g, _ in items:
            if t >= allowed:
                yield (*key[:-1], int(t))
                allowed = int(t) + int(g)

    joined = join_same(rows, carry, [*keys, "block"]).select(*keys, "block", "_t", "_gap", "_allowed")
    return map_runs(joined, [*keys, "block"], ["_t"], accept, f"{key_ddl}, _t long").withColumnRenamed("_t", order)


def fold_sorted(df: DataFrame, keys: list[str], order: list[str], step, new_state, schema: str) -> DataFrame:
    """Stream each key's rows in order through ``step(state, row) -> output row``; null is a key like any other.

    Rows arrive batch by batch, so memory holds one batch and the state of one key.
    """
    Row = namedtuple("Row", df.columns)
    out_type = to_arrow_schema(StructType.fromDDL(schema))
    where = [df.columns.index(k) for k in keys]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None
        for batch in batches:
            out = []
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                k = [row[i] for i in where]
                if k != current:
                    current, state = k, new_state()
                res = step(state, Row(*row))
                if res is not None:
                    out.append(res)
            yield as_batch(out, out_type)

    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, schema)


def as_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = zip(*rows) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)
