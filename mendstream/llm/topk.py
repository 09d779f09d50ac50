"""Exact top-k inner-product search by block-at-a-time pruning.

Candidates lie in blocks of neighbouring ids. A term is a component with its sign: for each query a block is bounded by
the sum, over the query's components, of the greatest products possible inside the block. Each query visits the blocks in descending order of
bound, scores a block through its forward index (its rows as a matrix), and stops when the next bound is below its k-th score.

The stated set of queries meets all rows in cells of one group of queries and one stripe of blocks; a cell holds a bounded number of
rows and returns k rows per query at most. Scores are exact integers: they are computed in doubles only where no sum can
reach 2^53.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from mendstream.llm.common import batch_rows, column

BLOCK, QUERIES, STRIPE = 512, 4096, 65536  # rows of a block, queries of a group, rows of a stripe


def quantized(df: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """_id and _v, floor(scale * x) of each component. Rows with a null id, a null vector, or a null or non-finite component are left out."""
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).where(fine).select(F.col(id_col).cast("long").alias("_id"), F.transform(v, lambda x: F.floor(x * scale)).alias("_v"))


def _matrix(vectors: pa.Array) -> np.ndarray:
    """Rows as integers, shorter ones filled up with 0."""
    off = np.asarray(vectors.offsets).astype(np.int64)
    size = np.diff(off)
    out = np.zeros((len(size), int(size.max(initial=0))), np.int64)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(row)) - np.repeat(off[:-1] - off[0], size)] = np.asarray(vectors.values)[off[0] : off[-1]]
    return out


def _widened(x: np.ndarray, dims: int) -> np.ndarray:
    return np.pad(x, ((0, 0), (0, dims - x.shape[1])))


def blocks(vectors: DataFrame) -> DataFrame:
    """Blocks of neighbouring ids: first id, ids and rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                ids, m = np.asarray(column(batch, "_id")), _matrix(column(batch, "_v"))
                yield pa.RecordBatch.from_arrays([pa.array([int(ids[0])]), pa.array([len(ids)], pa.int32()), pa.array([m.shape[1]], pa.int32()), pa.array([ids.tobytes()], pa.binary()), pa.array([m.tobytes()], pa.binary())], names=["first", "n", "dims", "ids", "rows"])

    ranged = vectors.repartitionByRange(int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")), "_id").sortWithinPartitions("_id")
    return batch_rows(ranged, BLOCK).mapInArrow(run, "first long, n int, dims int, ids binary, rows binary")


def search_cell(qid: np.ndarray, q: np.ndarray, parts: list[tuple[np.ndarray, np.ndarray]], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, id, score) of the k best of the blocks ``parts`` for each query, its own id left out."""
    dims = max([q.shape[1], *(m.shape[1] for _, m in parts)])
    q, mats = _widened(q, dims), [_widened(m, dims) for _, m in parts]
    top = lambda x: max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))
    kind = float if top(q) * max(map(top, mats)) * max(dims, 1) < 1 << 53 else object
    low = np.array([m.min(axis=0) for m in mats]).astype(kind)
    high = np.array([m.max(axis=0) for m in mats]).astype(kind)
    q, mats = q.astype(kind), [m.astype(kind) for m in mats]
    bound = np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T
    order = np.argsort(-bound, axis=1, kind="stable")
    kth = np.full(len(q), None if kind is object else -np.inf)
    live = np.arange(len(q))
    best = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, kind))
    for r in range(len(mats)):
        b = order[live, r]
        reach = bound[live, b]
        far = np.array([t is None or x >= t for x, t in zip(reach, kth[live])], bool) if kind is object else reach >= kth[live]
        live, b = live[far], b[far]
        if not len(live):
            break
        found = [best]
        for block in np.unique(b):
            rows = live[b == block]
            score = q[rows] @ mats[block].T
            ids = parts[block][0]
            t = kth[rows]
            good = np.array([[u is None or s >= u for s in line] for line, u in zip(score, t)], bool) if kind is object else score >= t[:, None]
            good &= ids[None, :] != qid[rows][:, None]
            i, j = np.nonzero(good)
            found.append((rows[i], ids[j], score[i, j]))
        row, ids, score = (np.concatenate(x) for x in zip(*found))
        o = np.lexsort((ids, -score, row)) if kind is not object else np.array(sorted(range(len(row)), key=lambda x: (row[x], -score[x], ids[x])), np.int64)
        row, ids, score = row[o], ids[o], score[o]
        head = np.searchsorted(row, np.arange(len(q)))
        place = np.arange(len(row)) - head[row]
        full = place == k - 1
        kth[row[full]] = score[full]
        best = row[place < k], ids[place < k], score[place < k]
    row, ids, score = best
    return row, ids, np.array([min(max(int(s), -(1 << 63)), (1 << 63) - 1) for s in score], np.int64)


def top_k(df: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 64) -> DataFrame:
    """The ``k`` rows with the greatest integer inner product for each query: query_id, rank, vec_id, score.

    Queries are the rows whose id is divisible by ``every``; ties go to the smaller id. Rows with a null id, a null vector or a component that is
    null or not finite take no part; missing components of shorter vectors count as 0. Candidates that repeat an id count each, queries equal in id and
    vector once; rows with a query's id are not its candidates. Scores outside the range of long are cut to it.
    """
    vectors = quantized(df, id_col, vector_col, scale)
    n = vectors.count()
    stripes, groups = max(1, -(-n // STRIPE)), max(1, -(-(n // every + 1) // QUERIES))
    queries = vectors.where(F.col("_id") % every == 0).distinct().withColumn("_g", F.pmod(F.xxhash64("_id"), F.lit(groups)).cast("int"))
    queries = queries.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))))
    stored = blocks(vectors).withColumn("_s", F.pmod(F.xxhash64("first"), F.lit(stripes)).cast("int")).withColumn("_g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))

    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [np.zeros(0, np.int64)] * 3
        qh = np.zeros(0, np.int64)
        if left.num_rows and right.num_rows:
            vec = left.column("_v").combine_chunks()
            vec = vec.chunk(0) if isinstance(vec, pa.ChunkedArray) else vec
            qid = np.asarray(left.column("_id"))
            parts = []
            for d, a, b in zip(right.column("dims").to_pylist(), right.column("ids").to_pylist(), right.column("rows").to_pylist()):
                ids = np.frombuffer(a, np.int64)
                parts.append((ids, np.frombuffer(b, np.int64).reshape(len(ids), d)))
            row, ids, score = search_cell(qid, _matrix(vec), parts, k)
            out = [qid[row], ids, score]
            qh = np.asarray(left.column("_q"))[row]
        return pa.table({"query_id": pa.array(out[0]), "_q": pa.array(qh), "vec_id": pa.array(out[1]), "score": pa.array(out[2])})

    queries = queries.withColumn("_q", F.xxhash64("_v"))
    hits = queries.groupBy("_g", "_s").cogroup(stored.groupBy("_g", "_s")).applyInArrow(cell, "query_id long, _q long, vec_id long, score long")
    best = W.partitionBy("query_id", "_q").orderBy(F.col("score").desc(), "vec_id")
    return hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op3(spark, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


SQL = """
WITH ok AS (SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
            WHERE embedding IS NOT NULL AND NOT list_contains([x IS NULL OR NOT isfinite(x) FOR x IN embedding], true)),
     s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
           FROM ok q JOIN ok c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 20
"""
