"""Join of texts whose word n-gram sets have a high Jaccard similarity, by prefix trees.

1. Sets. Words are folded to 64-bit hashes, n-grams to hashes of words; equal sets become one node.
2. Parts. N-grams are dealt into more parts than two near sets can differ in, so such sets hold the same in one part at least. A
   signature stands for all n-grams of a part, and nodes joined by signatures form neighbourhoods. In a large table unrelated sets share
   single rare n-grams, so that step 4 alone would join most nodes; they do not share whole parts.
3. Global order. N-grams with small hashes, a fixed share of all, come first and rarer ones of a neighbourhood before others; the rest follows by hash.
4. Clusters. Two sets with enough in common share one of their first n - ceil(t n) + 1 n-grams. Nodes of a neighbourhood joined by such
   shared n-grams form clusters; nothing is compared across clusters.
5. Tries. The sets of a cluster are stored in a trie, commonest n-grams first, so near sets share long paths. One
   traversal carries the overlaps of all sets with the path, shared by everything below it, and drops a set from a subtree when the overlap
   and the n-grams left cannot reach what the sizes ask for. A large cluster is cut into blocks of like sizes; every pair of blocks
   with sizes in reach is a cell of its own, so no group meets in one task.
Each cell returns one row per node: its degree and the least node it is joined with there. Pairs are never written out.
"""
from __future__ import annotations

from collections.abc import Iterator
from math import exp, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from mendstream.llm.common import U, batch_rows, chunks, column, fetch_key, flat, fresh, mix, reuse, same, tidy, word_bounds, word_hashes
from mendstream.llm.components import components
from mendstream.session import bounded

BLOCK_NODES, BLOCK_GRAMS = 1024, 1 << 20  # of a block of a large cluster
DEALS = 8  # ways of dealing n-grams into parts, for sets with too many empty parts in those before
SHIFTS = mix(np.arange(1, DEALS + 1, dtype=U))
ENTRY, HELD, BUCKET = 13, 1 << 20, 1 << 18  # bytes of a signature and its node, those held by a task, those of a bucket


def gram_sets(buf: np.ndarray, off: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(text number, n-gram hash), each n-gram of a text once, in order of text and hash.

    A-Z are lower-cased. A text with fewer words has its whole sequence as its only n-gram, one without words none.
    """
    low = np.where((buf >= 65) & (buf <= 90), buf + 32, buf).astype(np.uint8)
    start, end = word_bounds(low, off)
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, U)
    word = word_hashes(low, start, end)
    doc = np.searchsorted(off, start, "right") - 1
    count = np.bincount(doc, minlength=len(off) - 1)
    first = np.cumsum(count) - count
    docs, grams = [], []
    for size in range(1, words + 1):
        if size == words:
            at = np.arange(len(word) - words + 1)
            at = at[doc[at] == doc[at + words - 1]] if len(at) else at
        else:
            at = first[count == size]
        if len(at):
            h = mix(np.full(len(at), size, U))
            for k in range(size):
                h = mix(h + word[at + k])
            docs.append(doc[at])
            grams.append(h)
    doc, gram = np.concatenate(docs), np.concatenate(grams)
    o = np.lexsort((gram, doc))
    doc, gram = doc[o], gram[o]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (gram[1:] != gram[:-1])
    return doc[new], gram[new]


def _nodes(doc: np.ndarray, gram: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Set sizes, and 16 bytes that stand for each set."""
    size = np.bincount(doc, minlength=n_docs)
    out = np.zeros((n_docs, 2), U)
    has = np.flatnonzero(size)
    if len(has):
        at = (np.cumsum(size) - size)[has]
        out[has, 0] = mix(np.add.reduceat(mix(gram + U(1)), at) + size[has].astype(U))
        out[has, 1] = mix(np.add.reduceat(mix(gram ^ U(0x5851F42D4C957F2D)), at))
    return size, out


def _binary16(x: np.ndarray) -> pa.Array:
    data = np.ascontiguousarray(x).tobytes()
    return pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(np.arange(0, 16 * len(x) + 1, 16, dtype=np.int32).tobytes()), pa.py_buffer(data)])


def _nids(node: np.ndarray) -> pa.Array:
    """Should two nodes share it, their clusters are compared as one."""
    return pa.array(node[:, 0].copy().view(np.int64))


def prefixes(docs: DataFrame, words: int, num: int, den: int, pool: float) -> DataFrame:
    """_id, _h, n (set size), p (prefix length), u, node (16 bytes, equal for equal sets), nid (8 of them) and tokens.

    ``tokens`` are the n-grams of the pool, those with the least hashes (the same share of all n-grams for every text), ``u`` of them, and as many of
    the next hashes as the prefix length asks for.
    """
    limit = U(min((1 << 64) - 1, int(pool * (den - num) / den * (1 << 64))))
    schema = StructType([docs.schema["_id"], StructField("_h", LongType()), StructField("n", IntegerType()), StructField("p", IntegerType()), StructField("u", IntegerType()), StructField("node", BinaryType()), StructField("nid", LongType()), StructField("tokens", ArrayType(LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole, offs = flat(column(batch, "_text"))
            for i, j in chunks(offs):
                doc, gram = gram_sets(whole[offs[i] : offs[j]], offs[i : j + 1] - offs[i], words)
                size, node = _nodes(doc, gram, j - i)
                p = np.where(size > 0, size + (-size * num) // den + 1, 0)
                u = np.bincount(doc[gram < limit], minlength=j - i)
                take = np.maximum(p, u)
                end = np.cumsum(take)
                at = np.arange(end[-1] if len(end) else 0) - np.repeat(end - take, take) + np.repeat(np.cumsum(size) - size, take)
                part = batch.slice(i, j - i)
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, end).astype(np.int32)), pa.array(gram[at].view(np.int64)))
                yield pa.RecordBatch.from_arrays([column(part, "_id"), column(part, "_h"), *[pa.array(x.astype(np.int32)) for x in (size, p, u)], _binary16(node), _nids(node), lists], names=schema.names)

    return docs.mapInArrow(run, schema)


def size_classes(top: int, num: int, den: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Least size, number of parts and greatest number of parts that differ, of each class of the smaller set's sizes up to ``top``.

    Two sets of a and b >= a n-grams within reach differ in at most (a + b) (den - num) / (den + num) n-grams, and b is at most a den / num.
    """
    start, parts, differ = [1], [], []
    while start[-1] <= top:
        least = start[-1]
        most = max(least, least * 3 // 2 - 1)
        d = (most + most * den // num) * (den - num) // (den + num)
        for k in range(d + 1, d + d // 2 + 2):
            empty = k * exp(-least / k)
            if k - d > empty + sqrt(empty):
                break
        else:
            k = d + 1
        start.append(most + 1)
        parts.append(k)
        differ.append(d)
    return np.array(start[:-1]), np.array(parts), np.array(differ)


def signatures(doc: np.ndarray, gram: np.ndarray, size: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """(text number, signature of one of its parts): any two texts within reach of each other, with different sets, have a signature in common.

    A set has parts for its own size class and for those of smaller sets in reach. Of the parts that a pair has in common some may be
    empty; those count for nothing, and a set with so many of them that no other need be in common is dealt once more another way.
    """
    start, parts, differ = size_classes(int(size.max(initial=1)), num, den)
    own, low = (np.maximum(0, np.searchsorted(start, x, "right") - 1) for x in (size, -(-size * num // den)))
    owners, found = [np.zeros(0, np.int64)], [np.zeros(0, U)]
    for back in range(int((own - low).max(initial=0)) + 1):
        level = np.maximum(low, own - back)
        going = (size > 0) & (own - back >= low) & (differ[level] > 0)
        for deal in range(DEALS):
            if not going.any():
                break
            n = np.where(going, parts[level], 0)
            base = np.cumsum(n) - n
            mine = going[doc]
            d, h = doc[mine], mix(gram[mine] + SHIFTS[deal])
            slot = base[d] + (h % n[d].astype(U)).astype(np.int64)
            h = mix(h + U(1))
            total = int(n.sum())
            halves = [np.bincount(slot, (x & U(0xFFFFFFFF)).astype(float), total).astype(U) for x in (h, h >> U(32))]  # exact below 2^21 n-grams of a part
            full = np.bincount(slot, minlength=total) > 0
            who = np.repeat(np.arange(len(size)), n)
            name = (np.arange(total) - base[who]).astype(U) + (((level * DEALS + deal) << 40).astype(U))[who]
            going &= np.bincount(who[~full], minlength=len(size)) >= parts[level] - differ[level]
            if deal == DEALS - 1:
                full |= going[who]
            owners.append(who[full])
            found.append(mix(mix(mix(halves[0]) + halves[1]) + name)[full])
    return np.concatenate(owners), np.concatenate(found)


def neighbourhoods(docs: DataFrame, sets: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """nid, label: nodes joined by signatures. Signatures are dealt into buckets as flat bytes, 8 of the node and 5 of the signature."""
    spark = docs.sparkSession
    grams = sets.agg(F.sum(F.col("n").cast("long"))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1 + 2 * grams * (den - num) // den // BUCKET)

    def deal(held: list[tuple]) -> pa.RecordBatch:
        nid, sig = (np.concatenate(x) for x in zip(*held))
        bucket = (sig % U(buckets)).astype(np.int64)
        o = np.argsort(bucket, kind="stable")
        bucket = bucket[o]
        data = np.empty((len(o), ENTRY), np.uint8)
        data[:, :8], data[:, 8:] = (x[o].view(np.uint8).reshape(-1, 8)[:, k:] for x, k in ((nid, 0), (sig, 3)))
        first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        offs = (np.append(first, len(o)) * ENTRY).astype(np.int32)
        return pa.RecordBatch.from_arrays([pa.array(bucket[first]), pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offs), pa.py_buffer(data)])], names=["bucket", "entries"])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, seen = [], 0, set()
        for batch in batches:
            whole, offs = flat(column(batch, "_text"))
            for i, j in chunks(offs):
                doc, gram = gram_sets(whole[offs[i] : offs[j]], offs[i : j + 1] - offs[i], words)
                size, node = _nodes(doc, gram, j - i)
                nid = node[:, 0].copy()
                new = np.zeros(j - i, bool)  # copies of a text give their signatures once
                new[[r for r, x in enumerate(nid.tolist()) if not (x in seen or seen.add(x))]] = True
                mine = new[doc]
                who, sig = signatures(doc[mine], gram[mine], np.where(new, size, 0), num, den)
                if len(who):
                    held.append((nid[who], sig))
                    n += len(who)
                if n >= HELD:
                    yield deal(held)
                    held, n, seen = [], 0, set()
        if held:
            yield deal(held)

    def meet(table: pa.Table) -> pa.Table:
        data = np.frombuffer(b"".join(table.column("entries").to_pylist()), np.uint8).reshape(-1, ENTRY)
        nid, sig = np.ascontiguousarray(data[:, :8]).view(np.int64).ravel(), np.zeros((len(data), 8), np.uint8)
        sig[:, :5] = data[:, 8:]
        sig = sig.view(U).ravel()
        o = np.lexsort((nid, sig))
        nid, sig = nid[o], sig[o]
        first = np.flatnonzero(np.append(True, sig[1:] != sig[:-1]))
        least = np.repeat(nid[first], np.diff(np.append(first, len(sig))))
        pair = nid != least
        return pa.table({"a": nid[pair], "b": least[pair]})

    entries = batch_rows(docs.select("_text")).mapInArrow(spread, "bucket long, entries binary")
    return components(entries.groupBy("bucket").applyInArrow(meet, "a long, b long")).withColumnRenamed("node", "nid")


def clusters(sets: DataFrame, near: DataFrame) -> DataFrame:
    """nid, label: nodes of a neighbourhood (``near``) joined by an n-gram that both have in their prefix.

    The global order puts pool n-grams first, rarer ones before others, then the rest by hash. N-grams of one text only need no
    rows for that: how many of them a prefix holds follows from the counts. A token is an n-gram of a neighbourhood.
    """
    lists = reuse(sets.where("n > 0").join(bounded(near), "nid").select("nid", "label", "p", "u", "tokens"))
    tokens = lists.select("nid", "label", "p", "u", F.posexplode("tokens").alias("at", "token")).withColumn("token", F.xxhash64("label", "token"))
    busy = tokens.groupBy("token").agg(F.count("*").alias("c")).where("c > 1").select("token")
    few = tokens.select("nid", "token", F.when(F.col("at") < F.col("u"), F.struct("p", "u")).alias("pool"))
    shared = reuse(few.join(busy, "token", "left_semi").distinct())
    count = shared.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    known = shared.join(count, "token")
    own = W.partitionBy("nid", F.col("pool").isNotNull())  # at most the n-grams of one text
    ranked = known.withColumn("rank", F.row_number().over(own.orderBy("df", "token"))).withColumn("many", F.count("*").over(own))
    kept = reuse(ranked.where("pool is null or rank <= pool.p - (pool.u - many)").select("nid", "token"))
    low = kept.groupBy("token").agg(F.min("nid").alias("low"), F.count("*").alias("c")).where("c > 1").drop("c")
    return components(kept.join(low, "token").select(F.col("nid").alias("a"), F.col("low").alias("b")))


def trie_links(sets: list[np.ndarray], side: np.ndarray, num: int, den: int, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(weighted degree, component root) of each set by one traversal of the trie of all of them.

    ``side`` tells the two blocks of a cell apart: with both present only pairs across count.
    """
    m = len(sets)
    size = np.array([len(s) for s in sets])
    degree, root = np.zeros(m, np.int64), np.arange(m)
    if m < 2:
        return degree, root
    owner = np.repeat(np.arange(m), size)
    _, inverse, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = df[inverse] > 1  # what only one set holds never adds to an overlap
    order = np.empty(len(df), np.int64)
    order[np.argsort(-df, kind="stable")] = np.arange(len(df))
    token, owner = order[inverse[shared]], owner[shared]
    if not len(token):
        return degree, root
    post_owner = owner[np.argsort(token, kind="stable")]
    post = np.append(0, np.cumsum(np.bincount(token)))
    o = np.lexsort((token, owner))
    token, length = token[o], np.bincount(owner, minlength=m)
    seqs = np.split(token, np.cumsum(length)[:-1])
    rank = sorted(range(m), key=lambda i: seqs[i].tolist())
    seqs = [seqs[i] for i in rank]
    rank = np.array(rank)
    length, size_r = length[rank], size[rank]
    position = np.empty(m, np.int64)
    position[rank] = np.arange(m)
    post_owner = position[post_owner]
    side_r, weight_r = side[rank], weight[rank]
    across = side.min() != side.max()
    lcp = np.zeros(m, np.int64)
    for i in range(1, m):
        k = min(length[i], length[i - 1])
        diff = np.flatnonzero(seqs[i][:k] != seqs[i - 1][:k])
        lcp[i] = diff[0] if len(diff) else k
    label, deg = np.arange(m), np.zeros(m, np.int64)
    stack = [(0, m, 0, np.arange(m), np.zeros(m, np.int64))]
    while stack:
        lo, hi, depth, probe, overlap = stack.pop()
        reach = int(lcp[lo + 1 : hi].min()) if hi - lo > 1 else int(length[lo])
        if reach > depth:  # the edge into this subtree
            edge = seqs[lo][depth:reach]
            hits = np.concatenate([post_owner[post[t] : post[t + 1]] for t in edge])
            overlap = overlap + np.bincount(hits, minlength=m)[probe]
        left = np.minimum(int(length[lo:hi].max()) - reach, length[probe] - overlap)
        keep = (den + num) * (overlap + left) >= num * (size_r[probe] + int(size_r[lo:hi].min()))
        keep &= probe > lo
        probe, overlap = probe[keep], overlap[keep]
        if not len(probe):
            continue
        here = lo
        while here < hi and length[here] == reach:  # sets that end here
            ok = (probe > here) & ((den + num) * overlap >= num * (size_r[probe] + size_r[here]))
            if across:
                ok &= side_r[probe] != side_r[here]
            linked = probe[ok]
            if len(linked):
                deg[linked] += weight_r[here]
                deg[here] += weight_r[linked].sum()
                labels = np.unique(np.append(label[linked], label[here]))
                if len(labels) > 1:
                    label[np.isin(label, labels)] = labels[0]
            here += 1
        cuts = [here, *(here + 1 + np.flatnonzero(lcp[here + 1 : hi] == reach)).tolist(), hi] if here < hi else []
        for a, b in zip(cuts, cuts[1:]):
            stack.append((a, b, reach, probe, overlap))
    degree[rank] = deg
    root[rank] = rank[label]
    return degree, root


def block_ranges(member: DataFrame, num: int, den: int) -> DataFrame:
    """``member`` (label, n, node) with its block within the cluster as ``first`` and ``blocks`` (the node's hash picks one), and those it meets: ``low`` up to ``high``.

    A cluster of one block has only that. Others have blocks for each class of sizes, in order of size, and meet those of sizes in reach.
    """
    own, low, high = (F.floor(F.log(1.1, x)).cast("int") for x in (F.col("n"), F.ceil(F.col("n") * num / den), F.floor(F.col("n") * den / num)))
    blocks = F.greatest(F.ceil(F.count("*") / BLOCK_NODES), F.ceil(F.sum("n") / BLOCK_GRAMS)).cast("int").alias("blocks")
    large = member.groupBy("label").agg(blocks).where("blocks > 1").select("label")
    each = member.join(large, "label", "left_semi").groupBy("label", own.alias("z")).agg(blocks)
    placed = each.withColumn("first", F.sum("blocks").over(W.partitionBy("label").orderBy("z")) - F.col("blocks"))
    layout = placed.groupBy("label").agg(F.collect_list(F.struct("z", "first", "blocks")).alias("layout"))
    found = member.join(layout, "label", "left")
    mine = F.filter("layout", lambda x: x["z"] == own)[0]
    start = F.array_min(F.transform(F.filter("layout", lambda x: x["z"] >= low), lambda x: x["first"]))
    end = F.array_max(F.transform(F.filter("layout", lambda x: x["z"] <= high), lambda x: x["first"] + x["blocks"]))
    cols = (("first", mine["first"], 0), ("blocks", mine["blocks"], 1), ("low", start, 0), ("high", end, 1))
    return found.select(*member.columns, *[F.coalesce(c, F.lit(other)).cast("int").alias(name) for name, c, other in cols])


def linked_nodes(docs: DataFrame, sets: DataFrame, nodes: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """a, b, degree: for each node that shares a prefix n-gram with another one, the root of its cell and its degree there."""
    near = reuse(neighbourhoods(docs, sets, words, num, den))
    cluster = reuse(clusters(sets, near).withColumnRenamed("node", "nid"))
    member = nodes.join(cluster, "nid").select("node", "label", "copies", F.col("ex._id").alias("_id"), F.col("ex._h").alias("_h"), F.col("ex.n").alias("n"))
    member = block_ranges(member, num, den)
    picked = docs.join(member, same(docs, member, ["_id", "_h"])).select("_text", "node", "label", "copies", "first", "blocks", "low", "high")
    schema = "label long, i int, j int, side int, node binary, copies long, grams binary"
    cell_schema = pa.schema([("label", pa.int64()), ("i", pa.int32()), ("j", pa.int32()), ("side", pa.int32()), ("node", pa.binary()), ("copies", pa.int64()), ("grams", pa.binary())])

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), cell_schema)], schema=cell_schema)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole, offs = flat(column(batch, "_text"))
            first, blocks, low, high, copies = (np.asarray(column(batch, x)) for x in ("first", "blocks", "low", "high", "copies"))
            nodes, labels = column(batch, "node").to_pylist(), column(batch, "label").to_pylist()
            for lo, hi in chunks(offs):
                doc, gram = gram_sets(whole[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo], words)
                edge = np.append(0, np.cumsum(np.bincount(doc, minlength=hi - lo)))
                out, held = [], 0
                for r in range(lo, hi):
                    data = gram[edge[r - lo] : edge[r - lo + 1]].tobytes()
                    b = int(first[r]) + int.from_bytes(nodes[r][:4], "little") % int(blocks[r])
                    for k in range(int(low[r]), int(high[r])):
                        out.append((labels[r], min(b, k), max(b, k), int(b > k), nodes[r], int(copies[r]), data))
                        held += len(data)
                        if held > 1 << 24:
                            yield as_batch(out)
                            out, held = [], 0
                if out:
                    yield as_batch(out)

    def join_cell(table: pa.Table) -> pa.Table:
        seen, sets, sides, weights = {}, [], [], []
        for node, side, w, data in zip(*(table.column(c).to_pylist() for c in ("node", "side", "copies", "grams"))):
            if node not in seen:
                seen[node] = len(sets)
                sets.append(np.frombuffer(data, U))
                sides.append(side)
                weights.append(w)
        names = list(seen)
        if min(sides) == max(sides) and table.column("i")[0] != table.column("j")[0]:  # of two blocks, one with nothing in reach
            sets = [s[:0] for s in sets]
        degree, root = trie_links(sets, np.array(sides), num, den, np.array(weights))
        return pa.table({"a": pa.array(names, pa.binary()), "b": pa.array([names[r] for r in root], pa.binary()), "degree": pa.array(degree, pa.int64())})

    cells = batch_rows(picked).mapInArrow(spread, schema)
    return cells.groupBy("label", "i", "j").applyInArrow(join_cell, "a binary, b binary, degree long")


def jaccard_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, num: int = 80, den: int = 100, pool: float = 1.3) -> DataFrame:
    """Texts linked when den * |A and B| >= num * |A or B| of their ``words``-gram sets: _id, _h, n_shingles, component_id, n_links, component.

    One row per row of ``df``. component_id is the least id reachable by links, n_links the number of other rows linked directly.
    Texts without words, and null texts, have no n-grams, no links and their own id. Rows equal in text are linked. A null id is
    never a component's id unless all its ids are null. component names a component even where rows of several share an id. ``pool`` times 1 - t is the share of n-grams that are counted to order them;
    it changes the time, not the result.
    """
    with tidy(df.sparkSession):
        return _jaccard_components(df, id_col, text_col, words, num, den, pool)


def _jaccard_components(df: DataFrame, id_col: str, text_col: str, words: int, num: int, den: int, pool: float) -> DataFrame:
    docs = batch_rows(df).select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), fetch_key(id_col, text_col).alias("_h"))
    sets = reuse(prefixes(docs, words, num, den, pool))
    nodes = reuse(sets.where("n > 0").groupBy("node", "nid").agg(F.min("_id").alias("low_id"), F.count("*").alias("copies"), F.min(F.struct("_id", "_h", "n")).alias("ex")))
    links = reuse(linked_nodes(docs, sets, nodes, words, num, den))
    label = components(links.select("a", "b"))
    degree = links.groupBy(F.col("a").alias("node")).agg(F.sum("degree").alias("degree"))
    known = nodes.select("node", "low_id", "copies").join(label, "node", "left").join(degree, "node", "left").withColumn("label", F.coalesce("label", "node"))
    low = known.groupBy("label").agg(F.min("low_id").alias("component_id"))
    named = known.join(low, "label").select("node", "component_id", F.col("label").alias("component"), (F.col("copies") - 1 + F.coalesce("degree", F.lit(0))).alias("n_links"))
    left = sets.select("_id", "_h", "n", F.when(F.col("n") > 0, F.col("node")).alias("node"))
    out = left.join(named, "node", "left")
    return out.select("_id", "_h", F.col("n").cast("long").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("_id")).alias("component_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"), "component")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``df`` with one row of each component, the one with the least id; texts without words all stay. Columns as in ``df``."""
    found = jaccard_components(df, id_col, text_col, words, num, den).where("n_shingles > 0")
    first = reuse(found.groupBy("component").agg(F.min(F.struct(F.col("_id").isNull(), "_id", "_h")).alias("f")).select(F.col("f._id").alias("_id"), F.col("f._h").alias("_h")))
    own = fresh(df, "_h2")
    keyed = df.withColumn(own, fetch_key(id_col, text_col))
    empty = ~F.coalesce(F.col(text_col), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    kept = keyed.where(~empty).join(first, keyed[id_col].eqNullSafe(first["_id"]) & (keyed[own] == first["_h"]), "left_semi")
    if not found.groupBy("_id", "_h").count().where("count > 1").isEmpty():
        kept = kept.dropDuplicates([id_col, own])
    return kept.drop(own).unionByName(df.where(empty))


def op9(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return jaccard_components(docs, words=3, num=90, den=100, pool=2.0).select(F.col("_id").alias("doc_id"), "n_shingles", "component_id", "n_links")
