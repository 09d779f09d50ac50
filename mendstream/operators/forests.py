"""Isolation and random cut forests over the row x series matrix of each window.

A forest is data: trees are grown per (window, block of trees) and stand as a table of nodes; rows are scored against the nodes of a block, and Spark
adds the blocks up. One window is spread over as many tasks as it has blocks of trees and pieces of rows.
"""
from __future__ import annotations

import math
import pickle

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from mendstream import fixed
from mendstream.operators.timeseries import WIN
from mendstream.session import reuse

BLOCK, PIECE = 10, 4096  # trees of a task, rows of a task
EULER = 0.5772156649
NODE = "tenant_id string, window_id long, block int, tree int, node int, feature int, cut double, low int, high int, size int, depth int"


def row_vectors(df: DataFrame) -> DataFrame:
    """One row per row of the window with ``x``, its values in the order of the series' names; ``df`` is dense."""
    x = F.transform(F.array_sort(F.collect_list(F.struct("series", "v"))), lambda s: s["v"])
    return df.groupBy(*WIN, "row", "t", "is_baseline").agg(x.alias("x"))


def _spread(df: DataFrame, *keys: str) -> DataFrame:
    """Heavy on CPU, light on bytes: a given number of partitions is not merged by size at run time."""
    spark = df.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism * 2)
    return df.repartition(tasks, *keys)


def _blocks(trees: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit((trees - 1) // BLOCK)))


def _matrix(pdf: pd.DataFrame) -> np.ndarray:
    return np.stack(pdf["x"].to_numpy()).astype(float) if len(pdf) else np.zeros((0, 0))


# -- isolation forest --------------------------------------------------------------------------------


def grow_trees(x: np.ndarray, tree: np.ndarray, rng: np.random.Generator, limit: int) -> dict[str, np.ndarray]:
    """Node arrays of all trees at once, a level of all of them at a time; ``tree`` says which tree a row of ``x`` belongs to.

    A node of several different rows splits one of its series that vary, all alike likely, at a uniform cut above its least value.
    """
    at = np.unique(tree, return_inverse=True)[1]
    roots = int(at.max()) + 1
    out = {"tree": [np.unique(tree)], "node": [np.arange(roots)]} | {c: [] for c in ("feature", "cut", "low", "high", "size", "depth")}
    owner, first, total = out["tree"][0], 0, roots
    for depth in range(limit + 1):
        live = np.flatnonzero(at >= first)
        order = live[np.argsort(at[live], kind="stable")]
        size = np.bincount(at[order] - first, minlength=total - first)
        start = np.cumsum(size) - size
        least, most = (f.reduceat(x[order], start, axis=0) for f in (np.minimum, np.maximum))
        wide = most > least
        split = wide.any(axis=1) & (depth < limit)
        draw = np.where(wide, rng.random(wide.shape), -1.0)
        feature = np.where(split, draw.argmax(axis=1), -1)
        n = np.arange(len(size))
        lo, hi = least[n, feature], most[n, feature]
        cut = np.minimum(np.maximum(lo + (1 - rng.random(len(n))) * (hi - lo), np.nextafter(lo, np.inf)), hi)
        child = total + 2 * (np.cumsum(split) - split)
        for c, v in (("feature", feature), ("cut", np.where(split, cut, 0.0)), ("low", np.where(split, child, -1)), ("high", np.where(split, child + 1, -1)), ("size", size), ("depth", np.full(len(n), depth))):
            out[c].append(v)
        if not split.any():
            break
        moving = order[split[at[order] - first]]
        node = at[moving] - first
        at[moving] = child[node] + (x[moving, feature[node]] >= cut[node])
        owner = np.repeat(owner[split], 2)
        first, total = total, total + 2 * int(split.sum())
        out["tree"].append(owner)
        out["node"].append(np.arange(first, total))
    return {c: np.concatenate(v) for c, v in out.items()}


def isolation_nodes(vectors: DataFrame, trees: int, sample: int, seed: int) -> DataFrame:
    """Table of nodes: each tree is grown on ``sample`` baseline rows of its window, drawn without replacement; without a baseline on any rows.

    ``feature`` counts the window's series by name from 0, -1 in a leaf; rows below ``cut`` go to node ``low``, others to ``high``; roots have depth 0.
    """

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("row")
        block = int(pdf["block"].iloc[0])
        x = _matrix(pdf[pdf["is_baseline"]] if pdf["is_baseline"].any() else pdf)
        rng = np.random.default_rng([seed, block])
        m = min(sample, len(x))
        which = range(block * BLOCK, min(trees, (block + 1) * BLOCK))
        rows = np.concatenate([rng.choice(len(x), m, replace=False) for _ in which])
        nodes = grow_trees(x[rows], np.repeat(np.array(which), m), rng, max(1, math.ceil(math.log2(max(m, 2)))))
        return pd.DataFrame({"tenant_id": pdf["tenant_id"].iloc[0], "window_id": pdf["window_id"].iloc[0], "block": block} | nodes)

    fit = vectors.select(*WIN, "row", "is_baseline", "x", _blocks(trees).alias("block"))
    return _spread(fit, *WIN, "block").groupBy(*WIN, "block").applyInPandas(grow, NODE)


def mean_path(n: Column) -> Column:
    """Mean depth of a search that fails among ``n`` rows."""
    return F.when(n <= 1, 0.0).when(n == 2, 1.0).otherwise(2.0 * (F.log(n - 1.0) + EULER) - 2.0 * (n - 1.0) / n)


def forest_scores(vectors: DataFrame, nodes: DataFrame) -> DataFrame:
    """Isolation score of every row from a table of nodes: 2 to the minus mean depth over the mean path of the sample, both as the nodes say.

    A leaf of several rows counts as deep as a search among them would go on.
    """

    def walk(key: tuple, rows: pd.DataFrame, tree: pd.DataFrame) -> pd.DataFrame:
        tree = tree.sort_values("node")
        feature, cut, low, high = (tree[c].to_numpy() for c in ("feature", "cut", "low", "high"))
        reach = tree["reach"].to_numpy()
        slot = np.full(int(tree["node"].max()) + 1, -1) if len(tree) else np.zeros(0, int)
        slot[tree["node"].to_numpy()] = np.arange(len(tree))
        x = _matrix(rows)
        total = np.zeros(len(rows))
        n = np.arange(len(rows))
        for root in np.flatnonzero(tree["depth"].to_numpy() == 0):
            at = np.full(len(rows), root)
            while (inner := feature[at] >= 0).any():
                below = x[n, np.maximum(feature[at], 0)] < cut[at]
                at = np.where(inner, slot[np.where(below, low[at], high[at])], at)
            total += reach[at]
        return pd.DataFrame({"tenant_id": key[0], "window_id": key[1], "row": rows["row"].to_numpy(), "total": total})

    nodes = nodes.withColumn("reach", F.col("depth") + mean_path(F.col("size")))
    pieces = vectors.groupBy(*WIN).agg(F.max(F.expr(f"row div {PIECE}")).cast("int").alias("_last"))
    blocks = nodes.groupBy(*WIN).agg(F.collect_set("block").alias("_blocks"), F.countDistinct("block", "tree").alias("_trees"), F.max(F.when(F.col("depth") == 0, F.col("size"))).alias("_m"))
    left = vectors.join(blocks, WIN).select(*WIN, "row", "x", F.explode("_blocks").alias("block"), F.expr(f"row div {PIECE}").cast("int").alias("piece"))
    right = nodes.join(pieces, WIN).withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("_last")))).drop("_last")
    key = [*WIN, "block", "piece"]
    parts = _spread(left, *key).groupBy(*key).cogroup(_spread(right, *key).groupBy(*key)).applyInPandas(walk, "tenant_id string, window_id long, row int, total double")
    sums = parts.groupBy(*WIN, "row").agg(F.sum("total").alias("_total")).join(blocks.select(*WIN, "_trees", "_m"), WIN)
    score = F.pow(F.lit(2.0), -(F.col("_total") / F.col("_trees")) / F.greatest(mean_path(F.col("_m")), F.lit(1e-9)))
    return vectors.select(*WIN, "row", "t", "is_baseline").join(sums.select(*WIN, "row", score.alias("score")), [*WIN, "row"])


def flag(scored: DataFrame, reference: DataFrame, k: float, least: float = 0.0) -> DataFrame:
    """``is_anomaly`` where the score is above mean + k * population std (at least ``least``) of the window's ``reference`` scores."""
    limit = reference.groupBy(*WIN).agg((F.avg("score") + k * F.greatest(F.stddev_pop("score"), F.lit(least))).alias("_limit"))
    return scored.join(limit, WIN).select(*WIN, "row", "t", (F.col("score") > F.col("_limit")).alias("is_anomaly"), "score")


def baseline_of(scored: DataFrame) -> DataFrame:
    """The window's baseline rows, or all rows of a window without any."""
    some = scored.groupBy(*WIN).agg(F.max("is_baseline").alias("_some"))
    return scored.join(some, WIN).where("is_baseline or not _some")


def iforest_detect(df: DataFrame, k: float = fixed.FOREST_MULTIPLIER, trees: int = fixed.FOREST_TREES, sample: int = fixed.FOREST_SAMPLE, seed: int = 42) -> DataFrame:
    """Isolation forest; threshold = mean + k * population std of the baseline scores."""
    vectors = reuse(row_vectors(df))
    scored = reuse(forest_scores(vectors, reuse(isolation_nodes(vectors, trees, sample, seed))))
    return flag(scored, baseline_of(scored), k)


# -- random cut forest -------------------------------------------------------------------------------


class CutTree:
    """A random cut tree that points can join and leave.

    Every inner node cuts its bounding box at a place drawn evenly over the sum of the box's sides, so a point that joins may cut itself off at any
    node. A leaf holds all keys of one point. Nodes: [parent, low, high, feature, cut, box, size]; a leaf has its keys for ``low``.
    """

    def __init__(self, rng: np.random.Generator):
        self.rng, self.nodes, self.leaf_of, self.root, self.next = rng, {}, {}, None, 0

    def _new(self, *node) -> int:
        self.nodes[self.next] = list(node)
        self.next += 1
        return self.next - 1

    def _hang(self, parent: int | None, old: int | None, new: int | None) -> None:
        """Put ``new`` where ``old`` hangs."""
        if parent is None:
            self.root = new
        else:
            node = self.nodes[parent]
            node[1 if node[1] == old else 2] = new
        if new is not None:
            self.nodes[new][0] = parent

    def insert(self, key: int, point: np.ndarray) -> None:
        point = np.asarray(point, float)
        if self.root is None:
            self.root = self.leaf_of[key] = self._new(None, {key}, None, -1, 0.0, (point, point), 1)
            return
        at, above = self.root, []
        while True:
            node = self.nodes[at]
            low, high = np.minimum(node[5][0], point), np.maximum(node[5][1], point)
            sides = np.cumsum(high - low)
            if sides[-1] == 0:  # the same point as this leaf
                node[1].add(key)
                self.leaf_of[key] = at
                above.append(at)
                break
            draw = self.rng.random() * sides[-1]
            feature = min(int(np.searchsorted(sides, draw, "right")), len(sides) - 1)
            cut = low[feature] + draw - (sides[feature - 1] if feature else 0.0)
            under, over = node[5][0][feature] > cut >= point[feature], node[5][1][feature] <= cut < point[feature]
            if not (under or over) and node[3] < 0:  # rounding: a leaf is always cut off from another point
                feature = int(np.argmax(high - low))
                cut = low[feature]
                under = point[feature] <= cut
                over = not under
            if under or over:
                leaf = self._new(None, {key}, None, -1, 0.0, (point, point), 1)
                parent = node[0]
                top = self._new(parent, *((leaf, at) if under else (at, leaf)), feature, cut, (low, high), node[6] + 1)
                self._hang(parent, at, top)
                self.nodes[at][0] = self.nodes[leaf][0] = top
                self.leaf_of[key] = leaf
                break
            above.append(at)
            node[5] = (low, high)
            at = node[1] if point[node[3]] <= node[4] else node[2]
        for n in above:
            self.nodes[n][6] += 1

    def forget(self, key: int) -> None:
        leaf = self.leaf_of.pop(key)
        node = self.nodes[leaf]
        node[1].discard(key)
        at = node[0]
        if node[1]:
            node[6] -= 1
        else:
            del self.nodes[leaf]
            if at is None:
                self.root = None
                return
            parent = self.nodes.pop(at)
            other = parent[2] if parent[1] == leaf else parent[1]
            self._hang(parent[0], at, other)
            at = parent[0]
        while at is not None:
            node = self.nodes[at]
            boxes = [self.nodes[c][5] for c in node[1:3]]
            node[5] = (np.minimum(boxes[0][0], boxes[1][0]), np.maximum(boxes[0][1], boxes[1][1]))
            node[6] -= 1
            at = node[0]

    def displacement(self, key: int) -> float:
        """The largest ratio of a sibling's size to the own side's size on the way up: how much the tree would change without the point and its like."""
        at, worst = self.leaf_of[key], 0.0
        while (parent := self.nodes[at][0]) is not None:
            node = self.nodes[parent]
            other = node[2] if node[1] == at else node[1]
            worst = max(worst, self.nodes[other][6] / self.nodes[at][6])
            at = parent
        return worst


    def dump(self) -> tuple:
        """Plain data that ``load`` makes the same tree of."""
        return self.rng.bit_generator.state, self.nodes, self.leaf_of, self.root, self.next

    @classmethod
    def load(cls, data: tuple) -> CutTree:
        tree = cls(np.random.default_rng(0))
        tree.rng.bit_generator.state, tree.nodes, tree.leaf_of, tree.root, tree.next = data
        return tree


class LiveForest:
    """Random cut trees over the last ``sample`` points of a stream: each point joins all trees, is scored, and pushes out the oldest."""

    def __init__(self, trees: int, sample: int, seed: int):
        self.trees, self.sample, self.n = [CutTree(np.random.default_rng([seed, k])) for k in range(trees)], sample, 0

    def score(self, point: list[float]) -> float:
        """Mean displacement of the point."""
        total = 0.0
        for tree in self.trees:
            if self.n >= self.sample:
                tree.forget(self.n - self.sample)
            tree.insert(self.n, point)
            total += tree.displacement(self.n)
        self.n += 1
        return total / len(self.trees)

    def dump(self) -> bytes:
        return pickle.dumps((self.sample, self.n, [t.dump() for t in self.trees]))

    @classmethod
    def load(cls, data: bytes) -> LiveForest:
        forest = cls(0, 0, 0)
        forest.sample, forest.n, trees = pickle.loads(data)
        forest.trees = [CutTree.load(t) for t in trees]
        return forest


def displacements(x: np.ndarray, tree: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Displacement of each row of ``x`` in its tree, for trees grown on all their rows at once, a level of all trees at a time.

    Cuts are drawn as ``CutTree`` draws them; a leaf is all rows of one point.
    """
    at = np.unique(tree, return_inverse=True)[1]
    worst = np.zeros(int(at.max()) + 1 if len(at) else 0)  # of the nodes of a level
    out = np.zeros(len(x))
    live = np.arange(len(x))
    while len(live):
        nodes, node, size = np.unique(at[live], return_inverse=True, return_counts=True)
        order = np.argsort(node, kind="stable")
        start = np.cumsum(size) - size
        least, most = (f.reduceat(x[live[order]], start, axis=0) for f in (np.minimum, np.maximum))
        sides = np.cumsum(most - least, axis=1)
        split = sides[:, -1] > 0
        out[live] = worst[nodes][node]
        draw = rng.random(len(nodes)) * sides[:, -1]
        feature = np.minimum((sides <= draw[:, None]).sum(axis=1), x.shape[1] - 1)
        n = np.arange(len(nodes))
        cut = least[n, feature] + draw - np.where(feature > 0, sides[n, np.maximum(feature - 1, 0)], 0.0)
        cut = np.where(cut >= most[n, feature], least[n, feature], cut)  # rounding: both sides keep a row
        empty = split & (most[n, feature] <= least[n, feature])
        feature = np.where(empty, (most - least).argmax(axis=1), feature)
        cut = np.where(empty, least[n, feature], cut)
        keep = split[node]
        live, node = live[keep], node[keep]
        high = x[live, feature[node]] > cut[node]
        at[live] = 2 * node + high
        count = np.bincount(at[live], minlength=2 * len(nodes))
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = count.reshape(-1, 2)[:, ::-1].ravel() / count
        worst = np.maximum(np.repeat(worst[nodes], 2), np.nan_to_num(ratio, posinf=0.0))
    return out


def cut_scores(vectors: DataFrame, trees: int, sample: int, seed: int) -> DataFrame:
    """Mean displacement of every row over all trees. Each tree holds ``sample`` rows of its window; any other row joins it, is scored, and leaves again."""

    def score(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("row")
        block, x = int(pdf["block"].iloc[0]), _matrix(pdf)
        rng = np.random.default_rng([seed, block])
        n, m = len(x), min(sample, len(x))
        which = range(block * BLOCK, min(trees, (block + 1) * BLOCK))
        total = np.zeros(n)
        if m == n:
            total = displacements(np.tile(x, (len(which), 1)), np.repeat(np.array(which), n), rng).reshape(len(which), n).sum(axis=0)
        else:
            for _ in which:
                order = rng.permutation(n)
                tree = CutTree(rng)
                for i in order[:m].tolist():
                    tree.insert(i, x[i])
                for i in order[:m].tolist():
                    total[i] += tree.displacement(i)
                for i in order[m:].tolist():
                    tree.insert(i, x[i])
                    total[i] += tree.displacement(i)
                    tree.forget(i)
        return pd.DataFrame({"tenant_id": pdf["tenant_id"].iloc[0], "window_id": pdf["window_id"].iloc[0], "row": pdf["row"], "total": total})

    cells = _spread(vectors.select(*WIN, "row", "x", _blocks(trees).alias("block")), *WIN, "block")
    parts = cells.groupBy(*WIN, "block").applyInPandas(score, "tenant_id string, window_id long, row int, total double")
    sums = parts.groupBy(*WIN, "row").agg((F.sum("total") / trees).alias("score"))
    return vectors.select(*WIN, "row", "t", "is_baseline").join(sums, [*WIN, "row"])


def rrcf_detect(df: DataFrame, k: float = fixed.FOREST_MULTIPLIER, trees: int = fixed.FOREST_TREES, sample: int = fixed.FOREST_SAMPLE, seed: int = 42) -> DataFrame:
    """Random cut forest; the threshold comes from a forest of the baseline rows alone."""
    vectors = reuse(row_vectors(df))
    base = baseline_of(vectors)
    return flag(cut_scores(vectors, trees, sample, seed), cut_scores(base, trees, sample, seed), k, least=1e-4)
