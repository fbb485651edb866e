"""Forests on many rows: all trees grow together, one pass over binned rows a
level.

Spark ML draws a weight for each row and tree by a slow generator, keeps them
all and walks every tree from its root for each row and level, some 0.6
microseconds a row and tree.  Here rows are binned once, a byte for each feature
(Spark ML's candidate splits: midpoints of values, quantiles of a sample where
there are more than ``max_bins``), in blocks of ``BLOCK`` rows.  A block's weights
of a tree are Poisson(1) draws seeded by the tree and the block, drawn again in
each pass instead of kept.  A task adds up, for each open node, the weights of
its rows by bin and class of the features drawn for that node; features of few
bins share a joint histogram.  What is shuffled is these sums for each core;
the driver chooses the splits.

The trees are those of Spark ML's algorithm: a fresh subset of the features for
each node, Gini gain, a split where it is above 0 and both sides have rows, no
split of a pure node, leaves of a split with the same prediction merged.  They
become Spark ML models.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.bootstrap import _POISSON_CDF, added, partial_tasks

BLOCK = 1 << 15  # rows of a block at most: a core's cache holds their bins
BLOCKS_OF_A_TASK = 16  # or as few as leave a task so many blocks, which are dealt evenly
PART_ROWS = 250_000  # rows of a partition of blocks at most, about
JOINT = 1024  # cells of a histogram that features share, at most
HELD = 32 << 20  # bytes of a task's histograms in a pass, about

BLOCKS = "block long, n_rows int, bins binary, classes binary"
SUMS = "rep long, vals array<double>"


@dataclass
class Node:
    counts: np.ndarray  # rows drawn, by class
    split: tuple[int, int] | None = None  # feature, last bin of the left side
    gain: float = 0.0


# ------------------------------------------------------------------ binning


def thresholds(values: np.ndarray, weights: np.ndarray, max_bins: int) -> np.ndarray:
    """Candidate splits of a feature, as Spark ML chooses them."""
    found, at = np.unique(values, return_inverse=True)
    if len(found) <= max_bins:
        return (found[:-1] + found[1:]) / 2
    upto = np.cumsum(np.bincount(at, weights=weights))
    stride = upto[-1] / max_bins
    out, target = [], stride
    for i in range(1, len(found)):
        if abs(upto[i - 1] - target) < abs(upto[i] - target):
            out.append((found[i - 1] + found[i]) / 2)
            target += stride
    return np.array(out)


def binned_blocks(rows: DataFrame, edges: list[np.ndarray], block: int = BLOCK) -> DataFrame:
    """BLOCKS of (label, features) rows: a byte for each feature and row, feature
    after feature.  A value's bin is the number of thresholds below it."""
    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, made, held, n = TaskContext.get().partitionId(), 0, [], 0

        def made_of(codes: np.ndarray) -> pa.RecordBatch:
            nonlocal made
            made += 1
            return pa.RecordBatch.from_arrays([pa.array([(part << 32) + made], pa.int64()), pa.array([codes.shape[1]], pa.int32()), pa.array([codes[1:].tobytes()], pa.binary()),
                                               pa.array([codes[0].tobytes()], pa.binary())], names=[f.split()[0] for f in BLOCKS.split(", ")])

        for batch in batches:
            codes = np.empty((batch.num_columns, batch.num_rows), np.uint8)
            for i, column in enumerate(batch.columns):
                x = column.to_numpy(zero_copy_only=False)
                if column.null_count or np.isnan(x).any():
                    raise ValueError("a forest's rows have a null or NaN: " + ("label" if i == 0 else f"feature {i - 1}"))
                codes[i] = x if i == 0 else x > edges[i - 1][0] if len(edges[i - 1]) == 1 else np.searchsorted(edges[i - 1], x)
            held.append(codes)
            n += batch.num_rows
            while n >= block:
                codes = np.concatenate(held, axis=1)
                yield made_of(codes[:, :block])
                held, n = [codes[:, block:]], n - block
        if n:
            yield made_of(np.concatenate(held, axis=1))

    return rows.mapInArrow(bins, BLOCKS)


# ------------------------------------------------------------------ weights

_UNSURE = 255  # 16 bits do not tell the weight


def _weight_table() -> np.ndarray:
    at = np.arange(65537) / 65536
    low, high = np.searchsorted(_POISSON_CDF, at[:-1], side="right"), np.searchsorted(_POISSON_CDF, at[1:], side="left")
    return np.where(low == high, low, _UNSURE).astype(np.uint8)


def tree_weights(seed: int, tree: int, block: int, n: int, table: np.ndarray) -> np.ndarray:
    """Poisson(1) weights of a block's rows in a tree: 16 bits each, and more
    where those do not tell."""
    rng = np.random.Generator(np.random.SFC64([seed, tree, block]))
    u = rng.integers(0, 1 << 64, size=-(-n // 4), dtype=np.uint64).view(np.uint16)[:n]
    w = table.take(u)
    unsure = np.flatnonzero(w == _UNSURE)
    if len(unsure):
        w[unsure] = np.searchsorted(_POISSON_CDF, (u[unsure] + rng.random(len(unsure))) / 65536, side="right")
    return w


# --------------------------------------------------------------- histograms


def node_features(seed: int, tree: int, node: int, k: int) -> list[int]:
    """The features a node may split on, sqrt(k) of k rounded up, in the order
    of Spark ML's reservoir: of equal gains the first one's counts."""
    chance, kept = np.random.default_rng([seed, tree, 1, node]).random(k), math.ceil(math.sqrt(k))
    found = list(range(min(kept, k)))
    for f in range(kept, k):
        at = int(chance[f] * (f + 1))
        if at < kept:
            found[at] = f
    return found


def shared(features: Sequence[int], sizes: Sequence[int], classes: int, joint: int = JOINT) -> list[list[int]]:
    """The features in groups whose joint histogram has ``joint`` cells at most
    (a feature with more is alone)."""
    groups: list[list[int]] = []
    for f in sorted(features, key=lambda f: -sizes[f]):
        for g in groups:
            if math.prod(sizes[i] for i in [*g, f]) * classes <= joint:
                g.append(f)
                break
        else:
            groups.append([f])
    return groups


def histograms(blocks: DataFrame, plan, sizes: list[int], classes: int, seed: int, tasks: int) -> dict[int, np.ndarray]:
    """For each tree of ``plan`` = [(tree, splits of its inner nodes, [(node,
    groups of features)])] the nodes' weights by bin and class, feature after
    feature as the groups have them."""
    def cells(group: list[int]) -> int:
        return math.prod(sizes[f] for f in group) * classes

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _weight_table()
        sums = [[[np.zeros(cells(g)) for g in groups] for _, groups in nodes] for _, _, nodes in plan]
        for batch in batches:
            for b in range(batch.num_rows):
                block, n = batch["block"][b].as_py(), batch["n_rows"][b].as_py()
                narrow = np.frombuffer(batch["bins"][b].as_buffer(), np.uint8).reshape(-1, n)
                wide = narrow.astype(np.uint32 if max(cells(g) for _, _, nodes in plan for _, gs in nodes for g in gs) > 65535 else np.uint16)
                y = np.frombuffer(batch["classes"][b].as_buffer(), np.uint8).astype(wide.dtype)
                for (tree, splits, nodes), into in zip(plan, sums):
                    w = tree_weights(seed, tree, block, n, table)
                    of = {1: w > 0}
                    for node, (feature, last) in splits:
                        of[2 * node + 1] = right = of[node] & (narrow[feature] > last)
                        of[2 * node] = of[node] ^ right
                    for (node, groups), tables in zip(nodes, into):
                        rows = of[node].nonzero()[0]
                        mine, label = w.take(rows), y.take(rows)
                        for group, total in zip(groups, tables):
                            code = wide[group[0]].take(rows) if group else np.zeros(len(rows), wide.dtype)
                            for f in group[1:]:
                                code *= sizes[f]
                                code += wide[f].take(rows)
                            code *= classes
                            code += label
                            total += np.bincount(code, mine, len(total))
        vals = []
        for (_, _, nodes), into in zip(plan, sums):
            each = [np.zeros(0)]
            for (_, groups), tables in zip(nodes, into):
                for group, total in zip(groups, tables):
                    cube = total.reshape([sizes[f] for f in group] + [classes])
                    each += [cube.sum(axis=tuple(j for j in range(len(group)) if j != i)).ravel() for i in range(len(group))] or [total]
            vals.append(np.concatenate(each))
        ends = np.cumsum([0] + [len(v) for v in vals])
        for lo in range(0, len(vals), 64):  # some trees at once
            some = pa.ListArray.from_arrays(pa.array(ends[lo:lo + 65] - ends[lo], pa.int32()), pa.array(np.concatenate(vals[lo:lo + 64]), pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array([t for t, _, _ in plan[lo:lo + 64]], pa.int64()), some], names=["rep", "vals"])

    found = added(blocks.coalesce(tasks).mapInArrow(add, SUMS), tasks)
    return dict(zip(found["rep"].tolist(), found["v"]))


# -------------------------------------------------------------------- trees


def _gini(counts: np.ndarray) -> np.ndarray:
    total = counts.sum(axis=-1, keepdims=True)
    share = np.divide(counts, total, out=np.zeros(counts.shape), where=total > 0)
    impurity = np.ones(counts.shape[:-1])
    for c in range(counts.shape[-1]):  # in Spark ML's order, which decides between almost equal gains
        impurity = impurity - share[..., c] * share[..., c]
    return impurity


def best_split(by_feature: dict[int, np.ndarray], weight: np.ndarray):
    """(gain, feature, last bin of the left side, counts left, counts right) of
    the split with the largest gain above 0, or None, from a node's counts by
    bin and class of each feature."""
    best = None
    for feature, counts in by_feature.items():
        left = np.cumsum(counts, axis=0)
        right = left[-1] - left[:-1]
        left, whole = left[:-1], left[-1] * weight
        a, b = (left * weight).sum(axis=1), (right * weight).sum(axis=1)
        n = max(whole.sum(), 1e-300)
        gain = _gini(whole) - a / n * _gini(left * weight) - b / n * _gini(right * weight)
        gain[(left.sum(axis=1) < 1) | (right.sum(axis=1) < 1)] = -1.0
        i = int(gain.argmax()) if len(gain) else -1
        if i >= 0 and gain[i] > (best[0] if best else 0.0):
            best = float(gain[i]), feature, i, left[i], right[i]
    return best


def block_rows(n_rows: int, tasks: int) -> int:
    return min(BLOCK, max(1024, -(-n_rows // (BLOCKS_OF_A_TASK * tasks))))


def grow(df: DataFrame, features: Sequence[str], label: str, n_trees: int, depth: int, seed: int, class_weight: Sequence[float], n_rows: int, max_bins: int = 256,
         block: int | None = None) -> tuple[list[dict[int, Node]], list[np.ndarray]]:
    """(trees, thresholds of each feature).  A tree is its nodes by number: 1 is
    the root, the children of i are 2i and 2i + 1.  A tree depends on its own
    number and the rows' layout, not on how many trees there are."""
    if not 2 <= max_bins <= 256:
        raise ValueError("a bin is a byte")
    weight, k, classes = np.asarray(class_weight, float), len(features), len(class_weight)
    rows = df.select(F.col(label).cast("double").alias("_y"), *[F.col(f).cast("double").alias(f"_x{i}") for i, f in enumerate(features)])
    share = min(1.0, max(max_bins ** 2, 10_000) / max(1, n_rows))  # as Spark ML
    some = rows.sample(share, seed).toArrow() if share < 1 else rows.toArrow()
    y = weight[some["_y"].to_numpy().astype(int)]
    edges = [thresholds(some[f"_x{i}"].to_numpy(), y, max_bins) for i in range(k)]
    sizes, tasks = [len(e) + 1 for e in edges], partial_tasks(df)
    blocks = binned_blocks(rows, edges, block or block_rows(n_rows, tasks))
    blocks = blocks.repartition(max(2 * tasks, -(-n_rows // PART_ROWS)))  # a scan may give one partition for each file
    blocks = blocks.persist(StorageLevel.MEMORY_AND_DISK)
    trees: list[dict[int, Node]] = [{1: Node(np.zeros(classes))} for _ in range(n_trees)]
    try:
        blocks.count()
        for level in range(depth):
            todo = []
            for t, nodes in enumerate(trees):
                open_ = [i for i in nodes if i >> level == 1 and (level == 0 or abs(_gini(nodes[i].counts * weight)) >= 1e-15)]
                asked = [(i, shared([f for f in node_features(seed, t, i, k) if sizes[f] > 1], sizes, classes)) for i in open_]
                asked = [(i, groups or [[]]) for i, groups in asked if groups or level == 0]  # a root that nothing splits is counted
                if asked:
                    todo.append((t, [(i, nodes[i].split) for i in sorted(nodes) if nodes[i].split], asked))
            for plan in _passes(todo, sizes, classes):
                found = histograms(blocks, plan, sizes, classes, seed, tasks)
                for t, _, asked in plan:
                    _split(trees[t], asked, found[t], sizes, weight, lambda i, t=t: node_features(seed, t, i, k))
        return trees, edges
    finally:
        blocks.unpersist()


def _passes(todo: list, sizes: list[int], classes: int) -> Iterator[list]:
    """The trees of a level in as many passes as keep a task's histograms near HELD bytes."""
    plan, held = [], 0
    for x in todo:
        held += 8 * classes * sum(math.prod(sizes[f] for f in g) for _, groups in x[2] for g in groups)
        plan.append(x)
        if held >= HELD:
            yield plan
            plan, held = [], 0
    if plan:
        yield plan


def _split(nodes: dict[int, Node], asked, sums: np.ndarray, sizes: list[int], weight: np.ndarray, features_of) -> None:
    """Split the nodes asked for by their histograms."""
    at, classes = 0, len(weight)
    for i, groups in asked:
        by_feature = {}
        if groups == [[]]:
            nodes[i].counts = sums[:classes]
        for f in (f for g in groups for f in g):
            by_feature[f] = sums[at:at + sizes[f] * classes].reshape(sizes[f], classes)
            at += sizes[f] * classes
        if i == 1 and by_feature:
            nodes[1].counts = next(iter(by_feature.values())).sum(axis=0)
        best = best_split({f: by_feature[f] for f in features_of(i) if f in by_feature}, weight)
        if best:
            nodes[i].gain, feature, last, left, right = best
            nodes[i].split = feature, last
            nodes[2 * i], nodes[2 * i + 1] = Node(left), Node(right)


def walks(trees: list[dict[int, Node]], edges: list[np.ndarray], class_weight: Sequence[float]) -> list[tuple]:
    """Each tree for ``leaf_numbers``: (split or leaf number, class shares of its
    leaves); a split is (feature, threshold, left, right).  Leaves that a model
    merges vote as the merged one."""
    weight, out = np.asarray(class_weight, float), []

    def walk(nodes: dict[int, Node], i: int, shares: list):
        """(split or leaf number, prediction if it is a leaf)"""
        counts = nodes[i].counts * weight
        if nodes[i].split:
            held = len(shares)
            (left, a), (right, b) = walk(nodes, 2 * i, shares), walk(nodes, 2 * i + 1, shares)
            if a is None or a != b:
                feature, last = nodes[i].split
                return (feature, float(edges[feature][last]), left, right), None
            del shares[held:]
        shares.append(counts / counts.sum() if counts.sum() else counts)
        return len(shares) - 1, int(counts.argmax())

    for nodes in trees:
        shares: list[np.ndarray] = []
        tree = walk(nodes, 1, shares)[0]
        out.append((tree, np.array(shares)))
    return out


def leaf_numbers(tree, x: list[np.ndarray], kind) -> np.ndarray:
    """The leaf that each row of the feature columns ``x`` reaches."""
    if not isinstance(tree, tuple):
        return kind(tree)
    feature, threshold, left, right = tree
    return np.where(x[feature] <= threshold, leaf_numbers(left, x, kind), leaf_numbers(right, x, kind))


def vote_sums(df: DataFrame, keep: Sequence[str], features: Sequence[str], chunks: list[list[tuple]], ends: Sequence[int]) -> DataFrame:
    """``_keep0`` .. of the ``keep`` columns and the votes of both classes after
    each of the chunks numbered ``ends``, as arrays ``_zero`` and ``_one``."""
    n = len(keep)
    rows = df.select(*[F.col(c).alias(f"_keep{i}") for i, c in enumerate(keep)], *[F.col(f).cast("double").alias(f"_x{i}") for i, f in enumerate(features)])
    schema = T.StructType([*rows.schema.fields[:n], *[T.StructField(c, T.ArrayType(T.DoubleType())) for c in ("_zero", "_one")]])

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, size = [c.to_numpy(zero_copy_only=False) for c in batch.columns[n:]], batch.num_rows
            for f, c, v in zip(features, batch.columns[n:], x):
                if c.null_count or np.isnan(v).any():
                    raise ValueError(f"a forest votes on no null or NaN: {f}")
            votes, found = np.zeros((2, size)), np.empty((2, size, len(ends)))
            for i, trees in enumerate(chunks):
                mine = np.zeros((2, size))
                for tree, shares in trees:
                    leaf = np.broadcast_to(leaf_numbers(tree, x, np.uint8 if len(shares) < 256 else np.uint32), size).astype(np.intp)
                    mine[0] += shares[:, 0].take(leaf)
                    mine[1] += shares[:, 1].take(leaf)
                votes += mine
                if i in ends:
                    found[:, :, ends.index(i)] = votes
            offsets = pa.array(np.arange(size + 1) * len(ends), pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], *[pa.ListArray.from_arrays(offsets, pa.array(v.ravel())) for v in found]], names=[f.name for f in schema])

    return rows.mapInArrow(vote, schema)


def model(spark, trees: list[dict[int, Node]], edges: list[np.ndarray], class_weight: Sequence[float]) -> RandomForestClassificationModel:
    """The Spark ML model of some trees."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    ml, k, classes = jvm.org.apache.spark.ml, len(edges), len(class_weight)
    leaf, inner, split = ml.tree.LeafNode, ml.tree.InternalNode, ml.tree.ContinuousSplit
    gini, one = jvm.org.apache.spark.mllib.tree.impurity.GiniCalculator, ml.classification.DecisionTreeClassificationModel
    weight = np.asarray(class_weight, float)

    def build(nodes: dict[int, Node], i: int):
        """(node, its prediction if it is a leaf)"""
        node = nodes[i]
        counts = node.counts * weight
        stats = gateway.new_array(jvm.double, classes)
        for c, v in enumerate(counts.tolist()):
            stats[c] = v
        said, impurity, stats = float(counts.argmax()), float(_gini(counts)), gini(stats, int(node.counts.sum()))
        if node.split:
            (left, a), (right, b) = build(nodes, 2 * i), build(nodes, 2 * i + 1)
            if a is None or a != b:
                feature, last = node.split
                return inner(said, impurity, node.gain, left, right, split(feature, float(edges[feature][last])), stats), None
        return leaf(said, impurity, stats), said

    made = gateway.new_array(one, len(trees))
    for j, nodes in enumerate(trees):
        made[j] = one(build(nodes, 1)[0], k, classes)
    forest = ml.classification.RandomForestClassificationModel(made, k, classes)
    forest.set(forest.numTrees(), len(trees))
    return RandomForestClassificationModel(forest)
