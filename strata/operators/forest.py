"""Forests grown in chunks of seeded trees.

A forest of n trees is the union of its chunks, and a chunk depends on its own
seed and rows only: the forest of the first chunks *is* the smaller forest.  So
a sweep over sizes grows the largest forest once and scores every size in one
pass that keeps running votes, where separate fits would grow each size anew.
Chunks bound what a fit holds (Spark ML keeps a bootstrap weight for each row
and tree), and are independent jobs.

On ``MANY_ROWS`` rows and more the trees of all chunks grow together, by Spark
ML's algorithm on binned rows (``forest_histograms``), and become the same models.

A forest votes as Spark ML's does: the trees' class shares are added up.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.forest_histograms import grow, model, vote_sums, walks
from strata.operators.models import LABEL, WEIGHT, prepare

CHUNK = 100  # trees of a fit at most
JOBS = 2  # fits at once
MANY_ROWS = 250_000  # rows from which on all trees grow together (``forest_histograms``)
FIT_ROWS = 4_000_000  # rows from which on one fit of Spark ML fills the cores and the memory
PART_ROWS = 250_000  # rows of a partition at most, about


def partitions(rows: int, cores: int) -> int:
    """Partitions that a fit's rows are dealt to: two for each core, more where
    those would be large.  What a scan gives may be one for each file."""
    return max(2 * cores, -(-rows // PART_ROWS))


def chunk_seed(seed: int, first_tree: int) -> int:
    """Seed of the chunk that begins with a tree: no two chunks share one, and
    it does not depend on how many trees follow."""
    return int(np.random.SeedSequence([seed, first_tree]).generate_state(1, np.uint64)[0] >> np.uint64(1))


def chunk_sizes(sizes: Sequence[int], chunk: int = CHUNK) -> list[int]:
    """Trees of each chunk: a chunk ends at every multiple of ``chunk`` and at
    every size."""
    if not sizes or min(sizes) < 1:
        raise ValueError("a forest has at least one tree")
    ends = sorted({*sizes, *range(chunk, max(sizes), chunk)})
    return [b - a for a, b in zip([0, *ends], ends)]


@dataclass(frozen=True)
class ChunkedForest:
    chunks: tuple[RandomForestClassificationModel, ...]
    features: tuple[str, ...]
    walks: tuple[list, ...] = ()  # of trees grown together: each chunk's trees for ``vote_sums``

    @property
    def n_trees(self) -> int:
        return sum(m.getNumTrees for m in self.chunks)

    def prefix(self, n_trees: int) -> "ChunkedForest":
        """The forest of the first ``n_trees`` trees."""
        kept, n = [], 0
        for m in self.chunks:
            if n < n_trees:
                kept.append(m)
                n += m.getNumTrees
        if n != n_trees:
            raise ValueError(f"no chunk ends at {n_trees} trees")
        return ChunkedForest(tuple(kept), self.features, self.walks[:len(kept)])

    def feature_importance(self) -> np.ndarray:
        """Impurity importances: each tree's, summing to 1, averaged over the
        trees and scaled to sum to 1."""
        total = sum(m.featureImportances.toArray() * m.getNumTrees for m in self.chunks)
        return total / total.sum() if total.sum() else total

    def votes(self, df: DataFrame, keep: Sequence[str], sizes: Sequence[int]) -> DataFrame:
        """``keep`` columns, n_trees, prediction and p1 of each row and size:
        one pass over the rows, chunk after chunk, with the votes so far."""
        held = [f"_keep{i}" for i in range(len(keep))]
        ends = np.cumsum([m.getNumTrees for m in self.chunks]).tolist()
        found = [(n, i) for i, n in enumerate(ends) if n in sizes]
        if len(found) != len(set(sizes)):
            raise ValueError(f"chunks end at {[n for n, _ in found]} of the sizes {sorted(set(sizes))}")
        each = []
        if self.walks:
            rows = vote_sums(df, keep, self.features, list(self.walks), [i for _, i in found])
            each = [F.struct(F.lit(n).alias("n_trees"), F.col("_zero")[j].alias("zero"), F.col("_one")[j].alias("one")) for j, (n, _) in enumerate(found)]
        else:
            rows, zero, one = self._chunk_votes(df, keep, held), F.lit(0.0), F.lit(0.0)
            for i in range(len(self.chunks)):
                zero, one = zero + F.col(f"_v{i}")[0], one + F.col(f"_v{i}")[1]
                each += [F.struct(F.lit(n).alias("n_trees"), zero.alias("zero"), one.alias("one")) for n, k in found if k == i]
        rows = rows.select(*held, F.explode(F.array(*each)).alias("_x"))
        p1 = F.col("_x.one") / (F.col("_x.zero") + F.col("_x.one"))
        return rows.select(*[F.col(h).alias(c) for c, h in zip(keep, held)], F.col("_x.n_trees").alias("n_trees"),
                           (F.col("_x.one") > F.col("_x.zero")).cast("int").alias("prediction"), p1.alias("p1"))

    def _chunk_votes(self, df: DataFrame, keep: Sequence[str], held: Sequence[str]) -> DataFrame:
        """The ``keep`` columns as ``held`` and each chunk's votes, ``_v0`` .."""
        rows = VectorAssembler(inputCols=list(self.features), outputCol="_features", handleInvalid="error").transform(df)
        rows = rows.select(*[F.col(c).alias(h) for c, h in zip(keep, held)], "_features")
        for i, model in enumerate(self.chunks):
            model = model.copy({model.getParam("featuresCol"): "_features", model.getParam("rawPredictionCol"): f"_raw{i}",
                                model.getParam("probabilityCol"): "", model.getParam("predictionCol"): ""})
            rows = model.transform(rows)
        return rows.select(*held, *[vector_to_array(f"_raw{i}").alias(f"_v{i}") for i in range(len(self.chunks))])

    def predict(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        """``keep`` columns, prediction and p1 of the whole forest."""
        return self.votes(df, keep, [self.n_trees]).drop("n_trees")


def grow_forest(df: DataFrame, features: Sequence[str], label: str, sizes: Sequence[int], depth: int = 3, seed: int = 43,
                balanced: bool = False, max_bins: int = 256, chunk: int = CHUNK, jobs: int = JOBS, many_rows: int = MANY_ROWS) -> ChunkedForest:
    """The forest of max(sizes) trees whose chunks end at each of ``sizes``."""
    data, n_rows = prepare(df, features, label, balanced)
    plain = all(isinstance(df.schema[f].dataType, (T.NumericType, T.BooleanType)) for f in features)
    if n_rows >= many_rows and plain and max_bins <= 256:
        return _grow_together(df, data, features, label, chunk_sizes(sizes, chunk), depth, seed, balanced, max_bins, int(n_rows))
    data = data.select("features", LABEL, WEIGHT).repartition(partitions(int(n_rows), df.sparkSession.sparkContext.defaultParallelism))
    data = data.persist(StorageLevel.MEMORY_AND_DISK)  # read by every chunk
    jobs = 1 if n_rows >= FIT_ROWS else jobs  # a fit holds a weight for each row and tree of its chunk
    trees = chunk_sizes(sizes, chunk)
    firsts = [sum(trees[:i]) for i in range(len(trees))]

    def fit(first: int, n: int) -> RandomForestClassificationModel:
        return RandomForestClassifier(
            featuresCol="features", labelCol=LABEL, weightCol=WEIGHT, numTrees=n, maxDepth=depth, seed=chunk_seed(seed, first),
            featureSubsetStrategy="sqrt", subsamplingRate=1.0, bootstrap=True, impurity="gini", maxBins=max_bins).fit(data)

    try:
        data.count()
        with ThreadPoolExecutor(max_workers=max(1, jobs)) as pool:
            return ChunkedForest(tuple(pool.map(fit, firsts, trees)), tuple(features))
    finally:
        data.unpersist()


def _grow_together(df: DataFrame, data: DataFrame, features: Sequence[str], label: str, trees: list[int], depth: int, seed: int, balanced: bool, max_bins: int,
                   n_rows: int) -> ChunkedForest:
    """The same by passes over binned rows that serve all trees."""
    classes = data.groupBy(LABEL).agg(F.first(WEIGHT).alias("w")).collect()
    if any(r[LABEL] not in (0.0, 1.0) for r in classes):
        raise ValueError(f"labels of a forest are 0 and 1, not {sorted({str(r[LABEL]) for r in classes})}")
    weight = {r[LABEL]: r["w"] for r in classes}
    weight = [weight.get(0.0, 1.0), weight.get(1.0, 1.0)]
    grown, edges = grow(df, features, label, sum(trees), depth, seed, weight, n_rows, max_bins)
    firsts = [sum(trees[:i]) for i in range(len(trees))]
    chunks = [grown[a:a + n] for a, n in zip(firsts, trees)]
    return ChunkedForest(tuple(model(df.sparkSession, c, edges, weight) for c in chunks), tuple(features), tuple(walks(c, edges, weight) for c in chunks))
