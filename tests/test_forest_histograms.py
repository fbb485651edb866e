"""forests of many rows, grown in passes that serve all trees,
against brute force and against Spark ML's own trees."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from strata.operators import forest_histograms as h
from strata.operators.forest import ChunkedForest, grow_forest

NAMES = ["a", "b", "c", "d", "e"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    x = np.column_stack([rng.random((3000, 2)), rng.integers(0, 2, (3000, 2)), np.round(rng.random(3000), 1)])
    y = ((x[:, 0] > 0.6) ^ (x[:, 2] > 0.5)) | (rng.random(3000) < 0.1)
    return spark.createDataFrame([(i, int(l), *map(float, r)) for i, (l, r) in enumerate(zip(y, x))], "id long, y int, " + ", ".join(f"{n} double" for n in NAMES)).repartition(3)


def test_histograms_splits_and_counts_against_brute_force(rows):
    """Each node's counts are those of its rows by the weights of the tree, its
    split the best one of the features drawn for it."""
    trees, edges = h.grow(rows, NAMES, "y", 6, 3, 11, [1.0, 1.0], 3000, max_bins=32, block=500)
    doubles = rows.select(F.col("y").cast("double").alias("y"), *NAMES)
    blocks = h.binned_blocks(doubles, edges, 500).collect()
    assert len(blocks) == 6 and sum(b["n_rows"] for b in blocks) == 3000 and len({b["block"] for b in blocks}) == 6
    sizes, table, inner = [len(e) + 1 for e in edges], h._weight_table(), 0
    assert sizes[2:] == [2, 2, 11] and sizes[0] == sizes[1] and sizes[0] <= 32
    for t, nodes in enumerate(trees):
        w = np.concatenate([h.tree_weights(11, t, b["block"], b["n_rows"], table) for b in blocks])
        bins = np.concatenate([np.frombuffer(b["bins"], np.uint8).reshape(5, -1) for b in blocks], axis=1)
        y = np.concatenate([np.frombuffer(b["classes"], np.uint8) for b in blocks])
        of = {1: np.ones(3000, bool)}
        for i in sorted(nodes):
            assert nodes[i].counts.tolist() == [w[of[i] & (y == c)].sum() for c in (0, 1)]
            gains = {}
            for f in h.node_features(11, t, i, 5):
                for last in range(sizes[f] - 1):
                    side = [np.array([w[of[i] & s & (y == c)].sum() for c in (0, 1)], float) for s in (bins[f] <= last, bins[f] > last)]
                    if min(s.sum() for s in side) >= 1:
                        impurity = lambda s: 1 - ((s / s.sum()) ** 2).sum()
                        gains[f, last] = impurity(sum(side)) - sum(s.sum() * impurity(s) for s in side) / sum(side).sum()
            if i >= 8:
                assert nodes[i].split is None
            elif nodes[i].split:
                inner += 1
                assert nodes[i].gain == pytest.approx(max(gains.values())) and nodes[i].gain == pytest.approx(gains[nodes[i].split])
                f, last = nodes[i].split
                of[2 * i], of[2 * i + 1] = of[i] & (bins[f] <= last), of[i] & (bins[f] > last)
            else:
                assert max(gains.values(), default=0) <= 1e-12
    assert inner > 20


def test_the_law_of_spark_mls_trees(rows):
    """Importances, votes and accuracy of 200 trees grown either way."""
    together, apart = grow_forest(rows, NAMES, "y", [200], many_rows=1), grow_forest(rows, NAMES, "y", [200])
    assert [m.getNumTrees for m in together.chunks] == [100, 100] == [m.getNumTrees for m in apart.chunks]
    each = [np.array([t.featureImportances.toArray() for m in f.chunks for t in m.trees]) for f in (together, apart)]
    error = np.sqrt(sum(e.var(axis=0) for e in each) / 200)
    assert (np.abs(together.feature_importance() - apart.feature_importance()) < 4 * error + 0.002).all()
    p = [{r["id"]: r["p1"] for r in f.predict(rows, ["id"]).collect()} for f in (together, apart)]
    assert len(p[0]) == 3000 and max(abs(p[0][i] - p[1][i]) for i in p[0]) < 0.06
    roots = [np.mean([t._call_java("rootNode").split().featureIndex() == 0 for m in f.chunks for t in m.trees]) for f in (together, apart)]
    assert abs(roots[0] - roots[1]) < 0.2


def test_a_prefix_is_the_smaller_forest_and_models_walk_as_the_nodes(rows):
    large, small = grow_forest(rows, NAMES, "y", [5, 12, 20], chunk=10, many_rows=1), grow_forest(rows, NAMES, "y", [5, 12], chunk=10, many_rows=1)
    text = lambda f: [m.toDebugString.split("\n", 1)[1] for m in f.chunks]
    assert [m.getNumTrees for m in large.chunks] == [5, 5, 2, 8] and text(large.prefix(12)) == text(small)
    data = VectorAssembler(inputCols=NAMES, outputCol="features").transform(rows)
    tree = large.chunks[0].trees[0]
    assert tree.depth <= 3 and tree.transform(data).select("probability").distinct().count() <= tree.toDebugString.count("Predict")


def test_votes_of_walked_trees_are_the_models(rows):
    """To the last bit, for every size; merged leaves and depths alike."""
    for depth in (1, 3, 6):
        forest = grow_forest(rows, NAMES, "y", [5, 12, 20], depth=depth, chunk=10, many_rows=1)
        assert len(forest.walks) == len(forest.chunks) == 4
        slow = ChunkedForest(forest.chunks, forest.features)
        votes = [{(r["id"], r["n_trees"]): (r["y"], r["prediction"], r["p1"]) for r in f.votes(rows, ["id", "y"], [5, 20]).collect()} for f in (forest, slow)]
        assert len(votes[0]) == 6000 and votes[0] == votes[1]
        assert forest.votes(rows, ["id", "y"], [5, 20]).schema == slow.votes(rows, ["id", "y"], [5, 20]).schema
    assert forest.prefix(12).predict(rows, ["id"]).exceptAll(ChunkedForest(forest.chunks[:3], forest.features).predict(rows, ["id"])).count() == 0
    with pytest.raises(Exception, match="null or NaN"):
        forest.predict(rows.withColumn("a", F.lit(None).cast("double")), ["id"]).collect()


def test_vectors_are_grown_on_by_spark_ml(spark, rows):
    frame = VectorAssembler(inputCols=["a", "b"], outputCol="ab").transform(rows)
    forest = grow_forest(frame, ["ab", "c"], "y", [3], many_rows=1)
    assert not forest.walks and forest.predict(frame, ["id"]).count() == 3000


def test_weights_are_poisson_and_balanced_classes_weigh_alike(spark, rows):
    table = h._weight_table()
    w = np.concatenate([h.tree_weights(1, t, 5, 40_000, table) for t in range(50)]).astype(float)
    assert w.mean() == pytest.approx(1, abs=0.004) and w.var() == pytest.approx(1, abs=0.008) and (w == 0).mean() == pytest.approx(np.exp(-1), abs=0.002)
    assert (table == 255).sum() < 20 and w.max() < 12
    few = rows.where("y = 1 or id % 10 = 0")
    forest = grow_forest(few, NAMES, "y", [30], balanced=True, many_rows=1)
    stats = [t._call_java("rootNode").impurityStats().stats() for t in forest.chunks[0].trees]
    assert np.mean([s[0] / s[1] for s in stats]) == pytest.approx(1, abs=0.1)


def test_blocks_are_dealt_over_the_cores(spark, rows, monkeypatch):
    """Rows of one partition are grown on by all cores, in blocks of few rows."""
    seen, real, cores = [], h.histograms, spark.sparkContext.defaultParallelism
    monkeypatch.setattr(h, "histograms", lambda blocks, *a: seen.append([r["n"] for r in blocks.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]) or real(blocks, *a))
    wide = rows.crossJoin(spark.range(20).withColumnRenamed("id", "copy")).coalesce(1)
    h.grow(wide, NAMES, "y", 2, 1, 5, [1.0, 1.0], 60_000)
    (blocks,) = seen
    assert sum(blocks) == -(-60_000 // h.block_rows(60_000, cores)) >= 50 and len(blocks) >= min(cores, 16) and max(blocks) <= 2 + sum(blocks) // cores
    assert h.block_rows(10**9, 8) == h.BLOCK and h.block_rows(10, 8) == 1024


def test_candidate_splits():
    assert h.thresholds(np.array([1.0, 0.0, 1.0]), np.ones(3), 4).tolist() == [0.5] and h.thresholds(np.ones(3), np.ones(3), 4).tolist() == []
    assert h.thresholds(np.arange(1000.0), np.ones(1000), 4).tolist() == [249.5, 499.5, 749.5]
    assert h.shared([0, 1, 2, 3], [2, 256, 3, 300], 2) == [[3], [1, 0], [2]]


def test_rows_that_no_forest_takes(spark):
    few = spark.createDataFrame([(0, 1.0), (1, None), (1, 2.0)], "y int, a double")
    with pytest.raises(Exception, match="null or NaN"):
        grow_forest(few, ["a"], "y", [3], many_rows=1)
    with pytest.raises(ValueError, match="0 and 1"):
        grow_forest(few.withColumn("y", F.lit(2)), ["a"], "y", [3], many_rows=1)
    same = grow_forest(few.na.fill(1.0).withColumn("a", F.lit(1.0)), ["a"], "y", [3], many_rows=1)  # nothing to split on
    assert [t.numNodes for m in same.chunks for t in m.trees] == [1, 1, 1] and not same.feature_importance().any()
