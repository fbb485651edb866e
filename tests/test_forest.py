"""Forests in chunks: a prefix is the smaller forest, votes are its chunks'."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from strata.operators.forest import chunk_seed, chunk_sizes, grow_forest

NAMES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    x = rng.random((600, 4))
    y = ((x[:, 0] > 0.6) ^ (x[:, 1] > 0.5)) | (rng.random(600) < 0.1)
    return spark.createDataFrame([(i, int(l), *map(float, r)) for i, (l, r) in enumerate(zip(y, x))], "id long, y int, a double, b double, c double, d double")


def test_chunks_end_at_sizes_and_multiples():
    assert chunk_sizes([250, 120], 100) == [100, 20, 80, 50] and chunk_sizes([7], 100) == [7]
    assert len({chunk_seed(s, t) for s in range(5) for t in range(0, 900, 100)}) == 45
    with pytest.raises(ValueError):
        chunk_sizes([])


def test_a_prefix_is_the_smaller_forest(rows):
    large = grow_forest(rows, NAMES, "y", [5, 12, 20], chunk=10)
    small = grow_forest(rows, NAMES, "y", [5, 12], chunk=10)
    assert large.n_trees == 20 and [m.getNumTrees for m in large.chunks] == [5, 5, 2, 8]
    assert [m.toDebugString.split("\n", 1)[1] for m in large.prefix(12).chunks] == [m.toDebugString.split("\n", 1)[1] for m in small.chunks]
    with pytest.raises(ValueError):
        large.prefix(11)
    with pytest.raises(ValueError):
        large.votes(rows, ["id"], [11])


def test_votes_are_the_sum_over_all_trees(rows):
    forest = grow_forest(rows, NAMES, "y", [5, 20], depth=4, chunk=6)
    got = {(r["n_trees"], r["id"]): (r["prediction"], r["p1"]) for r in forest.votes(rows, ["id", "y"], [5, 20]).collect()}
    assert len(got) == 1200
    data = VectorAssembler(inputCols=NAMES, outputCol="features").transform(rows)
    trees = [t for m in forest.chunks for t in m.trees]
    shares = np.zeros((600, 2))
    for n, tree in enumerate(trees, 1):
        out = tree.transform(data).select("id", vector_to_array("probability").alias("p")).orderBy("id").collect()
        shares += np.array([r["p"] for r in out])
        if n in (5, 20):
            for i in range(600):
                assert got[n, i][1] == pytest.approx(shares[i, 1] / n, abs=1e-9)
                assert got[n, i][0] == int(shares[i, 1] > shares[i, 0])


def test_planted_signal_and_importances(rows):
    forest = grow_forest(rows, NAMES, "y", [60], depth=5, chunk=25)
    p = forest.predict(rows, ["y"])
    assert p.where(F.col("y") == F.col("prediction")).count() > 480
    imp = forest.feature_importance()
    assert imp.sum() == pytest.approx(1) and set(np.argsort(imp)[2:]) == {0, 1}


def test_clashing_names(rows):
    frame = rows.withColumnsRenamed({"a": "features", "b": "label", "id": "prediction"})
    forest = grow_forest(frame.withColumnRenamed("features", "x0").withColumnRenamed("label", "x1"), ["x0", "x1", "c", "d"], "y", [3])
    out = forest.predict(frame.withColumnsRenamed({"features": "x0", "label": "x1", "prediction": "key"}), ["key", "y"])
    assert out.columns == ["key", "y", "prediction", "p1"] and out.count() == 600


def test_rows_are_dealt_over_the_cores(spark, rows, monkeypatch):
    """A scan of one partition would grow its trees on one core."""
    from strata.operators import forest as f

    assert f.partitions(10, 4) == 8 and f.partitions(10**8, 4) == 400
    seen, fit = [], f.RandomForestClassifier.fit
    monkeypatch.setattr(f.RandomForestClassifier, "fit", lambda self, d: seen.append(d.rdd.getNumPartitions()) or fit(self, d))
    grow_forest(rows.coalesce(1), NAMES, "y", [4], chunk=2)
    assert seen == [2 * spark.sparkContext.defaultParallelism] * 2
