import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.operators import stats
from strata.operators.moments import corr_all, corr_label, eliminate_redundant, pair_moments


@pytest.fixture(scope="module")
def holes(spark):
    """Columns with nulls and NaN of their own, far from 0, equal and constant ones."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(800, 4)) + [0, 1e6, -50, 3]
    x[:, 3] = 0.9 * (x[:, 0]) + 0.1 * rng.normal(size=800)
    rows = []
    for i, r in enumerate(x):
        r = [None if rng.random() < 0.2 else float("nan") if rng.random() < 0.1 else float(v) for v in r]
        rows.append((*r, 7.0, None, int(i % 2)))
    return spark.createDataFrame(rows, "a double, b double, c double, d double, flat double, none double, y int")


def test_equal_to_corr_pairs(holes):
    cols = ["a", "b", "c", "d", "flat", "none", "y"]
    one = {(r["col_a"], r["col_b"]): r["r"] for r in stats.corr_pairs(holes, cols).collect()}
    for layout in (1, 7):
        got = {(r["col_a"], r["col_b"]): r["r"] for r in corr_all(holes.repartition(layout), cols).collect()}
        assert got.keys() == one.keys()
        for k in one:
            if "flat" in k or "none" in k:
                assert got[k] is None, k
            else:
                assert math.isclose(got[k], one[k], abs_tol=1e-6 if "b" in k else 1e-9), (k, got[k], one[k])  # b lies far from 0
    assert corr_label(holes, ["a", "none"], "y")["none"] is None


def test_counts_and_no_rows(spark, holes):
    n = pair_moments(holes, ["a", "b"])[0]
    both = holes.where("a IS NOT NULL AND NOT isnan(a) AND b IS NOT NULL AND NOT isnan(b)").count()
    assert n[0, 1] == n[1, 0] == both
    assert corr_all(holes.limit(0), ["a", "b"]).collect()[0]["r"] is None
    with pytest.raises(ValueError, match="infinite"):
        pair_moments(spark.createDataFrame([(float("inf"),), (1.0,)], "a double"), ["a"])


def test_one_exchange(holes):
    """27 columns: the state of a task is k x k numbers, shuffled once."""
    wide = holes.select(*[(F.col("a") * i + F.col("c")).alias(f"f{i}") for i in range(27)])
    seen = {}
    real = type(wide).collect

    def collect(self):
        seen["plan"] = self._jdf.queryExecution().executedPlan().toString()
        return real(self)

    type(wide).collect = collect
    try:
        pair_moments(wide, wide.columns)
    finally:
        type(wide).collect = real
    assert seen["plan"].count("Exchange hashpartitioning") == 1


def test_elimination(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=1000)
    x = {"a": base, "b": base + 0.1 * rng.normal(size=1000), "c": base + 0.5 * rng.normal(size=1000), "d": rng.normal(size=1000), "flat": np.ones(1000)}
    y = (base + 0.05 * rng.normal(size=1000) > 0).astype(int)
    df = spark.createDataFrame([(*map(float, r), int(l)) for r, l in zip(zip(*x.values()), y)], "a double, b double, c double, d double, flat double, y int")
    got = {r[0]: r[2:] for r in eliminate_redundant(df, list(x), "y", 0.8)}
    assert got == {"a": (True, None), "b": (False, "a"), "c": (False, "a"), "d": (True, None), "flat": (True, None)}
    assert [r[0] for r in eliminate_redundant(df, list(x), "y", 2.0) if not r[2]] == []
    twins = df.select("y", F.col("a").alias("z"), "a")
    assert [(r[0], r[2]) for r in eliminate_redundant(twins, ["z", "a"], "y", 0.99)] == [("a", True), ("z", False)]  # ties by name


def test_screen_is_one_pass_of_products(spark):
    """The screen's pairs come from the block products, not from three
    aggregates a pair, and are numpy's."""
    from strata.operators.features import screen_redundant

    rng = np.random.default_rng(4)
    x = rng.normal(size=(500, 3)) @ rng.normal(size=(3, 12))
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], ", ".join(f"f{i} double" for i in range(12)))
    found = screen_redundant(df, df.columns, 0.6)
    assert found.columns == ["col_a", "col_b", "r"] and "stddev_pop" not in found._jdf.queryExecution().toString()
    want = np.corrcoef(x.T)
    got = {(r["col_a"], r["col_b"]): r["r"] for r in found.collect()}
    assert got == {(f"f{i}", f"f{j}"): pytest.approx(want[i, j], abs=1e-9) for i in range(12) for j in range(i + 1, 12) if abs(want[i, j]) >= 0.6}


def test_rows_are_stored_before_tasks_stream_partitions(spark, holes, monkeypatch):
    """The tasks that stream several partitions read stored rows: what computes
    the rows (a join, sorts) runs in tasks of one partition each."""
    seen, real = [], type(holes).coalesce
    monkeypatch.setattr(type(holes), "coalesce", lambda self, n: seen.append(self._jdf.queryExecution().executedPlan().toString()) or real(self, n))
    pair_moments(holes.join(holes.select("a").distinct(), "a"), ["a", "b"])
    assert len(seen) == 1 and "InMemoryTableScan" in seen[0].split("InMemoryRelation")[0]
