import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.operators import sketches as S
from strata.operators import stats


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(6)
    values = np.concatenate([rng.lognormal(0, 2, 30_000), np.full(15_000, 1.5), rng.integers(0, 5, 15_000)])
    data = [("x" if i % 3 else "y", float(v), i % 4) for i, v in enumerate(rng.permutation(values))]
    data += [(None, 1.0, 0), ("x", None, 1), ("x", float("nan"), 2)] * 20
    return spark.createDataFrame(data, "key string, v double, part int")


def test_merged_distinct_counts(spark, rows, tmp_path):
    store = S.SketchStore(spark, str(tmp_path / "distinct"))
    for p in range(4):
        store.put(f"p{p}", S.distinct_sketches(rows.where(F.col("part") == p), ["key"], "v"))
    store.put("p1", S.distinct_sketches(rows.where(F.col("part") == 1), ["key"], "v"))  # put again: no difference
    merged = {r["key"]: r["n_distinct"] for r in S.distinct_estimates(S.merge_distinct(store.sketches(), ["key"]), ["key"]).collect()}
    direct = {r["key"]: r["n_distinct"] for r in S.distinct_estimates(S.distinct_sketches(rows, ["key"], "v"), ["key"]).collect()}
    exact = {r["key"]: r["n_distinct"] for r in stats.nunique(rows, ["key"], "v").collect()}
    assert merged.keys() == exact.keys() == {"x", "y"}
    for k in exact:
        assert abs(merged[k] - direct[k]) <= 0.01 * exact[k]
        assert abs(merged[k] - exact[k]) <= 3 * S.distinct_error() * exact[k]
    with pytest.raises(ValueError):
        store.put("a/b", rows)


def test_merged_quantiles_within_the_rank_error(spark, rows, tmp_path):
    store = S.SketchStore(spark, str(tmp_path / "quantiles"))
    for p in range(4):
        store.put(str(p), S.quantile_sketches(rows.where(F.col("part") == p), ["key"], "v"))
    merged = S.merge_quantiles(store.sketches(), ["key"])
    probs = {f"p{int(p * 1000)}": p for p in (0.001, 0.05, 0.25, 0.5, 0.75, 0.95, 0.999)}
    for r in S.sketched_quantiles(merged, ["key"], probs).collect():
        v = np.array([x["v"] for x in rows.where((F.col("key") == r["key"]) & F.col("v").isNotNull() & ~F.isnan("v")).select("v").collect()])
        assert r["n"] == len(v)
        for name, p in probs.items():  # a tied value has a range of ranks
            assert (v < r[name]).mean() - 0.006 <= p <= (v <= r[name]).mean() + 0.006


def test_box_numbers_near_the_exact_ones(rows):
    exact = {r["key"]: r for r in stats.box_stats(rows, ["key"], "v").collect()}
    for r in S.sketched_box_stats(S.quantile_sketches(rows, ["key"], "v"), ["key"]).collect():
        e = exact[r["key"]]
        assert r["n"] == e["n"] and abs(r["n_outliers"] - e["n_outliers"]) <= 0.02 * e["n"]
        for c in ("q1", "median", "q3"):
            assert r[c] == pytest.approx(e[c], rel=0.05)
        assert r["whisker_low"] <= e["whisker_low"] and r["whisker_high"] >= e["whisker_high"] * 0.9
    assert S.sketched_box_stats(S.quantile_sketches(rows.limit(0), ["key"], "v"), ["key"]).collect() == []
