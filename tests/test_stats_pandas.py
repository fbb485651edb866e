"""Grouped statistics against pandas on a random frame with nulls."""

import numpy as np
import pandas as pd
import pytest

from strata.operators import stats


@pytest.fixture(scope="module")
def frames(spark):
    rng = np.random.default_rng(11)
    n = 2000
    pdf = pd.DataFrame({
        "g": rng.choice(["a", "b", "c"], n, p=[0.6, 0.3, 0.1]),
        "h": rng.integers(1, 4, n),
        "x": np.where(rng.random(n) < 0.15, np.nan, np.round(rng.normal(30, 12, n), 1)),
        "y": np.round(rng.gamma(2.0, 20.0, n), 2),
        "c": rng.choice(["S", "C", "Q", None], n, p=[0.5, 0.3, 0.15, 0.05]),
    })
    sdf = spark.createDataFrame(
        [(r.g, int(r.h), None if np.isnan(r.x) else float(r.x), float(r.y), r.c)
         for r in pdf.itertuples()], "g string, h int, x double, y double, c string")
    return pdf, sdf


def test_means_and_counts(frames):
    pdf, sdf = frames
    got = {(r.g, r.h): r.m for r in stats.grouped_mean(sdf, ["g", "h"], "x", "m").collect()}
    exp = pdf.groupby(["g", "h"])["x"].mean().to_dict()
    assert got.keys() == exp.keys()
    for k in exp:
        assert got[k] == pytest.approx(exp[k], rel=1e-12)
    cnt = {r.g: r.n for r in stats.count_by_keys(sdf, ["g"], "x").collect()}
    assert cnt == pdf.groupby("g")["x"].count().to_dict()


def test_modes(frames):
    pdf, sdf = frames
    got = {r.g: r["mode"] for r in stats.mode_of(sdf, "c", ["g"]).collect()}
    exp = {g: s.mode().sort_values().iloc[0] for g, s in pdf.groupby("g")["c"]}
    assert got == exp


def test_quantiles(frames):
    pdf, sdf = frames
    probs = [0.25, 0.5, 0.75, 0.9]
    got = {r.g: r for r in stats.quantiles(sdf, ["g"], "y", probs).collect()}
    for g, s in pdf.groupby("g")["y"]:
        for p in probs:
            assert got[g][f"q_{round(p * 100)}"] == pytest.approx(s.quantile(p), abs=1e-8)


def test_pivot_mean(frames):
    pdf, sdf = frames
    got = {r.g: (r["1"], r["2"], r["3"]) for r in
           stats.pivot_agg(sdf, "g", "h", [1, 2, 3], "mean", "y").collect()}
    exp = pdf.groupby(["g", "h"])["y"].mean().unstack()
    for g in exp.index:
        assert got[g] == pytest.approx(tuple(exp.loc[g, [1, 2, 3]]), rel=1e-12)


def test_pairwise_correlation(frames):
    pdf, sdf = frames
    pdf = pdf.assign(h=pdf.h.astype(float))
    got = {(r.col_a, r.col_b): r.r for r in stats.corr_pairs(sdf, ["h", "x", "y"]).collect()}
    exp = pdf[["h", "x", "y"]].corr()  # pairwise-complete, like ours
    for (a, b), r in got.items():
        assert r == pytest.approx(exp.loc[a, b], abs=1e-9)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_histogram_matches_numpy(spark, seed):
    rng = np.random.default_rng(seed)
    x = np.concatenate([np.round(rng.normal(50, 15, 3000), 2), np.arange(0, 101, 10.0)])
    df = spark.createDataFrame([(float(v),) for v in x], "v double")
    got = {r.bin: r.n for r in stats.histogram(df, "v", 10).collect()}
    counts, _ = np.histogram(x, bins=10)
    assert [got.get(i, 0) for i in range(10)] == list(counts)


def test_shares_and_weighted_rate(frames):
    pdf, sdf = frames
    counts = stats.count_by_keys(sdf, ["g", "h"], "y")
    got = {(r.g, r.h): r.pct_g for r in
           stats.shares_of_totals(counts, "n", {"g": ["g"]}).collect()}
    c = pdf.groupby(["g", "h"])["y"].count()
    exp = (c / c.groupby(level="g").transform("sum") * 100).to_dict()
    assert got.keys() == exp.keys()
    for k in exp:
        assert got[k] == pytest.approx(exp[k], rel=1e-12)
    pdf2 = pdf.assign(lab=(pdf.y > 40).astype(int))
    sdf2 = sdf.withColumn("lab", (sdf.y > 40).cast("int"))
    w = {r.g: r.weighted_rate for r in stats.weighted_rate(sdf2, "g", "lab").collect()}
    total = pdf2.lab.count()
    for g, s in pdf2.groupby("g")["lab"]:
        assert w[g] == pytest.approx((s * s.count() / total * 100).sum(), rel=1e-12)
