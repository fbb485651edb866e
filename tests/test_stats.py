import numpy as np
import pytest
from pyspark.sql import functions as F

from fixtures import passengers_df
from strata.operators import stats


def test_shares_of_totals(spark):
    p = passengers_df(spark)
    counts = stats.count_by_keys(p, ["pclass", "sex", "survived"], "passenger_id")
    out = stats.shares_of_totals(counts, "n", {"label": ["survived"], "sex": ["sex"]})
    got = {(r.pclass, r.sex, r.survived): (r.n, r.pct_label, r.pct_sex) for r in out.collect()}
    assert got == {
        (1, "female", 1): (2, 50.0, 50.0), (2, "female", 1): (1, 25.0, 25.0),
        (2, "male", 0): (1, 25.0, 25.0), (3, "female", 1): (1, 25.0, 25.0),
        (3, "male", 0): (3, 75.0, 75.0)}


def test_weighted_survival(spark):
    out = stats.weighted_rate(passengers_df(spark), "title", "survived").collect()
    got = {r.title: r.weighted_rate for r in out}
    assert got == pytest.approx({"Master": 0.0, "Miss": 12.5, "Mr": 0.0, "Mrs": 50.0,
                                 "the Countess": 12.5})


def test_pivot_mean_age(spark):
    out = stats.pivot_agg(passengers_df(spark), "survived", "pclass", [1, 2, 3], "mean", "age")
    got = {r.survived: (r["1"], r["2"], r["3"]) for r in out.collect()}
    assert got == {0: (None, 30.0, 12.0), 1: (38.0, 14.0, 26.0)}


def test_pivot_count_missing_cell_is_null(spark):
    out = stats.pivot_agg(passengers_df(spark), "survived", "pclass", [1, 2, 3], "count",
                          "passenger_id")
    got = {r.survived: (r["1"], r["2"], r["3"]) for r in out.collect()}
    assert got == {0: (None, 1, 3), 1: (2, 1, 1)}


def test_correlations(spark):
    out = stats.corr_pairs(passengers_df(spark), ["fare", "age"], with_col="survived").collect()
    got = {r.col_a: r.r for r in out}
    assert got["fare"] == pytest.approx(0.219161259, abs=1e-9)
    assert got["age"] == pytest.approx(0.346410162, abs=1e-9)


def test_corr_constant_column_is_null(spark):
    df = spark.range(10).select(F.col("id").cast("double").alias("x"), F.lit(1.0).alias("c"))
    out = stats.corr_pairs(df, ["x", "c"]).collect()
    assert out[0].r is None


def test_age_quartiles(spark):
    q = stats.quantiles(passengers_df(spark), [], "age", [0.25, 0.5, 0.75]).collect()[0]
    assert (q.q_25, q.q_50, q.q_75, q.n) == (16.0, 24.0, 29.0, 6)


def test_median_even_count(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "v double")
    assert stats.median_of(df, "v").collect()[0]["median"] == 2.5


@pytest.mark.parametrize("parts", [1, 7])
def test_quantiles_match_numpy(spark, parts):
    rng = np.random.default_rng(3)
    g = rng.integers(0, 4, 3000)
    g[:1000] = 0  # a hot group
    v = np.round(rng.gamma(2.0, 10.0, 3000), 2)
    v[rng.random(3000) < 0.3] = 12.5  # many ties
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(g, v)], "g int, v double") \
        .repartition(parts)
    probs = [0.1, 0.25, 0.5, 0.75, 0.9]
    got = {r.g: r for r in stats.quantiles(df, ["g"], "v", probs).collect()}
    for key in range(4):
        exp = np.quantile(v[g == key], probs)  # linear interpolation
        row = got[key]
        assert row.n == int((g == key).sum())
        for p, e in zip(probs, exp):
            assert row[f"q_{round(p * 100)}"] == pytest.approx(e, abs=1e-8)


def test_quantiles_approx_close(spark):
    df = spark.range(10000).select((F.col("id") % 100).cast("double").alias("v"))
    q = stats.quantiles(df, [], "v", [0.5], approx=True).collect()[0]
    assert abs(q.q_50 - 49.5) <= 1.0


def test_box_stats(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4, 5, 6, 7, 8, 100]], "v double")
    r = stats.box_stats(df, [], "v").collect()[0]
    assert (r.q1, r.median, r.q3) == (3.0, 5.0, 7.0)
    assert (r.whisker_low, r.whisker_high, r.n_outliers) == (1.0, 8.0, 1)


def test_mode_smallest_on_ties(spark):
    m = stats.mode_of(passengers_df(spark), "embarked").collect()[0]
    assert (m["mode"], m.mode_count) == ("C", 3)
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("a", "y"), ("b", None)], "k string, v string")
    got = {r.k: r["mode"] for r in stats.mode_of(df, "v", ["k"]).collect()}
    assert got == {"a": "y"}


def test_histogram_last_bin_closed(spark):
    df = spark.createDataFrame([(float(x),) for x in range(11)], "v double")
    got = {r.bin: r.n for r in stats.histogram(df, "v", 10).collect()}
    assert got == {i: (2 if i == 9 else 1) for i in range(10)}


def test_grouping_sets_equal_separate_groupbys(spark):
    p = passengers_df(spark)
    sets = [["title"], ["sex", "pclass"]]
    out = stats.grouping_sets_mean(p, sets, "survived").collect()
    by_title = {r.title: r.rate for r in out if r.grouping_set == "title"}
    flat = {r.title: r.rate for r in stats.grouped_mean(p, ["title"], "survived", "rate").collect()}
    assert by_title == flat
    assert len([r for r in out if r.grouping_set == "sex,pclass"]) == 5


def test_exact_mean_is_order_free(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (0.3,)] * 100, "v double")
    a = df.repartition(1).agg(stats.exact_mean("v")).first()[0]
    b = df.repartition(13).agg(stats.exact_mean("v")).first()[0]
    assert a == b == pytest.approx(0.2)


def test_pivot_totals_equal_flat_totals(spark):
    p = passengers_df(spark)
    piv = stats.pivot_agg(p, "survived", "pclass", [1, 2, 3], "count", "passenger_id").collect()
    flat = stats.count_by_keys(p, ["survived"], "passenger_id").collect()
    tot = {r.survived: sum(r[c] or 0 for c in ("1", "2", "3")) for r in piv}
    assert tot == {r.survived: r.n for r in flat}


def test_corr_matrix_equals_pairwise_on_complete_data(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, 4))
    x[:, 3] = 0.5 * x[:, 0] + rng.normal(size=500)
    df = spark.createDataFrame([tuple(map(float, r)) + (1.0,) for r in x], "a double, b double, c double, d double, k double")
    m = {(r.col_a, r.col_b): r.r for r in stats.corr_matrix(df, ["a", "b", "c", "d", "k"]).collect()}
    p = {(r.col_a, r.col_b): r.r for r in stats.corr_pairs(df, ["a", "b", "c", "d", "k"]).collect()}
    assert m.keys() == p.keys()
    for key in m:
        if p[key] is None:
            assert m[key] is None  # constant column
        else:
            assert m[key] == pytest.approx(p[key], abs=1e-9)


def test_nunique_exact_and_approx(spark):
    df = spark.range(200000).select((F.col("id") % 3).alias("g"), (F.col("id") % 50000).alias("v"))
    exact = {r.g: r.n_distinct for r in stats.nunique(df, ["g"], "v").collect()}
    approx = {r.g: r.n_distinct for r in stats.nunique(df, ["g"], "v", approx=True).collect()}
    assert exact == {0: 50000, 1: 50000, 2: 50000}
    assert all(abs(approx[g] - exact[g]) / exact[g] < 0.03 for g in exact)
    assert stats.nunique(df, [], "v").first().n_distinct == 50000


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", float("nan")), ("b", None)], "g string, v double")
    q = stats.median_of(df, "v").first()
    assert (q["median"], q.n) == (1.5, 2)
    assert {r.g: r.m for r in stats.grouped_mean(df, ["g"], "v", "m").collect()} == {"a": 1.5, "b": None}
    assert {r.g: r.n for r in stats.count_by_keys(df, ["g"], "v").collect()} == {"a": 2, "b": 0}
    assert sum(r.n for r in stats.histogram(df, "v", 2).collect()) == 2
    assert stats.nunique(df, [], "v").first().n_distinct == 2


def test_null_keys_leave_grouping_sets(spark):
    df = spark.createDataFrame([("a", "x", 1.0), (None, "x", 3.0), ("a", None, 5.0)], "g string, h string, v double")
    got = {(r.grouping_set, r.g, r.h): r.rate for r in stats.grouping_sets_mean(df, [["g"], ["g", "h"], ["h"]], "v").collect()}
    assert got == {("g", "a", None): 3.0, ("g,h", "a", "x"): 1.0, ("h", None, "x"): 2.0}


def test_small_values_are_not_rounded_away(spark):
    df = spark.createDataFrame([(i * 1e-11,) for i in range(1, 10)], "v double")
    assert stats.median_of(df, "v").first()["median"] == pytest.approx(5e-11, rel=1e-12)


def test_correlation_of_columns_of_very_different_scale(spark):
    df = spark.range(20).select(F.col("id").cast("double").alias("y"), (F.col("id") * 1e14).alias("t"))
    assert stats.corr_pairs(df, ["y", "t"]).first().r == pytest.approx(1.0, abs=1e-12)


def test_quantile_columns_have_names_of_their_own(spark):
    df = spark.range(1001).select(F.col("id").cast("double").alias("v"))
    q = stats.quantiles(df, [], "v", [0.001, 0.004, 0.025, 0.975]).first().asDict()
    assert q == {"n": 1001, "q_0_1": 1.0, "q_0_4": 4.0, "q_2_5": 25.0, "q_97_5": 975.0}


def test_pivot_finds_its_values_and_refuses_unlisted_ones(spark):
    df = spark.createDataFrame([("a", 1, 2.0), ("a", 9, 4.0), ("b", 9, None), ("b", None, 1.0)], "g string, k int, v double")
    found = stats.pivot_agg(df, "g", "k", None, "mean", "v")
    assert found.columns == ["g", "1", "9"] and {r.g: (r["1"], r["9"]) for r in found.collect()} == {"a": (2.0, 4.0), "b": (None, None)}
    with pytest.raises(Exception, match="not listed"):
        stats.pivot_agg(df, "g", "k", [1, 2], "mean", "v").collect()


def test_box_stats_scans_its_rows_once(spark):
    df = spark.createDataFrame([(g, float(v)) for g in "ab" for v in [1, 2, 3, 4, 5, 6, 7, 8, 100]], "g string, v double")
    box = stats.box_stats(df, ["g"], "v")
    assert "LocalTableScan" not in box._jdf.queryExecution().executedPlan().toString()  # only the checkpointed histogram
    assert {(r.g, r.n, r.median, r.whisker_high, r.n_outliers) for r in box.collect()} == {(g, 9, 5.0, 8.0, 1) for g in "ab"}
