import pytest
from pyspark.sql import functions as F

from fixtures import PASSENGER_EXPECTED, passengers_df
from strata.operators.features import FeaturePipeline, add_interactions, cut_edges


def test_fitted_state(spark):
    m = FeaturePipeline().fit(passengers_df(spark))
    assert m.family_edges == pytest.approx([-0.01, 10 / 3, 20 / 3, 10.0])
    assert m.sibling_edges == pytest.approx([-0.008, 4.0, 8.0])
    assert m.age_median == 24.0
    assert m.port_mode == "C"
    assert m.categories["level_cabin"] == ["B", "C", "F", "No Cabin"]
    assert m.categories["fam_size"] == ["large_fam", "medium_fam", "small_fam"]


def test_rows_match_fixture(spark):
    p = passengers_df(spark)
    m = FeaturePipeline().fit(p)
    feats = {r.passenger_id: r for r in m.transform(p).collect()}
    derived = {r.passenger_id: r for r in m.binned(p).collect()}
    for pid, (title, fam, cabin, fsize, sib, age_s, fare_s, port) in PASSENGER_EXPECTED.items():
        d, f = derived[pid], feats[pid]
        assert (d.title, d.family_size, d.level_cabin, d.fam_size, d.sib_sp_num) == \
            (title, fam, cabin, fsize, sib)
        assert f.age == pytest.approx(age_s, abs=1e-6)
        assert f.fare == pytest.approx(fare_s, abs=1e-6)
        assert f[f"embarked_{port}"] == 1.0


def test_one_hot_rows_sum_to_one(spark):
    p = passengers_df(spark)
    m = FeaturePipeline().fit(p)
    t = m.transform(p)
    for name in ("fam_size", "sib_sp_num", "sex", "pclass", "level_cabin", "embarked"):
        cols = [c for c in t.columns if c.startswith(name + "_")]
        sums = t.select(sum(F.col(c) for c in cols).alias("s")).collect()
        assert all(r.s == 1.0 for r in sums), name


def test_unseen_category_raises_or_ignored(spark):
    p = passengers_df(spark)
    m = FeaturePipeline().fit(p)
    other = p.withColumn("sex", F.lit("unknown"))
    with pytest.raises(Exception):
        m.transform(other).collect()
    m.handle_unknown = "ignore"
    rows = m.transform(other).select("sex_female", "sex_male").collect()
    assert all(r.sex_female == 0.0 and r.sex_male == 0.0 for r in rows)


def test_fitted_state_reused_on_other_rows(spark):
    p = passengers_df(spark)
    m = FeaturePipeline().fit(p)
    # a value outside the fitted range is clamped into the end bin, not refitted
    extra = p.where(F.col("passenger_id") == 5).withColumn("parch", F.lit(20))
    r = m.binned(extra).collect()[0]
    assert r.fam_size == "large_fam"
    scaled = m.transform(extra).collect()[0]
    assert scaled.age == pytest.approx(22 / 36)


def test_constant_column_edges():
    e = cut_edges(5.0, 5.0, 2)
    assert e[0] < 5.0 < e[-1]


def test_interactions(spark):
    p = passengers_df(spark)
    t = add_interactions(FeaturePipeline().fit(p).transform(p))
    r = {x.passenger_id: x for x in t.collect()}
    assert r[2].fem_family == 1.0 and r[1].fem_family == 0.0
    assert r[2].female_age == pytest.approx(1.0)
    assert r[8].fare_family == pytest.approx(r[8].fare)


@pytest.mark.parametrize("seed,bins,kind", [(1, 3, "int"), (2, 2, "int"), (3, 4, "float"),
                                            (4, 3, "const"), (5, 5, "float")])
def test_cut_matches_pandas_cut(spark, seed, bins, kind):
    import numpy as np
    import pandas as pd

    from strata.operators.features import cut_column
    rng = np.random.default_rng(seed)
    if kind == "int":
        x = rng.integers(0, 11, 400).astype(float)
    elif kind == "const":
        x = np.full(50, 7.0)
    else:
        x = np.round(rng.normal(10, 3, 400), 3)
    labels = [f"b{i}" for i in range(bins)]
    exp, edges = pd.cut(x, bins=bins, labels=labels, retbins=True)
    got_edges = cut_edges(float(x.min()), float(x.max()), bins)
    assert got_edges == pytest.approx(list(edges), rel=1e-12, abs=1e-12)
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(x)], "i int, x double")
    out = df.select("i", cut_column(F.col("x"), got_edges, labels).alias("b")).orderBy("i")
    assert [r.b for r in out.collect()] == [str(v) for v in exp]


def test_categories_that_fold_alike_keep_a_column_each(spark):
    from strata.operators.features import FeatureSpec
    values = ["A-B", "A B", "é", "中", "plain"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string")
    m = FeaturePipeline(FeatureSpec(steps=(("one_hot", ("c",)),))).fit(df)  # a spec without a numeric step
    assert len(set(m.feature_names)) == 5 and "c_plain" in m.feature_names
    rows = m.transform(df, ("i",)).collect()
    assert all(sum(r[n] for n in m.feature_names) == 1.0 for r in rows)


def test_many_categories(spark):
    from strata.operators.features import FeatureSpec
    df = spark.range(1001).select(F.col("id").cast("string").alias("c"))
    wide = FeaturePipeline(FeatureSpec(steps=(("one_hot", ("c",)),))).fit(df)
    assert len(wide.feature_names) == 1001
    m = FeaturePipeline(FeatureSpec(steps=(("one_hot_vector", ("c",)),))).fit(df)
    assert m.feature_names == ["c_vec"]
    seen = {tuple(r.c_vec.indices) for r in m.transform(df, ()).collect()}
    assert len(seen) == 1001 and all(len(x) == 1 for x in seen)
    with pytest.raises(Exception):
        m.transform(df.select(F.lit("other").alias("c")), ()).collect()


def test_missing_features_are_named(spark):
    from strata.operators.features import SUBSET_17, present, screen_redundant, with_known_levels
    feats = FeaturePipeline().fit(passengers_df(spark)).transform(passengers_df(spark))
    with pytest.raises(ValueError, match="sex_female"):
        add_interactions(feats.drop("sex_female"))
    full = add_interactions(feats)
    found, absent = present(full, SUBSET_17)
    assert "level_cabin_D" in absent and "age" in found
    assert set(found) | set(absent) == set(SUBSET_17)
    known = with_known_levels(full)
    assert known.agg(F.sum("level_cabin_D")).first()[0] == 0.0
    pairs = {(r.col_a, r.col_b) for r in screen_redundant(full, ["sex_female", "sex_male", "age"], 0.99).collect()}
    assert pairs == {("sex_female", "sex_male")}


def test_nan_does_not_reach_the_fitted_constants(spark):
    p = passengers_df(spark)
    with_nan = p.withColumn("fare", F.when(F.col("passenger_id") == 1, F.lit(float("nan"))).otherwise(F.col("fare")))
    lo, hi = FeaturePipeline().fit(with_nan).ranges["fare"]
    assert lo == lo and hi == hi and hi < 1e6
