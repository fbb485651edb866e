import numpy as np
import pytest

from strata.operators import models as M
from strata.operators.bootstrap import bootstrap_logreg, replicate_weights

N, K = 3000, 4
TRUE_B = np.array([0.5, 1.5, -2.0, 0.0, 0.8])


def planted(spark, n=N, seed=5):
    rng = np.random.default_rng(seed)
    X = rng.normal(size=(n, K))
    p = 1 / (1 + np.exp(-(TRUE_B[0] + X @ TRUE_B[1:])))
    y = (rng.random(n) < p).astype(int)
    rows = [(i, int(y[i]), *map(float, X[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, y int, " + ", ".join(f"x{j} double" for j in range(K)))
    return df, X, y


def newton_c_form(X, y, w, C):
    """argmin 0.5 ||b[1:]||^2 + C sum w_i logloss_i (intercept unpenalised)."""
    Z = np.column_stack([np.ones(len(y)), X])
    b = np.zeros(Z.shape[1])
    P = np.eye(Z.shape[1])
    P[0, 0] = 0
    for _ in range(100):
        p = 1 / (1 + np.exp(-(Z @ b)))
        g = C * Z.T @ (w * (y - p)) - P @ b
        H = C * (Z.T * (w * p * (1 - p))) @ Z + P
        step = np.linalg.solve(H, g)
        b += step
        if np.abs(step).max() < 1e-12:
            break
    return b


FEATS = [f"x{j}" for j in range(K)]


@pytest.mark.parametrize("C,balanced", [(1.0, False), (0.4, True)])
def test_logreg_matches_c_form(spark, C, balanced):
    df, X, y = planted(spark)
    m = M.fit_logreg(df, FEATS, "y", C=C, balanced=balanced, tol=1e-12, max_iter=500)
    if balanced:
        w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    else:
        w = np.ones(len(y))
    exp = newton_c_form(X, y, w, C)
    got = np.array([m.intercept, *m.coefficients.toArray()])
    assert got == pytest.approx(exp, abs=1e-4)


def test_logit_inference_matches_irls(spark):
    df, X, y = planted(spark)
    rows, extra = M.logit_inference(df, FEATS, "y", fit_intercept=False)
    b = np.zeros(K)
    for _ in range(50):
        p = 1 / (1 + np.exp(-(X @ b)))
        H = (X.T * (p * (1 - p))) @ X
        b += np.linalg.solve(H, X.T @ (y - p))
    se = np.sqrt(np.diag(np.linalg.inv(H)))
    got = {r[0]: r for r in rows}
    import math
    for j, f in enumerate(FEATS):
        assert got[f][1] == pytest.approx(b[j], abs=1e-6)
        assert got[f][2] == pytest.approx(se[j], rel=1e-4)
        z = b[j] / se[j]
        assert got[f][3] == pytest.approx(z, rel=1e-4)
        assert got[f][4] == pytest.approx(math.erfc(abs(z) / math.sqrt(2)), rel=1e-3, abs=1e-12)
    pr = 1 / (1 + np.exp(-(X @ b)))
    ll = float(np.sum(y * np.log(pr) + (1 - y) * np.log(1 - pr)))
    pbar = y.mean()
    ll0 = float(y.sum() * np.log(pbar) + (len(y) - y.sum()) * np.log(1 - pbar))
    assert extra["log_likelihood"] == pytest.approx(ll, rel=1e-6)
    assert extra["null_log_likelihood"] == pytest.approx(ll0, rel=1e-12)
    assert extra["pseudo_r2"] == pytest.approx(1 - ll / ll0, rel=1e-5)


def test_bootstrap_replicates_match_weighted_fits(spark):
    df, X, y = planted(spark, n=1200)
    B, seed, C = 8, 11, 1.0
    beta, per_rep, conv = bootstrap_logreg(df, FEATS, "y", "id", replicates=B, C=C, seed=seed)
    assert conv.all()
    W = replicate_weights(np.arange(len(y)), B, seed)
    for r in (0, 5):
        wr = W[:, r]
        n_r = wr.sum()
        n1 = wr[y == 1].sum()
        cw = np.where(y == 1, n_r / (2 * n1), n_r / (2 * (n_r - n1)))
        exp = newton_c_form(X, y, wr * cw, C)
        assert beta[r] == pytest.approx(exp, abs=1e-6)
    # one replicate through Spark ML with the same row weights
    wr = W[:, 0]
    n_r, n1 = wr.sum(), wr[y == 1].sum()
    cw = np.where(y == 1, n_r / (2 * n1), n_r / (2 * (n_r - n1)))
    wdf = spark.createDataFrame([(i, float(v)) for i, v in enumerate(wr * cw)], "id long, w double")
    m = M.fit_logreg(df.join(wdf, "id"), FEATS, "y", C=C, weight="w", tol=1e-12, max_iter=500)
    assert np.array([m.intercept, *m.coefficients.toArray()]) == pytest.approx(beta[0], abs=1e-4)
    reps = per_rep.collect()
    assert len(reps) == B and all(0.5 < r.accuracy < 1 for r in reps)


def test_tree_and_forest_planted_signal(spark):
    df, X, y = planted(spark)
    from strata.operators import evaluate as ev
    tree = M.fit_tree(df, FEATS, "y", depth=3)
    acc_t = ev.accuracy_score(M.predict(tree, df, FEATS, ["id", "y"]), "y").first()[0]
    forest = M.fit_forest(df, FEATS, "y", n_trees=30, depth=3)
    acc_f = ev.accuracy_score(M.predict(forest, df, FEATS, ["id", "y"]), "y").first()[0]
    assert acc_t > 0.7 and acc_f > 0.7
    for m in (tree, forest):
        imp = M.feature_importance(spark, m, FEATS).collect()
        assert sum(r.importance for r in imp) == pytest.approx(1.0)
        by = {r.feature: r.importance for r in imp}
        assert by["x1"] > by["x2"] and by["x0"] > by["x2"]  # x2 carries no signal


def test_grid_matches_separate_fits(spark):
    from strata.operators.bootstrap import grid_logreg
    df, X, y = planted(spark, n=1500)
    Cs = [1.0, 0.4, 0.05]
    beta, per_model, conv = grid_logreg(df, FEATS, "y", "id", Cs)
    assert conv.all()
    w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    for r, C in enumerate(Cs):
        assert beta[r] == pytest.approx(newton_c_form(X, y, w, C), abs=1e-7)
        m = M.fit_logreg(df, FEATS, "y", C=C, balanced=True, tol=1e-12, max_iter=500)
        assert np.array([m.intercept, *m.coefficients.toArray()]) == pytest.approx(beta[r], abs=1e-4)
    assert per_model.count() == 3


def test_cv_folds_match_separate_fits(spark):
    from pyspark.sql import functions as F

    from strata.operators.bootstrap import cv_logreg
    from strata.operators.split import fold_column
    df, X, y = planted(spark, n=1500)
    df = df.withColumn("fold", fold_column("id", 3))
    fold = np.array([r.fold for r in df.orderBy("id").select("fold").collect()])
    beta, per_fold, conv = cv_logreg(df, FEATS, "y", "id", "fold", 3, C=0.5)
    assert conv.all()
    for i in range(3):
        tr = fold != i
        yt = y[tr]
        w = np.where(yt == 1, len(yt) / (2 * yt.sum()), len(yt) / (2 * (len(yt) - yt.sum())))
        assert beta[i] == pytest.approx(newton_c_form(X[tr], yt, w, 0.5), abs=1e-7)
    rows = {r.rep: r for r in per_fold.collect()}
    for i in range(3):
        Z = np.column_stack([np.ones(len(y)), X])[fold == i]
        pred = (Z @ beta[i]) > 0
        assert rows[i].accuracy == pytest.approx(np.mean(pred == (y[fold == i] == 1)))
    assert sum(rows[i].tp + rows[i].fp + rows[i].fn + rows[i].tn for i in range(3)) == len(y)


def test_collinear_features_are_named(spark):
    import pytest

    from strata.operators import models as M
    df = spark.range(200).selectExpr("CAST(id % 7 AS DOUBLE) AS a", "CAST(id % 5 AS DOUBLE) AS b", "CAST(2 * (id % 7) AS DOUBLE) AS c",
                                     "CAST(0 AS DOUBLE) AS z", "CAST(id % 3 = 0 AS INT) AS y")
    with pytest.raises(ValueError, match="c, z"):
        M.logit_inference(df, ["a", "b", "c", "z"], "y")


def test_separable_data_say_whether_they_converged(spark):
    from strata.operators.bootstrap import grid_logreg
    df = spark.range(100).selectExpr("id", "CAST(id AS DOUBLE) / 100 AS x", "CAST(id >= 50 AS INT) AS y")
    _, metrics, converged = grid_logreg(df, ["x"], "y", "id", [1.0, 1e12], max_iter=12)
    rows = {r.rep: r.converged for r in metrics.collect()}
    assert rows == {0: bool(converged[0]), 1: bool(converged[1])} and rows[0] and not rows[1]


def test_batched_fits_leave_nothing_cached(spark):
    from strata.operators.bootstrap import grid_logreg
    spark.catalog.clearCache()
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    df = spark.range(100).selectExpr("id", "CAST(id % 9 AS DOUBLE) AS x", "CAST(id % 4 = 0 AS INT) AS y")
    grid_logreg(df, ["x"], "y", "id", [1.0, 0.5])[1].collect()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before
