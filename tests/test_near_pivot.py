"""Exact refits from the derivatives at the fit of all rows: the Newton fits'
coefficients and cells, in fewer passes over the draws."""

import numpy as np
import pandas as pd
import pytest

from strata.operators import bootstrap

B = 40


def frame(spark, n, k):
    rng = np.random.default_rng(3)
    x = np.round(rng.random((n, k)), 3)
    x[:, -1] = rng.random(n) < 0.03
    y = (rng.random(n) < 1 / (1 + np.exp(-(x[:, 0] - x[:, 1] + x[:, -1] - 0.4)))).astype(int)
    return spark.createDataFrame(pd.DataFrame({"id": range(n), "y": y, **{f"f{i}": x[:, i] for i in range(k)}})), [f"f{i}" for i in range(k)]


@pytest.mark.parametrize("n,k,balanced", [(30, 2, True), (400, 5, True), (20000, 5, False), (4000, 20, True)])
def test_same_as_newton_passes(spark, n, k, balanced, monkeypatch):
    rows, names = frame(spark, n, k)
    passes, reduce = [], bootstrap._reduce
    monkeypatch.setattr(bootstrap, "_reduce", lambda parts, models, *a: passes.append(models) or reduce(parts, models, *a))
    beta, per, converged = bootstrap.bootstrap_logreg(rows, names, "y", "id", replicates=B, balanced=balanced, draws="exact")
    few = passes.count(B)
    with monkeypatch.context() as m:
        m.setattr(bootstrap, "_near", lambda *a: (None, None, None))
        passes.clear()
        beta0, per0, converged0 = bootstrap.bootstrap_logreg(rows, names, "y", "id", replicates=B, balanced=balanced, draws="exact")
    assert (converged == converged0).all() and np.allclose(beta, beta0, atol=1e-7)
    assert sorted(map(tuple, per.collect())) == sorted(map(tuple, per0.collect()))
    if n == 20000:
        assert few <= 5 < passes.count(B)


def test_replicates_of_one_class(spark):
    """Draws that miss a class are left to the Newton passes."""
    rows = spark.createDataFrame([(i, int(i == 0), float(i)) for i in range(6)], "id long, y int, f double")
    _, per, _ = bootstrap.bootstrap_logreg(rows, ["f"], "y", "id", replicates=20, draws="exact")
    cells = per.toPandas()
    assert (cells[["tp", "fp", "fn", "tn"]].sum(axis=1) == 6).all() and (cells["tp"] + cells["fn"] == 0).any()


def test_models_share_their_draws(spark, monkeypatch):
    """C values on the same rows are refitted in the same passes, with the
    cells of each one alone."""
    rows, names = frame(spark, 3000, 4)
    alone = [bootstrap.bootstrap_logreg(rows, names, "y", "id", replicates=B, C=C, draws="exact")[1] for C in (1.0, 0.02)]
    passes, reduce = [], bootstrap._reduce
    monkeypatch.setattr(bootstrap, "_reduce", lambda parts, models, *a: passes.append(models) or reduce(parts, models, *a))
    together = bootstrap.bootstrap_logreg_grid(rows, names, "y", "id", (1.0, 0.02), replicates=B)
    assert passes.count(B) <= 1 and passes.count(2 * B) >= 1
    for one, other in zip(alone, together):
        assert sorted(map(tuple, one.collect())) == sorted(map(tuple, other.collect()))


def test_models_share_their_draws_in_newton_passes(spark, monkeypatch):
    rows, names = frame(spark, 200, 2)
    alone = [bootstrap.bootstrap_logreg(rows, names, "y", "id", replicates=B, C=C, draws="exact")[1] for C in (1.0, 0.02)]
    monkeypatch.setattr(bootstrap, "_near", lambda *a: (None, None, None))
    for one, other in zip(alone, bootstrap.bootstrap_logreg_grid(rows, names, "y", "id", (1.0, 0.02), replicates=B)):
        assert sorted(map(tuple, one.collect())) == sorted(map(tuple, other.collect()))
