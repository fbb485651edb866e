"""Exact resampling: totals, law and independence of the layout; partial sums
that do not grow with the partitions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.operators import evaluate as ev
from strata.operators.bootstrap import batched_logreg, bootstrap_logreg
from strata.operators.resample import drawn_blocks, leaf_bits, row_weights

B = 200


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(9)
    x = np.round(rng.normal(size=(3000, 2)), 2)
    x[:1000] = x[0]  # a third of all rows are equal
    y = (rng.random(3000) < 1 / (1 + np.exp(-x[:, 0]))).astype(int)
    return spark.createDataFrame([(i, int(l), float(a), float(b)) for i, (l, (a, b)) in enumerate(zip(y, x))], "id long, y int, a double, b double")


def weights(df, leaf=64, seed=5, replicates=B):
    """Weights of each distinct row, all replicates."""
    out = {}
    for r in drawn_blocks(df, "y", ["a", "b"], replicates, seed, leaf).collect():
        x, w = np.array(r["x"]).reshape(-1, 2), row_weights(r["leaf"], r["draws"], r["m"], seed)
        assert (w.sum(axis=0) == r["draws"]).all()
        for k in range(r["n_rows"]):
            out[r["y"][k], *x[k]] = (r["m"][k], w[k])
    return out


def test_every_replicate_has_n_draws(rows):
    for leaf in (64, 1 << 20):
        found = weights(rows, leaf)
        assert sum(m for m, _ in found.values()) == 3000
        assert (sum(w for _, w in found.values()) == 3000).all()
    assert leaf_bits(1) == leaf_bits(2048) == 0 and leaf_bits(2049) == 1 and leaf_bits(10**6, 64) == 14


def test_draws_do_not_depend_on_the_layout(rows):
    one, many = weights(rows.repartition(1)), weights(rows.orderBy(F.desc("b")).repartition(16))
    assert one.keys() == many.keys()
    assert all(one[k][0] == many[k][0] and (one[k][1] == many[k][1]).all() for k in one)
    assert any((weights(rows, seed=6)[k][1] != one[k][1]).any() for k in one)


def test_law_of_the_weights(rows):
    """Means, variances and covariances of a multinomial with n draws, and the
    law of the confusion cells that the four counts alone give."""
    found = list(weights(rows, replicates=2000).values())
    m, w = np.array([x[0] for x in found]), np.array([x[1] for x in found])
    p = m / 3000
    assert np.abs(w.mean(axis=1) - m).max() < 6 * np.sqrt(m.max() / 2000) + 0.15
    heavy = m.argmax()
    assert w[heavy].var() == pytest.approx(3000 * p[heavy] * (1 - p[heavy]), rel=0.12)
    half = np.arange(len(m)) % 2 == 0  # any set of rows: binomial
    share = p[half].sum()
    assert w[half].sum(axis=0).var() == pytest.approx(3000 * share * (1 - share), rel=0.12)
    single = m == 1
    assert w[single].var(axis=1).mean() == pytest.approx(1, rel=0.02)
    assert np.corrcoef(w[single].reshape(single.sum(), -1)[:2])[0, 1] == pytest.approx(0, abs=0.1)


def test_cells_against_the_cell_bootstrap(spark, rows):
    pred = rows.withColumn("prediction", (F.col("a") > 0).cast("int"))
    cells = ev.cell_bootstrap(pred, "y", replicates=1500, seed=2).toPandas()
    tp = np.zeros(1500)
    for (y, a, _), (_, w) in weights(rows, seed=3, replicates=1500).items():
        if y == 1 and a > 0:
            tp += w
    assert tp.mean() == pytest.approx(cells["tp"].mean(), abs=3) and tp.std() == pytest.approx(cells["tp"].std(), rel=0.1)


def test_empty_and_null_rows(spark):
    empty = spark.createDataFrame([], "y int, a double, b double")
    assert drawn_blocks(empty, "y", ["a", "b"], 3, 1).collect() == []
    one = spark.createDataFrame([(1, 0.5, None), (1, 0.5, None)], "y int, a double, b double")
    (block,) = drawn_blocks(one, "y", ["a", "b"], 3, 1).collect()
    assert block["m"] == [2] and block["draws"] == [2, 2, 2]


def test_refits_on_exact_draws(rows):
    """One replicate against a fit weighted by its draws; layouts agree."""
    from strata.operators import models as M

    beta, per_rep, converged = bootstrap_logreg(rows, ["a", "b"], "y", "id", replicates=8, C=0.7, balanced=False, seed=5, draws="exact")
    assert converged.all()
    again, _, _ = bootstrap_logreg(rows.repartition(13), ["a", "b"], "y", "id", replicates=8, C=0.7, balanced=False, seed=5, draws="exact")
    assert np.allclose(beta, again, atol=1e-7)
    cells = per_rep.toPandas()
    assert (cells[["tp", "fp", "fn", "tn"]].sum(axis=1) == 3000).all()
    w = weights(rows, leaf=2048, replicates=8)
    frame = rows.sparkSession.createDataFrame([(int(y), float(a), float(b), float(v[3])) for (y, a, b), (_, v) in w.items()], "y int, a double, b double, w double")
    lr = M.fit_logreg(frame.where("w > 0"), ["a", "b"], "y", C=0.7, weight="w", tol=1e-12)
    assert np.allclose(beta[3], [lr.intercept, *lr.coefficients.toArray()], atol=1e-5)


@pytest.mark.parametrize("draws", ["exact", "poisson"])
def test_partials_do_not_grow_with_the_partitions(spark, rows, draws, monkeypatch):
    """At 16 and at 256 partitions a pass has the same number of partials, no
    more than cores, and gives the same coefficients."""
    from strata.operators import bootstrap

    seen, reduce = [], bootstrap._reduce

    def counted(parts, models, width, tasks):
        parts = parts.persist()
        seen.append(parts.count() // models)
        return reduce(parts, models, width, tasks)

    monkeypatch.setattr(bootstrap, "_reduce", counted)
    betas = []
    for n in (16, 256):
        betas.append(batched_logreg(rows.repartition(n), ["a", "b"], "y", "id", [1.0] * 4, seed=3, draws=draws)[0])
    assert np.allclose(*betas, atol=1e-7)
    assert max(seen) <= spark.sparkContext.defaultParallelism
    spark.catalog.clearCache()


def test_two_levels_add_up(spark, rows, monkeypatch):
    from strata.operators import bootstrap

    plain = batched_logreg(rows.repartition(16), ["a", "b"], "y", "id", [1.0, 0.5], draws="poisson")[0]
    monkeypatch.setattr(bootstrap, "FAN_IN", 2)
    assert np.allclose(plain, batched_logreg(rows.repartition(16), ["a", "b"], "y", "id", [1.0, 0.5], draws="poisson")[0], atol=1e-9)


def test_weights_are_stored_as_drawn(spark):
    """passes read the weights that a leaf's draws are split into, those
    of rows that stand there very often too."""
    from strata.operators.resample import block_weights, leaf_weights, weighted_blocks

    rows = [(1, 0.5, 0.5)] * 900 + [(i % 2, float(i), 1.0) for i in range(300)]
    drawn = drawn_blocks(spark.createDataFrame(rows, "y int, a double, b double"), "y", ["a", "b"], 6, 4, 64)
    want = {r["leaf"]: leaf_weights(r["leaf"], r["draws"], r["m"], 4) for r in drawn.collect()}
    stored = weighted_blocks(drawn, 4).collect()
    got = {r["leaf"]: block_weights(r["w"], r["w_bytes"], 6, r["n_rows"]) for r in stored}
    assert len(want) > 1 and want.keys() == got.keys() and all((want[i] == got[i]).all() for i in want)
    assert {r["w_bytes"] for r in stored} == {1, 2} and sum(w.sum(axis=1) for w in got.values()).tolist() == [1200] * 6
