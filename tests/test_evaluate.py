import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.operators import evaluate as ev


def _pred(spark):
    # tp=3, fp=1, fn=2, tn=4
    rows = [(1, 1)] * 3 + [(0, 1)] + [(1, 0)] * 2 + [(0, 0)] * 4
    return spark.createDataFrame([(i, y, p) for i, (y, p) in enumerate(rows)],
                                 "id long, label int, prediction int")


def test_metrics(spark):
    r = ev.classification_metrics(_pred(spark)).collect()[0]
    assert (r.tp, r.fp, r.fn, r.tn) == (3, 1, 2, 4)
    assert r.accuracy == pytest.approx(0.7)
    assert r.precision == pytest.approx(0.75)
    assert r.recall == pytest.approx(0.6)
    assert r.f1 == pytest.approx(2 / 3)
    assert ev.accuracy_score(_pred(spark)).collect()[0].accuracy == pytest.approx(0.7)


def test_order_stat_interval(spark):
    scores = spark.range(1, 1001).select(F.lit("m").alias("model"), F.lit("acc").alias("metric"),
                                         F.col("id").cast("double").alias("score"))
    out = {r.level: (r.lo, r.hi) for r in
           ev.order_stat_interval(scores, ["model", "metric"], "score", 1000).collect()}
    assert out == {80: (101.0, 900.0), 90: (51.0, 950.0), 95: (26.0, 975.0)}


def test_poisson_thresholds_mean_one():
    t = ev.poisson_thresholds()
    u = np.linspace(0, 16 ** 8 - 1, 200001).astype(np.int64)
    w = sum((u >= int(x, 16)).astype(int) for x in t)
    assert w.mean() == pytest.approx(1.0, abs=1e-3)
    assert w.var() == pytest.approx(1.0, abs=5e-3)


def test_bootstrap_eval_deterministic_and_unbiased(spark):
    p = _pred(spark)
    a = sorted(tuple(r) for r in ev.bootstrap_eval(p, "id", replicates=400).collect())
    b = sorted(tuple(r) for r in ev.bootstrap_eval(p.repartition(3), "id", replicates=400).collect())
    assert a == b
    sizes = [r[1] + r[2] + r[3] + r[4] for r in a]
    assert np.mean(sizes) == pytest.approx(10, abs=0.5)


def test_cell_bootstrap(spark):
    reps = ev.cell_bootstrap(_pred(spark), replicates=300, seed=3).collect()
    assert len(reps) == 300
    assert all(r.tp + r.fp + r.fn + r.tn == 10 for r in reps)
    again = ev.cell_bootstrap(_pred(spark), replicates=300, seed=3).collect()
    assert sorted(map(tuple, reps)) == sorted(map(tuple, again))
    assert np.mean([r.accuracy for r in reps]) == pytest.approx(0.7, abs=0.03)


def test_poisson_and_multinomial_intervals_agree(spark):
    rng = np.random.default_rng(4)
    y = rng.integers(0, 2, 3000)
    p = np.where(rng.random(3000) < 0.7, y, 1 - y)
    pred = spark.createDataFrame([(i, int(a), int(b)) for i, (a, b) in enumerate(zip(y, p))],
                                 "id long, label int, prediction int")
    B = 1000
    iv = {}
    for name, per_rep in (("poisson", ev.bootstrap_eval(pred, "id", replicates=B)),
                          ("multinomial", ev.cell_bootstrap(pred, replicates=B))):
        s = ev.long_scores(per_rep, ("accuracy",), name)
        iv[name] = {r.level: (r.lo, r.hi) for r in
                    ev.order_stat_interval(s, ["model", "metric"], "score", B).collect()}
    for lvl in (80, 90, 95):
        assert iv["poisson"][lvl][0] == pytest.approx(iv["multinomial"][lvl][0], abs=0.006)
        assert iv["poisson"][lvl][1] == pytest.approx(iv["multinomial"][lvl][1], abs=0.006)
