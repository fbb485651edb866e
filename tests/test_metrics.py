import pytest
from pyspark.sql import functions as F

from fixtures import sales_df
from strata.operators.metrics import Derived, Metric, metric_rollup


def metrics():
    return [
        Metric("n_cust", "distinct", "customer_id"),
        Metric("n_fast", "distinct", "customer_id", F.col("delivery_type").isin("fast", "fastest")),
        Metric("n", "count"),
        Metric("rev", "money_sum", "revenue"),
        Metric("rev_60", "money_sum", "revenue", F.col("duration") == "60"),
        Metric("max_cost", "max", "cost"),
        Metric("min_cost", "min", "cost", F.col("cost_type") == "expert"),
        Metric("cost", "sum", "cost"),
    ]


DERIVED = [Derived("rev_per_cust", lambda m: F.try_divide(m["rev"].cast("double"),
                                                           m["n_cust"].cast("double")))]



def _rows(df):
    return {r.region: tuple(r)[1:] for r in df.collect()}


def test_two_level_equals_one_level(spark):
    df = sales_df(spark)
    two = metric_rollup(df, ["region"], metrics(), DERIVED)
    one = metric_rollup(df, ["region"], metrics(), DERIVED, how="one_level")
    assert _rows(two) == _rows(one)
    assert "Expand" not in two._jdf.queryExecution().executedPlan().toString()
    e = _rows(two)["E"]
    assert e[:3] == (5, 3, 6)           # customers 1-5; fast ones 1, 3, 4; six rows
    assert float(e[3]) == 11300.0       # revenue
    assert e[5:7] == (1200.0, 100.0)
    assert e[8] == pytest.approx(11300.0 / 5)


def test_global_rollup_and_bad_kind(spark):
    out = metric_rollup(sales_df(spark), [], metrics()[:3]).collect()[0]
    assert (out.n_cust, out.n) == (7, 8)   # null-region row kept: no keys
    with pytest.raises(ValueError):
        metric_rollup(sales_df(spark), ["region"], [Metric("x", "median", "cost")])


@pytest.mark.parametrize("how", ["auto", "one_level"])
def test_metric_rollup_matches_pandas(spark, how):
    import numpy as np
    import pandas as pd
    rng = np.random.default_rng(8)
    n = 4000
    ent = rng.integers(1, 400, n).astype(object)
    ent[rng.random(n) < 0.05] = None
    pdf = pd.DataFrame({"k": rng.choice(["a", "b", "c"], n), "e": ent,
                        "v": np.round(rng.uniform(0, 100, n), 2), "t": rng.choice(["x", "y"], n)})
    sdf = spark.createDataFrame([(r.k, None if r.e is None else int(r.e), float(r.v), r.t)
                                 for r in pdf.itertuples()], "k string, e long, v double, t string")
    ms = [Metric("n_e", "distinct", "e"), Metric("n_e_x", "distinct", "e", F.col("t") == "x"),
          Metric("n", "count"), Metric("s", "money_sum", "v"),
          Metric("s_x", "money_sum", "v", F.col("t") == "x"),
          Metric("mx", "max", "v", F.col("t") == "y"), Metric("mn", "min", "v")]
    got = {r.k: r for r in metric_rollup(sdf, ["k"], ms, how=how).collect()}
    for k, g in pdf.groupby("k"):
        r = got[k]
        assert r.n_e == g.e.nunique()
        assert r.n_e_x == g[g.t == "x"].e.nunique()
        assert r.n == len(g)
        assert float(r.s) == pytest.approx(g.v.sum(), abs=1e-6)
        assert float(r.s_x) == pytest.approx(g[g.t == "x"].v.sum(), abs=1e-6)
        assert r.mx == g[g.t == "y"].v.max() and r.mn == g.v.min()
