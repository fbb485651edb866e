import pytest

from fixtures import SALES_EXPECTED, sales_df
from strata.operators.rollup import METRIC_COLUMNS, Periods, sales_rollup

SPEC = Periods()  # 2019H1 / 2018H1, as of 2019-09-09, unit 1
CODE = Periods(current=("2019-01-01", "2019-06-06"))


def _rows(df):
    return {(r["region"], r["country"]): tuple(r[c] for c in METRIC_COLUMNS) for r in df.collect()}


def _check(got, expected):
    assert set(got) == set(expected)
    for k, exp in expected.items():
        for g, e in zip(got[k], exp):
            if e is None:
                assert g is None, (k, got[k])
            else:
                assert g == pytest.approx(e, abs=1e-6), (k, got[k])


@pytest.mark.parametrize("how", ["two_level", "one_level"])
def test_fixture_spec_periods(spark, how):
    _check(_rows(sales_rollup(sales_df(spark), SPEC, how=how)), SALES_EXPECTED)


def test_fixture_code_period_end(spark):
    got = _rows(sales_rollup(sales_df(spark), CODE))
    ea = got[("E", "A")]
    idx = {c: i for i, c in enumerate(METRIC_COLUMNS)}
    assert ea[idx["rev_2019"]] == pytest.approx(3000)
    assert ea[idx["cost_2019"]] == pytest.approx(1300)
    assert ea[idx["cost_2019_exp"]] == pytest.approx(400)
    assert ea[idx["other_cost"]] == pytest.approx(900)
    assert ea[idx["profit_margin"]] == pytest.approx(86.666667, abs=1e-6)
    assert ea[idx["profit_margin_total_cost"]] == pytest.approx(56.666667, abs=1e-6)
    assert ea[idx["growth"]] == pytest.approx(-25)
    assert got[("E", "B")] == _rows(sales_rollup(sales_df(spark), SPEC))[("E", "B")]


def test_null_group_key_dropped(spark):
    got = _rows(sales_rollup(sales_df(spark), SPEC))
    assert all(k[0] is not None for k in got)


def test_layout_independent(spark):
    from strata.sources.tables import sales
    from strata.operators.rollup import DRIVER_PERIODS
    s = sales(spark, "/root/testdata/sf0.001")
    a = sorted(tuple(r) for r in sales_rollup(s.repartition(1), DRIVER_PERIODS).collect())
    b = sorted(tuple(r) for r in sales_rollup(s.repartition(16), DRIVER_PERIODS).collect())
    c = sorted(tuple(r) for r in sales_rollup(s, DRIVER_PERIODS, how="one_level").collect())
    assert a == b == c


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_two_level_plan_has_no_expand(spark):
    two = sales_rollup(sales_df(spark), SPEC)
    one = sales_rollup(sales_df(spark), SPEC, how="one_level")
    assert "Expand" not in _plan(two)
    assert "Expand" in _plan(one)


def test_no_python_in_rollup_plan(spark):
    from strata.sources.tables import sales
    from strata.operators.rollup import DRIVER_PERIODS
    p = _plan(sales_rollup(sales(spark, "/root/testdata/sf0.001"), DRIVER_PERIODS))
    assert "Python" not in p and "ArrowEval" not in p


def test_scan_is_pruned(spark):
    from strata.sources.tables import sales
    from strata.operators.rollup import DRIVER_PERIODS
    df = sales_rollup(sales(spark, "/root/testdata/sf0.001"), DRIVER_PERIODS)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # the lineitem scan reads only the seven columns the roll-up needs
    assert "l_shipdate" not in plan and "l_tax" not in plan and "l_comment" not in plan


def test_count_by_delivery_fixture(spark):
    from strata.operators.rollup import count_by_delivery
    rows = count_by_delivery(sales_df(spark), ("2019-01-01", "2019-06-06")).collect()
    by = {(r["customer_id"], r["delivery_type"]): r["fast_and_fastest"] for r in rows}
    assert by[(1, "fast")] == 1 and by[(1, "fastest")] == 1
    assert by[(5, "slow")] is None
    assert by[(7, "fast")] is None  # null region: no group


def test_hot_customer_and_group(spark):
    """A third of all rows on one customer of one group: both forms agree
    with a plain pandas computation of the specified metrics."""
    import datetime as dt

    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(9)
    n = 30000
    cust = rng.integers(1, 2000, n)
    cust[: n // 3] = 7  # hot customer
    region = np.where(cust == 7, "E", np.where(cust % 2 == 0, "E", "W"))
    country = np.where(cust == 7, "A", np.where(cust % 3 == 0, "A", "B"))
    days = rng.integers(0, 730, n)
    dates = [dt.datetime(2018, 1, 1) + dt.timedelta(days=int(d)) for d in days]
    pdf = pd.DataFrame({
        "region": region, "country": country, "customer_id": cust.astype("int64"),
        "date": dates, "delivery_type": rng.choice(["fast", "fastest", "slow", "normal"], n),
        "revenue": np.round(rng.uniform(1, 1000, n), 2), "cost": np.round(rng.uniform(1, 500, n), 2),
        "cost_type": rng.choice(["expert", "normal"], n), "duration": rng.choice(["30", "60"], n)})
    from fixtures import SALES_SCHEMA
    df = spark.createDataFrame(pdf[[f.name for f in SALES_SCHEMA.fields]], SALES_SCHEMA)
    two = {(r.region, r.country): r for r in sales_rollup(df, SPEC).collect()}
    one = {(r.region, r.country): r for r in sales_rollup(df, SPEC, how="one_level").collect()}
    assert two == one
    cur = (pdf.date >= "2019-01-01") & (pdf.date < "2019-07-01")
    for (reg, cty), g in pdf.groupby(["region", "country"]):
        c = g[cur.loc[g.index]]
        r = two[(reg, cty)]
        assert r.fast_and_fastest == c[c.delivery_type.isin(["fast", "fastest"])].customer_id.nunique()
        assert r.rev_2019 == pytest.approx(c.revenue.sum(), rel=1e-12)
        d60 = c[c.duration == "60"]
        assert r.rev_per_60 == pytest.approx(d60.revenue.sum() / d60.customer_id.nunique(), rel=1e-12)


def test_null_customer_counts_money_not_customers(spark):
    import datetime as dt

    from fixtures import SALES_SCHEMA
    extra = spark.createDataFrame(
        [("E", "A", None, dt.datetime(2019, 2, 1), "fast", 100.0, 10.0, "expert", "60")],
        SALES_SCHEMA)
    df = sales_df(spark).unionByName(extra)
    two = _rows(sales_rollup(df, SPEC))
    one = _rows(sales_rollup(df, SPEC, how="one_level"))
    assert two == one
    idx = {c: i for i, c in enumerate(METRIC_COLUMNS)}
    ea = two[("E", "A")]
    assert ea[idx["fast_and_fastest"]] == 1          # the null customer is no customer
    assert ea[idx["rev_2019"]] == pytest.approx(6100)  # but its money counts
    assert ea[idx["rev_per_60"]] == pytest.approx(3100)  # 3100 over one known customer


def test_all_metrics_match_pandas_spec(spark):
    """All twelve metrics against a direct pandas computation of the spec,
    on random rows with null keys and null customers."""
    import datetime as dt

    import numpy as np
    import pandas as pd

    from fixtures import SALES_SCHEMA
    rng = np.random.default_rng(21)
    n = 5000
    pdf = pd.DataFrame({
        "region": rng.choice(["E", "W", None], n, p=[0.5, 0.45, 0.05]),
        "country": rng.choice(["A", "B", "C"], n),
        "customer_id": np.where(rng.random(n) < 0.05, None, rng.integers(1, 300, n)),
        "date": [dt.datetime(2018, 1, 1) + dt.timedelta(days=int(d)) for d in rng.integers(0, 700, n)],
        "delivery_type": rng.choice(["fast", "fastest", "slow", "normal"], n),
        "revenue": np.round(rng.uniform(1, 1000, n), 2),
        "cost": np.round(rng.uniform(1, 500, n), 2),
        "cost_type": rng.choice(["expert", "normal"], n),
        "duration": rng.choice(["30", "60"], n),
    })
    rows = [tuple(None if (isinstance(v, float) and np.isnan(v)) else v for v in r)
            for r in pdf[[f.name for f in SALES_SCHEMA.fields]].itertuples(index=False)]
    rows = [r[:2] + ((None if r[2] is None else int(r[2])), r[3].to_pydatetime()) + r[4:]
            for r in rows]
    got = _rows(sales_rollup(spark.createDataFrame(rows, SALES_SCHEMA), SPEC))
    d = pdf.dropna(subset=["region", "country"])
    cur = (d.date >= "2019-01-01") & (d.date < "2019-07-01")
    prev = (d.date >= "2018-01-01") & (d.date < "2018-07-01")
    for (reg, cty), g in d.groupby(["region", "country"]):
        c, p_ = g[cur[g.index]], g[prev[g.index]]
        rev, rev_p, cost = c.revenue.sum(), p_.revenue.sum(), c.cost.sum()
        cexp = c[c.cost_type == "expert"].cost.sum()
        d60, d60e = c[c.duration == "60"], c[(c.duration == "60") & (c.cost_type == "expert")]
        exp = (
            (dt.datetime(2019, 9, 9) - g.date.max()).days,
            c[c.delivery_type.isin(["fast", "fastest"])].customer_id.nunique(),
            rev, rev_p, cost, cexp, cost - cexp,
            d60.revenue.sum() / d60.customer_id.nunique() if d60.customer_id.nunique() else None,
            (rev - cexp) / rev * 100 if rev else None,
            (rev - cost) / rev * 100 if rev else None,
            d60e.cost.sum() / d60e.customer_id.nunique() if d60e.customer_id.nunique() else None,
            (rev / rev_p - 1) * 100 if rev_p else None,
        )
        for a, e in zip(got[(reg, cty)], exp):
            assert (a is None) == (e is None)
            if e is not None:
                assert a == pytest.approx(e, rel=1e-9, abs=1e-9)
