"""Fits read stored rows, one scan gives the labelled rows, and the Poisson
bootstrap adds four weights a row and block."""

import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from strata.operators import evaluate as ev


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    d, rng, n = str(tmp_path_factory.mktemp("tables")), np.random.default_rng(5), 700
    ok = [None, 3, 3, *range(10, n + 7)]  # a null key and one that comes twice
    orders = pd.DataFrame({"o_orderkey": pd.array(ok, "Int64"), "o_custkey": rng.integers(0, 60, n), "o_orderstatus": rng.choice(["F", "O"], n),
                           "o_totalprice": np.round(rng.random(n) * 1000, 2), "o_orderpriority": rng.choice(["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"], n)})
    cust = pd.DataFrame({"c_custkey": range(60), "c_name": [f"C{i}" for i in range(60)], "c_nationkey": [i % 3 for i in range(60)],
                         "c_mktsegment": [["AUTO", "BUILD", "FURN", "HOUSE", "MACH"][i % 5] for i in range(60)]})
    nation = pd.DataFrame({"n_nationkey": range(3), "n_name": ["A", "B", "C"]})
    for name, t in (("orders", orders), ("customer", cust), ("nation", nation)):
        t.to_parquet(f"{d}/{name}.parquet")
    return d


def test_labelled_rows_in_one_scan(spark, tables):
    from strata.plans import model_queries as q

    one = q.labelled_rows(spark, tables)
    both = q.train_rows(spark, tables).unionByName(q.held_out_and_scoring(spark, tables)[0])
    assert sorted(map(str, one.select(both.columns).collect())) == sorted(map(str, both.collect()))
    assert "Union" not in one._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["write_predictions_full", "heldout_interval_logreg"])
def test_fits_read_stored_rows(spark, tables, name, monkeypatch):
    from strata.plans import model_queries as q
    from strata.plans.registry import QUERIES

    seen, fit = [], q.M.fit_logreg
    monkeypatch.setattr(q.M, "fit_logreg", lambda df, *a, **kw: seen.append(df._jdf.queryExecution().withCachedData().toString()) or fit(df, *a, **kw))
    rows = QUERIES[name](spark, tables).collect()
    assert len(rows) > 0 and len(seen) == 1 and "Join" not in seen[0].split("InMemoryRelation")[0] and "InMemoryRelation" in seen[0]


def test_weights_of_draws(spark):
    cuts = ev.poisson_thresholds()
    draws = sorted({"00000000", "ffffffff", *cuts, *[format(int(t, 16) - 1, "08x") for t in cuts]})
    got = {r["h"]: r["w"] for r in spark.createDataFrame([(h,) for h in draws], "h string").select("h", ev._weight_from_hex(F.col("h")).alias("w")).collect()}
    assert got == {h: sum(h >= t for t in cuts) for h in draws}


def test_cells_from_few_groups(spark):
    rows = [(i, i % 2 if i % 11 else None, int(i % 3 == 0), int(i % 5 == 0) if i % 7 else None) for i in range(90)]
    df = spark.createDataFrame(rows, "k long, y int, a int, b int")
    out = ev.bootstrap_eval_many(df, "k", "y", ["a", "b"], replicates=10)
    keys = re.findall(r"Aggregate \[([^\]]*)\]", out._jdf.queryExecution().optimizedPlan().toString())
    assert any("_y" in k for k in keys)
    w = {(r["k"], r["rep"]): r["w"] for r in df.crossJoin(spark.range(10).withColumnRenamed("id", "rep")).select("k", "rep", ev.poisson_weight(7, F.col("rep"), F.col("k")).alias("w")).collect()}
    got = {(r["model"], r["rep"]): (r["tp"], r["fp"], r["fn"], r["tn"]) for r in out.collect()}
    assert len(got) == 20
    for (model, rep), cells in got.items():
        at = lambda p, y: sum(w[r[0], rep] for r in rows if r[1] == y and r[2 + "ab".index(model)] == p)  # noqa: E731, B023
        assert cells == (at(1, 1), at(1, 0), at(0, 1), at(0, 0))
