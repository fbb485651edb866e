"""Every query with an oracle agrees with DuckDB (row count, column names,
values exactly, order-insensitive) at sf0.001, and its plan evaluates no
Python (everything stays in the JVM, inside whole-stage codegen)."""

import os

import pytest

os.environ.setdefault("STRICT", "1")

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from strata.plans.registry import ORACLE  # noqa: E402
from oracle_check import compare, duck  # noqa: E402

SF = "/root/testdata/sf0.001"
oracle_sql()  # loads the registry
NAMES = sorted(ORACLE)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "PythonMapInArrow",
                "FlatMapGroupsInPandas", "AggregateInPandas", "PythonUDF")


@pytest.mark.parametrize("name", NAMES)
def test_oracle(spark, con, name):
    df = queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(n in plan for n in PYTHON_NODES), f"Python in the plan of {name}"
    r = compare(spark, con, name, lambda s, d: df, oracle_sql()[name], SF)
    assert r["ok"], r
