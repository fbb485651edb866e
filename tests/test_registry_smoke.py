"""Every registered query without an oracle (model fits, sinks, seeded
draws) runs end to end through the registry at sf0.001 and yields rows."""

import pytest

from __spark_entry__ import oracle_sql, queries
from strata.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"
oracle_sql()  # loads the registry
NAMES = sorted(set(QUERIES) - set(oracle_sql()))


@pytest.mark.parametrize("name", NAMES)
def test_rows_only_query_runs(spark, name):
    df = queries()[name](spark, SF)
    rows = df.collect()
    assert len(rows) > 0
    assert len(df.columns) == len(set(df.columns))
