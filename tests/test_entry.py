from __spark_entry__ import entry, oracle_sql, queries


def test_entry_runs(spark):
    df = entry(spark)
    rows = df.collect()
    assert len(rows) == 25
    assert df.columns[:3] == ["region", "country", "recency"]


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())
    assert len(oracle_sql()) >= 75
