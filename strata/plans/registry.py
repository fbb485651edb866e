"""Registry of named queries and their DuckDB oracle SQL.

Each query is ``fn(spark, sf_dir) -> DataFrame`` over the driver tables.
The oracle is an independent SQL statement over the same tables (views
named like the parquet files); queries whose semantics SQL cannot state
(model fitting) register no oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn`` under ``name``; ``sql`` is its oracle (or None)."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def rounded(df: DataFrame, *cols: str, decimals: int = 9) -> DataFrame:
    """Order-dependent floating results at the precision that the comparison
    with another engine uses; operators themselves do not round."""
    from pyspark.sql import functions as F
    return df.withColumns({c: F.round(c, decimals) for c in cols})


def load_all() -> None:
    """Import every plan module so that all queries are registered."""
    from strata.plans import (  # noqa: F401
        doc_queries, eda_queries, feature_queries, model_queries, sales_queries,
    )
