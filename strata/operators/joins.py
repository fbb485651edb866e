"""Join helper.

``scalar`` turns a global one-value aggregate (a total, a fitted median)
into a scalar subquery: Spark evaluates it once and inlines the value into
the outer projection — no join, no cross product, nothing collected by us.

Joins carry no hints: Spark broadcasts a side by its size in bytes (the
estimate when it plans, the measured size at run time under AQE) and splits
the skewed partitions of the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def scalar(df: DataFrame, expr: Column) -> Column:
    """``(SELECT expr FROM df)`` as a Column; ``expr`` must be an aggregate."""
    return df.select(expr).scalar()
