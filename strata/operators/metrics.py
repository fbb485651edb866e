"""Many custom aggregations in one grouping pass.

A roll-up is a list of ``Metric``s — each an aggregate kind over a value
expression with its own optional filter — plus ``Derived`` columns computed
from the aggregated values (ratios, growth, differences).

Physical shape: when every ``distinct`` metric counts the same entity column
(customers, users, ...), the roll-up runs in two aggregation levels — per
(keys, entity), then per keys — so no ``Expand`` copies the rows once per
distinct aggregate, and both levels combine map-side (a hot entity or a hot
group stays cheap).  Otherwise it is a single aggregate.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.scalars import MONEY

KINDS = ("sum", "money_sum", "count", "distinct", "min", "max")


@dataclass(frozen=True)
class Metric:
    """``kind`` of ``expr`` over the rows where ``where`` holds.

    sum        sum of a numeric expression (NULL when no row qualifies)
    money_sum  exact DECIMAL(18,4) sum, 0 when no row qualifies
    count      number of qualifying rows (``expr`` unused)
    distinct   number of distinct non-null values of ``expr``
    min, max   extreme of ``expr``
    """
    name: str
    kind: str
    expr: Column | str | None = None
    where: Column | None = None

    def value(self) -> Column:
        e = F.col(self.expr) if isinstance(self.expr, str) else self.expr
        if self.kind == "count":
            e = F.lit(1)
        elif self.kind == "money_sum":
            e = e.cast(MONEY)
        return e if self.where is None else F.when(self.where, e)


@dataclass(frozen=True)
class Derived:
    """A column computed from the aggregated metrics by ``fn(cols)``, where
    ``cols`` maps metric names to their Columns."""
    name: str
    fn: Callable[[dict[str, Column]], Column]


def _one_level(m: Metric) -> Column:
    v = m.value()
    return {"sum": F.sum(v), "money_sum": F.coalesce(F.sum(v), F.lit(0).cast(MONEY)),
            "count": F.count(v), "distinct": F.count_distinct(v),
            "min": F.min(v), "max": F.max(v)}[m.kind].alias(m.name)


def metric_rollup(df: DataFrame, keys: Sequence[str], metrics: Sequence[Metric],
                  derived: Sequence[Derived] = (), drop_null_keys: bool = True,
                  how: str = "auto") -> DataFrame:
    """Group by ``keys`` and compute all ``metrics`` and ``derived`` columns.
    ``how``: ``auto`` (two-level when the distinct metrics share one entity
    column), ``one_level`` or ``two_level``."""
    keys = list(keys)
    for m in metrics:
        if m.kind not in KINDS:
            raise ValueError(f"{m.name}: unknown kind {m.kind!r}")
    base = df
    if drop_null_keys and keys:
        cond = F.lit(True)
        for k in keys:
            cond = cond & F.col(k).isNotNull()
        base = df.where(cond)
    entities = {str(m.expr) if not isinstance(m.expr, str) else m.expr
                for m in metrics if m.kind == "distinct"}
    entity = next(iter(entities)) if len(entities) == 1 else None
    two = (how == "two_level") or (how == "auto" and entity is not None
                                   and all(isinstance(m.expr, str) for m in metrics
                                           if m.kind == "distinct"))
    if how == "two_level" and entity is None:
        raise ValueError("two_level needs all distinct metrics on one entity column")
    grouped = base.groupBy(*keys) if keys else base
    if not two:
        agg = grouped.agg(*[_one_level(m) for m in metrics])
    else:
        lvl1, lvl2 = [], []
        for i, m in enumerate(metrics):
            c, v = f"_m{i}", m.value()
            if m.kind == "distinct":
                lvl1.append(F.max(F.when(v.isNotNull(), F.lit(1)).otherwise(F.lit(0))).alias(c))
                lvl2.append(F.sum(F.when(F.col(entity).isNotNull(), F.col(c))
                                  .otherwise(F.lit(0))).cast("bigint").alias(m.name))
            elif m.kind in ("sum", "money_sum", "count"):
                lvl1.append((F.count(v) if m.kind == "count" else F.sum(v)).alias(c))
                total = F.sum(F.col(c))
                if m.kind == "money_sum":
                    total = F.coalesce(total, F.lit(0).cast(MONEY))
                lvl2.append(total.alias(m.name))
            else:
                fn = F.min if m.kind == "min" else F.max
                lvl1.append(fn(v).alias(c))
                lvl2.append(fn(F.col(c)).alias(m.name))
        per_entity = base.groupBy(*keys, entity).agg(*lvl1)
        agg = (per_entity.groupBy(*keys) if keys else per_entity).agg(*lvl2)
    cols = {m.name: F.col(m.name) for m in metrics}
    out = agg.select(*keys, *[c.alias(n) for n, c in cols.items()],
                     *[d.fn(cols).alias(d.name) for d in derived])
    return out
