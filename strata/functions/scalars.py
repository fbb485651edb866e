"""Column-level helpers.  All are built-in Spark expressions (codegen, no UDF).

Contract for undefined arithmetic: a ratio with a zero or null denominator
is NULL (pandas would give inf/NaN; Spark's ANSI mode would raise).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The title sits between ", " and the next "." of a name;
# an empty or missing cabin letter becomes "No Cabin".
TITLE_SEPARATOR = ", "
TITLE_END = "."
NO_CABIN = "No Cabin"

# Money is summed as DECIMAL(18,4): exact and independent of task order, so
# any two runs (or engines) agree to the last digit.
MONEY = "decimal(18,4)"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def date_literal(s: str) -> Column:
    """``strptime("%Y-%m-%d")`` as a typed DATE literal."""
    return F.lit(_dt.date.fromisoformat(s))


def extract_title(name) -> Column:
    """Text between ", " and the next "."; NULL when either is missing."""
    after = F.split_part(_c(name), F.lit(TITLE_SEPARATOR), F.lit(2))
    return F.nullif(F.split_part(after, F.lit(TITLE_END), F.lit(1)), F.lit(""))


def cabin_level(cabin) -> Column:
    """First character of the cabin, or ``No Cabin`` when null/empty."""
    return F.coalesce(F.nullif(F.substring(_c(cabin), 1, 1), F.lit("")), F.lit(NO_CABIN))


def safe_ratio(num, den) -> Column:
    """num / den as DOUBLE, NULL when den is 0 or null."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def percent_of(part, total) -> Column:
    return safe_ratio(part, total) * F.lit(100.0)


def pct_growth(current, previous) -> Column:
    """``(current / previous - 1) * 100``; NULL when previous is 0."""
    return (safe_ratio(current, previous) - F.lit(1.0)) * F.lit(100.0)


def scale_unit(x, unit: float) -> Column:
    """Divide by the reporting unit (1000 = thousands)."""
    return _c(x).cast("double") / F.lit(float(unit))


def date_recency(asof: str, last) -> Column:
    """Whole days from ``last`` to the as-of date (positive when in the past)."""
    return F.datediff(date_literal(asof), F.to_date(_c(last))).cast("bigint")


def in_period(date_col, start: str, end: str) -> Column:
    """Inclusive calendar period: every instant of the end day is inside."""
    d = _c(date_col)
    return (d >= date_literal(start)) & (d < F.date_add(date_literal(end), 1))


def money(x) -> Column:
    return _c(x).cast(MONEY)


def abs_value(x) -> Column:
    return F.abs(_c(x))


def hash_unit_hex(seed, key, width: int = 8) -> Column:
    """First ``width`` hex digits of md5(seed ':' key): a uniform draw that
    depends only on the key, so it is the same on any partitioning, any
    re-run after executor loss, and in SQL engines that have md5."""
    return F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), _c(key).cast("string"))), 1, width)
