from strata.functions.scalars import (  # noqa: F401
    MONEY, NO_CABIN, abs_value, cabin_level, date_literal, date_recency, extract_title,
    hash_unit_hex, in_period, money, pct_growth, percent_of, safe_ratio, scale_unit,
)
