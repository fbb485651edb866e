"""Derived passenger columns: title, family size, cabin level."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.scalars import cabin_level, extract_title


def enrich(df: DataFrame) -> DataFrame:
    """Add ``title``, ``family_size`` (sibsp + parch) and ``level_cabin``."""
    return df.withColumns({
        "title": extract_title(F.col("name")),
        "family_size": F.col("sibsp") + F.col("parch"),
        "level_cabin": cabin_level(F.col("cabin")),
    })
