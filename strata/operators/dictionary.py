"""Dictionaries of any size: dense ids of categories, and sparse one-hot vectors.

No list of categories reaches the driver or a plan.  The distinct categories are
range-partitioned and numbered by a prefix sum over the partitions' counts, the
dictionary stays a table, and rows are joined to it (a category that a third of
the rows hold is a skewed join key, which Spark splits).  Spark ML's encoder needs
the number of categories only.
"""

from __future__ import annotations

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.stats import _ranked


def dictionary(df: DataFrame, col: str) -> DataFrame:
    """(value, id): the distinct non-null categories as text, numbered from 0
    in their order."""
    values = df.select(F.col(col).cast("string").alias("value")).where(F.col("value").isNotNull()).distinct()
    return _ranked(values, [], "value").select("value", F.col("_lo_rank").alias("id"))


def encode_ids(df: DataFrame, col: str, words: DataFrame, out: str, handle_unknown: str = "error") -> DataFrame:
    """``df`` with the id of each row's category in the dictionary ``words``;
    null for a null category.  One that is not there raises, or is null
    (``handle_unknown="ignore"``)."""
    if handle_unknown not in ("error", "ignore"):
        raise ValueError(f"handle_unknown {handle_unknown!r}")
    names = words.select(F.col("value").alias("_value"), F.col("id").alias("_id"))
    joined = df.join(names, F.col(col).cast("string") == F.col("_value"), "left")
    found = F.col("_id")
    if handle_unknown == "error":
        text = F.concat(F.lit(f"{col} has a category that is not in the dictionary: "), F.col(col).cast("string"))
        found = F.when(F.col("_id").isNull() & F.col(col).isNotNull(), F.raise_error(text).cast("long")).otherwise(found)
    return joined.select(*df.columns, found.alias(out))


def one_hot_sparse(df: DataFrame, col: str, words: DataFrame, out: str, handle_unknown: str = "error") -> DataFrame:
    """``df`` with a sparse vector that has a 1 at the category's id; all zero
    for a null category, and for one that is not in the dictionary if ignored."""
    size = words.count()
    encoded = encode_ids(df, col, words, "_code", handle_unknown)
    if not size:
        raise ValueError("the dictionary is empty")
    # the number past the last id stands for none: it is the category that the encoder drops
    coded = encoded.withColumn("_code", F.coalesce("_code", F.lit(size)).cast("double"))
    ends = df.sparkSession.createDataFrame([(0.0,), (float(size),)], "_code double")
    model = OneHotEncoder(inputCols=["_code"], outputCols=[out], dropLast=True).fit(ends)
    return model.transform(coded).drop("_code")
