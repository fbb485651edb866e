"""Sketches that are stored by group and merged over new rows.

An exact distinct count or quantile has to see all rows again when some arrive;
a sketch of a batch is kept beside the others, and any set of batches merges to
the sketch of their rows together.  Both are Spark's own aggregates over
DataSketches, some kilobytes a group whatever the rows.

* distinct values: HyperLogLog with 2^lg_k registers; the relative standard
  error is 1.04 / sqrt(2^lg_k) at most (1.6 % at 12).
* quantiles: KLL; with k = 800 a rank is off by 0.4 % of the group's rows at
  most, with 99 % certainty.

NULL and NaN count as missing, rows with a null key are left out.  The exact
forms are ``stats.nunique`` and ``stats.box_stats``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.stats import _not_null, value_of

LG_K = 12
K = 800
STEPS = 400


def distinct_error(lg_k: int = LG_K) -> float:
    """Relative standard error of a distinct count, at most."""
    return 1.04 / 2 ** (lg_k / 2)


def distinct_sketches(df: DataFrame, keys: Sequence[str], col: str, lg_k: int = LG_K) -> DataFrame:
    """keys and ``sketch`` of the distinct values of ``col``."""
    rows = df.where(_not_null(keys)).select(*keys, value_of(df, col).cast("string").alias("_v"))
    return rows.groupBy(*keys).agg(F.hll_sketch_agg("_v", F.lit(lg_k)).alias("sketch"))


def merge_distinct(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The sketch of all rows of each group, of sketches of some of them."""
    return sketches.groupBy(*keys).agg(F.hll_union_agg("sketch").alias("sketch"))


def distinct_estimates(sketches: DataFrame, keys: Sequence[str], alias: str = "n_distinct") -> DataFrame:
    return sketches.select(*keys, F.hll_sketch_estimate("sketch").alias(alias))


def quantile_sketches(df: DataFrame, keys: Sequence[str], col: str, k: int = K) -> DataFrame:
    """keys, ``sketch``, and the exact ``n``, ``least`` and ``most``."""
    rows = df.where(_not_null(keys)).select(*keys, value_of(df, col).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    return rows.groupBy(*keys).agg(F.kll_sketch_agg_double("_v", F.lit(k)).alias("sketch"), F.count("_v").alias("n"),
                                   F.min("_v").alias("least"), F.max("_v").alias("most"))


def merge_quantiles(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    return sketches.groupBy(*keys).agg(F.kll_merge_agg_double("sketch").alias("sketch"), F.sum("n").alias("n"),
                                       F.min("least").alias("least"), F.max("most").alias("most"))


def sketched_quantiles(sketches: DataFrame, keys: Sequence[str], probs: dict[str, float]) -> DataFrame:
    """keys, n and a column for each named probability: a value whose rank is
    within the sketch's error of it."""
    return sketches.select(*keys, "n", *[F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias(name) for name, p in probs.items()])


def sketched_box_stats(sketches: DataFrame, keys: Sequence[str], whisker: float = 1.5) -> DataFrame:
    """The numbers under a box plot from the sketches alone: quartiles, the
    fences cut to the least and the largest value, and about how many rows lie
    outside."""
    q = sketches.select(*keys, "sketch", "n", "least", "most", *[F.kll_sketch_get_quantile_double("sketch", F.lit(p)).alias(name)
                                                                 for name, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))])
    reach = F.lit(whisker) * (F.col("q3") - F.col("q1"))
    q = q.withColumns({"whisker_low": F.greatest("least", F.col("q1") - reach), "whisker_high": F.least("most", F.col("q3") + reach)})
    # the share of rows outside: of the quantiles at equal steps, those that are
    steps = F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(i / STEPS) for i in range(STEPS + 1)]))
    outside = F.size(F.filter(steps, lambda v: (v < F.col("whisker_low")) | (v > F.col("whisker_high"))))
    return q.select(*keys, "n", "q1", "median", "q3", "whisker_low", "whisker_high", F.round(outside / (STEPS + 1) * F.col("n")).cast("long").alias("n_outliers"))


class SketchStore:
    """Sketches of batches below a folder.  A batch goes by its name: put
    again, after a failure or a correction, it replaces what was there."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def put(self, batch: str, sketches: DataFrame) -> None:
        if not batch or set(batch) & set("/=\\"):
            raise ValueError(f"batch name {batch!r}")
        sketches.write.mode("overwrite").parquet(f"{self.path}/batch={batch}")

    def sketches(self) -> DataFrame:
        """All batches' rows."""
        return self.spark.read.parquet(self.path).drop("batch")
