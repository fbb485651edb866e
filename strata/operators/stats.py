"""Grouped statistics: counts, means, shares, pivots, grouping sets,
quantiles and box statistics, histograms, modes and correlations.

Every statistic is an aggregate whose partial form combines map-side, so a
group holding a third of all rows costs no more than any other.  Two
statistics need care at scale:

NULL and NaN count as missing everywhere; statistics are not rounded.

* exact quantiles — Spark's ``percentile`` keeps a value->count map per
  group and merges it in one task.  ``quantiles`` instead builds the
  distinct-value histogram with an ordinary aggregate and finds the ranks by
  a distributed prefix sum over a range-partitioned sort, so no group is
  ever gathered in one task (``approx=True`` uses the bounded sketch of
  ``percentile_approx`` instead).
* modes — counted per value with a partial aggregate, then the top value
  per group is picked with ``min_by`` (again partial), never by collecting.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.scalars import safe_ratio
from strata.session import checkpoint_dir


def _not_null(keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def value_of(df: DataFrame, col: str) -> Column:
    """The column with NaN as NULL: a statistic skips both."""
    c = F.col(col)
    return F.when(~F.isnan(c), c) if dict(df.dtypes)[col] in ("double", "float") else c


def exact_mean(col: str | Column, scale: int = 4) -> Column:
    """Mean with an exact DECIMAL sum of ``scale`` decimals: the same result
    whatever the order in which partial sums meet."""
    c = F.col(col) if isinstance(col, str) else col
    return F.sum(c.cast(f"decimal({28 + scale},{scale})")).cast("double") / F.count(c)


def count_by_keys(df: DataFrame, keys: Sequence[str], col: str, alias: str = "n") -> DataFrame:
    """Non-null count of ``col`` by keys (rows with a null key dropped)."""
    return df.where(_not_null(keys)).groupBy(*keys).agg(F.count(value_of(df, col)).alias(alias))


def nunique(df: DataFrame, keys: Sequence[str], col: str, alias: str = "n_distinct",
            approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """Distinct non-null values of ``col`` per group (or overall without
    keys).  Exact by default; ``approx`` uses HyperLogLog++ sketches
    (``approx_count_distinct``, relative error ``rsd``), whose partial state
    is a few kilobytes per group however many distinct values there are."""
    keys = list(keys)
    v = value_of(df, col)
    fn = (F.approx_count_distinct(v, rsd) if approx else F.count_distinct(v)).alias(alias)
    base = df.where(_not_null(keys)) if keys else df
    return base.groupBy(*keys).agg(fn) if keys else base.agg(fn)


def grouped_mean(df: DataFrame, keys: Sequence[str], value: str, alias: str | None = None,
                 exact_scale: int | None = None) -> DataFrame:
    """Mean of ``value`` by keys, nulls skipped.  ``exact_scale`` sums as
    DECIMAL with that many decimals (for money columns)."""
    v = value_of(df, value)
    m = exact_mean(v, exact_scale) if exact_scale is not None else F.avg(v)
    return df.where(_not_null(keys)).groupBy(*keys).agg(m.alias(alias or f"mean_{value}"))


def mean_and_count(df: DataFrame, key: str, value: str) -> DataFrame:
    """``groupby(key)[value].agg(["mean", "count"])``."""
    return (df.where(F.col(key).isNotNull()).groupBy(key)
            .agg(F.avg(value_of(df, value)).alias("mean"), F.count(value_of(df, value)).alias("count")))


def grouping_sets_mean(df: DataFrame, sets: Sequence[Sequence[str]], value: str,
                       alias: str = "rate", exact_scale: int | None = None) -> DataFrame:
    """Means for several key sets in one scan; ``grouping_set`` names the set
    (keys joined by ',') and absent keys are NULL.  A group with a null in one
    of its own set's keys is dropped, as in ``grouped_mean``.  ``exact_scale``:
    sum as DECIMAL (money columns)."""
    cols = sorted({k for s in sets for k in s})
    name, whole = F.lit(None).cast("string"), F.lit(False)
    for s in sets:
        gid = F.col("_gid") == sum(1 << (len(cols) - 1 - i) for i, c in enumerate(cols) if c not in s)
        name = F.when(gid, F.lit(",".join(s))).otherwise(name)
        whole = whole | (gid & _not_null(s))
    v = value_of(df, value)
    return (df.groupingSets([list(s) for s in sets], *cols)
            .agg((exact_mean(v, exact_scale) if exact_scale is not None else F.avg(v)).alias(alias),
                 F.count(v).alias("n"), F.grouping_id().alias("_gid"))
            .where(whole).withColumn("grouping_set", name).drop("_gid"))


def pivot_agg(df: DataFrame, row_key: str | Sequence[str], col_key: str, values: Sequence | None, agg: str,
              value: str, exact_scale: int | None = None) -> DataFrame:
    """``groupby([row_key, col_key]).agg().unstack()``, with one row key or
    several: one column per value of ``col_key``; a missing cell is NULL.
    ``exact_scale``: means as in ``grouped_mean``.  Without ``values`` they are found
    first (one job).  Where they are given, a non-null value outside them
    raises: nothing is left out of the table unseen."""
    mean = F.avg if exact_scale is None else (lambda c: exact_mean(c, exact_scale))
    fn = {"mean": mean, "count": F.count, "sum": F.sum}[agg]
    row_keys = [row_key] if isinstance(row_key, str) else list(row_key)
    base = df.where(_not_null([*row_keys, col_key])).select(*row_keys, col_key, value_of(df, value).alias(value))
    if values is None:
        values = sorted(r[0] for r in base.select(col_key).distinct().collect())
    else:
        text = F.concat(F.lit(f"{col_key} has a value that is not listed: "), F.col(col_key).cast("string"))
        listed = F.when(F.col(col_key).isin(list(values)), F.col(col_key))
        base = base.withColumn(col_key, listed.otherwise(F.raise_error(text).cast(dict(df.dtypes)[col_key])))
    out = base.groupBy(*row_keys).pivot(col_key, list(values)).agg(fn(F.col(value)))
    if agg == "count":  # a pivot cell with no rows is NULL, as in the unstacked frame
        for v in values:
            out = out.withColumn(str(v), F.when(F.col(str(v)) != 0, F.col(str(v))))
    return out


def shares_of_totals(counts: DataFrame, n_col: str, partitions: dict[str, Sequence[str]]) -> DataFrame:
    """Add ``total_<name>`` and ``pct_<name>`` per entry of ``partitions``:
    the share of each row's count within its partition.  The totals are an
    aggregate of ``counts`` joined back — not a window, which would put every
    group of one partition value (e.g. one label) into a single task."""
    out = counts
    for name, keys in partitions.items():
        totals = counts.groupBy(*keys).agg(F.sum(n_col).alias(f"total_{name}"))
        out = (out.join(totals, list(keys))
               .withColumn(f"pct_{name}", safe_ratio(F.col(n_col), F.col(f"total_{name}")) * 100.0))
    return out


def weighted_rate(df: DataFrame, key: str, label: str, alias: str = "weighted_rate") -> DataFrame:
    """Per group: sum(label * n_group / n_total * 100) = sum(label) * n_group
    / n_total * 100.  The total is the sum of the groups' counts, those of a
    null key included: the rows are scanned once."""
    groups = df.groupBy(key).agg(F.sum(label).cast("double").alias("_s"), F.count(F.col(label)).cast("double").alias("_n"))
    total = groups.select(F.sum("_n")).scalar()
    return groups.where(F.col(key).isNotNull()).select(key, (F.col("_s") * F.col("_n") / total * 100.0).alias(alias))


# ---------------------------------------------------------------- quantiles

def _ranked(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The histogram of ``value`` per group with each value's ranks: _lo_rank
    (first, from 0), _hi_rank (after the last) and the group's size n.

    Running counts inside each partition of a range-partitioned histogram,
    then an exclusive prefix over the partitions (a table of at most one row
    per partition and group)."""
    checkpoint_dir(df.sparkSession)
    hist = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_c"))
    # the partition id feeds two branches: a reliable checkpoint in the shared
    # folder fixes it once and cuts the lineage for lost executors
    ranged = (hist.repartitionByRange(*[F.col(k) for k in keys], F.col(value))
              .withColumn("_pid", F.spark_partition_id()).checkpoint(eager=True))
    before = Window.unboundedPreceding
    local = Window.partitionBy("_pid", *keys).orderBy(value).rowsBetween(before, Window.currentRow)
    totals = ranged.groupBy("_pid", *keys).agg(F.sum("_c").alias("_ptot"))
    earlier = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(before, -1)
    offsets = totals.select("_pid", *keys, F.coalesce(F.sum("_ptot").over(earlier), F.lit(0)).alias("_off"),
                            F.sum("_ptot").over(Window.partitionBy(*keys)).alias("n"))
    return (ranged.withColumn("_cum", F.sum("_c").over(local)).join(offsets, ["_pid", *keys])
            .withColumn("_hi_rank", F.col("_off") + F.col("_cum"))
            .withColumn("_lo_rank", F.col("_hi_rank") - F.col("_c")))


def _at_ranks(ranked: DataFrame, keys: list[str], value: str, probs: Sequence[float], names: Sequence[str]) -> DataFrame:
    """keys, n and one column per probability, interpolated between the
    neighbouring order statistics: rank k lies at the value with
    _lo_rank <= k < _hi_rank."""
    v, aggs, finals = F.col(value), [], []
    for i, (p, name) in enumerate(zip(probs, names)):
        r = F.lit(float(p)) * (F.col("n") - 1).cast("double")
        lo, hi = F.floor(r), F.ceil(r)
        at = lambda k: (F.col("_lo_rank") <= k) & (k < F.col("_hi_rank"))
        aggs += [F.max(F.when(at(lo), v)).alias(f"_lo{i}"), F.max(F.when(at(hi), v)).alias(f"_hi{i}"), F.max(r - lo).alias(f"_d{i}")]
        finals.append((F.col(f"_lo{i}") + F.col(f"_d{i}") * (F.col(f"_hi{i}") - F.col(f"_lo{i}"))).cast("double").alias(name))
    return ranked.groupBy(*keys).agg(F.max("n").alias("n"), *aggs).select(*keys, "n", *finals)


def quantile_name(p: float) -> str:
    """q_25 for 0.25, q_2_5 for 0.025: one name for each probability."""
    return "q_" + format(Decimal(repr(float(p))) * 100, "f").rstrip("0").rstrip(".").replace(".", "_") if p else "q_0"


def _values(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    return df.where(_not_null(keys)).select(*keys, value_of(df, value).alias(value)).where(F.col(value).isNotNull())


def quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float],
              approx: bool = False, accuracy: int = 100_000) -> DataFrame:
    """Per group, the ``probs`` quantiles of ``value`` with linear
    interpolation between order statistics (pandas / ``quantile_cont``
    convention), NULL and NaN skipped.  Output: keys, ``n``, a column
    ``quantile_name`` per probability.

    Exact and distributed whatever the number of distinct values: a count per
    (keys, value), ranks by a prefix sum over its range partitions, and an
    aggregate that picks the values at the ranks.  ``approx=True`` uses the
    bounded sketch of ``percentile_approx``."""
    keys, names = list(keys), [quantile_name(p) for p in probs]
    base = _values(df, keys, value)
    if approx:
        return (base.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.percentile_approx(value, list(probs), accuracy).alias("_q"))
                .select(*keys, "n", *[F.col("_q")[i].alias(nm) for i, nm in enumerate(names)]))
    return _at_ranks(_ranked(base, keys, value), keys, value, probs, names)


def median_of(df: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """Exact median (2.5 for 1, 2, 3, 10)."""
    return quantiles(df, keys, value, [0.5]).withColumnRenamed("q_50", "median")


def box_stats(df: DataFrame, keys: Sequence[str], value: str, whisker: float = 1.5) -> DataFrame:
    """The numbers under a box plot per group: quartiles, 1.5 IQR whisker
    ends (the most extreme data points inside the fences) and outlier count.
    All of it is read off the ranked histogram: the rows are scanned once."""
    keys = list(keys)
    ranked = _ranked(_values(df, keys, value), keys, value)
    q = _at_ranks(ranked, keys, value, [0.25, 0.5, 0.75], ["q1", "median", "q3"])
    reach = F.lit(whisker) * (F.col("q3") - F.col("q1"))
    q = q.withColumns({"_low": F.col("q1") - reach, "_high": F.col("q3") + reach})
    counted = ranked.select(*keys, value, "_c")
    v = F.col(value)
    joined = counted.join(q, keys) if keys else counted.crossJoin(F.broadcast(q))  # without keys q is one row
    inside = (v >= F.col("_low")) & (v <= F.col("_high"))
    return joined.groupBy(*keys).agg(
        F.first("n").alias("n"), F.first("q1").alias("q1"), F.first("median").alias("median"), F.first("q3").alias("q3"),
        F.min(F.when(inside, v)).alias("whisker_low"), F.max(F.when(inside, v)).alias("whisker_high"),
        F.coalesce(F.sum(F.when(~inside, F.col("_c"))), F.lit(0)).alias("n_outliers"))


def mode_of(df: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """Most frequent non-null value per group; the smallest value on ties."""
    keys = list(keys)
    counts = (_values(df, keys, value).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n")))
    return counts.groupBy(*keys).agg(
        F.min_by(F.col(value), F.struct((-F.col("_n")).alias("a"), F.col(value).alias("b")))
        .alias("mode"),
        F.max("_n").alias("mode_count"))


def histogram(df: DataFrame, value: str, bins: int = 10) -> DataFrame:
    """Counts in ``bins`` equal-width bins between min and max, the last bin
    closed on the right (pandas/numpy ``hist``), NULL and NaN skipped.  Both
    ends come from one aggregate, used as a scalar; rows are binned locally and
    counted with a partial aggregate."""
    rows = _values(df, [], value)
    ends = rows.select(F.struct(F.min(value).alias("mn"), F.max(value).alias("mx"))).scalar()
    rows = rows.withColumn("_ends", ends)
    mn, width = F.col("_ends.mn"), (F.col("_ends.mx") - F.col("_ends.mn")) / F.lit(float(bins))
    raw = F.floor(F.try_divide(F.col(value) - mn, width))
    b = F.least(F.coalesce(raw, F.lit(0)), F.lit(bins - 1)).cast("int")
    return (rows.groupBy(b.alias("bin"), "_ends").agg(F.count(F.lit(1)).alias("n"))
            .select("bin", (mn + F.col("bin") * width).alias("lower"), (mn + (F.col("bin") + 1) * width).alias("upper"), "n"))


# ------------------------------------------------------------- correlation

def corr_pairs(df: DataFrame, cols: Sequence[str], with_col: str | None = None) -> DataFrame:
    """Pearson r for every pair of ``cols`` (or each col against ``with_col``),
    pairwise-complete rows (NULL and NaN skipped), in one aggregate of Spark's
    single-pass moments.  Long output (col_a, col_b, r); NULL when a side has
    no variance."""
    cols = list(cols)
    pairs = ([(a, with_col) for a in cols] if with_col
             else [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]])
    clean = {c: value_of(df, c).cast("double") for p in pairs for c in p}
    aggs = []
    for i, (a, b) in enumerate(pairs):
        x, y = F.when(clean[b].isNotNull(), clean[a]), F.when(clean[a].isNotNull(), clean[b])
        spread = F.stddev_pop(x) * F.stddev_pop(y)
        r = F.try_divide(F.covar_pop(clean[a], clean[b]), spread)
        # greatest and least skip NULL, so a missing r is kept missing
        aggs.append(F.when(r.isNotNull(), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r))).alias(f"r{i}"))
    s = df.agg(*aggs)
    rows = [F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(f"r{i}").alias("r"))
            for i, (a, b) in enumerate(pairs)]
    return s.select(F.explode(F.array(*rows)).alias("p")).select("p.*")


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson matrix of complete (null-free) numeric columns, long form
    (col_a, col_b, r) for the upper triangle.  One distributed Gram-matrix
    aggregation (Spark ML ``Correlation``); only the k x k result reaches the
    driver.  A null in any column raises (use ``corr_pairs`` for pairwise-
    complete statistics); a zero-variance column gives NULL."""
    import math

    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import Correlation

    cols = list(cols)
    vec = VectorAssembler(inputCols=cols, outputCol="_v", handleInvalid="error").transform(df)
    m = Correlation.corr(vec.select("_v"), "_v", "pearson").first()[0].toArray()
    rows = []
    for i, a in enumerate(cols):
        for j in range(i + 1, len(cols)):
            r = float(m[i, j])
            rows.append((a, cols[j], None if math.isnan(r) else r))
    return df.sparkSession.createDataFrame(rows, "col_a string, col_b string, r double")
