"""Binary-classification evaluation as aggregates.

* ``confusion_counts`` / ``classification_metrics``: one aggregate; the true
  precision and recall of the positive class (not swapped), F1 and accuracy;
  undefined ratios are NULL.
* ``bootstrap_eval``: metric distributions over B resamples without refit.
  Each (replicate, row) gets a Poisson(1) weight drawn from md5 of
  (seed, replicate, key) — deterministic, layout-free, re-runnable after an
  executor loss, and reproducible in SQL.  Rows are expanded by a generator
  (``explode``), weighted counts are combined map-side per replicate, so the
  shuffle carries at most B rows per task.
* ``cell_bootstrap``: the same distribution for any metric of the confusion
  cells, from the four cell counts alone: resampling n rows is a
  multinomial draw over the cells, so one aggregate plus B tiny draws
  replace n * B weights.
* ``order_stat_interval``: percentile intervals as order statistics of the
  B sorted replicate scores (ranks k+1 and B-k), via ``row_number`` over
  windows of B rows per (model, metric).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.session import spread

# Interval levels -> number of replicates cut from each tail, per 1000.
LEVEL_TAIL_PER_1000 = {80: 100, 90: 50, 95: 25}


def _cells(label: Column, pred: Column, w: Column | None = None) -> list[Column]:
    one = F.lit(1) if w is None else w
    zero = F.lit(0) if w is None else F.lit(0)
    def s(cond):
        return F.sum(F.when(cond, one).otherwise(zero))
    return [s((pred == 1) & (label == 1)).alias("tp"), s((pred == 1) & (label == 0)).alias("fp"),
            s((pred == 0) & (label == 1)).alias("fn"), s((pred == 0) & (label == 0)).alias("tn")]


def confusion_counts(pred: DataFrame, label: str = "label", prediction: str = "prediction",
                     by: list[str] | None = None) -> DataFrame:
    by = by or []
    lab, p = F.col(label).cast("int"), F.col(prediction).cast("int")
    g = pred.groupBy(*by) if by else pred
    out = g.agg(*_cells(lab, p))
    return out.select(*by, *[F.col(c).cast("bigint").alias(c) for c in ("tp", "fp", "fn", "tn")])


def metric_columns(tp="tp", fp="fp", fn="fn", tn="tn") -> list[Column]:
    d = lambda c: F.col(c).cast("double")
    total = d(tp) + d(fp) + d(fn) + d(tn)
    return [F.try_divide(d(tp) + d(tn), total).alias("accuracy"),
            F.try_divide(d(tp), d(tp) + d(fp)).alias("precision"),
            F.try_divide(d(tp), d(tp) + d(fn)).alias("recall"),
            F.try_divide(F.lit(2.0) * d(tp), F.lit(2.0) * d(tp) + d(fp) + d(fn)).alias("f1")]


def classification_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction",
                           by: list[str] | None = None) -> DataFrame:
    by = by or []
    c = confusion_counts(pred, label, prediction, by)
    return c.select(*by, "tp", "fp", "fn", "tn", *metric_columns())


def accuracy_score(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    ok = (F.col(label).cast("int") == F.col(prediction).cast("int")).cast("double")
    return pred.agg(F.avg(ok).alias("accuracy"))


# ------------------------------------------------------------- bootstrap

def poisson_thresholds(width: int = 8) -> list[str]:
    """Hex thresholds T_k = floor(P(K <= k) * 16^width) of Poisson(1); a draw
    h (hex prefix) has weight #{k : h >= T_k}.  The list stops where the
    remaining mass is below the resolution of the draw."""
    scale = 16 ** width
    out, cdf, term, k = [], 0.0, math.exp(-1.0), 0
    while True:
        cdf += term
        t = int(cdf * scale)
        if t >= scale - 1:
            break
        out.append(format(t, f"0{width}x"))
        k += 1
        term /= k
    return out


DRAWS_PER_DIGEST = 4  # one md5 digest (32 hex) gives four 8-hex draws


def _weight_from_hex(h: Column, width: int = 8) -> Column:
    """The first threshold above the draw decides: for most draws one or two
    comparisons."""
    first, *more = enumerate(poisson_thresholds(width))
    w = F.when(h < F.lit(first[1]), F.lit(first[0]))
    for k, t in more:
        w = w.when(h < F.lit(t), F.lit(k))
    return w.otherwise(F.lit(len(more) + 1))


def poisson_weight(seed, rep: Column, key: Column, width: int = 8) -> Column:
    """Poisson(1) weight of (replicate, key): draw ``rep % 4`` of the digest
    md5(seed ':' rep div 4 ':' key)."""
    block = F.floor(rep / DRAWS_PER_DIGEST).cast("long")
    slot = (rep % DRAWS_PER_DIGEST).cast("int")
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), block.cast("string"), key.cast("string")))
    return _weight_from_hex(F.substring(digest, slot * width + 1, width), width)


def poisson_weight_sql(seed, rep: str, key: str, width: int = 8) -> str:
    h = (f"substr(md5('{seed}:' || CAST({rep} // {DRAWS_PER_DIGEST} AS VARCHAR) || ':' || "
         f"CAST({key} AS VARCHAR)), CAST(({rep} % {DRAWS_PER_DIGEST}) * {width} + 1 AS INTEGER), "
         f"{width})")
    return "(" + " + ".join(f"CAST({h} >= '{t}' AS INTEGER)" for t in poisson_thresholds(width)) + ")"


def bootstrap_eval(pred: DataFrame, key: str, label: str = "label", prediction: str = "prediction",
                   replicates: int = 1000, seed=7) -> DataFrame:
    """Per replicate: weighted confusion cells and metrics (Poisson bootstrap).

    Rows are expanded per block of four replicates (one md5 digest each);
    per block the 4 x 4 weighted cells are summed with map-side combine and
    then unfolded to one row per replicate."""
    out = bootstrap_eval_many(pred, key, label, [prediction], replicates, seed)
    return out.drop("model")


def bootstrap_eval_many(pred: DataFrame, key: str, label: str, predictions: list[str],
                        replicates: int = 1000, seed=7) -> DataFrame:
    """As ``bootstrap_eval`` for several prediction columns of the same rows: a
    row's weights are drawn once and weigh every model's cells.  ``model`` is
    the column's name."""
    models = range(len(predictions))
    rows = spread(pred.select(F.col(key).alias("_k"), F.col(label).cast("int").alias("_y"),
                              *[F.col(c).cast("int").alias(f"_p{i}") for i, c in enumerate(predictions)]))
    n_blocks = -(-replicates // DRAWS_PER_DIGEST)
    x = rows.select("*", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("_blk"))
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("_blk").cast("string"), F.col("_k").cast("string")))
    # draws and weights are projected once; the aggregate over the rows only adds the four weights of each
    # (block, label, predictions), the cells are put together from those few groups
    models_p = [f"_p{i}" for i in models]
    x = x.withColumn("_d", digest).select("_blk", "_y", *models_p, *[F.substring(F.col("_d"), j * 8 + 1, 8).alias(f"_h{j}") for j in range(DRAWS_PER_DIGEST)])
    x = x.select("_blk", "_y", *models_p, *[_weight_from_hex(F.col(f"_h{j}")).cast("bigint").alias(f"_w{j}") for j in range(DRAWS_PER_DIGEST)])
    x = x.groupBy("_blk", "_y", *models_p).agg(*[F.sum(f"_w{j}").alias(f"_w{j}") for j in range(DRAWS_PER_DIGEST)])
    aggs = []
    for i in models:
        y, p = F.col("_y"), F.col(f"_p{i}")
        cells = {"tp": (p == 1) & (y == 1), "fp": (p == 1) & (y == 0), "fn": (p == 0) & (y == 1), "tn": (p == 0) & (y == 0)}
        aggs += [F.sum(F.when(c, F.col(f"_w{j}")).otherwise(F.lit(0).cast("bigint"))).alias(f"{n}{i}_{j}")
                 for j in range(DRAWS_PER_DIGEST) for n, c in cells.items()]
    per_block = x.groupBy("_blk").agg(*aggs)
    cells = ("tp", "fp", "fn", "tn")
    unfolded = per_block.select(F.explode(F.array(*[
        F.struct((F.col("_blk") * DRAWS_PER_DIGEST + j).alias("rep"), F.lit(name).alias("model"),
                 *[F.col(f"{n}{i}_{j}").alias(n) for n in cells]) for i, name in enumerate(predictions) for j in range(DRAWS_PER_DIGEST)
    ])).alias("r")).select("r.*").where(F.col("rep") < replicates)
    return unfolded.select("model", F.col("rep").cast("bigint").alias("rep"),
                           *[F.col(c).cast("bigint").alias(c) for c in cells], *metric_columns())


def cell_bootstrap(pred: DataFrame, label: str = "label", prediction: str = "prediction",
                   replicates: int = 1000, seed: int = 7) -> DataFrame:
    """Multinomial resampling of the four confusion cells: B replicates of
    n rows drawn with replacement, generated on the executors from the four
    counts (a one-row aggregate) with a per-replicate seeded generator."""
    c = confusion_counts(pred, label, prediction).first()
    counts = [int(c[k] or 0) for k in ("tp", "fp", "fn", "tn")]
    n = sum(counts)
    p = np.array(counts, dtype=float) / max(n, 1)
    reps = pred.sparkSession.range(replicates).withColumnRenamed("id", "rep")

    def draw(it):
        for pdf in it:
            out = [(int(r), *[int(v) for v in np.random.default_rng([seed, int(r)]).multinomial(n, p)])
                   for r in pdf["rep"]]
            yield pd.DataFrame(out, columns=["rep", "tp", "fp", "fn", "tn"])

    drawn = reps.mapInPandas(draw, "rep long, tp long, fp long, fn long, tn long")
    return drawn.select("rep", "tp", "fp", "fn", "tn", *metric_columns())


def order_stat_interval(scores: DataFrame, group: list[str], score: str, replicates: int,
                        levels=(80, 90, 95)) -> DataFrame:
    """Percentile interval per group and level: with B sorted scores and k
    = B * tail cut per side, lower = score at rank k+1, upper = rank B-k.
    Each window holds the B scores of one (model, metric)."""
    w = Window.partitionBy(*group).orderBy(F.col(score).asc_nulls_last())
    ranked = scores.withColumn("_rank", F.row_number().over(w))
    aggs, rows = [], []
    for lvl in levels:
        k = LEVEL_TAIL_PER_1000[lvl] * replicates // 1000
        aggs += [F.max(F.when(F.col("_rank") == k + 1, F.col(score))).alias(f"lo{lvl}"),
                 F.max(F.when(F.col("_rank") == replicates - k, F.col(score))).alias(f"hi{lvl}")]
        rows.append(F.struct(F.lit(lvl).alias("level"), F.col(f"lo{lvl}").alias("lo"),
                             F.col(f"hi{lvl}").alias("hi")))
    return (ranked.groupBy(*group).agg(*aggs)
            .select(*group, F.explode(F.array(*rows)).alias("_i")).select(*group, "_i.*"))


def long_scores(per_rep: DataFrame, metrics=("accuracy", "f1"), model: str = "model") -> DataFrame:
    """(rep, metric, score) rows from per-replicate metric columns."""
    return per_rep.select("rep", F.lit(model).alias("model"), F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).alias("score")) for m in metrics])).alias("m")
    ).select("rep", "model", "m.metric", "m.score")


def mean_std(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    """Mean and population standard deviation (numpy's ``std``)."""
    return df.groupBy(*by).agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"))
