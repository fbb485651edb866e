"""Pairwise-complete moments of many columns in one pass.

k columns have k (k + 1) / 2 pairs, and each pair its own set of rows in which
both are present.  Rather than some aggregates for each pair, a task multiplies
blocks: X holds the values (0 where missing), M the presence (0 or 1); M'M are
the pairs' counts, X'M their sums, (X * X)'M their squares and X'X their cross
products.  What leaves a task is these four k x k blocks, row by row; they are
added by row, so one exchange of k x k state per core is all that is shuffled.

Sums of squares of values far from 0 lose their digits, so values are counted
from a point in their midst: the column's mean, from an aggregate before.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.bootstrap import partial_tasks
from strata.operators.stats import value_of

BLOCK = 65_536  # rows multiplied at once


def pair_moments(df: DataFrame, cols: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(counts, sums, squares, products, origin): entry (i, j) is over the
    rows in which i and j are present, sums and squares of i, products of i and
    j, all of value minus origin.  NULL and NaN are missing; an infinity raises."""
    cols, k = list(cols), len(cols)
    names = [f"c{i}" for i in range(k)]
    rows = df.select(*[value_of(df, c).cast("double").alias(n) for c, n in zip(cols, names)]).persist(StorageLevel.MEMORY_AND_DISK)
    try:  # stored by the means, partition by partition: a task that streams several then only reads them
        means = rows.agg(*[F.avg(n).alias(n) for n in names]).first() if k else []
        origin = np.array([m if m is not None else 0.0 for m in means])
        if not np.isfinite(origin).all():
            raise ValueError(f"infinite values in {', '.join(c for c, o in zip(cols, origin) if not np.isfinite(o))}")

        def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            state = np.zeros((4, k, k))
            for batch in batches:
                for a in range(0, batch.num_rows, BLOCK):
                    part = batch.slice(a, BLOCK)
                    x = np.column_stack([part[n].to_numpy(zero_copy_only=False) for n in names]) - origin
                    m = ~np.isnan(x)
                    x[~m] = 0.0
                    m = m.astype(np.float64)
                    state += [m.T @ m, x.T @ m, (x * x).T @ m, x.T @ x]
            yield pa.RecordBatch.from_arrays([pa.array(range(k), pa.int32()), pa.array(list(state.transpose(1, 0, 2).reshape(k, 4 * k)), pa.list_(pa.float64()))], names=["i", "v"])

        parts = rows.coalesce(partial_tasks(df)).mapInArrow(multiply, "i int, v array<double>")
        summed = parts.select("i", array_to_vector("v").alias("v")).groupBy("i").agg(Summarizer.sum(F.col("v")).alias("v"))
        state = np.zeros((k, 4, k))
        for r in summed.select("i", vector_to_array("v").alias("v")).collect():  # k rows
            state[r["i"]] = np.reshape(r["v"], (4, k))
    finally:
        rows.unpersist()
    return (*state.transpose(1, 0, 2), origin)


def corr_all(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson r of every pair of ``cols`` as ``stats.corr_pairs`` gives it
    (col_a, col_b, r and n, the rows with both), for any number of columns in
    one pass.  NULL where a side has no variance in the pair's rows."""
    cols = list(cols)
    n, s, q, p, _ = pair_moments(df, cols)
    with np.errstate(divide="ignore", invalid="ignore"):
        mean = s / n  # of i in the rows of (i, j)
        spread = q - n * mean * mean
        r = (p - n * mean * mean.T) / np.sqrt(spread * spread.T)
        flat = (spread <= 1e-12 * np.maximum(q, n * mean * mean)) | ~(n > 1)
    rows = [(a, cols[j], None if flat[i, j] or flat[j, i] else float(np.clip(r[i, j], -1, 1)), int(n[i, j]))
            for i, a in enumerate(cols) for j in range(i + 1, len(cols))]
    return df.sparkSession.createDataFrame(rows, "col_a string, col_b string, r double, n long")


def corr_label(df: DataFrame, cols: Sequence[str], label: str) -> dict[str, float | None]:
    found = corr_all(df, [*cols, label]).where(F.col("col_b") == label).collect()
    return {r["col_a"]: r["r"] for r in found}


def eliminate_redundant(df: DataFrame, cols: Sequence[str], label: str, max_abs_r: float) -> list[tuple[str, float | None, bool, str | None]]:
    """Greedy choice over the correlation graph, (feature, r with the label,
    kept, because of): features go by falling |r| with the label (ties and
    features without r: by name, the latter last); one stays unless its |r| with
    a feature that stays reaches ``max_abs_r``: ``because of`` is the first such
    feature in that order.  What stays is not redundant, and each of the others
    is so beside one that stays."""
    cols = list(cols)
    r = {}
    for row in corr_all(df, [*cols, label]).collect():  # one row for each pair of columns
        r[row["col_a"], row["col_b"]] = r[row["col_b"], row["col_a"]] = row["r"]
    order = sorted(cols, key=lambda c: (r[c, label] is None, -abs(r[c, label] or 0.0), c))
    kept, out = [], []
    for c in order:
        near = next((k for k in kept if r[c, k] is not None and abs(r[c, k]) >= max_abs_r), None)
        if near is None:
            kept.append(c)
        out.append((c, r[c, label], near is None, near))
    return out
