"""Many logistic regressions at once: bootstrap refits and C grids.

Instead of B separate fits (B x ~100 Spark jobs), the B replicate models are
fitted together by Newton's method (IRLS): each pass is ONE Spark job.

* Replicate weights are drawn exactly (``draws="exact"``: n rows with
  replacement, multinomial weights that add up to n, ``operators.resample``)
  or are Poisson(1) draws from a 64-bit hash of (seed, replicate, key), whose
  sum varies around n.  Both are independent of partitioning and identical
  when a lost task is recomputed.
* A ``mapInPandas`` task streams its partition once per pass and keeps, for
  every replicate, the gradient, the loss and the upper triangle of the
  Hessian (B x (k+1)(k+2)/2 numbers, independent of the partition size).  The
  Hessians of a block of rows are one product: the pairwise products of the
  features against the B weights; ``BLOCK`` rows bound its memory.
* Partials are added up in a tree.  Partitions are first folded into at most
  as many tasks as the cluster runs at once (a narrow ``coalesce``, a task
  streams its partitions into one set of sums), so what is shuffled is cores x
  B x (k+1)(k+2)/2 numbers a pass and does not grow with the data; then they are
  added per (replicate, group of tasks) and per replicate by Spark ML's
  ``Summarizer``.  The driver receives B x (k+1)(k+2)/2 numbers and solves B
  systems of size k+1.  Nothing row-sized reaches it.
* A step after which a model's loss has risen is halved; a model is done when
  its step is small, and says so in ``converged``.
* Exact draws are made once and stored with the rows, compressed; every pass
  reads them.  Models that differ in C only share a replicate's draws.
* Replicates of exact draws lie near the fit of all rows.  One pass sums, for each
  replicate, the first and second derivatives of its loss at that fit, another
  one the third ones of all rows, which differ little from a replicate's; the
  driver solves from these, and passes that sum true gradients only correct the
  rest until steps are below ``tol`` (``_near``).  What does not shrink fast, as on
  few rows, goes on by Newton passes from there.

Objective per replicate (the C form): 0.5 ||b||^2 + C sum_i w_ri c_ri L_i,
intercept unpenalised; c_ri is the balanced class weight computed on the
replicate (n_r / (2 n_r,class)), as a refit on the resample would.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.resample import block_weights, drawn_blocks, weighted_blocks

BLOCK = 2048  # rows of a block: bounds the memory of its weights and products
CACHED = 256  # rows of a block whose replicates' scores are worked on in place, in a core's cache

_M1 = np.uint64(0x9E3779B97F4A7C15)
_M2 = np.uint64(0xBF58476D1CE4E5B9)
_M3 = np.uint64(0x94D049BB133111EB)


def _splitmix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        z = x + _M1
        z = (z ^ (z >> np.uint64(30))) * _M2
        z = (z ^ (z >> np.uint64(27))) * _M3
        return z ^ (z >> np.uint64(31))


_POISSON_CDF = np.cumsum([np.exp(-1.0) / np.prod(np.arange(1, k + 1, dtype=float))
                          for k in range(40)])


def replicate_weights(keys: np.ndarray, replicates: int, seed: int) -> np.ndarray:
    """n x B Poisson(1) weights, a pure function of (seed, key, replicate)."""
    k = keys.astype(np.uint64)[:, None]
    r = np.arange(replicates, dtype=np.uint64)[None, :]
    with np.errstate(over="ignore"):
        h = _splitmix(_splitmix(k ^ _splitmix(np.uint64(seed) + r)))
    u = (h >> np.uint64(11)).astype(np.float64) * (1.0 / 9007199254740992.0)
    return np.searchsorted(_POISSON_CDF, u, side="right").astype(np.float64)


def _frame(df: DataFrame, key: str, label: str, features: Sequence[str],
           fold_col: str | None = None) -> DataFrame:
    extra = [F.col(fold_col).cast("int").alias("_fold")] if fold_col else []
    return df.select(F.col(key).cast("long").alias("_key"), F.col(label).cast("double").alias("_y"),
                     *extra,
                     *[F.col(f).cast("double").alias(f"_x{i}") for i, f in enumerate(features)])


FAN_IN = 32  # partials of a replicate added in one task of the first level


def partial_tasks(df: DataFrame) -> int:
    """Partials of a pass at most: one for each core."""
    return max(1, df.sparkSession.sparkContext.defaultParallelism)


def added(parts: DataFrame, tasks: int) -> pd.DataFrame:
    """(rep, v): the sums of the tasks' rows (rep, vals) for each rep, in two
    levels where there are many."""
    add = lambda df, by: df.groupBy(*by).agg(Summarizer.sum(F.col("v")).alias("v"))
    red = parts.select("rep", F.pmod(F.spark_partition_id(), F.lit(max(1, tasks // FAN_IN))).alias("part"), array_to_vector("vals").alias("v"))
    if tasks > FAN_IN:
        red = add(red, ["rep", "part"])
    return add(red, ["rep"]).select("rep", vector_to_array("v").alias("v")).toPandas()


def _reduce(parts: DataFrame, models: int, width: int, tasks: int) -> np.ndarray:
    """Sum the tasks' rows (rep, vals[width]) into a models x width matrix."""
    red = added(parts, tasks)
    out = np.zeros((models, width))
    if len(red):
        out[red["rep"].to_numpy()] = np.stack(red["v"])
    return out


def batched_logreg(df: DataFrame, features: Sequence[str], label: str, key: str, Cs,
                   seed: int | None = None, balanced: bool = True, max_iter: int = 30,
                   tol: float = 1e-9, fold_col: str | None = None, draws: str = "poisson",
                   intercept: bool = True, replicates: int | None = None):
    """Fit len(Cs) logistic models together by Newton's method, one Spark job
    per pass.  Model r has regularisation Cs[r] and row weights w_ri:

    * ``seed`` given: replicate draws (the bootstrap), ``draws`` "exact" (the
      key is not read: equal rows are interchangeable) or "poisson"; of exact
      draws there may be fewer ``replicates`` than models: model r then has the
      weights of replicate r % replicates;
    * ``fold_col`` given: 1 on rows whose fold is not r (cross-validation;
      model r is then scored on the rows of fold r);
    * otherwise 1 (a grid of C values over the same rows).

    Without ``intercept`` it stays 0.

    Returns (coefficients R x (k+1), intercept first; per-model metrics
    DataFrame with columns ``rep`` and ``converged`` — in-sample, or on the
    held-out fold; converged flags)."""
    Cs = np.asarray(Cs, dtype=float)
    k = len(features)
    if draws not in ("exact", "poisson"):
        raise ValueError(f"draws {draws!r}")
    exact = seed is not None and draws == "exact"
    replicates = len(Cs) if replicates is None else replicates
    if len(Cs) % replicates or (replicates < len(Cs) and not exact):
        raise ValueError(f"{len(Cs)} models on {replicates} replicates")
    rows = weighted_blocks(drawn_blocks(df, label, features, replicates, seed), seed) if exact else _frame(df, key, label, features, fold_col)
    # weighted blocks are large: Spark's cache asks for memory after every 16 batches only, 4 MB each and more, in every task
    rows = rows.persist(StorageLevel.DISK_ONLY if exact else StorageLevel.MEMORY_AND_DISK)
    try:
        rows.count()  # stored partition by partition: a task that streams several then holds no join or sort of theirs
        tasks = partial_tasks(df)
        data = rows.coalesce(tasks)
        beta = cells = None
        if exact:
            pivot = _newton(data.drop("w"), k, Cs[:1], None, balanced, max_iter, tol, None, True, intercept, tasks, 1)[0][0]
            beta, cells, converged = _near(data, k, Cs, replicates, balanced, max_iter, tol, intercept, tasks, pivot)
        if cells is None:
            beta, cells, converged = _newton(data, k, Cs, seed, balanced, max_iter, tol, fold_col, exact, intercept, tasks, replicates, beta)
    finally:
        rows.unpersist()
    from strata.operators.evaluate import metric_columns
    rows = [(r, *map(int, cells[r]), bool(converged[r])) for r in range(len(Cs))]
    out = df.sparkSession.createDataFrame(rows, "rep long, tp long, fp long, fn long, tn long, converged boolean")
    return beta, out.select("rep", "tp", "fp", "fn", "tn", *metric_columns(), "converged"), converged


def _drawn(frames, k: int, replicates: int | None):
    """(X without the intercept, y, W) of BLOCK rows at most, from weighted
    blocks; without replicates one model of all rows."""
    for frame in frames:
        for i, (y, x, m) in enumerate(zip(frame["y"], frame["x"], frame["m"])):
            y, x = np.asarray(y), np.asarray(x).reshape(-1, k)
            W = np.asarray(m)[:, None] if replicates is None else block_weights(frame["w"].iat[i], frame["w_bytes"].iat[i], replicates, len(y)).T
            for lo in range(0, len(y), BLOCK):
                yield x[lo:lo + BLOCK], y[lo:lo + BLOCK], W[lo:lo + BLOCK].astype(np.float64)


def _drawn_classes(frames, k: int, replicates: int | None, intercept: bool, block: int = BLOCK):
    """(class, X, W of replicates x rows) of ``block`` rows at most of one class."""
    for frame in frames:
        for i, (y, x, m) in enumerate(zip(frame["y"], frame["x"], frame["m"])):
            y, x = np.asarray(y), np.asarray(x).reshape(-1, k)
            X = np.column_stack([np.full(len(y), float(intercept)), x])
            W = np.asarray(m)[None, :] if replicates is None else block_weights(frame["w"].iat[i], frame["w_bytes"].iat[i], replicates, len(y))
            first = int((y != 1.0).sum())  # the rows of a leaf are in the order of their labels
            for c, start, end in ((0, 0, first), (1, first, len(y))):
                for lo in range(start, end, block):
                    hi = min(end, lo + block)
                    yield c, X[lo:hi], W[:, lo:hi].astype(np.float64)


def _class_weights(nc: np.ndarray, balanced: bool) -> np.ndarray:
    """models x 2 from the models' weighted class sizes."""
    if not balanced:
        return np.ones(nc.shape)
    with np.errstate(divide="ignore"):
        return np.where(nc > 0, nc.sum(axis=1, keepdims=True) / (2.0 * nc), 0.0)


def _near(data: DataFrame, k: int, Cs: np.ndarray, replicates: int, balanced: bool, max_iter: int, tol: float, intercept: bool, tasks: int, pivot: np.ndarray):
    """(coefficients, confusion cells, converged) of replicates of exact draws,
    from the derivatives of their losses at ``pivot``, corrected by true
    gradients; no cells and the coefficients so far, if any, where steps do not
    shrink fast."""
    k1, B, models = k + 1, replicates, len(Cs)
    two = np.triu_indices(k1)
    width, schema = 1 + k1 + len(two[0]), "rep long, vals array<double>"

    def derivatives(it):
        sums = np.zeros((B, 2, width))
        for c, X, W in _drawn_classes(it, k, B, intercept):
            p = 1.0 / (1.0 + np.exp(-(X @ pivot)))
            sums[:, c] += W @ np.hstack([np.ones((len(X), 1)), X * (c - p)[:, None], X[:, two[0]] * X[:, two[1]] * (p * (1.0 - p))[:, None]])
        yield pd.DataFrame({"rep": np.arange(B), "vals": list(sums.reshape(B, -1))})

    def third(it):
        n, sums = np.zeros((2, 1)), np.zeros((2, len(two[0]), k1))
        for c, X, m in _drawn_classes(it, k, None, intercept):
            p = 1.0 / (1.0 + np.exp(-(X @ pivot)))
            n[c] += m.sum()
            sums[c] += (X[:, two[0]] * X[:, two[1]]).T @ (X * (m[0] * p * (1.0 - p) * (1.0 - 2.0 * p))[:, None])
        yield pd.DataFrame({"rep": [0, 1], "vals": list(np.hstack([n, sums.reshape(2, -1)]))})

    sums = _reduce(data.mapInPandas(derivatives, schema), B, 2 * width, tasks).reshape(B, 2, width)
    nc = sums[:, :, 0]
    if (nc == 0).any():  # a replicate of one class
        return None, None, None
    cw = _class_weights(nc, balanced)
    total = np.einsum("bc,bcw->bw", cw, sums)
    of = np.arange(models) % B  # the replicate of a model
    grad, H = total[of, 1:1 + k1], np.zeros((B, k1, k1))
    H[:, two[0], two[1]] = H[:, two[1], two[0]] = total[:, 1 + k1:]
    H, cw, nc = H[of], cw[of], nc[of]
    sums = _reduce(data.drop("w").mapInPandas(third, schema), 2, 1 + len(two[0]) * k1, tasks)
    T = np.zeros((2, k1, k1, k1))
    T[:, two[0], two[1]] = T[:, two[1], two[0]] = sums[:, 1:].reshape(2, len(two[0]), k1)
    share = cw * nc / sums[:, 0]  # of a class's third derivatives in a model's
    penalty = np.eye(k1)
    penalty[0, 0] = 0.0 if intercept else 1.0  # without an intercept its column is 0
    C = Cs[:, None, None]

    def solve(J, g):
        return np.linalg.solve(J, g[:, :, None])[:, :, 0]

    delta = np.zeros((models, k1))
    J = C * H + penalty
    try:
        for _ in range(max_iter):  # Newton's method on the expansion
            Td = sum((share[:, c:c + 1] * delta @ T[c].reshape(k1, -1)).reshape(H.shape) for c in (0, 1))
            J = C * (H + Td) + penalty
            g = Cs[:, None] * (grad - np.einsum("bij,bj->bi", H + 0.5 * Td, delta)) - (pivot + delta) @ penalty
            step = solve(J, g)
            delta = delta + step
            if not np.isfinite(delta).all() or np.abs(step).max() < tol / 10:
                break
    except np.linalg.LinAlgError:
        return None, None, None
    if not np.isfinite(delta).all():
        return None, None, None
    beta, last = pivot + delta, np.inf
    for _ in range(max_iter):
        now = beta.copy()

        def gradients(it, now=now):
            out = np.zeros((models, k1 + 2))
            for c, X, W in _drawn_classes(it, k, B, intercept, CACHED):
                for lo in range(0, models, B):
                    some = slice(lo, lo + B)
                    z = now[some] @ X.T
                    out[some, k1 + c] += np.einsum("br,br->b", W, z > 0)
                    np.negative(z, out=z)
                    np.exp(z, out=z)
                    z += 1.0
                    np.reciprocal(z, out=z)
                    np.subtract(float(c), z, out=z)
                    z *= W
                    out[some, :k1] += cw[some, c:c + 1] * (z @ X)
            yield pd.DataFrame({"rep": np.arange(models), "vals": list(out)})

        red = _reduce(data.mapInPandas(gradients, schema), models, k1 + 2, tasks)
        step = solve(J, Cs[:, None] * red[:, :k1] - beta @ penalty)
        size = np.abs(step).max(axis=1)
        if not np.isfinite(size).all():
            return None, None, None
        if size.max() < tol:
            fp, tp = np.rint(red[:, k1]), np.rint(red[:, k1 + 1])
            return beta, np.column_stack([tp, fp, nc[:, 1] - tp, nc[:, 0] - fp]), size < tol
        if size.max() > last / 4:
            break
        beta, last = beta + step, size.max()
    return beta, None, None


def _newton(data: DataFrame, k: int, Cs: np.ndarray, seed, balanced: bool, max_iter: int, tol: float, fold_col, exact: bool, intercept: bool, tasks: int, replicates: int, start: np.ndarray | None = None):
    """(coefficients, confusion cells, converged) of the models, from ``start`` or 0."""
    k1 = k + 1
    iu = np.triu_indices(k1)
    B = len(Cs)
    xcols = [f"_x{i}" for i in range(k)]
    models = np.arange(B)

    def batches(it, evaluate=False):
        if exact:
            for x, y, W in _drawn(it, k, None if seed is None else replicates):
                yield np.column_stack([np.full(len(y), float(intercept)), x]), y, np.tile(W, (1, B // W.shape[1]))
            return
        for pdf in (frame.iloc[i:i + BLOCK] for frame in it for i in range(0, len(frame), BLOCK)):
            X = np.column_stack([np.full(len(pdf), float(intercept))] + [pdf[c].to_numpy() for c in xcols])
            if fold_col is not None:
                fold = pdf["_fold"].to_numpy()[:, None]
                W = (fold == models[None, :]) if evaluate else (fold != models[None, :])
                W = W.astype(np.float64)
            elif seed is not None:
                W = replicate_weights(pdf["_key"].to_numpy(), B, seed)
            else:
                W = np.ones((len(pdf), B))
            yield X, pdf["_y"].to_numpy(), W

    # pass 0: weighted class sizes per model -> balanced class weights
    def class_counts(it):
        acc = np.zeros((B, 2))
        for X, y, W in batches(it):
            acc[:, 0] += W[y == 0].sum(axis=0)
            acc[:, 1] += W[y == 1].sum(axis=0)
        yield pd.DataFrame({"rep": np.arange(B), "vals": list(acc)})

    schema = "rep long, vals array<double>"
    nc = _reduce(data.mapInPandas(class_counts, schema), B, 2, tasks)
    cw = _class_weights(nc, balanced)

    beta = np.zeros((B, k1)) if start is None else start
    penalty = np.eye(k1)
    penalty[0, 0] = 0.0
    converged = np.zeros(B, dtype=bool)
    before, lowest = beta.copy(), np.full(B, np.inf)
    for _ in range(max_iter):
        b_now, cw_now = beta.copy(), cw

        def newton_parts(it, b_now=b_now, cw_now=cw_now):
            H = np.zeros((B, len(iu[0])))
            g, loss = np.zeros((B, k1)), np.zeros((B, 1))
            for X, y, W in batches(it):
                sw = W * np.where(y[:, None] == 1.0, cw_now[None, :, 1], cw_now[None, :, 0])
                z = X @ b_now.T
                p = 1.0 / (1.0 + np.exp(-z))
                g += (X.T @ (sw * (y[:, None] - p))).T
                H += (sw * p * (1.0 - p)).T @ (X[:, iu[0]] * X[:, iu[1]])
                loss[:, 0] += (sw * (np.logaddexp(0.0, z) - y[:, None] * z)).sum(axis=0)
            yield pd.DataFrame({"rep": np.arange(B), "vals": list(np.hstack([H, g, loss]))})

        red = _reduce(data.mapInPandas(newton_parts, schema), B, len(iu[0]) + k1 + 1, tasks)
        loss = Cs * red[:, -1] + 0.5 * (beta[:, 1:] ** 2).sum(axis=1)
        step = np.zeros_like(beta)
        for r in range(B):
            if loss[r] > lowest[r] + 1e-9 * abs(lowest[r]):  # the last step went too far
                step[r] = (before[r] - beta[r]) / 2
                continue
            before[r], lowest[r] = beta[r], loss[r]
            Hr = np.zeros((k1, k1))
            Hr[iu] = red[r, :len(iu[0])]
            Hr = Hr + np.triu(Hr, 1).T
            grad = Cs[r] * red[r, len(iu[0]):-1] - penalty @ beta[r]
            step[r] = np.linalg.lstsq(Cs[r] * Hr + penalty, grad, rcond=None)[0]
        beta = beta + step
        converged = np.abs(step).max(axis=1) < tol
        if converged.all():
            break

    b_fin = beta.copy()

    def scores(it):
        acc = np.zeros((B, 4))
        for X, y, W in batches(it, evaluate=True):
            pred = (X @ b_fin.T) > 0.0
            yy = (y[:, None] == 1.0)
            acc[:, 0] += (W * (pred & yy)).sum(axis=0)
            acc[:, 1] += (W * (pred & ~yy)).sum(axis=0)
            acc[:, 2] += (W * (~pred & yy)).sum(axis=0)
            acc[:, 3] += (W * (~pred & ~yy)).sum(axis=0)
        yield pd.DataFrame({"rep": np.arange(B), "vals": list(acc)})

    return beta, _reduce(data.mapInPandas(scores, schema), B, 4, tasks), converged


def bootstrap_logreg(df: DataFrame, features: Sequence[str], label: str, key: str,
                     replicates: int = 1000, C: float = 1.0, balanced: bool = True,
                     seed: int = 11, max_iter: int = 30, tol: float = 1e-9, draws: str = "poisson"):
    """B bootstrap refits, fitted together: Poisson weights, or ("exact") n
    rows drawn with replacement for each."""
    return batched_logreg(df, features, label, key, [C] * replicates, seed=seed,
                          balanced=balanced, max_iter=max_iter, tol=tol, draws=draws)


def bootstrap_logreg_grid(df: DataFrame, features: Sequence[str], label: str, key: str, Cs,
                          replicates: int = 1000, balanced: bool = True, seed: int = 11,
                          max_iter: int = 30, tol: float = 1e-9) -> list[DataFrame]:
    """For each C value the metrics of B refits on exact draws, as
    ``bootstrap_logreg`` gives them; a replicate's rows are drawn once for all."""
    _, per_rep, _ = batched_logreg(df, features, label, key, np.repeat(np.asarray(Cs, float), replicates), seed=seed, balanced=balanced,
                                   max_iter=max_iter, tol=tol, draws="exact", replicates=replicates)
    model = F.floor(F.col("rep") / replicates)
    return [per_rep.where(model == i).withColumn("rep", F.col("rep") - i * replicates) for i in range(len(Cs))]


def grid_logreg(df: DataFrame, features: Sequence[str], label: str, key: str, Cs,
                balanced: bool = True, max_iter: int = 30, tol: float = 1e-9, intercept: bool = True):
    """One model per C value over the same rows, fitted together (a whole
    regularisation path in ~8 passes over the data instead of one
    optimiser run per C)."""
    return batched_logreg(df, features, label, key, Cs, seed=None, balanced=balanced,
                          max_iter=max_iter, tol=tol, intercept=intercept)


def cv_logreg(df: DataFrame, features: Sequence[str], label: str, key: str, fold_col: str,
              folds: int, C: float = 1.0, balanced: bool = True, max_iter: int = 30,
              tol: float = 1e-9):
    """k-fold cross-validation: the k fold models fitted together, each scored
    on its held-out fold (class weights balanced on its training folds)."""
    return batched_logreg(df, features, label, key, [C] * folds, balanced=balanced,
                          max_iter=max_iter, tol=tol, fold_col=fold_col)
