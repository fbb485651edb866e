"""Separation: directions in which an unpenalised logit has no finite fit.

A direction d separates if no row lies on the wrong side of it: with s = +1
for label 1 and -1 for label 0, s x.d >= 0 for all rows and > 0 for some.  The
likelihood then rises for ever along d.  If no row lies on the border either,
the separation is complete, else quasi-complete.

Such a direction is found where the fit runs off to: two ridge fits with a very
weak and a much weaker penalty differ along it, and agree wherever the fit is
finite.  The difference is only a candidate: it is cleaned of what does not
grow, and one aggregate over all rows then proves it or turns it down.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.bootstrap import grid_logreg

WEAK = (1e4, 1e6, 1e8)  # C of the fits, for each row
GROWS = (0.02, 0.1, 0.3)  # share of the largest growth below which a coefficient stands still
TOLERANCE = 1e-9


@dataclass(frozen=True)
class Separation:
    kind: str  # "complete" or "quasi-complete"
    columns: tuple[str, ...]  # those in the direction, largest coefficient first
    direction: tuple[float, ...]

    def __str__(self) -> str:
        return f"{self.kind} separation by {', '.join(self.columns)}"


def _proved(df: DataFrame, features: list[str], label: str, directions: list[np.ndarray]):
    """For each direction (least, largest signed margin, largest |margin|), in one aggregate."""
    sign = F.when(F.col(label).cast("double") == 1.0, F.lit(1.0)).otherwise(F.lit(-1.0))
    aggs = []
    for i, d in enumerate(directions):
        margin = F.lit(float(d[0]))
        for f, c in zip(features, d[1:]):
            if c:
                margin = margin + F.col(f).cast("double") * F.lit(float(c))
        aggs += [F.min(sign * margin).alias(f"lo{i}"), F.max(sign * margin).alias(f"hi{i}")]
    row = df.agg(*aggs).first()
    return [(row[f"lo{i}"], row[f"hi{i}"]) for i in range(len(directions))]


def find_separation(df: DataFrame, features: Sequence[str], label: str, fit_intercept: bool = False) -> Separation | None:
    """A separating direction of the rows without nulls, or None.  Features
    are brought to a largest absolute value of 1 for the search."""
    features = list(features)
    rows = df.na.drop(subset=[*features, label]).select(F.col(label).alias("_label"), *[F.col(f).cast("double").alias(f"_f{i}") for i, f in enumerate(features)])
    names = [f"_f{i}" for i in range(len(features))]
    stats = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("_label").cast("double") == 1.0).alias("ones"), *[F.max(F.abs(c)).alias(c) for c in names]).first()
    n, ones = stats["n"], stats["ones"]
    if not n:
        return None
    if fit_intercept and ones in (0, n):
        return Separation("complete", ("intercept",), (1.0 if ones else -1.0, *[0.0] * len(features)))
    scale = np.array([stats[c] or 1.0 for c in names])
    scaled = rows.select("_label", *[(F.col(c) / F.lit(float(s))).alias(c) for c, s in zip(names, scale)], F.lit(0).alias("_key"))
    beta, _, _ = grid_logreg(scaled, names, "_label", "_key", WEAK, balanced=False, max_iter=60, tol=1e-7, intercept=fit_intercept)
    candidates = []
    for a in range(len(WEAK) - 1):
        growth = (beta[a + 1] - beta[a]) / np.log(WEAK[a + 1] / WEAK[a])
        most = np.abs(growth).max()
        if most < 1e-3:  # the fit stands still
            continue
        candidates += [np.where(np.abs(growth) >= share * most, growth / most, 0.0) for share in (0.0, *GROWS)]
        # rows on the border need an exact direction: of counts and 0/1 columns it is one of small fractions
        own = growth / np.append(1.0, scale)
        own /= np.abs(own).max()
        candidates += [np.round(np.where(np.abs(own) >= share, own, 0.0) * parts) / parts * np.append(1.0, scale) for share in GROWS for parts in (1, 60)]
    if not candidates:
        return None
    for d, (low, high) in zip(candidates, _proved(scaled, names, "_label", candidates)):
        if low >= -TOLERANCE and high > 1e-6:
            unscaled = d[1:] / scale
            order = np.argsort(-np.abs(d[1:]), kind="stable")
            columns = tuple(features[i] for i in order if d[1 + i])
            return Separation("complete" if low > 1e-6 else "quasi-complete", columns or ("intercept",), (float(d[0]), *map(float, unscaled)))
    return None
