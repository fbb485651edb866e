"""Fit-once / apply-anywhere feature pipeline.

``FeaturePipeline.fit(train)`` computes a handful of statistics with Spark
aggregates (bin edges from min/max, the exact median, the mode, min/max for
scaling, the sorted category lists) and returns a ``FeatureModel`` that holds
only those constants.  ``FeatureModel.transform(df)`` is then a single
projection of built-in expressions with literal parameters: no join, no
shuffle, one whole-stage-codegen span, applicable to train, held-out or
scoring rows alike (bin edges are never refitted on another set).

Conventions (chosen to match the reference's library defaults):
* equal-width cut, right-closed intervals, lowest edge lowered by 0.1 % of
  the range; values outside the fitted range are clamped to the end bins;
* min-max scaling (x - min) / (max - min); a constant column scales by 1;
* one-hot columns in sorted category order, named ``<column>_<value>``, one
  name for each category; an unseen category raises by default
  (``handle_unknown="ignore"`` gives all zeros).  A column of very many
  categories is better declared as ``one_hot_vector``: one sparse vector
  column ``<column>_vec`` by Spark ML's indexer and encoder;
* nulls (passenger spec): age -> training median, port -> training mode,
  scaled fare -> training mean of the scaled fare.

The steps are declared by a ``FeatureSpec``; ``PASSENGER_SPEC`` is the
passenger transformer, ``strata.plans.doc_queries.DOC_SPEC`` another one.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators import stats

# Bin labels of the two equal-width cuts.
FAMILY_LABELS = ("small_fam", "medium_fam", "large_fam")
SIBLING_LABELS = ("less_4", "over_4")


def safe_name(s) -> str:
    return re.sub(r"[^0-9A-Za-z]+", "_", str(s)).strip("_")


def category_names(column: str, categories) -> dict[str, str]:
    """Column name of each category: ``<column>_<value>`` with other
    characters folded to "_".  Categories that fold alike, or to nothing, get
    their UTF-8 bytes in hex appended, so no two share a name."""
    folded = [safe_name(c) for c in categories]
    out = {}
    for c, f in zip(categories, folded):
        plain = f and folded.count(f) == 1
        out[c] = f"{column}_{f}" if plain else f"{column}_{f}_x{str(c).encode().hex()}"
    if len(set(out.values())) != len(out):
        raise ValueError(f"categories of {column} share a column name")
    return out


def cut_edges(mn: float, mx: float, bins: int) -> list[float]:
    """Equal-width edges with the pandas range extension."""
    if mn == mx:
        adj = 0.001 * abs(mn) if mn != 0 else 0.001
        return list(np.linspace(mn - adj, mx + adj, bins + 1))
    edges = np.linspace(mn, mx, bins + 1)
    edges[0] -= (mx - mn) * 0.001
    return [float(e) for e in edges]


def cut_column(x: Column, edges: list[float], labels) -> Column:
    """Right-closed bins (e0, e1], (e1, e2], ...; out-of-range values clamp."""
    expr = None
    for e, lab in zip(edges[1:-1], labels[:-1]):
        cond = x <= F.lit(float(e))
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    last = F.lit(labels[-1])
    out = last if expr is None else expr.otherwise(last)
    return F.when(x.isNotNull(), out)


def minmax_column(x: Column, mn: float, mx: float) -> Column:
    rng = (mx - mn) if mx != mn else 1.0
    return (x - F.lit(float(mn))) / F.lit(float(rng))


def one_hot_columns(x: Column, name: str, categories, handle_unknown: str = "error") -> dict:
    out = {n: F.when(x.cast("string") == F.lit(str(c)), F.lit(1.0)).otherwise(F.lit(0.0))
           for c, n in category_names(name, categories).items()}
    if handle_unknown == "error" and out:
        known = x.cast("string").isin([str(c) for c in categories])
        guard = F.when(x.isNotNull() & ~known,
                       F.raise_error(F.concat(F.lit(f"unseen category in {name}: "),
                                              x.cast("string"))))
        first = next(iter(out))
        out[first] = F.coalesce(guard.cast("double"), out[first])
    return out


@dataclass(frozen=True)
class Cut:
    """Equal-width cut of ``src`` into ``bins`` labelled bins, named ``out``."""
    out: str
    src: str
    bins: int
    labels: tuple


@dataclass(frozen=True)
class FeatureSpec:
    """Cuts (applied first), then ordered transformer steps.  Step kinds:
    ``median_scale`` (impute train median, then min-max), ``scale`` (min-max,
    nulls -> train mean of the scaled value), ``one_hot``, ``mode_one_hot``
    (impute train mode, then one-hot), ``one_hot_vector`` (one sparse vector
    column).  Output columns follow step order."""
    cuts: tuple = ()
    steps: tuple = ()

    def columns(self, kind: str) -> list[str]:
        return [c for k, cols in self.steps if k == kind for c in cols]


# The passenger transformer: age (median, scale), five one-hot blocks, fare
# (scale), port (mode, one-hot).
PASSENGER_SPEC = FeatureSpec(
    cuts=(Cut("fam_size", "family_size", 3, FAMILY_LABELS),
          Cut("sib_sp_num", "sibsp", 2, SIBLING_LABELS)),
    steps=(("median_scale", ("age",)),
           ("one_hot", ("fam_size", "sib_sp_num", "sex", "pclass", "level_cabin")),
           ("scale", ("fare",)),
           ("mode_one_hot", ("embarked",))))


@dataclass
class FeatureModel:
    """Fitted constants; ``transform`` is a pure projection."""
    spec: FeatureSpec
    edges: dict[str, list[float]]
    medians: dict[str, float]
    modes: dict[str, str]
    ranges: dict[str, tuple[float, float]]
    fills: dict[str, float]
    categories: dict[str, list] = field(default_factory=dict)
    handle_unknown: str = "error"
    fill_from: str = "train"
    vectors: dict = field(default_factory=dict)

    # passenger-spec conveniences
    @property
    def family_edges(self):
        return self.edges.get("fam_size")

    @property
    def sibling_edges(self):
        return self.edges.get("sib_sp_num")

    @property
    def age_median(self):
        return self.medians.get("age")

    @property
    def port_mode(self):
        return self.modes.get("embarked")

    def binned(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c.out: cut_column(F.col(c.src), self.edges[c.out], c.labels)
                               for c in self.spec.cuts})

    def transform(self, df: DataFrame, keep=("passenger_id", "survived")) -> DataFrame:
        """Feature columns in step order, plus the kept columns that exist in
        ``df`` (the id and the label stay on the row)."""
        d = self.binned(df)
        for indexer, encoder in self.vectors.values():
            d = encoder.transform(indexer.transform(d))
        cols: dict[str, Column] = {}
        for kind, names in self.spec.steps:
            for c in names:
                if kind == "median_scale":
                    cols[c] = minmax_column(F.coalesce(F.col(c), F.lit(self.medians[c])),
                                            *self.ranges[c])
                elif kind == "scale":
                    scaled = minmax_column(F.col(c), *self.ranges[c])
                    fill = (d.select(F.avg(scaled)).scalar() if self.fill_from == "batch"
                            else F.lit(self.fills[c]))
                    cols[c] = F.coalesce(scaled, fill)
                elif kind == "one_hot":
                    cols.update(one_hot_columns(F.col(c), c, self.categories[c],
                                                self.handle_unknown))
                elif kind == "mode_one_hot":
                    cols.update(one_hot_columns(F.coalesce(F.col(c), F.lit(self.modes[c])), c,
                                                self.categories[c], self.handle_unknown))
                elif kind == "one_hot_vector":
                    cols[f"{c}_vec"] = F.col(f"{c}_vec")
                else:
                    raise ValueError(f"unknown step {kind!r}")
        kept = [c for c in keep if c in df.columns]
        return d.select(*kept, *[e.alias(n) for n, e in cols.items()])

    @property
    def feature_names(self) -> list[str]:
        names = []
        for kind, cols in self.spec.steps:
            for c in cols:
                if kind in ("median_scale", "scale"):
                    names.append(c)
                elif kind == "one_hot_vector":
                    names.append(f"{c}_vec")
                else:
                    names += category_names(c, self.categories[c]).values()
        return names


class FeaturePipeline:
    """Equal-width cuts, median/mode imputation, min-max scaling, one-hot."""

    def __init__(self, spec: FeatureSpec = PASSENGER_SPEC, handle_unknown: str = "error",
                 fill_from: str = "train"):
        self.spec = spec
        self.handle_unknown, self.fill_from = handle_unknown, fill_from

    def fit(self, df: DataFrame) -> FeatureModel:
        """A few small jobs over the (persisted) input: one aggregate of
        extremes and means, one exact median per median column, and one
        count per (column, value) that gives the category lists and the modes.
        A column's categories are part of the model (a column each); where
        there are too many for that, declare it ``one_hot_vector``."""
        spec = self.spec
        cut_outs = {c.out for c in spec.cuts}
        used = [c.src for c in spec.cuts] + [c for _, cols in spec.steps for c in cols
                                              if c not in cut_outs]
        # only the columns the fit reads are cached, once, for its few jobs
        df = df.select(*[stats.value_of(df, c).alias(c) for c in dict.fromkeys(used)]).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            return self._fit(df)
        finally:
            df.unpersist()

    def _fit(self, df: DataFrame) -> FeatureModel:
        spec = self.spec
        med_cols, scale_cols = spec.columns("median_scale"), spec.columns("scale")
        ranged = [c.src for c in spec.cuts] + med_cols + scale_cols
        aggs = [e for c in dict.fromkeys(ranged)
                for e in (F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}"))]
        aggs += [F.avg(c).alias(f"avg_{c}") for c in scale_cols]
        ext = df.agg(*aggs).first() if aggs else {}
        medians = {c: float(stats.median_of(df, c).first()["median"]) for c in med_cols}
        mode_cols = spec.columns("mode_one_hot")
        dtypes = dict(df.dtypes)
        # string mode columns get their mode from the category counts below;
        # others keep their own type's order for ties
        modes = {c: stats.mode_of(df, c).first()["mode"] for c in mode_cols
                 if dtypes[c] != "string"}
        edges = {c.out: cut_edges(float(ext[f"min_{c.src}"]), float(ext[f"max_{c.src}"]), c.bins)
                 for c in spec.cuts}
        ranges, fills = {}, {}
        for c in med_cols:
            ranges[c] = (min(float(ext[f"min_{c}"]), medians[c]),
                         max(float(ext[f"max_{c}"]), medians[c]))
        for c in scale_cols:
            lo, hi = float(ext[f"min_{c}"]), float(ext[f"max_{c}"])
            ranges[c] = (lo, hi)
            fills[c] = (float(ext[f"avg_{c}"]) - lo) / ((hi - lo) if hi != lo else 1.0)

        binned = df.withColumns(
            {c.out: cut_column(F.col(c.src), edges[c.out], c.labels) for c in spec.cuts})
        cat_cols = spec.columns("one_hot") + mode_cols
        cats: dict[str, list] = {c: [] for c in cat_cols}
        counts: dict[str, list] = {c: [] for c in cat_cols}
        if cat_cols:
            each = F.explode(F.array(*[F.struct(F.lit(c).alias("k"), F.col(c).cast("string").alias("v")) for c in cat_cols]))
            found = (binned.select(each.alias("p")).select("p.k", "p.v").where(F.col("v").isNotNull())
                     .groupBy("k", "v").agg(F.count(F.lit(1)).alias("n")).collect())
            for r in found:
                cats[r["k"]].append(r["v"])
                counts[r["k"]].append((-r["n"], r["v"]))
        for c, vals in cats.items():
            vals.sort()
            if c in mode_cols and c not in modes:
                modes[c] = min(counts[c])[1] if counts[c] else None
        vectors = {}
        for c in spec.columns("one_hot_vector"):
            keep = "error" if self.handle_unknown == "error" else "keep"
            indexer = StringIndexer(inputCol=c, outputCol=f"{c}_idx", stringOrderType="alphabetAsc", handleInvalid=keep).fit(binned)
            encoder = OneHotEncoder(inputCols=[f"{c}_idx"], outputCols=[f"{c}_vec"], dropLast=False, handleInvalid=keep)
            vectors[c] = (indexer, encoder.fit(indexer.transform(binned)))
        return FeatureModel(spec, edges, medians, modes, ranges, fills, cats,
                            self.handle_unknown, self.fill_from, vectors)


# Interaction terms (name, left feature, right feature).
INTERACTIONS = (("fem_family", "sex_female", "fam_size_small_fam"),
                ("female_age", "sex_female", "age"),
                ("fare_family", "fare", "fam_size_small_fam"))


def add_interactions(feats: DataFrame, terms=INTERACTIONS) -> DataFrame:
    """Products of two feature columns; a missing column raises."""
    missing = {c for _, a, b in terms for c in (a, b)} - set(feats.columns)
    if missing:
        raise ValueError(f"no feature {', '.join(sorted(missing))}")
    return feats.withColumns({name: F.col(a) * F.col(b) for name, a, b in terms})


# Feature subsets by the names the analysis meant (one-hot
# columns named by value), 17 features after the correlation screen, 11 after
# the p-values; and the cabin levels that the subsets name.
SUBSET_17 = ("age", "fam_size_small_fam", "fam_size_large_fam", "sex_female", "pclass_1",
             "pclass_3", "level_cabin_No_Cabin", "level_cabin_B", "level_cabin_F",
             "level_cabin_D", "level_cabin_G", "fare", "embarked_S", "embarked_Q",
             "fem_family", "female_age", "fare_family")
SUBSET_11 = ("age", "fam_size_large_fam", "sex_female", "pclass_3", "pclass_1", "level_cabin_D",
             "level_cabin_G", "fare", "embarked_Q", "female_age", "fare_family")
KNOWN_CABIN_LEVELS = ("A", "B", "C", "D", "E", "F", "G", "T", "No_Cabin")


def with_known_levels(feats: DataFrame, column: str = "level_cabin", levels=KNOWN_CABIN_LEVELS) -> DataFrame:
    """One-hot columns for known levels that no row has: all zero."""
    absent = [f"{column}_{v}" for v in levels if f"{column}_{v}" not in feats.columns]
    return feats.withColumns({c: F.lit(0.0) for c in absent})


def present(feats: DataFrame, names) -> tuple[list[str], list[str]]:
    """(members of the subset that are columns, members that are not)."""
    return [n for n in names if n in feats.columns], [n for n in names if n not in feats.columns]


def screen_redundant(feats: DataFrame, names, max_abs_r: float) -> DataFrame:
    """Pairs of features (col_a, col_b, r) whose correlation with each other
    reaches ``max_abs_r``: one of each says little beside the other.  All pairs
    come from one pass of block products."""
    from strata.operators.moments import corr_all

    return corr_all(feats, list(names)).drop("n").where(F.abs(F.col("r")) >= F.lit(max_abs_r))


def select_by_correlation(feats: DataFrame, names, label: str, min_abs_r: float) -> DataFrame:
    """Features whose |r| with the label reaches ``min_abs_r``."""
    c = stats.corr_pairs(feats, list(names), with_col=label)
    return c.where(F.abs(F.col("r")) >= F.lit(min_abs_r))
