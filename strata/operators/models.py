"""Binary classifiers on Spark ML.

Fitting is distributed by Spark ML itself (gradient / statistics aggregation
over partitions); the driver only holds coefficients and tree structures.

Logistic regression in the C form ``0.5 ||b||^2 + C * sum_i w_i logloss_i``
(intercept unpenalised) is Spark's objective
``(1/W) sum_i w_i logloss_i + regParam/2 ||b||^2`` with ``regParam =
1 / (C * W)``, ``W = sum_i w_i``, no standardisation and no L1 part.
``class_weight="balanced"`` is the row weight n / (2 * n_class), so W = n.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.classification import (
    DecisionTreeClassifier, LogisticRegression, RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LABEL = "label"
WEIGHT = "weight"


def prepare(df: DataFrame, features: Sequence[str], label: str, balanced: bool = False,
            weight: str | None = None) -> tuple[DataFrame, float]:
    """Assemble the feature vector, a double label and a row weight.
    Returns the frame and W, the sum of weights (one small aggregate)."""
    data = VectorAssembler(inputCols=list(features), outputCol="features",
                           handleInvalid="error").transform(df)
    data = data.withColumn(LABEL, F.col(label).cast("double"))
    counts = data.agg(F.count(F.lit(1)).alias("n"), F.sum(LABEL).alias("n1")).first()
    n, n1 = int(counts["n"]), float(counts["n1"] or 0.0)
    if balanced:
        w1 = n / (2.0 * n1) if n1 else 0.0
        w0 = n / (2.0 * (n - n1)) if n - n1 else 0.0
        w = F.when(F.col(LABEL) == 1.0, F.lit(w1)).otherwise(F.lit(w0))
    elif weight:
        w = F.col(weight).cast("double")
    else:
        w = F.lit(1.0)
    data = data.withColumn(WEIGHT, w)
    total = float(n) if (balanced or not weight) else float(data.agg(F.sum(WEIGHT)).first()[0])
    return data, total


def fit_logreg(df: DataFrame, features: Sequence[str], label: str, C: float = 1.0,
               balanced: bool = False, weight: str | None = None, max_iter: int = 100,
               tol: float = 1e-6):
    data, total = prepare(df, features, label, balanced, weight)
    lr = LogisticRegression(featuresCol="features", labelCol=LABEL, weightCol=WEIGHT,
                            regParam=1.0 / (C * total), elasticNetParam=0.0,
                            standardization=False, fitIntercept=True, maxIter=max_iter, tol=tol,
                            family="binomial")
    return lr.fit(data)


def logreg_coefficients(model, features: Sequence[str]) -> list[tuple[str, float]]:
    return [("intercept", float(model.intercept))] + [
        (f, float(c)) for f, c in zip(features, model.coefficients.toArray())]


def logit_inference(df: DataFrame, features: Sequence[str], label: str,
                    fit_intercept: bool = False):
    """Unpenalised logit (IRLS on Spark's normal equations) with standard
    errors, z statistics and two-sided p-values, rows with nulls dropped.
    Returns (rows, extra): rows = [(feature, coef, std_err, z, p_value)],
    extra = log-likelihoods and McFadden's pseudo R^2 against the
    intercept-only model.  Data that some direction of the features separates
    have no finite fit: raises with the names (``operators.separation``), looked
    for where the fit's signs say so."""
    d = df.na.drop(subset=list(features) + [label])
    data = VectorAssembler(inputCols=list(features), outputCol="features").transform(d) \
        .withColumn(LABEL, F.col(label).cast("double"))
    glm = GeneralizedLinearRegression(family="binomial", link="logit", featuresCol="features",
                                      labelCol=LABEL, fitIntercept=fit_intercept, maxIter=100,
                                      tol=1e-10, regParam=0.0)
    data = data.select("features", LABEL).persist(StorageLevel.MEMORY_AND_DISK)  # read once for each iteration
    try:
        rows, extra = _inference(glm, data, list(features), fit_intercept)
    finally:
        data.unpersist()
    if extra["doubtful"]:
        from strata.operators.separation import find_separation

        found = find_separation(d, features, label, fit_intercept)
        if found:
            raise ValueError(f"the logit has no finite fit: {found}")
    return rows, extra


def _inference(glm, data: DataFrame, features: list[str], fit_intercept: bool):
    m = glm.fit(data)
    s = m.summary
    try:
        s.coefficientStandardErrors
    except Exception as e:
        raise ValueError(f"the features are collinear: {', '.join(collinear(data, features, fit_intercept))}") from e
    names = list(features) + (["intercept"] if fit_intercept else [])
    coefs = list(m.coefficients.toArray()) + ([m.intercept] if fit_intercept else [])
    rows = [(n, float(c), float(se), float(z), float(p)) for n, c, se, z, p in
            zip(names, coefs, s.coefficientStandardErrors, s.tValues, s.pValues)]
    ll = -0.5 * float(s.deviance)  # binary labels: saturated log-likelihood is 0
    cnt = data.agg(F.count(F.lit(1)).alias("n"), F.sum(LABEL).alias("n1")).first()
    n, n1 = float(cnt["n"]), float(cnt["n1"])
    p = n1 / n
    ll0 = n1 * math.log(p) + (n - n1) * math.log(1 - p) if 0 < p < 1 else 0.0
    # a coefficient that runs off stops somewhere, with an error far above that of any fit
    doubtful = m.summary.numIterations >= 25 or any(not math.isfinite(se) or se > 10 * max(1.0, abs(c)) for _, c, se, _, _ in rows) or ll > -1e-6 * n
    extra = {"doubtful": doubtful, "log_likelihood": ll, "null_log_likelihood": ll0,
             "pseudo_r2": (1.0 - ll / ll0) if ll0 else None, "n": int(n)}
    return rows, extra


def collinear(data: DataFrame, features: list[str], fit_intercept: bool) -> list[str]:
    """Features that the ones before them (and the intercept) determine, read
    off their Gram matrix; a constant zero column is one."""
    k = len(features)
    cols = vector_to_array("features")
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    row = data.select(*[F.sum(cols[i] * cols[j]) for i, j in pairs], *[F.sum(cols[i]) for i in range(k)], F.count(F.lit(1))).first()
    gram = np.zeros((k + 1, k + 1))  # the intercept first
    for (i, j), v in zip(pairs, row):
        gram[i + 1, j + 1] = gram[j + 1, i + 1] = v
    gram[0, 1:] = gram[1:, 0] = row[len(pairs):-1]
    gram[0, 0] = row[-1]
    kept, out = [0] if fit_intercept else [], []
    for i in range(1, k + 1):
        with_i = gram[np.ix_(kept + [i], kept + [i])]
        scale = np.sqrt(np.maximum(np.diag(with_i), 1e-300))
        if np.linalg.matrix_rank(with_i / np.outer(scale, scale), tol=1e-8) <= len(kept) or gram[i, i] == 0:
            out.append(features[i - 1])
        else:
            kept.append(i)
    return out


def fit_tree(df: DataFrame, features: Sequence[str], label: str, depth: int = 3, seed: int = 43,
             balanced: bool = False, max_bins: int = 256):
    data, _ = prepare(df, features, label, balanced)
    return DecisionTreeClassifier(featuresCol="features", labelCol=LABEL, weightCol=WEIGHT,
                                  maxDepth=depth, impurity="gini", seed=seed,
                                  maxBins=max_bins).fit(data)


def fit_forest(df: DataFrame, features: Sequence[str], label: str, n_trees: int = 100,
               depth: int = 3, seed: int = 43, max_bins: int = 256):
    data, _ = prepare(df, features, label)
    return RandomForestClassifier(featuresCol="features", labelCol=LABEL, weightCol=WEIGHT,
                                  numTrees=n_trees, maxDepth=depth, seed=seed,
                                  featureSubsetStrategy="sqrt", subsamplingRate=1.0,
                                  bootstrap=True, impurity="gini", maxBins=max_bins).fit(data)


def predict(model, df: DataFrame, features: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """``keep`` columns + ``prediction`` (int) + ``p1`` (positive-class probability)."""
    data = VectorAssembler(inputCols=list(features), outputCol="features",
                           handleInvalid="error").transform(df)
    out = model.transform(data)
    return out.select(*keep, F.col("prediction").cast("int").alias("prediction"),
                      vector_to_array("probability")[1].alias("p1"))


IMPORTANCE_SCHEMA = T.StructType([T.StructField("feature", T.StringType()),
                                  T.StructField("importance", T.DoubleType())])


def feature_importance(spark, model, features: Sequence[str]) -> DataFrame:
    """Impurity importances next to the names the model was fitted on."""
    imp = model.featureImportances.toArray()
    return spark.createDataFrame([(f, float(v)) for f, v in zip(features, imp)],
                                 IMPORTANCE_SCHEMA)
