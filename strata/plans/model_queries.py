"""Model and evaluation queries.

Two kinds of predictor are evaluated:

* group-rate rules (fitted on train by a grouped mean, applied to held-out
  rows by a join): their predictions, confusion cells, metrics, Poisson
  bootstrap and intervals are all SQL-expressible and carry an oracle;
* Spark ML models (logistic, tree, forest, GLM inference), which carry none.
"""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import replace

from pyspark import StorageLevel
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators import evaluate as ev
from strata.operators import models as M
from strata.operators.bootstrap import bootstrap_logreg, bootstrap_logreg_grid, cv_logreg, grid_logreg
from strata.operators.enrich import enrich
from strata.operators.forest import grow_forest
from strata.operators.features import SUBSET_11, SUBSET_17, FeaturePipeline, FeatureSpec, add_interactions, present
from strata.operators.split import check_folds, exact_folds, exact_split, fold_column, fold_sql, train_flag
from strata.plans.eda_queries import test_rows, train_rows
from strata.plans.feature_queries import test_features, train_features
from strata.plans.registry import query, rounded
from strata.plans.sql import PASSENGERS_CTE, SPLIT_CTE, TEST_CTE, TRAIN_CTE, with_
from strata.sources.tables import passengers

BOOT_B = 1000
BOOT_SEED = 7

# ------------------------------------------------------ group-rate rules


def rule_predictions(spark, sf_dir, key: str = "title"):
    """Predict 1 where the training survival rate of the row's group exceeds
    the overall training rate (unknown group -> overall rate -> 0)."""
    train = train_rows(spark, sf_dir)
    rates = train.groupBy(key).agg(F.avg("survived").alias("_rate"))
    overall = train.select(F.avg("survived")).scalar()
    test = test_rows(spark, sf_dir).select("passenger_id", "survived", key)
    j = test.join(rates, key, "left")
    return j.select("passenger_id", "survived",
                    F.when(F.coalesce(F.col("_rate"), overall) > overall, F.lit(1))
                    .otherwise(F.lit(0)).alias("prediction"))


def _rule_cte(key: str, name: str) -> str:
    return f"""
{name}_rates AS (SELECT {key}, avg(survived) AS rate FROM train GROUP BY {key}),
{name}_pred AS (
  SELECT t.passenger_id, t.survived,
         CASE WHEN COALESCE(r.rate, (SELECT avg(survived) FROM train))
                   > (SELECT avg(survived) FROM train) THEN 1 ELSE 0 END AS prediction
  FROM test t LEFT JOIN {name}_rates r ON t.{key} = r.{key})
"""


RULES = with_(PASSENGERS_CTE, SPLIT_CTE, TRAIN_CTE, TEST_CTE) + ", " + _rule_cte("title", "title") \
    + ", " + _rule_cte("sex", "sex")

D = "CAST({} AS DOUBLE)"
METRICS_SQL = (
    f"({D.format('tp')} + {D.format('tn')}) / NULLIF({D.format('tp')} + {D.format('fp')} + "
    f"{D.format('fn')} + {D.format('tn')}, 0) AS accuracy, "
    f"{D.format('tp')} / NULLIF({D.format('tp')} + {D.format('fp')}, 0) AS precision, "
    f"{D.format('tp')} / NULLIF({D.format('tp')} + {D.format('fn')}, 0) AS recall, "
    f"(CAST(2.0 AS DOUBLE) * {D.format('tp')}) / NULLIF(CAST(2.0 AS DOUBLE) * {D.format('tp')}"
    f" + {D.format('fp')} + {D.format('fn')}, 0) AS f1")


def _cells_sql(src: str, w: str = "1") -> str:
    return (f"CAST(sum(CASE WHEN prediction = 1 AND survived = 1 THEN {w} ELSE 0 END) AS BIGINT) AS tp, "
            f"CAST(sum(CASE WHEN prediction = 1 AND survived = 0 THEN {w} ELSE 0 END) AS BIGINT) AS fp, "
            f"CAST(sum(CASE WHEN prediction = 0 AND survived = 1 THEN {w} ELSE 0 END) AS BIGINT) AS fn, "
            f"CAST(sum(CASE WHEN prediction = 0 AND survived = 0 THEN {w} ELSE 0 END) AS BIGINT) AS tn "
            f"FROM {src}")


@query("confusion_counts", RULES + "SELECT " + _cells_sql("title_pred"))
def q_confusion_counts(spark, sf_dir):
    return ev.confusion_counts(rule_predictions(spark, sf_dir), "survived")


@query("classification_metrics", RULES + f", c AS (SELECT {_cells_sql('title_pred')}) "
       f"SELECT tp, fp, fn, tn, {METRICS_SQL} FROM c")
def q_classification_metrics(spark, sf_dir):
    """Accuracy, true precision and recall of the positive class, F1."""
    return ev.classification_metrics(rule_predictions(spark, sf_dir), "survived")


@query("accuracy_score", RULES + """
SELECT avg(CAST(prediction = survived AS INTEGER)) AS accuracy FROM title_pred
""")
def q_accuracy_score(spark, sf_dir):
    return ev.accuracy_score(rule_predictions(spark, sf_dir), "survived")


def _boot_sql(pred: str) -> str:
    w = ev.poisson_weight_sql(BOOT_SEED, "r.rep", "p.passenger_id")
    return f"""
{pred}_x AS (SELECT p.passenger_id, p.survived, p.prediction, r.rep, {w} AS w
             FROM {pred} p CROSS JOIN range(0, {BOOT_B}) AS r(rep)),
{pred}_boot AS (
  SELECT rep, tp, fp, fn, tn, {METRICS_SQL}
  FROM (SELECT rep, {_cells_sql(f'{pred}_x GROUP BY rep', 'w')}) c)
"""


BOOT_EVAL_SQL = RULES + ", " + _boot_sql("title_pred")


@query("bootstrap_eval", BOOT_EVAL_SQL + "SELECT * FROM title_pred_boot")
def q_bootstrap_eval(spark, sf_dir):
    """B = 1000 Poisson resamples of the held-out predictions, no refit."""
    return ev.bootstrap_eval(rule_predictions(spark, sf_dir), "passenger_id", "survived",
                             replicates=BOOT_B, seed=BOOT_SEED)


def _interval_sql(boot: str, model: str, metrics=("accuracy", "f1")) -> str:
    unions = " UNION ALL ".join(
        f"SELECT '{model}' AS model, '{m}' AS metric, {m} AS score FROM {boot}" for m in metrics)
    parts = []
    for lvl, k in ev.LEVEL_TAIL_PER_1000.items():
        kk = k * BOOT_B // 1000
        parts.append(
            f"SELECT model, metric, {lvl} AS level, "
            f"max(CASE WHEN rk = {kk + 1} THEN score END) AS lo, "
            f"max(CASE WHEN rk = {BOOT_B - kk} THEN score END) AS hi "
            f"FROM ranked_{model} GROUP BY model, metric")
    return (f"ranked_{model} AS (SELECT *, row_number() OVER (PARTITION BY model, metric "
            f"ORDER BY score) AS rk FROM ({unions}) s)", " UNION ALL ".join(parts))


def _intervals(spark, sf_dir, key: str, model: str, metrics=("accuracy", "f1")):
    per_rep = ev.bootstrap_eval(rule_predictions(spark, sf_dir, key), "passenger_id", "survived",
                                replicates=BOOT_B, seed=BOOT_SEED)
    scores = ev.long_scores(per_rep, metrics, model)
    return ev.order_stat_interval(scores, ["model", "metric"], "score", BOOT_B)


_ranked, _sel = _interval_sql("title_pred_boot", "title_rule")


@query("interval_table", BOOT_EVAL_SQL + ", " + _ranked + " " + _sel)
def q_interval_table(spark, sf_dir):
    """80/90/95 % bootstrap intervals of accuracy and F1 (ranks k+1, B-k)."""
    return _intervals(spark, sf_dir, "title", "title_rule")


_ranked_a, _sel_a = _interval_sql("title_pred_boot", "title_rule", ("accuracy",))


@query("order_stat_interval", BOOT_EVAL_SQL + ", " + _ranked_a + " " + _sel_a)
def q_order_stat_interval(spark, sf_dir):
    return _intervals(spark, sf_dir, "title", "title_rule", ("accuracy",))


_ranked_s, _sel_s = _interval_sql("sex_pred_boot", "sex_rule")


@query("stack_results", BOOT_EVAL_SQL + ", " + _boot_sql("sex_pred") + ", " + _ranked + ", "
       + _ranked_s + " " + _sel + " UNION ALL " + _sel_s)
def q_stack_results(spark, sf_dir):
    """Interval tables of two predictors stacked (duplicates kept); both are
    scored on the same draws, made once."""
    title, sex = rule_predictions(spark, sf_dir), rule_predictions(spark, sf_dir, "sex")
    both = title.select("passenger_id", "survived", F.col("prediction").alias("title_rule")).join(
        sex.select("passenger_id", F.col("prediction").alias("sex_rule")), "passenger_id")
    per_rep = ev.bootstrap_eval_many(both, "passenger_id", "survived", ["title_rule", "sex_rule"], replicates=BOOT_B, seed=BOOT_SEED)
    scores = per_rep.select("rep", "model", F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).alias("score")) for m in ("accuracy", "f1")])).alias("m")).select("rep", "model", "m.*")
    return ev.order_stat_interval(scores, ["model", "metric"], "score", BOOT_B)


HISTOGRAM_SQL = BOOT_EVAL_SQL + """
, s AS (SELECT 'accuracy' AS metric, accuracy AS score FROM title_pred_boot UNION ALL SELECT 'f1', f1 FROM title_pred_boot),
e AS (SELECT metric, min(score) AS mn, max(score) AS mx FROM s GROUP BY metric),
b AS (SELECT s.metric, CAST(LEAST(COALESCE(FLOOR((score - mn) / NULLIF((mx - mn) / 10.0, 0)), 0), 9) AS INTEGER) AS bin
      FROM s JOIN e ON e.metric = s.metric WHERE score IS NOT NULL)
SELECT metric, bin, CAST(count(*) AS BIGINT) AS n FROM b GROUP BY metric, bin
"""


def _score_histograms(per_rep, metrics=("accuracy", "f1")):
    """Ten equal-width bins of each metric's replicate scores."""
    from strata.operators.stats import histogram

    return _union([histogram(per_rep.select(F.col(m).alias("score")), "score", 10).select(F.lit(m).alias("metric"), "bin", "n") for m in metrics])


@query("bootstrap_histogram", HISTOGRAM_SQL)
def q_bootstrap_histogram(spark, sf_dir):
    """Histograms of bootstrap accuracy and F1 (the numbers under them); the
    replicates are drawn once and stored."""
    per_rep = q_bootstrap_eval(spark, sf_dir).checkpoint()
    return _score_histograms(per_rep)


@query("bootstrap_refit_histogram")
def q_bootstrap_refit_histogram(spark, sf_dir):
    """The same of refitted replicates."""
    return _score_histograms(q_bootstrap_refit(spark, sf_dir))


def _long_metrics_sql(pred: str, model: str) -> str:
    return (f"SELECT '{model}' AS model, metric, value FROM (SELECT {METRICS_SQL} FROM "
            f"(SELECT {_cells_sql(pred)}) c) UNPIVOT (value FOR metric IN "
            f"(accuracy, precision, recall, f1))")


@query("stack_metrics", RULES + _long_metrics_sql("title_pred", "title_rule") + " UNION ALL "
       + _long_metrics_sql("sex_pred", "sex_rule"))
def q_stack_metrics(spark, sf_dir):
    """Metrics of several models as long rows (model, metric, value)."""
    out = None
    for key, name in (("title", "title_rule"), ("sex", "sex_rule")):
        m = ev.classification_metrics(rule_predictions(spark, sf_dir, key), "survived")
        long = m.select(F.lit(name).alias("model"), F.explode(F.array(*[
            F.struct(F.lit(c).alias("metric"), F.col(c).alias("value"))
            for c in ("accuracy", "precision", "recall", "f1")])).alias("m")).select("model", "m.*")
        out = long if out is None else out.unionByName(long)
    return out


# ------------------------------------------------------------ Spark ML

FULL = "full"
def _union(frames):
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _feats(spark, sf_dir):
    return train_features(spark, sf_dir)


def _names(feats, subset):
    if subset == FULL:
        return [c for c in feats.columns if c not in ("passenger_id", "survived")]
    return present(feats, subset)[0]  # a cabin level that no row has would make the fit singular


METRIC_SCHEMA = "model string, tp bigint, fp bigint, fn bigint, tn bigint, accuracy double, " \
                "precision double, recall double, f1 double"


def _lr_metrics(feats, name, subset, C, balanced):
    names = _names(feats, subset)
    m = M.fit_logreg(feats, names, "survived", C=C, balanced=balanced)
    pred = M.predict(m, feats, names, ["passenger_id", "survived"])
    return ev.classification_metrics(pred, "survived").select(F.lit(name).alias("model"), "*")


@query("logreg_full")
def q_logreg_full(spark, sf_dir):
    """L2 logistic regression, C = 1, all features; in-sample metrics."""
    return _lr_metrics(_feats(spark, sf_dir)[0], "log full", FULL, 1.0, False)


@query("logreg_balanced")
def q_logreg_balanced(spark, sf_dir):
    return _lr_metrics(_feats(spark, sf_dir)[0], "log balanced", FULL, 1.0, True)


@query("logreg_regularized")
def q_logreg_regularized(spark, sf_dir):
    return _lr_metrics(_feats(spark, sf_dir)[0], "log regularized", FULL, 0.4, True)


@query("baseline_compare")
def q_baseline_compare(spark, sf_dir):
    """The three logistic baselines side by side (long rows); the two balanced
    ones, which differ in C only, are fitted together."""
    feats, _ = _feats(spark, sf_dir)
    _, balanced, _ = grid_logreg(feats, _names(feats, FULL), "survived", "passenger_id", (1.0, 0.4))
    names = F.element_at(F.array(F.lit("log balanced"), F.lit("log regularized")), F.col("rep").cast("int") + 1)
    plain = _lr_metrics(feats, "log full", FULL, 1.0, False)
    return plain.unionByName(balanced.select(names.alias("model"), *[c for c in plain.columns if c != "model"]))


# The regularisation grid.
C_GRID = (1.0, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1)


def c_sweep(spark, sf_dir):
    """Balanced logistic for every C of the grid, fitted together (batched
    Newton: one Spark job per pass for the whole grid); in-sample metrics."""
    feats, _ = _feats(spark, sf_dir)
    names = _names(feats, SUBSET_11)
    _, per_model, _ = grid_logreg(feats, names, "survived", "passenger_id", C_GRID)
    grid = F.array(*[F.lit(float(c)) for c in C_GRID])
    return per_model.select(F.element_at(grid, F.col("rep").cast("int") + 1).alias("C"),
                            "tp", "fp", "fn", "tn", "accuracy", "precision", "recall", "f1")


@query("logreg_c_sweep")
def q_logreg_c_sweep(spark, sf_dir):
    """Balanced logistic on the 11-feature subset for C = 1 .. 0.1."""
    return c_sweep(spark, sf_dir)


@query("max_of_metric")
def q_max_of_metric(spark, sf_dir):
    """Best score over the C sweep and the C that reaches it, per metric."""
    sweep = c_sweep(spark, sf_dir)
    return sweep.select(F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).alias("score"), F.col("C").alias("C"))
        for m in ("accuracy", "precision", "recall", "f1")])).alias("s")).select("s.*") \
        .groupBy("metric").agg(F.max("score").alias("best"),
                               F.max_by("C", F.struct("score", "C")).alias("best_C"))


INFERENCE_SCHEMA = T.StructType([
    T.StructField("feature", T.StringType()), T.StructField("coef", T.DoubleType()),
    T.StructField("std_err", T.DoubleType()), T.StructField("z", T.DoubleType()),
    T.StructField("p_value", T.DoubleType())])


def _inference(spark, sf_dir, subset):
    feats, _ = _feats(spark, sf_dir)
    rows, extra = M.logit_inference(feats, _names(feats, subset), "survived")
    return spark.createDataFrame(rows, INFERENCE_SCHEMA), extra


TITLE_ONLY = FeatureSpec(steps=(("one_hot", ("title",)),))


def _title_features(frame):
    """One-hot titles fitted on ``frame``: (features, model, names)."""
    model = FeaturePipeline(TITLE_ONLY, handle_unknown="ignore").fit(frame)
    return model.transform(frame), model, model.feature_names


# a logit on the one-hot columns of one key without an intercept is fitted group by group:
# coefficient ln(p / (1 - p)), standard error 1 / sqrt(n p (1 - p))
TITLE_LOGIT = with_(PASSENGERS_CTE, SPLIT_CTE, TRAIN_CTE) + """
, g AS (SELECT title, CAST(count(*) AS DOUBLE) AS n, avg(survived) AS p FROM train WHERE title IS NOT NULL GROUP BY title),
i AS (SELECT 'title_' || title AS feature, ln(p / (1 - p)) AS coef, 1 / sqrt(n * p * (1 - p)) AS std_err FROM g)
"""


def _title_inference(spark, sf_dir):
    feats, _, names = _title_features(train_rows(spark, sf_dir).where(F.col("title").isNotNull()))
    rows, _ = M.logit_inference(feats, names, "survived")
    return spark.createDataFrame(rows, INFERENCE_SCHEMA)


@query("logit_inference", TITLE_LOGIT + """
SELECT feature, round(coef, 6) AS coef, round(std_err, 6) AS std_err, round(coef / std_err, 5) AS z FROM i
""")
def q_logit_inference(spark, sf_dir):
    """Unpenalised logit on the titles' one-hot columns, no intercept."""
    out = _title_inference(spark, sf_dir)
    return out.select("feature", F.round("coef", 6).alias("coef"), F.round("std_err", 6).alias("std_err"), F.round("z", 5).alias("z"))


@query("logit_inference_17")
def q_logit_inference_17(spark, sf_dir):
    """Unpenalised logit without intercept on the 17-feature subset."""
    return _inference(spark, sf_dir, SUBSET_17)[0]


@query("logit_inference_11")
def q_logit_inference_11(spark, sf_dir):
    """The second fit: unpenalised logit on the 11-feature subset."""
    return _inference(spark, sf_dir, SUBSET_11)[0]


P_VALUE_CUT = 0.2


# the two-sided p-value stays below 0.2 where |z| passes this quantile of the normal distribution
Z_OF_CUT = 1.2815515655446004


@query("select_by_pvalue", TITLE_LOGIT + f"""
SELECT feature FROM i WHERE abs(coef / std_err) > {Z_OF_CUT}
""")
def q_select_by_pvalue(spark, sf_dir):
    """Features of the titles' logit whose p-value stays below the cut."""
    return _title_inference(spark, sf_dir).where(F.col("p_value") < P_VALUE_CUT).select("feature")


@query("select_by_pvalue_17")
def q_select_by_pvalue_17(spark, sf_dir):
    """Features of the 17 whose p-value stays below the cut."""
    inf, _ = _inference(spark, sf_dir, SUBSET_17)
    return inf.where(F.col("p_value") < P_VALUE_CUT).select("feature", "p_value")


def _tree_metrics(feats, name, subset, balanced, depth=3):
    names = _names(feats, subset)
    m = M.fit_tree(feats, names, "survived", depth=depth, seed=43, balanced=balanced)
    pred = M.predict(m, feats, names, ["passenger_id", "survived"])
    return ev.classification_metrics(pred, "survived").select(F.lit(name).alias("model"), "*"), \
        m, names


@query("tree_full")
def q_tree_full(spark, sf_dir):
    """Depth-3 gini tree, all features; in-sample metrics."""
    return _tree_metrics(_feats(spark, sf_dir)[0], "tree", FULL, False)[0]


@query("tree_depth_2")
def q_tree_depth_2(spark, sf_dir):
    """Depth-2 gini tree, all features; in-sample metrics."""
    return _tree_metrics(_feats(spark, sf_dir)[0], "tree depth 2", FULL, False, 2)[0]


@query("tree_balanced")
def q_tree_balanced(spark, sf_dir):
    return _tree_metrics(_feats(spark, sf_dir)[0], "tree balanced", SUBSET_11, True)[0]


FOREST_TREES = 1000
FOREST_SIZES = tuple(range(100, 1000, 100))


def _forest_metrics(feats, name, subset, sizes, depth):
    """(metrics of each size, the forest): grown once, scored in one pass."""
    forest = grow_forest(feats, _names(feats, subset), "survived", sizes, depth=depth, seed=43)
    votes = forest.votes(feats, ["survived"], sizes)
    metrics = ev.classification_metrics(votes, "survived", by=["n_trees"])
    return metrics.select(F.lit(name).alias("model"), "n_trees", F.lit(depth).alias("depth"), *[c for c in metrics.columns if c != "n_trees"]), forest


@query("forest_full")
def q_forest_full(spark, sf_dir):
    """1000 trees of depth 3, all features."""
    return _forest_metrics(_feats(spark, sf_dir)[0], "forest", FULL, [FOREST_TREES], 3)[0]


@query("forest_subset")
def q_forest_subset(spark, sf_dir):
    return _forest_metrics(_feats(spark, sf_dir)[0], "forest subset", SUBSET_11, [FOREST_TREES], 3)[0]


@query("forest_size_sweep")
def q_forest_size_sweep(spark, sf_dir):
    """Accuracy for 100 .. 900 trees (depth 3), full and subset features: the
    sizes are prefixes of one forest for each feature set."""
    feats, _ = _feats(spark, sf_dir)
    return _union([_forest_metrics(feats, name, subset, FOREST_SIZES, 3)[0] for subset, name in ((FULL, "forest"), (SUBSET_11, "forest subset"))])


@query("forest_depth_sweep")
def q_forest_depth_sweep(spark, sf_dir):
    """Depth 2 .. 5 on the subset; the tree count is its own parameter."""
    feats, _ = _feats(spark, sf_dir)
    return _union([_forest_metrics(feats, "forest subset", SUBSET_11, [100], depth)[0] for depth in range(2, 6)])


@query("feature_importance")
def q_feature_importance(spark, sf_dir):
    """Impurity importances of the four models: the depth-3 tree, the balanced
    subset tree, and the forests of 1000 trees on all features and the subset."""
    feats, _ = _feats(spark, sf_dir)
    found = []
    for name, subset, balanced in (("tree", FULL, False), ("tree balanced", SUBSET_11, True)):
        _, tree, names = _tree_metrics(feats, name, subset, balanced)
        found += [(name, f, float(v)) for f, v in zip(names, tree.featureImportances.toArray())]
    for name, subset in (("forest", FULL), ("forest subset", SUBSET_11)):
        forest = grow_forest(feats, _names(feats, subset), "survived", [FOREST_TREES], seed=43)
        found += [(name, f, float(v)) for f, v in zip(forest.features, forest.feature_importance())]
    return spark.createDataFrame(found, "model string, feature string, importance double")


FOLDS_SQL = with_(PASSENGERS_CTE, SPLIT_CTE, TRAIN_CTE) + f"""
, f AS (SELECT title, survived, {fold_sql('passenger_id', 5)} AS fold FROM train WHERE title IS NOT NULL),
k AS (SELECT DISTINCT fold FROM f),
o AS (SELECT k.fold, avg(f.survived) AS overall FROM k JOIN f ON f.fold <> k.fold GROUP BY k.fold),
r AS (SELECT k.fold, f.title, avg(f.survived) AS rate FROM k JOIN f ON f.fold <> k.fold GROUP BY k.fold, f.title),
p AS (SELECT f.fold, f.survived, CASE WHEN coalesce(r.rate, o.overall) > o.overall THEN 1 ELSE 0 END AS prediction
      FROM f JOIN o ON o.fold = f.fold LEFT JOIN r ON r.fold = f.fold AND r.title = f.title),
s AS (SELECT fold, tp, fp, fn, tn, {METRICS_SQL} FROM (SELECT fold, {_cells_sql('p GROUP BY fold')}) c)
"""


def _rule_folds(spark, sf_dir):
    """Five hash folds, checked to hold both classes: the title rule with the
    rates of the other folds (all rows' counts less the fold's own), scored on
    each fold."""
    rows = train_rows(spark, sf_dir).where(F.col("title").isNotNull()).withColumn("fold", fold_column("passenger_id", 5))
    check_folds(rows, "fold", "survived")
    n, s = F.count("survived"), F.sum("survived")
    own = rows.groupBy("fold", "title").agg(n.alias("n"), s.alias("s"))
    whole = own.groupBy("title").agg(F.sum("n").alias("tn"), F.sum("s").alias("ts"))
    fold = own.groupBy("fold").agg(F.sum("n").alias("fn"), F.sum("s").alias("fs"))
    everything = own.agg(F.struct(F.sum("n").alias("n"), F.sum("s").alias("s")).alias("x")).select("x").scalar()
    rates = (own.join(whole, "title").join(fold, "fold").withColumn("all_", everything)
             .select("fold", "title", F.try_divide(F.col("ts") - F.col("s"), F.col("tn") - F.col("n")).alias("rate"),
                     ((F.col("all_.s") - F.col("fs")) / (F.col("all_.n") - F.col("fn"))).alias("overall")))
    rule = F.when(F.coalesce("rate", "overall") > F.col("overall"), 1).otherwise(0)
    pred = rows.join(rates, ["fold", "title"]).select("fold", "survived", rule.alias("prediction"))
    y, p = F.col("survived") == 1, F.col("prediction") == 1
    cells = pred.groupBy("fold").agg(*[F.count_if(c).alias(name) for name, c in
                                       (("tp", p & y), ("fp", p & ~y), ("fn", ~p & y), ("tn", ~p & ~y))])
    return cells.select("fold", "tp", "fp", "fn", "tn", *ev.metric_columns())


@query("cross_validate", FOLDS_SQL + "SELECT * FROM s")
def q_cross_validate_rule(spark, sf_dir):
    """Cross-validated metrics of the title rule, a row for each fold."""
    return _rule_folds(spark, sf_dir)


def _mean_std(folds):
    long = folds.select(F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).alias("score")) for m in ("f1", "accuracy")
    ])).alias("s")).select("s.*")
    return ev.mean_std(long, "score", ["metric"])


@query("mean_std", FOLDS_SQL + """
SELECT metric, round(avg(score), 9) AS mean, round(stddev_pop(score), 9) AS std
FROM (SELECT 'f1' AS metric, f1 AS score FROM s UNION ALL SELECT 'accuracy', accuracy FROM s) GROUP BY metric
""")
def q_mean_std_rule(spark, sf_dir):
    """Mean and population std of the rule's fold scores."""
    return rounded(_mean_std(_rule_folds(spark, sf_dir)), "mean", "std")


@query("cross_validate_logreg")
def q_cross_validate(spark, sf_dir):
    """5 hash folds: balanced logistic (all features), the five fold models
    fitted together (batched Newton); F1 and accuracy on each held-out fold."""
    feats, _ = _feats(spark, sf_dir)
    names = _names(feats, FULL)
    feats = feats.withColumn("fold", fold_column("passenger_id", 5))
    _, per_fold, _ = cv_logreg(feats, names, "survived", "passenger_id", "fold", 5)
    return per_fold.withColumnRenamed("rep", "fold").withColumn("fold", F.col("fold").cast("int"))


@query("mean_std_logreg")
def q_mean_std(spark, sf_dir):
    """Mean and population std of the cross-validation fold scores."""
    return _mean_std(q_cross_validate(spark, sf_dir))


def _exact_sql(parts: str, seed: str, classes: str) -> str:
    return with_(PASSENGERS_CTE, SPLIT_CTE, TRAIN_CTE) + f"""
, r AS (SELECT passenger_id, survived, row_number() OVER (PARTITION BY {classes} ORDER BY substr(md5('{seed}:' || CAST(passenger_id AS VARCHAR)), 1, 12),
               passenger_id) - 1 AS i, count(*) OVER (PARTITION BY {classes}) AS n FROM {parts})
"""


EXACT_FOLDS = _exact_sql("train", "42f", "survived")


@query("stratified_folds", EXACT_FOLDS + """
SELECT passenger_id, survived, CAST((SELECT max(f) FROM range(5) AS g(f) WHERE f * n // 5 <= i) AS INTEGER) AS fold FROM r
""")
def q_stratified_folds(spark, sf_dir):
    """Five folds whose sizes differ by one row at most in each class."""
    return exact_folds(train_rows(spark, sf_dir), "passenger_id", 5, stratify="survived").select("passenger_id", "survived", "fold")


@query("exact_split", _exact_sql("passengers", "42", "1") + """
SELECT passenger_id, i < n - CAST(ceil(round(n * 0.2, 9)) AS BIGINT) AS is_train FROM r
""")
def q_exact_split(spark, sf_dir):
    """80 % of the rows, to the row (712 of 891)."""
    return exact_split(passengers(spark, sf_dir), "passenger_id").select("passenger_id", "is_train")


@query("cross_validate_stratified")
def q_cross_validate_stratified(spark, sf_dir):
    """The balanced logit of all features on five stratified folds of exact
    size, the fold models fitted together, each scored on its held-out fold."""
    feats, _ = _feats(spark, sf_dir)
    folds = exact_folds(feats, "passenger_id", 5, stratify="survived")
    _, per_fold, _ = cv_logreg(folds, _names(feats, FULL), "survived", "passenger_id", "fold", 5)
    return per_fold.withColumnRenamed("rep", "fold").withColumn("fold", F.col("fold").cast("int"))


BOOT_REFIT_B = 1000


@query("bootstrap_refit")
def q_bootstrap_refit(spark, sf_dir):
    """Balanced logistic refitted on B resamples of the training rows, n of n
    rows with replacement (11-feature subset); accuracy and F1 on each resample."""
    feats, _ = _feats(spark, sf_dir)
    _, per_rep, _ = bootstrap_logreg(feats, _names(feats, SUBSET_11), "survived", "passenger_id",
                                     replicates=BOOT_REFIT_B, C=1.0, balanced=True, draws="exact")
    return per_rep


@query("bootstrap_refit_intervals")
def q_bootstrap_refit_intervals(spark, sf_dir):
    per_rep = q_bootstrap_refit(spark, sf_dir)
    scores = ev.long_scores(per_rep, ("accuracy", "f1"), "feature sel2")
    return ev.order_stat_interval(scores, ["model", "metric"], "score", BOOT_REFIT_B)


SCORING_SEED = "42s"
SCORING_SQL = f"substr(md5('{SCORING_SEED}:' || CAST(passenger_id AS VARCHAR)), 1, 12) < '800000000000'"


def held_out_and_scoring(spark, sf_dir):
    """The rows outside the training set in two halves by another hash: a
    labelled held-out half, and the scoring set, which no fit sees."""
    rows = test_rows(spark, sf_dir)
    scoring = train_flag("passenger_id", SCORING_SEED, 0.5)
    return rows.where(~scoring), rows.where(scoring)


@contextmanager
def stored(rows):
    """``rows``, without the columns that no feature is made of, stored while a
    model is fitted: a fit reads them some times, and they come from a join."""
    kept = rows.drop("name", "cabin", "title", "parch").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()


def labelled_rows(spark, sf_dir):
    """The training rows and the labelled held-out half, in one scan."""
    return enrich(passengers(spark, sf_dir).where(train_flag("passenger_id") | ~train_flag("passenger_id", SCORING_SEED, 0.5)))


def final_model(spark, sf_dir):
    """Balanced logistic fitted on all labelled rows (train + held-out half),
    with the feature model fitted on train."""
    feats_tr, fmodel = train_features(spark, sf_dir)
    names = _names(feats_tr, FULL)
    with stored(labelled_rows(spark, sf_dir)) as labelled:
        return M.fit_logreg(add_interactions(fmodel.transform(labelled)), names, "survived", C=1.0, balanced=True), fmodel, names


@query("final_fit_and_score_full")
def q_final_fit_and_score_full(spark, sf_dir):
    """Refit on all labelled rows, score the scoring set (id carried through);
    a missing scaled fare is filled with the scored batch's own mean."""
    lr, fmodel, names = final_model(spark, sf_dir)
    scoring = held_out_and_scoring(spark, sf_dir)[1].drop("survived")
    feats = add_interactions(replace(fmodel, fill_from="batch").transform(scoring))
    return M.predict(lr, feats, names, ["passenger_id"]).select("passenger_id", "prediction")


# A balanced logit without a penalty on the one-hot columns of one key predicts 1 exactly
# where the group's rate passes the overall rate of the rows it was fitted on.
UNPENALISED = 1e9


def _title_scores(labelled, scored):
    feats, model, names = _title_features(labelled.where(F.col("title").isNotNull()))
    lr = M.fit_logreg(feats, names, "survived", C=UNPENALISED, balanced=True)
    return M.predict(lr, model.transform(scored), names, ["passenger_id"]).select("passenger_id", "prediction")


BATCH_SQL = RULES + "SELECT {} FROM title_pred"
FINAL_SQL = with_(PASSENGERS_CTE, SPLIT_CTE, TRAIN_CTE, TEST_CTE) + f"""
, scoring AS (SELECT * FROM test WHERE {SCORING_SQL}),
labelled AS (SELECT title, survived FROM train UNION ALL SELECT title, survived FROM test WHERE NOT {SCORING_SQL}),
o AS (SELECT avg(survived) AS overall FROM labelled),
r AS (SELECT title, avg(survived) AS rate FROM labelled GROUP BY title),
p AS (SELECT s.passenger_id, CASE WHEN coalesce(r.rate, o.overall) > o.overall THEN 1 ELSE 0 END AS prediction
      FROM scoring s CROSS JOIN o LEFT JOIN r ON r.title = s.title)
"""


@query("batch_score", BATCH_SQL.format("passenger_id, prediction"))
def q_batch_score(spark, sf_dir):
    """Held-out rows scored by the balanced logit on titles fitted on train."""
    return _title_scores(train_rows(spark, sf_dir), test_rows(spark, sf_dir))


@query("batch_score_full")
def q_batch_score_full(spark, sf_dir):
    """Held-out rows scored by the balanced model of all features."""
    feats, _ = train_features(spark, sf_dir)
    names = _names(feats, FULL)
    m = M.fit_logreg(feats, names, "survived", C=1.0, balanced=True)
    test, _ = test_features(spark, sf_dir)
    return M.predict(m, test, names, ["passenger_id"]).select("passenger_id", "prediction")


@query("align_scores", BATCH_SQL.format("passenger_id AS \"PassengerId\", prediction AS \"Survived\""))
def q_align_scores(spark, sf_dir):
    """Id and predicted label side by side (the id rides through transform)."""
    return q_batch_score(spark, sf_dir).select(
        F.col("passenger_id").alias("PassengerId"), F.col("prediction").alias("Survived"))


@query("final_fit_and_score", FINAL_SQL + "SELECT * FROM p")
def q_final_fit_and_score(spark, sf_dir):
    """The balanced logit on titles, refitted on all labelled rows, scores the
    scoring set, which is outside the fit."""
    held, scoring = held_out_and_scoring(spark, sf_dir)
    return _title_scores(train_rows(spark, sf_dir).unionByName(held), scoring.drop("survived"))


@query("write_predictions", FINAL_SQL + 'SELECT passenger_id AS "PassengerId", prediction AS "Survived" FROM p')
def q_write_predictions(spark, sf_dir):
    """Write the scored rows as CSV part files into the shared checkpoint
    folder and read them back with the declared schema."""
    from strata.session import scratch_path
    from strata.sources.files import read_predictions, write_predictions
    path = scratch_path(spark, "predictions")
    write_predictions(q_final_fit_and_score(spark, sf_dir), path)
    return read_predictions(spark, path)


@query("align_scores_full")
def q_align_scores_full(spark, sf_dir):
    """Id and predicted label of the scoring set side by side, by the final
    model of all features."""
    return q_final_fit_and_score_full(spark, sf_dir).select(F.col("passenger_id").alias("PassengerId"), F.col("prediction").alias("Survived"))


@query("write_predictions_full")
def q_write_predictions_full(spark, sf_dir):
    """The prediction file of the final model of all features, read back."""
    from strata.session import scratch_path
    from strata.sources.files import read_predictions, write_predictions
    path = scratch_path(spark, "predictions-full")
    write_predictions(q_final_fit_and_score_full(spark, sf_dir), path)
    return read_predictions(spark, path)


FARE_GAP = 97  # every 97th row of the scored set has no fare


@query("fill_mean_scaled_fare", with_(PASSENGERS_CTE, SPLIT_CTE, TRAIN_CTE, TEST_CTE) + f"""
, e AS (SELECT min(fare) AS lo, max(fare) AS hi FROM train),
s AS (SELECT passenger_id, (CASE WHEN passenger_id % {FARE_GAP} <> 0 THEN fare END - lo) / (hi - lo) AS scaled FROM test, e)
SELECT passenger_id, round(coalesce(scaled, (SELECT avg(scaled) FROM s)), 9) AS fare FROM s
""")
def q_fill_mean_scaled_fare(spark, sf_dir):
    """Held-out fares scaled as in training, missing ones filled with the mean
    of the scored batch."""
    _, model = train_features(spark, sf_dir)
    gaps = test_rows(spark, sf_dir).withColumn("fare", F.when(F.col("passenger_id") % FARE_GAP != 0, F.col("fare")))
    return rounded(replace(model, fill_from="batch").transform(gaps).select("passenger_id", "fare"), "fare")


@query("heldout_interval_logreg")
def q_heldout_interval_logreg(spark, sf_dir):
    """The interval table's "test results" rows: 80/90/95 % intervals of
    accuracy and F1 of the fitted 11-feature logit over Poisson resamples of
    the held-out rows, without a refit."""
    feats, fmodel = train_features(spark, sf_dir)
    names = _names(feats, SUBSET_11)
    with stored(train_rows(spark, sf_dir)) as train:
        m = M.fit_logreg(add_interactions(fmodel.transform(train)), names, "survived", C=1.0, balanced=True)
    test = add_interactions(fmodel.transform(test_rows(spark, sf_dir)))
    pred = M.predict(m, test, names, ["passenger_id", "survived"])
    per_rep = ev.bootstrap_eval(pred, "passenger_id", "survived", replicates=BOOT_B, seed=BOOT_SEED)
    return ev.order_stat_interval(ev.long_scores(per_rep, ("accuracy", "f1"), "test results"), ["model", "metric"], "score", BOOT_B)


FIT_STATS_SCHEMA = "n bigint, log_likelihood double, null_log_likelihood double, pseudo_r2 double"


@query("logit_fit_stats")
def q_logit_fit_stats(spark, sf_dir):
    """Log-likelihood, intercept-only log-likelihood and McFadden's pseudo
    R^2 of the 17-feature logit (the null model is the constant-only one)."""
    _, extra = _inference(spark, sf_dir, SUBSET_17)
    return spark.createDataFrame([(extra["n"], extra["log_likelihood"],
                                   extra["null_log_likelihood"], extra["pseudo_r2"])],
                                 FIT_STATS_SCHEMA)


# (model label, feature subset, C, rows): the models whose bootstrap
# intervals the analysis stacks into one table.
INTERVAL_MODELS = (("baseline", FULL, 1.0, "train"), ("feature sel1", SUBSET_17, 1.0, "train"),
                   ("feature sel2", SUBSET_11, 1.0, "train"),
                   ("feature sel2 reg", SUBSET_11, 0.4, "train"),
                   ("full calibration", FULL, 1.0, "all"))


@query("bootstrap_interval_table")
def q_bootstrap_interval_table(spark, sf_dir):
    """80/90/95 % intervals of in-sample accuracy and F1 over B = 1000
    balanced-logistic refits, for each model of the analysis, stacked."""
    feats_tr, fmodel = _feats(spark, sf_dir)
    allrows = train_rows(spark, sf_dir).unionByName(test_rows(spark, sf_dir))
    feats_all = add_interactions(fmodel.transform(allrows))
    alike = {}  # models that differ in C only share their draws
    for label, subset, C, rows in INTERVAL_MODELS:
        alike.setdefault((subset, rows), []).append((label, C))
    tables = []
    for (subset, rows), models in alike.items():
        frame = feats_tr if rows == "train" else feats_all
        refits = bootstrap_logreg_grid(frame, _names(feats_tr, subset), "survived", "passenger_id", [C for _, C in models], replicates=BOOT_REFIT_B)
        for (label, _), per_rep in zip(models, refits):
            scores = ev.long_scores(per_rep, ("accuracy", "f1"), label)
            tables.append(ev.order_stat_interval(scores, ["model", "metric"], "score", BOOT_REFIT_B))
    tables.append(q_heldout_interval_logreg(spark, sf_dir))
    return _union(tables)


@query("logreg_heldout_metrics")
def q_logreg_heldout_metrics(spark, sf_dir):
    """The balanced 11-feature model fitted on train, evaluated on the
    held-out rows transformed with the train-fitted features."""
    feats, _ = _feats(spark, sf_dir)
    names = _names(feats, SUBSET_11)
    m = M.fit_logreg(feats, names, "survived", C=1.0, balanced=True)
    test, _ = test_features(spark, sf_dir)
    pred = M.predict(m, test, names, ["passenger_id", "survived"])
    return ev.classification_metrics(pred, "survived").select(F.lit("log sub").alias("model"), "*")


@query("bootstrap_eval_multinomial")
def q_bootstrap_eval_multinomial(spark, sf_dir):
    """Intervals of held-out accuracy and F1 from B = 1000 exact multinomial
    resamples of n rows (as resampling with replacement does), drawn from
    the four confusion counts — O(n + B) work for any metric of the cells."""
    per_rep = ev.cell_bootstrap(rule_predictions(spark, sf_dir), "survived",
                                replicates=BOOT_B, seed=BOOT_SEED)
    scores = ev.long_scores(per_rep, ("accuracy", "f1"), "title_rule")
    return ev.order_stat_interval(scores, ["model", "metric"], "score", BOOT_B)
