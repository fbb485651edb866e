"""Queries of the feature pipeline: cuts, imputation, scaling, one-hot,
the full transformer, interactions and subsets (fit on train, applied to
train and held-out rows)."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators.dictionary import dictionary, one_hot_sparse
from strata.operators.moments import corr_all, eliminate_redundant
from strata.operators.features import (
    INTERACTIONS, SUBSET_11, SUBSET_17, FeaturePipeline, add_interactions, screen_redundant,
    select_by_correlation, with_known_levels,
)
from strata.plans.eda_queries import test_rows, train_rows
from strata.plans.registry import query, rounded
from strata.plans.sql import PASSENGERS_CTE, SPLIT_CTE, TEST_CTE, TRAIN_CTE, with_

# Categories of the passenger binding, in sorted order (what the fitted
# encoder finds; written out for the SQL statements only).
SQL_CATEGORIES = {
    "fam_size": ["large_fam", "medium_fam", "small_fam"],
    "sib_sp_num": ["less_4", "over_4"],
    "sex": ["female", "male"],
    "pclass": [1, 2, 3],
    "level_cabin": ["A", "B", "F", "H", "M", "No Cabin"],
    "embarked": ["C", "Q", "S"],
}

PARAMS_CTE = """
params AS (
  SELECT CAST(min(family_size) AS DOUBLE) AS fmin, CAST(max(family_size) AS DOUBLE) AS fmax,
         CAST(min(sibsp) AS DOUBLE) AS smin, CAST(max(sibsp) AS DOUBLE) AS smax,
         min(age) AS amin, max(age) AS amax, min(fare) AS pmin, max(fare) AS pmax,
         avg(fare) AS pmean, quantile_cont(age, 0.5) AS amed,
         (SELECT embarked FROM train WHERE embarked IS NOT NULL GROUP BY embarked
          ORDER BY count(*) DESC, embarked LIMIT 1) AS port
  FROM train),
edges AS (
  SELECT *, 1 * ((fmax - fmin) / 3) + fmin AS fe1, 2 * ((fmax - fmin) / 3) + fmin AS fe2,
         1 * ((smax - smin) / 2) + smin AS se1,
         LEAST(amin, amed) AS amin2, GREATEST(amax, amed) AS amax2
  FROM params)
"""


def _binned(src: str) -> str:
    return f"""
{src}_b AS (
  SELECT s.*,
    CASE WHEN family_size IS NULL THEN NULL WHEN family_size <= fe1 THEN 'small_fam'
         WHEN family_size <= fe2 THEN 'medium_fam' ELSE 'large_fam' END AS fam_size,
    CASE WHEN sibsp IS NULL THEN NULL WHEN sibsp <= se1 THEN 'less_4' ELSE 'over_4' END
         AS sib_sp_num,
    (COALESCE(age, amed) - amin2) / (CASE WHEN amax2 = amin2 THEN 1.0 ELSE amax2 - amin2 END)
         AS age_s,
    COALESCE((fare - pmin) / (CASE WHEN pmax = pmin THEN 1.0 ELSE pmax - pmin END),
             (pmean - pmin) / (CASE WHEN pmax = pmin THEN 1.0 ELSE pmax - pmin END)) AS fare_s,
    COALESCE(embarked, port) AS port_i
  FROM {src} s, edges)
"""


def _oh(col: str, name: str, cats) -> list[str]:
    out = []
    for c in cats:
        lit = f"'{c}'" if isinstance(c, str) else str(c)
        safe = str(c).replace(" ", "_")
        out.append(f"CASE WHEN {col} = {lit} THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END"
                   f" AS {name}_{safe}")
    return out


FEATURE_SELECT = ",\n    ".join(
    ["age_s AS age"]
    + _oh("fam_size", "fam_size", SQL_CATEGORIES["fam_size"])
    + _oh("sib_sp_num", "sib_sp_num", SQL_CATEGORIES["sib_sp_num"])
    + _oh("sex", "sex", SQL_CATEGORIES["sex"])
    + _oh("pclass", "pclass", SQL_CATEGORIES["pclass"])
    + _oh("level_cabin", "level_cabin", SQL_CATEGORIES["level_cabin"])
    + ["fare_s AS fare"]
    + _oh("port_i", "embarked", SQL_CATEGORIES["embarked"]))

TRAIN_FEATS = with_(PASSENGERS_CTE, SPLIT_CTE, TRAIN_CTE, PARAMS_CTE, _binned("train")) + f"""
, feats AS (SELECT passenger_id, survived,
    {FEATURE_SELECT}
  FROM train_b)
"""

TEST_FEATS = with_(PASSENGERS_CTE, SPLIT_CTE, TRAIN_CTE, TEST_CTE, PARAMS_CTE,
                   _binned("test")) + f"""
, feats AS (SELECT passenger_id, survived,
    {FEATURE_SELECT}
  FROM test_b)
"""

INTERACTION_SQL = ", ".join(f"{a} * {b} AS {n}" for n, a, b in INTERACTIONS)


def fitted(spark, sf_dir):
    train = train_rows(spark, sf_dir)
    return train, FeaturePipeline().fit(train)


def train_features(spark, sf_dir):
    """Training rows -> full feature frame (id and label kept on the row)."""
    train, model = fitted(spark, sf_dir)
    return add_interactions(model.transform(train)), model


def test_features(spark, sf_dir):
    """Held-out rows transformed with the train-fitted model."""
    _, model = fitted(spark, sf_dir)
    return add_interactions(model.transform(test_rows(spark, sf_dir))), model


@query("cut_equal_width", with_(PASSENGERS_CTE, SPLIT_CTE, TRAIN_CTE, PARAMS_CTE,
                                _binned("train")) + """
SELECT passenger_id, fam_size, sib_sp_num FROM train_b
""")
def q_cut_equal_width(spark, sf_dir):
    train, model = fitted(spark, sf_dir)
    return model.binned(train).select("passenger_id", "fam_size", "sib_sp_num")


@query("impute_median", with_(PASSENGERS_CTE, SPLIT_CTE, TRAIN_CTE, PARAMS_CTE) + """
SELECT passenger_id, COALESCE(age, amed) AS age FROM train, params
""")
def q_impute_median(spark, sf_dir):
    train, model = fitted(spark, sf_dir)
    return train.select("passenger_id", F.coalesce("age", F.lit(model.age_median)).alias("age"))


@query("impute_mode", with_(PASSENGERS_CTE, SPLIT_CTE, TRAIN_CTE, PARAMS_CTE) + """
SELECT passenger_id, COALESCE(embarked, port) AS embarked FROM train, params
""")
def q_impute_mode(spark, sf_dir):
    train, model = fitted(spark, sf_dir)
    return train.select("passenger_id",
                        F.coalesce("embarked", F.lit(model.port_mode)).alias("embarked"))


@query("minmax_scale", TRAIN_FEATS + "SELECT passenger_id, age, fare FROM feats")
def q_minmax_scale(spark, sf_dir):
    feats, _ = train_features(spark, sf_dir)
    return feats.select("passenger_id", "age", "fare")


@query("one_hot", TRAIN_FEATS + """
SELECT passenger_id, sex_female, sex_male, pclass_1, pclass_2, pclass_3 FROM feats
""")
def q_one_hot(spark, sf_dir):
    feats, _ = train_features(spark, sf_dir)
    return feats.select("passenger_id", "sex_female", "sex_male", "pclass_1", "pclass_2",
                        "pclass_3")


@query("column_transformer", TRAIN_FEATS + "SELECT * FROM feats")
def q_column_transformer(spark, sf_dir):
    """The ordered bundle: 24 feature columns, id and label on the row."""
    train, model = fitted(spark, sf_dir)
    return model.transform(train)


@query("interaction_terms", TRAIN_FEATS + f"""
SELECT passenger_id, {INTERACTION_SQL} FROM feats
""")
def q_interaction_terms(spark, sf_dir):
    feats, _ = train_features(spark, sf_dir)
    return feats.select("passenger_id", *[n for n, _, _ in INTERACTIONS])


@query("apply_fitted_stats", TEST_FEATS + f"""
SELECT *, {INTERACTION_SQL} FROM feats
""")
def q_apply_fitted_stats(spark, sf_dir):
    """Held-out rows through the train-fitted transform (no refit)."""
    feats, _ = test_features(spark, sf_dir)
    return feats


def _subset_sql(names, feats_sql):
    cols = [n if n in _SQL_FEATURE_NAMES else f"CAST(0.0 AS DOUBLE) AS {n}" for n in names]
    return feats_sql + f"""
, full_f AS (SELECT *, {INTERACTION_SQL} FROM feats)
SELECT passenger_id, survived, {', '.join(cols)} FROM full_f
"""


_SQL_FEATURE_NAMES = (["age"] + [f"{k}_{str(c).replace(' ', '_')}" for k in
                                 ("fam_size", "sib_sp_num", "sex", "pclass", "level_cabin")
                                 for c in SQL_CATEGORIES[k]]
                      + ["fare"] + [f"embarked_{c}" for c in SQL_CATEGORIES["embarked"]]
                      + [n for n, _, _ in INTERACTIONS])


@query("feature_subsets", _subset_sql(SUBSET_17, TRAIN_FEATS))
def q_feature_subsets(spark, sf_dir):
    """The 17-feature subset by name; a known cabin level that no row has is
    a column of zeros."""
    feats, _ = train_features(spark, sf_dir)
    return with_known_levels(feats).select("passenger_id", "survived", *SUBSET_17)


@query("features_with_label", _subset_sql(SUBSET_11, TRAIN_FEATS))
def q_features_with_label(spark, sf_dir):
    """The 11-feature subset with the label on the same row."""
    feats, _ = train_features(spark, sf_dir)
    return with_known_levels(feats).select("passenger_id", "survived", *SUBSET_11)


SELECT_MIN_ABS_R = 0.01


@query("select_by_correlation", TRAIN_FEATS + """
, full_f AS (SELECT *, """ + INTERACTION_SQL + """ FROM feats),
r AS (""" + " UNION ALL ".join(
    f"SELECT '{n}' AS col_a, 'survived' AS col_b, round(corr({n}, survived), 9) AS r FROM full_f"
    for n in _SQL_FEATURE_NAMES) + f""")
SELECT * FROM r WHERE abs(r) >= {SELECT_MIN_ABS_R}
""")
def q_select_by_correlation(spark, sf_dir):
    """Features whose |corr| with the label reaches the threshold."""
    feats, _ = train_features(spark, sf_dir)
    names = [c for c in feats.columns if c not in ("passenger_id", "survived")]
    return rounded(select_by_correlation(feats, names, "survived", SELECT_MIN_ABS_R), "r")


EDA_CORR_COLS = ("pclass", "age", "fare", "small_fam", "large_fam", "less_4", "female")


def _eda_corr_sql():
    base = with_(PASSENGERS_CTE, SPLIT_CTE, TRAIN_CTE, PARAMS_CTE, _binned("train")) + """
, e AS (SELECT survived, pclass, age, fare,
          CASE WHEN fam_size = 'small_fam' THEN 1.0 ELSE 0.0 END AS small_fam,
          CASE WHEN fam_size = 'large_fam' THEN 1.0 ELSE 0.0 END AS large_fam,
          CASE WHEN sib_sp_num = 'less_4' THEN 1.0 ELSE 0.0 END AS less_4,
          CASE WHEN sex = 'female' THEN 1.0 ELSE 0.0 END AS female
        FROM train_b)
"""
    return base + " UNION ALL ".join(
        f"SELECT '{c}' AS col_a, 'survived' AS col_b, round(corr({c}, survived), 9) AS r FROM e"
        for c in EDA_CORR_COLS)


@query("eda_corr_with_label", _eda_corr_sql())
def q_eda_corr_with_label(spark, sf_dir):
    """Correlation with the label of the columns the exploratory heat map
    keeps: class, age, fare and the family / sibling / sex dummies (cuts
    fitted on the training rows; numeric columns only)."""
    from strata.operators.stats import corr_pairs
    train, model = fitted(spark, sf_dir)
    b = model.binned(train)
    dummy = lambda cond: F.when(cond, F.lit(1.0)).otherwise(F.lit(0.0))
    e = b.select("survived", "pclass", "age", "fare",
                 dummy(F.col("fam_size") == "small_fam").alias("small_fam"),
                 dummy(F.col("fam_size") == "large_fam").alias("large_fam"),
                 dummy(F.col("sib_sp_num") == "less_4").alias("less_4"),
                 dummy(F.col("sex") == "female").alias("female"))
    return rounded(corr_pairs(e, list(EDA_CORR_COLS), with_col="survived"), "r")


def _feature_corr_sql():
    names = _SQL_FEATURE_NAMES
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1:]]
    return TRAIN_FEATS + f", full_f AS (SELECT *, {INTERACTION_SQL} FROM feats) " + \
        " UNION ALL ".join(f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 9) AS r "
                           f"FROM full_f" for a, b in pairs)


REDUNDANT_R = 0.5


@query("screen_redundant", "SELECT * FROM (" + _feature_corr_sql() + f") WHERE abs(r) >= {REDUNDANT_R}")
def q_screen_redundant(spark, sf_dir):
    """Pairs of features whose correlation with each other reaches 0.5."""
    feats, _ = train_features(spark, sf_dir)
    names = [c for c in feats.columns if c not in ("passenger_id", "survived")]
    return rounded(screen_redundant(feats, names, REDUNDANT_R), "r")


KEEP_R = 0.5
ELIMINATE_SQL = TRAIN_FEATS + f", full_f AS (SELECT *, {INTERACTION_SQL} FROM feats), " + """
lr AS (""" + " UNION ALL ".join(f"SELECT '{n}' AS f, corr({n}, survived) AS r FROM full_f" for n in _SQL_FEATURE_NAMES) + """),
pr AS (""" + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r FROM full_f" for i, a in enumerate(_SQL_FEATURE_NAMES)
                                for b in _SQL_FEATURE_NAMES[i + 1:]) + f"""),
"""


@query("eliminate_redundant", "WITH RECURSIVE " + ELIMINATE_SQL.strip().removeprefix("WITH") + f"""
e AS (SELECT a, b FROM pr WHERE abs(r) >= {KEEP_R} UNION ALL SELECT b, a FROM pr WHERE abs(r) >= {KEEP_R}),
o AS (SELECT f, r, row_number() OVER (ORDER BY (r IS NULL OR isnan(r)), abs(r) DESC, f) AS i FROM lr),
near AS (SELECT o.i, o.f, coalesce(list(e.b) FILTER (WHERE e.b IS NOT NULL), []) AS bs FROM o LEFT JOIN e ON e.a = o.f GROUP BY o.i, o.f),
g(i, kept) AS (SELECT CAST(0 AS BIGINT), CAST([] AS VARCHAR[])
               UNION ALL SELECT near.i, CASE WHEN list_has_any(g.kept, near.bs) THEN g.kept ELSE list_append(g.kept, near.f) END
               FROM g JOIN near ON near.i = g.i + 1),
k AS (SELECT kept FROM g ORDER BY i DESC LIMIT 1)
SELECT o.f AS feature, list_contains(k.kept, o.f) AS kept FROM o, k
""")
def q_eliminate_redundant(spark, sf_dir):
    """Greedy choice of features, by falling |r| with the label, none of which
    correlates with another one kept at 0.5 or more."""
    feats, _ = train_features(spark, sf_dir)
    names = [c for c in feats.columns if c not in ("passenger_id", "survived")]
    return spark.createDataFrame([(f, kept) for f, _, kept, _ in eliminate_redundant(feats, names, "survived", KEEP_R)], "feature string, kept boolean")


@query("corr_all", _feature_corr_sql())
def q_corr_all(spark, sf_dir):
    """All pairs of the model features with the label's rows as they are: one
    masked block product, nulls skipped by pair."""
    feats, _ = train_features(spark, sf_dir)
    names = [c for c in feats.columns if c not in ("passenger_id", "survived")]
    return rounded(corr_all(feats, names).drop("n"), "r")


@query("one_hot_dictionary", TRAIN_FEATS + """
, d AS (SELECT name, row_number() OVER (ORDER BY name) - 1 AS id FROM (SELECT DISTINCT name FROM train WHERE name IS NOT NULL))
SELECT t.passenger_id, CAST(d.id AS BIGINT) AS id, CAST((SELECT count(*) FROM d) AS INTEGER) AS size
FROM train t JOIN d ON d.name = t.name
""")
def q_one_hot_dictionary(spark, sf_dir):
    """Sparse one-hot vectors of a column with very many categories (the names):
    the place of the 1 and the vector's size."""
    train = train_rows(spark, sf_dir)
    words = dictionary(train, "name")
    coded = one_hot_sparse(train.select("passenger_id", "name"), "name", words, "vec")
    parts = F.unwrap_udt("vec")
    return coded.select("passenger_id", parts["indices"][0].cast("long").alias("id"), parts["size"].alias("size"))


@query("feature_corr_matrix", _feature_corr_sql())
def q_feature_corr_matrix(spark, sf_dir):
    """Pearson matrix of the model features (upper triangle, long form): the
    transformed training rows are complete, so one Gram-matrix aggregation
    gives every pair."""
    from strata.operators.stats import corr_matrix
    feats, _ = train_features(spark, sf_dir)
    names = [c for c in feats.columns if c not in ("passenger_id", "survived")]
    return rounded(corr_matrix(feats, names), "r")
