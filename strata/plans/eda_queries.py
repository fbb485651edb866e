"""Queries over the ``passengers`` binding: scans, projections, filters,
scalar columns and the grouped statistics of the exploratory analysis.

The analysis runs on the training rows (md5 hash split, 80 %) with the
derived columns title, family_size and level_cabin."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions.scalars import NO_CABIN, abs_value, percent_of
from strata.operators import stats
from strata.operators.enrich import enrich
from strata.operators.split import split_train_test
from strata.plans.registry import query, rounded
from strata.plans.sql import PASSENGERS_CTE, SPLIT_CTE, TEST_CTE, TRAIN_CTE, with_
from strata.sources.tables import passengers

TRAIN = with_(PASSENGERS_CTE, SPLIT_CTE, TRAIN_CTE)
TEST = with_(PASSENGERS_CTE, SPLIT_CTE, TEST_CTE)
BASE_COLS = ["passenger_id", "survived", "pclass", "name", "sex", "age", "sibsp", "parch",
             "fare", "cabin", "embarked"]


def train_rows(spark, sf_dir):
    tr, _ = split_train_test(passengers(spark, sf_dir), "passenger_id")
    return enrich(tr)


def test_rows(spark, sf_dir):
    _, te = split_train_test(passengers(spark, sf_dir), "passenger_id")
    return enrich(te)


# ------------------------------------------------------------ scans, sinks

@query("read_passengers", with_(PASSENGERS_CTE) + "SELECT * FROM passengers")
def q_read_passengers(spark, sf_dir):
    return passengers(spark, sf_dir)


@query("read_scoring_set", TEST + """
SELECT passenger_id, pclass, name, sex, age, sibsp, parch, fare, cabin, embarked FROM test
""")
def q_read_scoring_set(spark, sf_dir):
    """The held-out rows as a scoring set: every column but the label."""
    return test_rows(spark, sf_dir).select(*[c for c in BASE_COLS if c != "survived"])


@query("split_train_test", with_(PASSENGERS_CTE, SPLIT_CTE) + """
SELECT is_train, CAST(count(*) AS BIGINT) AS n, CAST(sum(survived) AS BIGINT) AS n_survived
FROM split GROUP BY is_train
""")
def q_split_train_test(spark, sf_dir):
    from strata.operators.split import train_flag
    p = passengers(spark, sf_dir).withColumn("is_train", train_flag("passenger_id"))
    return p.groupBy("is_train").agg(F.count(F.lit(1)).alias("n"),
                                     F.sum("survived").cast("bigint").alias("n_survived"))


@query("table_profile", TRAIN + """
SELECT CAST(count(*) AS BIGINT) AS n_rows,
  """ + ",\n  ".join(f"CAST(count({c}) AS BIGINT) AS nn_{c}" for c in BASE_COLS) + """
FROM train
""")
def q_table_profile(spark, sf_dir):
    """Row count and per-column non-null counts in a single aggregate."""
    t = train_rows(spark, sf_dir)
    return t.agg(F.count(F.lit(1)).alias("n_rows"),
                 *[F.count(F.col(c)).alias(f"nn_{c}") for c in BASE_COLS])


@query("preview", TRAIN + """
SELECT passenger_id, survived, pclass, name, sex, age FROM train
ORDER BY passenger_id LIMIT 5
""")
def q_preview(spark, sf_dir):
    """First rows by key (the limit is the feature: a top-k by id)."""
    return (train_rows(spark, sf_dir).orderBy("passenger_id").limit(5)
            .select("passenger_id", "survived", "pclass", "name", "sex", "age"))


# ---------------------------------------------- projection, filter, assign

@query("project_columns", TRAIN + "SELECT survived, passenger_id FROM train")
def q_project_columns(spark, sf_dir):
    return train_rows(spark, sf_dir).select("survived", "passenger_id")


@query("drop_columns", TRAIN + """
SELECT passenger_id, pclass, name, sex, age, sibsp, parch, fare, cabin, embarked FROM train
""")
def q_drop_columns(spark, sf_dir):
    return train_rows(spark, sf_dir).drop("survived", "title", "family_size", "level_cabin")


@query("filter_equality", TRAIN + "SELECT passenger_id, survived, sex FROM train WHERE pclass = 1")
def q_filter_equality(spark, sf_dir):
    return (train_rows(spark, sf_dir).where(F.col("pclass") == 1)
            .select("passenger_id", "survived", "sex"))


@query("filter_null", TRAIN + "SELECT passenger_id, pclass FROM train WHERE age IS NULL")
def q_filter_null(spark, sf_dir):
    return train_rows(spark, sf_dir).where(F.col("age").isNull()).select("passenger_id", "pclass")


@query("drop_null_rows", TRAIN + """
SELECT passenger_id, age, embarked FROM train WHERE age IS NOT NULL AND embarked IS NOT NULL
""")
def q_drop_null_rows(spark, sf_dir):
    return (train_rows(spark, sf_dir).select("passenger_id", "age", "embarked")
            .na.drop(subset=["age", "embarked"]))


@query("drop_null_columns", TRAIN + """
SELECT passenger_id, survived, pclass, name, sex, sibsp, parch, fare FROM train
""")
def q_drop_null_columns(spark, sf_dir):
    """Drop every column that holds a null (null counts: one aggregate)."""
    t = train_rows(spark, sf_dir).select(*BASE_COLS)
    counts = t.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in BASE_COLS]).first()
    return t.drop(*[c for c in BASE_COLS if counts[c] > 0])


@query("fill_constant", TRAIN + f"""
SELECT passenger_id, COALESCE(cabin, '{NO_CABIN}') AS cabin FROM train
""")
def q_fill_constant(spark, sf_dir):
    t = train_rows(spark, sf_dir)
    return t.select("passenger_id", F.coalesce("cabin", F.lit(NO_CABIN)).alias("cabin"))


@query("fill_mean", TRAIN + """
SELECT passenger_id, COALESCE(age, (SELECT avg(age) FROM train)) AS age FROM train
""")
def q_fill_mean(spark, sf_dir):
    """Null age -> mean age (a scalar subquery, evaluated once)."""
    t = train_rows(spark, sf_dir)
    mean_age = t.select(F.avg("age")).scalar()
    return t.select("passenger_id", F.coalesce(F.col("age"), mean_age).alias("age"))


@query("derive_sum", TRAIN + "SELECT passenger_id, sibsp + parch AS family_size FROM train")
def q_derive_sum(spark, sf_dir):
    return train_rows(spark, sf_dir).select("passenger_id", "family_size")


@query("rename_columns", TRAIN + """
SELECT passenger_id AS "PassengerId", survived AS "Survived", pclass AS "Pclass" FROM train
""")
def q_rename_columns(spark, sf_dir):
    return (train_rows(spark, sf_dir).select("passenger_id", "survived", "pclass")
            .withColumnsRenamed({"passenger_id": "PassengerId", "survived": "Survived",
                                 "pclass": "Pclass"}))


# ----------------------------------------------------------------- scalars

@query("extract_title", with_(PASSENGERS_CTE) + """
SELECT passenger_id, NULLIF(split_part(split_part(name, ', ', 2), '.', 1), '') AS title
FROM passengers
""")
def q_extract_title(spark, sf_dir):
    return enrich(passengers(spark, sf_dir)).select("passenger_id", "title")


@query("cabin_level", with_(PASSENGERS_CTE) + f"""
SELECT passenger_id, COALESCE(NULLIF(substr(cabin, 1, 1), ''), '{NO_CABIN}') AS level_cabin
FROM passengers
""")
def q_cabin_level(spark, sf_dir):
    return enrich(passengers(spark, sf_dir)).select("passenger_id", "level_cabin")


@query("percent_of", TRAIN + """
SELECT pclass, CAST(sum(survived) AS DOUBLE) / NULLIF(CAST(count(*) AS DOUBLE), 0)
               * CAST(100.0 AS DOUBLE) AS pct_survived
FROM train GROUP BY pclass
""")
def q_percent_of(spark, sf_dir):
    t = train_rows(spark, sf_dir)
    return t.groupBy("pclass").agg(percent_of(F.sum("survived"), F.count(F.lit(1)))
                                   .alias("pct_survived"))


# --------------------------------------------------------- join-shaped steps

@query("align_label", TRAIN + "SELECT passenger_id, pclass, fare, survived FROM train")
def q_align_label(spark, sf_dir):
    """Features and label glued on the key (never on row position): both stand
    on the same row, so the frame is one projection."""
    return train_rows(spark, sf_dir).select("passenger_id", "pclass", "fare", "survived")


@query("broadcast_total", TRAIN + """
SELECT title, CAST(count(*) AS BIGINT) AS n,
       CAST(count(*) AS DOUBLE) / CAST((SELECT count(*) FROM train) AS DOUBLE)
       * CAST(100.0 AS DOUBLE) AS pct_of_all
FROM train WHERE title IS NOT NULL GROUP BY title
""")
def q_broadcast_total(spark, sf_dir):
    """A global total used inside each group: the sum of the groups' counts,
    those of a null title included."""
    groups = train_rows(spark, sf_dir).groupBy("title").agg(F.count(F.lit(1)).alias("n"))
    total = groups.select(F.sum("n")).scalar()
    return groups.where(F.col("title").isNotNull()).select(
        "title", "n", (F.col("n").cast("double") / total.cast("double") * 100.0).alias("pct_of_all"))


# ------------------------------------------------------------- aggregates

@query("nunique_by_group", TRAIN + """
SELECT survived, CAST(count(DISTINCT passenger_id) AS BIGINT) AS n_passengers
FROM train GROUP BY survived
""")
def q_nunique_by_group(spark, sf_dir):
    return stats.nunique(train_rows(spark, sf_dir), ["survived"], "passenger_id", "n_passengers")


@query("nunique_global", TRAIN + """
SELECT CAST(count(DISTINCT passenger_id) AS BIGINT) AS n_passengers FROM train WHERE pclass = 1
""")
def q_nunique_global(spark, sf_dir):
    return stats.nunique(train_rows(spark, sf_dir).where(F.col("pclass") == 1), [],
                         "passenger_id", "n_passengers")


@query("distinct_values", TRAIN + "SELECT DISTINCT title FROM train")
def q_distinct_values(spark, sf_dir):
    return train_rows(spark, sf_dir).select("title").distinct()


@query("class_survival_share", TRAIN + """
, fc AS (SELECT survived, passenger_id FROM train WHERE pclass = 1)
SELECT survived,
       CAST(count(DISTINCT passenger_id) AS DOUBLE)
       / CAST((SELECT count(DISTINCT passenger_id) FROM fc) AS DOUBLE) * CAST(100.0 AS DOUBLE)
       AS pct_of_class
FROM fc GROUP BY survived
""")
def q_class_survival_share(spark, sf_dir):
    """Percentage of first-class passengers by outcome: a passenger has one
    outcome, so the total is the sum of the groups' distinct counts (rows are
    counted as distinct ids in any case)."""
    fc = train_rows(spark, sf_dir).where(F.col("pclass") == 1)
    # a row for each passenger: outcomes and the total come off one aggregate
    each = fc.where(F.col("passenger_id").isNotNull()).groupBy("passenger_id").agg(F.collect_set("survived").alias("outcomes"))
    total = each.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.array_contains("outcomes", 0)).alias("0"), F.count_if(F.array_contains("outcomes", 1)).alias("1"))
    rows = total.select("n", F.explode(F.array(*[F.struct(F.lit(k).alias("survived"), F.col(str(k)).alias("k")) for k in (0, 1)])).alias("x"))
    return rows.where("x.k > 0").select("x.survived", (F.col("x.k").cast("double") / F.col("n").cast("double") * 100.0).alias("pct_of_class"))


@query("count_by_keys", TRAIN + """
SELECT pclass, sex, CAST(count(passenger_id) AS BIGINT) AS n FROM train GROUP BY pclass, sex
""")
def q_count_by_keys(spark, sf_dir):
    return stats.count_by_keys(train_rows(spark, sf_dir), ["pclass", "sex"], "passenger_id")


@query("mean_age_by", TRAIN + """
SELECT survived, sex, avg(age) AS mean_age FROM train GROUP BY survived, sex
""")
def q_mean_age_by(spark, sf_dir):
    return stats.grouped_mean(train_rows(spark, sf_dir), ["survived", "sex"], "age", "mean_age")


@query("mean_fare_by", TRAIN + """
SELECT survived, sex, pclass,
       CAST(sum(CAST(fare AS DECIMAL(18,4))) AS DOUBLE) / count(fare) AS mean_fare
FROM train GROUP BY survived, sex, pclass
""")
def q_mean_fare_by(spark, sf_dir):
    return stats.grouped_mean(train_rows(spark, sf_dir), ["survived", "sex", "pclass"], "fare",
                              "mean_fare", exact_scale=4)


@query("survival_rate_by", TRAIN + """
SELECT title, avg(survived) AS rate FROM train GROUP BY title
""")
def q_survival_rate_by(spark, sf_dir):
    return stats.grouped_mean(train_rows(spark, sf_dir), ["title"], "survived", "rate")


SURVIVAL_SETS = [["title"], ["title", "pclass"], ["family_size"], ["family_size", "pclass"],
                 ["family_size", "sex"], ["parch"], ["parch", "sex"], ["sibsp"],
                 ["sibsp", "sex"], ["level_cabin"], ["level_cabin", "pclass"]]


def _sets_sql(set_list=None, mean_sql="avg(survived)", n_sql="count(survived)", alias="rate"):
    set_list = set_list or SURVIVAL_SETS
    cols = sorted({k for s in set_list for k in s})
    label = "CASE " + " ".join(
        f"WHEN {' AND '.join(f'GROUPING({c}) = {0 if c in s else 1}' for c in cols)} "
        f"THEN '{','.join(s)}'" for s in set_list) + " END"
    sets = ", ".join("(" + ", ".join(s) + ")" for s in set_list)
    return TRAIN + f"""
SELECT {', '.join(cols)}, {mean_sql} AS {alias}, CAST({n_sql} AS BIGINT) AS n,
       {label} AS grouping_set
FROM train GROUP BY GROUPING SETS ({sets})
HAVING {' AND '.join(f'(GROUPING({c}) = 1 OR {c} IS NOT NULL)' for c in cols)}
"""


@query("survival_rate_sets", _sets_sql())
def q_survival_rate_sets(spark, sf_dir):
    """Eleven survival-rate breakdowns in one scan (GROUPING SETS)."""
    return stats.grouping_sets_mean(train_rows(spark, sf_dir), SURVIVAL_SETS, "survived")


@query("multi_agg", TRAIN + """
SELECT title, avg(survived) AS mean, CAST(count(survived) AS BIGINT) AS count
FROM train GROUP BY title
""")
def q_multi_agg(spark, sf_dir):
    return stats.mean_and_count(train_rows(spark, sf_dir), "title", "survived")


@query("weighted_survival", TRAIN + """
SELECT title, CAST(sum(survived) AS DOUBLE) * CAST(count(survived) AS DOUBLE)
              / CAST((SELECT count(survived) FROM train) AS DOUBLE) * CAST(100.0 AS DOUBLE)
              AS weighted_rate
FROM train GROUP BY title
""")
def q_weighted_survival(spark, sf_dir):
    return stats.weighted_rate(train_rows(spark, sf_dir), "title", "survived")


def _box_sql(value: str) -> str:
    return TRAIN + f"""
, q AS (
  SELECT pclass, survived, sex, count(*) AS n,
         quantile_cont({value}, 0.25) AS q1, quantile_cont({value}, 0.5) AS median,
         quantile_cont({value}, 0.75) AS q3
  FROM train WHERE {value} IS NOT NULL GROUP BY pclass, survived, sex),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT f.pclass, f.survived, f.sex, CAST(f.n AS BIGINT) AS n,
       round(f.q1, 9) AS q1, round(f.median, 9) AS median, round(f.q3, 9) AS q3,
       min(CASE WHEN t.{value} BETWEEN f.lo AND f.hi THEN t.{value} END) AS whisker_low,
       max(CASE WHEN t.{value} BETWEEN f.lo AND f.hi THEN t.{value} END) AS whisker_high,
       CAST(count(CASE WHEN t.{value} < f.lo OR t.{value} > f.hi THEN 1 END) AS BIGINT)
           AS n_outliers
FROM train t JOIN f ON t.pclass = f.pclass AND t.survived = f.survived AND t.sex = f.sex
WHERE t.{value} IS NOT NULL
GROUP BY f.pclass, f.survived, f.sex, f.n, f.q1, f.median, f.q3
"""


@query("box_stats", _box_sql("age"))
def q_box_stats(spark, sf_dir):
    """Age box-plot numbers by class x outcome x sex."""
    return rounded(stats.box_stats(train_rows(spark, sf_dir), ["pclass", "survived", "sex"], "age"), "q1", "median", "q3")


@query("box_stats_fare", _box_sql("fare"))
def q_box_stats_fare(spark, sf_dir):
    """Fare box-plot numbers by class x outcome x sex."""
    return rounded(stats.box_stats(train_rows(spark, sf_dir), ["pclass", "survived", "sex"], "fare"), "q1", "median", "q3")


@query("histogram_bins", TRAIN + """
, mm AS (SELECT min(fare) AS mn, max(fare) AS mx FROM train),
b AS (SELECT CAST(LEAST(COALESCE(FLOOR((fare - mn) / NULLIF((mx - mn) / 10.0, 0)), 0), 9)
                 AS INTEGER) AS bin
      FROM train, mm WHERE fare IS NOT NULL)
SELECT bin, CAST(count(*) AS BIGINT) AS n FROM b GROUP BY bin
""")
def q_histogram_bins(spark, sf_dir):
    """Ten equal-width fare bins (the numbers under the histogram)."""
    return stats.histogram(train_rows(spark, sf_dir), "fare", 10).select("bin", "n")


@query("median_value", TRAIN + """
SELECT CAST(count(age) AS BIGINT) AS n, round(quantile_cont(age, 0.5), 9) AS median FROM train
""")
def q_median_value(spark, sf_dir):
    return rounded(stats.median_of(train_rows(spark, sf_dir), "age"), "median")


@query("quantiles_by_group", TRAIN + """
SELECT pclass, CAST(count(fare) AS BIGINT) AS n,
       round(quantile_cont(fare, 0.1), 9) AS q_10, round(quantile_cont(fare, 0.5), 9) AS q_50,
       round(quantile_cont(fare, 0.9), 9) AS q_90
FROM train GROUP BY pclass
""")
def q_quantiles_by_group(spark, sf_dir):
    return rounded(stats.quantiles(train_rows(spark, sf_dir), ["pclass"], "fare", [0.1, 0.5, 0.9]), "q_10", "q_50", "q_90")


@query("mode_value", TRAIN + """
, c AS (SELECT embarked, count(*) AS n FROM train WHERE embarked IS NOT NULL GROUP BY embarked)
SELECT embarked AS mode, CAST(n AS BIGINT) AS mode_count FROM c
ORDER BY n DESC, embarked ASC LIMIT 1
""")
def q_mode_value(spark, sf_dir):
    """Most frequent port (smallest on ties)."""
    return stats.mode_of(train_rows(spark, sf_dir), "embarked")


@query("mode_by_group", TRAIN + """
, c AS (SELECT pclass, title, count(*) AS n FROM train WHERE title IS NOT NULL
        GROUP BY pclass, title),
r AS (SELECT *, row_number() OVER (PARTITION BY pclass ORDER BY n DESC, title ASC) AS rn FROM c)
SELECT pclass, title AS mode, CAST(n AS BIGINT) AS mode_count FROM r WHERE rn = 1
""")
def q_mode_by_group(spark, sf_dir):
    return stats.mode_of(train_rows(spark, sf_dir), "title", ["pclass"])


EDA_NUMERIC = ["survived", "pclass", "age", "fare", "sibsp", "parch", "family_size"]


def _corr_sql(pairs):
    sel = " UNION ALL ".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 9) AS r FROM train"
        for a, b in pairs)
    return TRAIN + sel


@query("corr_pairs", _corr_sql([(a, b) for i, a in enumerate(EDA_NUMERIC)
                                for b in EDA_NUMERIC[i + 1:]]))
def q_corr_pairs(spark, sf_dir):
    """Pearson matrix (upper triangle, long form) in one aggregate."""
    return rounded(stats.corr_pairs(train_rows(spark, sf_dir), EDA_NUMERIC), "r")


@query("corr_with_label", _corr_sql([(a, "survived") for a in EDA_NUMERIC[1:]]))
def q_corr_with_label(spark, sf_dir):
    return rounded(stats.corr_pairs(train_rows(spark, sf_dir), EDA_NUMERIC[1:], with_col="survived"), "r")


@query("abs_value", TRAIN + " SELECT col_a, abs(r) AS abs_r FROM (" + " UNION ALL ".join(
    f"SELECT '{a}' AS col_a, round(corr({a}, survived), 9) AS r FROM train"
    for a in EDA_NUMERIC[1:]) + ")")
def q_abs_value(spark, sf_dir):
    c = rounded(stats.corr_pairs(train_rows(spark, sf_dir), EDA_NUMERIC[1:], with_col="survived"), "r")
    return c.select("col_a", abs_value(F.col("r")).alias("abs_r"))


# ------------------------------------------------------------ shares, pivots

SHARES_SQL = TRAIN + """
, g AS (SELECT pclass, sex, survived, count(passenger_id) AS n FROM train
        GROUP BY pclass, sex, survived)
SELECT pclass, sex, survived, CAST(n AS BIGINT) AS n,
       CAST(sum(n) OVER (PARTITION BY survived) AS BIGINT) AS total_label,
       CAST(n AS DOUBLE) / CAST(sum(n) OVER (PARTITION BY survived) AS DOUBLE)
           * CAST(100.0 AS DOUBLE) AS pct_label,
       CAST(sum(n) OVER (PARTITION BY sex) AS BIGINT) AS total_sex,
       CAST(n AS DOUBLE) / CAST(sum(n) OVER (PARTITION BY sex) AS DOUBLE)
           * CAST(100.0 AS DOUBLE) AS pct_sex
FROM g
"""


def _shares(spark, sf_dir):
    counts = stats.count_by_keys(train_rows(spark, sf_dir), ["pclass", "sex", "survived"],
                                 "passenger_id")
    return stats.shares_of_totals(counts, "n", {"label": ["survived"], "sex": ["sex"]})


@query("share_of_label_total", SHARES_SQL)
def q_share_of_label_total(spark, sf_dir):
    """Share of each (class, sex) cell within its outcome (window over groups)."""
    return _shares(spark, sf_dir)


@query("share_of_sex_total", TRAIN + """
, g AS (SELECT pclass, sex, survived, count(passenger_id) AS n FROM train
        GROUP BY pclass, sex, survived)
SELECT sex, survived, pclass,
       CAST(n AS DOUBLE) / CAST(sum(n) OVER (PARTITION BY sex) AS DOUBLE)
           * CAST(100.0 AS DOUBLE) AS pct_sex
FROM g
""")
def q_share_of_sex_total(spark, sf_dir):
    return _shares(spark, sf_dir).select("sex", "survived", "pclass", "pct_sex")


@query("pivot_mean", TRAIN + """
SELECT survived, avg(CASE WHEN pclass = 1 THEN age END) AS "1",
       avg(CASE WHEN pclass = 2 THEN age END) AS "2", avg(CASE WHEN pclass = 3 THEN age END) AS "3"
FROM train GROUP BY survived
""")
def q_pivot_mean(spark, sf_dir):
    """Mean age, outcome x class (unstacked)."""
    return stats.pivot_agg(train_rows(spark, sf_dir), "survived", "pclass", [1, 2, 3], "mean", "age")


# Means unstacked: name, row keys, column key, its values, value.  Fares are summed as DECIMAL.
SEXES, CLASSES = ("female", "male"), (1, 2, 3)
MEAN_PIVOTS = (
    ("pivot_mean_age_sex", ["survived"], "sex", SEXES, "age"),
    ("pivot_mean_fare_sex", ["survived"], "sex", SEXES, "fare"),
    ("pivot_mean_fare_sex_class", ["survived", "sex"], "pclass", CLASSES, "fare"),
    ("pivot_rate_title_class", ["title"], "pclass", CLASSES, "survived"),
    ("pivot_rate_family_class", ["family_size"], "pclass", CLASSES, "survived"),
    ("pivot_rate_family_sex", ["family_size"], "sex", SEXES, "survived"),
    ("pivot_rate_parch_sex", ["parch"], "sex", SEXES, "survived"),
    ("pivot_rate_sibsp_sex", ["sibsp"], "sex", SEXES, "survived"),
    ("pivot_rate_cabin_class", ["level_cabin"], "pclass", CLASSES, "survived"),
)


def _mean_pivot(name, rows, col, values, value):
    cell = ("CAST(sum(CASE WHEN {c} THEN CAST(fare AS DECIMAL(18,4)) END) AS DOUBLE) / count(CASE WHEN {c} THEN fare END)"
            if value == "fare" else "avg(CASE WHEN {c} THEN " + value + " END)")
    literal = lambda v: f"'{v}'" if isinstance(v, str) else str(v)
    cells = ", ".join(cell.format(c=f"{col} = {literal(v)}") + f' AS "{v}"' for v in values)
    keys = ", ".join(rows)
    whole = " AND ".join(f"{k} IS NOT NULL" for k in [*rows, col])

    @query(name, TRAIN + f"SELECT {keys}, {cells} FROM train WHERE {whole} GROUP BY {keys}")
    def run(spark, sf_dir):
        return stats.pivot_agg(train_rows(spark, sf_dir), rows, col, values, "mean", value, exact_scale=4 if value == "fare" else None)

    run.__doc__ = f"Mean {value}, {' x '.join(rows)} x {col} (unstacked)."


for _pivot in MEAN_PIVOTS:
    _mean_pivot(*_pivot)


@query("pivot_count", TRAIN + """
SELECT survived, """ + ", ".join(
    f'CAST(NULLIF(count(CASE WHEN sibsp = {i} THEN passenger_id END), 0) AS BIGINT) AS "{i}"'
    for i in range(9)) + """
FROM train GROUP BY survived
""")
def q_pivot_count(spark, sf_dir):
    """Passenger counts, outcome x siblings (unstacked; empty cell NULL)."""
    return stats.pivot_agg(train_rows(spark, sf_dir), "survived", "sibsp", list(range(9)),
                           "count", "passenger_id")


@query("sorted_groups", TRAIN + """
SELECT pclass, avg(survived) AS rate FROM train GROUP BY pclass ORDER BY pclass
""")
def q_sorted_groups(spark, sf_dir):
    """Grouped output ordered by key, at the presentation edge only."""
    return (stats.grouped_mean(train_rows(spark, sf_dir), ["pclass"], "survived", "rate")
            .orderBy("pclass"))


@query("box_stats_group_means", TRAIN + """
, m AS (SELECT survived, sibsp, pclass,
               CAST(sum(CAST(fare AS DECIMAL(18,4))) AS DOUBLE) / count(fare) AS mean_fare
        FROM train GROUP BY survived, sibsp, pclass),
q AS (SELECT sibsp, survived, count(*) AS n,
             quantile_cont(mean_fare, 0.25) AS q1, quantile_cont(mean_fare, 0.5) AS median,
             quantile_cont(mean_fare, 0.75) AS q3
      FROM m WHERE mean_fare IS NOT NULL GROUP BY sibsp, survived),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT f.sibsp, f.survived, CAST(f.n AS BIGINT) AS n,
       round(f.q1, 9) AS q1, round(f.median, 9) AS median, round(f.q3, 9) AS q3,
       min(CASE WHEN m.mean_fare BETWEEN f.lo AND f.hi THEN m.mean_fare END) AS whisker_low,
       max(CASE WHEN m.mean_fare BETWEEN f.lo AND f.hi THEN m.mean_fare END) AS whisker_high,
       CAST(count(CASE WHEN m.mean_fare < f.lo OR m.mean_fare > f.hi THEN 1 END) AS BIGINT)
           AS n_outliers
FROM m JOIN f ON m.sibsp = f.sibsp AND m.survived = f.survived
GROUP BY f.sibsp, f.survived, f.n, f.q1, f.median, f.q3
""")
def q_box_stats_group_means(spark, sf_dir):
    """Box-plot numbers over an aggregated table: mean fare per
    (outcome, siblings, class), boxed by siblings x outcome."""
    means = stats.grouped_mean(train_rows(spark, sf_dir), ["survived", "sibsp", "pclass"], "fare",
                               "mean_fare", exact_scale=4)
    return rounded(stats.box_stats(means, ["sibsp", "survived"], "mean_fare"), "q1", "median", "q3")


AGE_SETS = [["survived"], ["survived", "sex"], ["survived", "pclass"]]
FARE_SETS = [["survived"], ["survived", "sex"], ["survived", "sex", "pclass"],
             ["survived", "sibsp", "sex"], ["survived", "sibsp", "pclass"]]


@query("mean_age_sets", _sets_sql(AGE_SETS, "avg(age)", "count(age)", "mean_age"))
def q_mean_age_sets(spark, sf_dir):
    """Mean age by outcome; x sex; x class — one GROUPING SETS scan."""
    return stats.grouping_sets_mean(train_rows(spark, sf_dir), AGE_SETS, "age", "mean_age")


@query("mean_fare_sets", _sets_sql(
    FARE_SETS, "CAST(sum(CAST(fare AS DECIMAL(18,4))) AS DOUBLE) / count(fare)", "count(fare)",
    "mean_fare"))
def q_mean_fare_sets(spark, sf_dir):
    """The five mean-fare breakdowns in one scan (exact decimal sums)."""
    return stats.grouping_sets_mean(train_rows(spark, sf_dir), FARE_SETS, "fare", "mean_fare",
                                    exact_scale=4)


@query("box_stats_sex_fare_means", TRAIN + """
, m AS (SELECT survived, sibsp, sex,
               CAST(sum(CAST(fare AS DECIMAL(18,4))) AS DOUBLE) / count(fare) AS mean_fare
        FROM train GROUP BY survived, sibsp, sex),
q AS (SELECT sex, survived, count(*) AS n,
             quantile_cont(mean_fare, 0.25) AS q1, quantile_cont(mean_fare, 0.5) AS median,
             quantile_cont(mean_fare, 0.75) AS q3
      FROM m WHERE mean_fare IS NOT NULL GROUP BY sex, survived),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT f.sex, f.survived, CAST(f.n AS BIGINT) AS n,
       round(f.q1, 9) AS q1, round(f.median, 9) AS median, round(f.q3, 9) AS q3,
       min(CASE WHEN m.mean_fare BETWEEN f.lo AND f.hi THEN m.mean_fare END) AS whisker_low,
       max(CASE WHEN m.mean_fare BETWEEN f.lo AND f.hi THEN m.mean_fare END) AS whisker_high,
       CAST(count(CASE WHEN m.mean_fare < f.lo OR m.mean_fare > f.hi THEN 1 END) AS BIGINT)
           AS n_outliers
FROM m JOIN f ON m.sex = f.sex AND m.survived = f.survived
GROUP BY f.sex, f.survived, f.n, f.q1, f.median, f.q3
""")
def q_box_stats_sex_fare_means(spark, sf_dir):
    """Box-plot numbers over an aggregated table: mean fare per (outcome,
    siblings, sex), boxed by sex x outcome."""
    means = stats.grouped_mean(train_rows(spark, sf_dir), ["survived", "sibsp", "sex"], "fare", "mean_fare", exact_scale=4)
    return rounded(stats.box_stats(means, ["sex", "survived"], "mean_fare"), "q1", "median", "q3")


@query("nunique_sketched", TRAIN + "SELECT title, CAST(count(DISTINCT survived) AS BIGINT) AS n_distinct FROM train WHERE title IS NOT NULL GROUP BY title")
def q_nunique_sketched(spark, sf_dir):
    """Distinct outcomes by title from sketches of four batches of rows, stored
    and merged (so few distinct values are counted exactly)."""
    from strata.operators import sketches as S
    from strata.session import scratch_path

    rows, store = train_rows(spark, sf_dir), S.SketchStore(spark, scratch_path(spark, "distinct-sketches"))
    for b in range(4):
        store.put(str(b), S.distinct_sketches(rows.where(F.pmod(F.col("passenger_id"), F.lit(4)) == b), ["title"], "survived"))
    return S.distinct_estimates(S.merge_distinct(store.sketches(), ["title"]), ["title"])


@query("box_stats_sketched")
def q_box_stats_sketched(spark, sf_dir):
    """Fare box-plot numbers by class x outcome x sex from merged quantile sketches."""
    from strata.operators import sketches as S
    from strata.session import scratch_path

    keys = ["pclass", "survived", "sex"]
    rows, store = train_rows(spark, sf_dir), S.SketchStore(spark, scratch_path(spark, "quantile-sketches"))
    for b in range(4):
        store.put(str(b), S.quantile_sketches(rows.where(F.pmod(F.col("passenger_id"), F.lit(4)) == b), keys, "fare"))
    return S.sketched_box_stats(S.merge_quantiles(store.sketches(), keys), keys)


@query("read_scoring_set_csv", TEST + """
SELECT passenger_id, pclass, name, sex, age, sibsp, parch, fare, cabin, embarked FROM test
""")
def q_read_scoring_set_csv(spark, sf_dir):
    """The unlabelled CSV: held-out rows written without the label, read back
    by the declared-schema source, bad rows aside (there are none)."""
    from strata.session import scratch_path
    from strata.sources.files import PASSENGER_CSV_HEADER, PASSENGER_SCHEMA, read_scoring_set_checked

    path = scratch_path(spark, "scoring-csv")
    rows = test_rows(spark, sf_dir).withColumn("ticket", F.lit(None).cast("string"))
    named = [(f.name, h) for f, h in zip(PASSENGER_SCHEMA.fields, PASSENGER_CSV_HEADER) if f.name != "survived"]
    rows.select(*[F.col(c).alias(h) for c, h in named]).write.option("header", True).csv(path)
    read, bad = read_scoring_set_checked(spark, path)
    return read.drop("ticket").unionByName(bad.select(F.raise_error(F.col("reason")).cast("long").alias("passenger_id")), allowMissingColumns=True)


@query("read_passengers_csv", with_(PASSENGERS_CTE) + "SELECT * FROM passengers")
def q_read_passengers_csv(spark, sf_dir):
    """CSV round trip in the classic passenger layout (header, quoted names,
    empty cells for nulls), read back by the declared-schema source."""
    from strata.session import scratch_path
    from strata.sources.files import PASSENGER_CSV_HEADER, read_passengers
    path = scratch_path(spark, "passengers-csv")
    p = passengers(spark, sf_dir).withColumn("ticket", F.lit(None).cast("string"))
    cols = ["passenger_id", "survived", "pclass", "name", "sex", "age", "sibsp", "parch",
            "ticket", "fare", "cabin", "embarked"]
    p.select(*[F.col(c).alias(h) for c, h in zip(cols, PASSENGER_CSV_HEADER)]) \
        .write.mode("overwrite").option("header", True).csv(path)
    return read_passengers(spark, path).drop("ticket")


@query("box_stats_shares", TRAIN + """
, g AS (SELECT pclass, sex, survived, count(passenger_id) AS n FROM train
        GROUP BY pclass, sex, survived),
s AS (SELECT pclass, sex, survived,
             CAST(n AS DOUBLE) / CAST(sum(n) OVER (PARTITION BY sex) AS DOUBLE)
             * CAST(100.0 AS DOUBLE) AS pct_sex FROM g),
q AS (SELECT sex, survived, count(*) AS n,
             round(quantile_cont(pct_sex, 0.25), 9) AS q1,
             round(quantile_cont(pct_sex, 0.5), 9) AS median,
             round(quantile_cont(pct_sex, 0.75), 9) AS q3
      FROM s GROUP BY sex, survived),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT f.sex, f.survived, CAST(f.n AS BIGINT) AS n,
       round(f.q1, 9) AS q1, round(f.median, 9) AS median, round(f.q3, 9) AS q3,
       min(CASE WHEN s.pct_sex BETWEEN f.lo AND f.hi THEN s.pct_sex END) AS whisker_low,
       max(CASE WHEN s.pct_sex BETWEEN f.lo AND f.hi THEN s.pct_sex END) AS whisker_high,
       CAST(count(CASE WHEN s.pct_sex < f.lo OR s.pct_sex > f.hi THEN 1 END) AS BIGINT)
           AS n_outliers
FROM s JOIN f ON s.sex = f.sex AND s.survived = f.survived
GROUP BY f.sex, f.survived, f.n, f.q1, f.median, f.q3
""")
def q_box_stats_shares(spark, sf_dir):
    """Box-plot numbers of the per-class share of each sex, by sex x outcome
    (a box over an aggregated table)."""
    return rounded(stats.box_stats(_shares(spark, sf_dir), ["sex", "survived"], "pct_sex"), "q1", "median", "q3")


@query("pivot_count_family_sex", TRAIN + """
SELECT family_size,
       CAST(NULLIF(count(CASE WHEN sex = 'female' THEN passenger_id END), 0) AS BIGINT) AS female,
       CAST(NULLIF(count(CASE WHEN sex = 'male' THEN passenger_id END), 0) AS BIGINT) AS male
FROM train GROUP BY family_size
""")
def q_pivot_count_family_sex(spark, sf_dir):
    """Passengers by family size x sex (unstacked)."""
    return stats.pivot_agg(train_rows(spark, sf_dir), "family_size", "sex", ["female", "male"],
                           "count", "passenger_id")


@query("pivot_count_cabin_class", TRAIN + """
SELECT level_cabin, """ + ", ".join(
    f'CAST(NULLIF(count(CASE WHEN pclass = {c} THEN survived END), 0) AS BIGINT) AS "{c}"'
    for c in (1, 2, 3)) + """
FROM train GROUP BY level_cabin
""")
def q_pivot_count_cabin_class(spark, sf_dir):
    """Labelled passengers by cabin level x class (unstacked)."""
    return stats.pivot_agg(train_rows(spark, sf_dir), "level_cabin", "pclass", [1, 2, 3],
                           "count", "survived")
