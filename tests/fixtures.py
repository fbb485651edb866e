"""Hand fixtures (FIXTURES.md sections 1 and 2)."""

import datetime as dt

from pyspark.sql import types as T

SALES_ROWS = [
    ("E", "A", 1, "2019-01-01", "fast", 1000.0, 400.0, "expert", "60"),
    ("E", "A", 1, "2019-03-05", "fastest", 2000.0, 900.0, "normal", "60"),
    ("E", "A", 2, "2019-06-30", "slow", 3000.0, 1200.0, "expert", "30"),
    ("E", "A", 3, "2018-06-30", "fast", 4000.0, 1000.0, "normal", "60"),
    ("E", "A", 4, "2019-07-01", "fast", 500.0, 100.0, "expert", "60"),
    ("E", "B", 5, "2019-02-02", "slow", 800.0, 300.0, "normal", "30"),
    ("W", "C", 6, "2018-02-02", "fast", 700.0, 200.0, "expert", "60"),
    (None, "D", 7, "2019-02-02", "fast", 900.0, 100.0, "expert", "60"),
]

SALES_SCHEMA = T.StructType([
    T.StructField("region", T.StringType()), T.StructField("country", T.StringType()),
    T.StructField("customer_id", T.LongType()), T.StructField("date", T.TimestampNTZType()),
    T.StructField("delivery_type", T.StringType()), T.StructField("revenue", T.DoubleType()),
    T.StructField("cost", T.DoubleType()), T.StructField("cost_type", T.StringType()),
    T.StructField("duration", T.StringType()),
])


def sales_df(spark):
    rows = [r[:3] + (dt.datetime.fromisoformat(r[3]),) + r[4:] for r in SALES_ROWS]
    return spark.createDataFrame(rows, SALES_SCHEMA)


# group -> recency, fast_and_fastest, rev_2019, rev_2018, cost_2019, cost_2019_exp,
# other_cost, rev_per_60, profit_margin, profit_margin_total_cost, cost_exp_per_60, growth
SALES_EXPECTED = {
    ("E", "A"): (70, 1, 6000, 4000, 2500, 1600, 900, 3000, 73.333333, 58.333333, 400, 50),
    ("E", "B"): (219, 0, 800, 0, 300, 0, 300, None, 100, 62.5, None, None),
    ("W", "C"): (584, 0, 0, 700, 0, 0, 0, None, None, None, None, -100),
}

PASSENGER_ROWS = [
    (1, 0, 3, "Braund, Mr. Owen", "male", 22.0, 1, 0, 7.25, None, "S"),
    (2, 1, 1, "Cumings, Mrs. John", "female", 38.0, 1, 0, 71.25, "C85", "C"),
    (3, 1, 3, "Heikkinen, Miss. Laina", "female", 26.0, 0, 0, 8.0, "", "S"),
    (4, 1, 1, "Rothes, the Countess. of (L)", "female", None, 4, 0, 50.0, "B77", "C"),
    (5, 0, 3, "Sage, Mr. Fred", "male", None, 8, 2, 70.0, None, "S"),
    (6, 0, 2, "Moran, Mr. James", "male", 30.0, 0, 0, 8.0, None, None),
    (7, 0, 3, "Rice, Master. Eugene", "male", 2.0, 4, 1, 30.0, None, "Q"),
    (8, 1, 2, "Nasser, Mrs. N", "female", 14.0, 1, 0, 30.0, "F2", "C"),
]

PASSENGER_SCHEMA = T.StructType([
    T.StructField("passenger_id", T.LongType()), T.StructField("survived", T.IntegerType()),
    T.StructField("pclass", T.IntegerType()), T.StructField("name", T.StringType()),
    T.StructField("sex", T.StringType()), T.StructField("age", T.DoubleType()),
    T.StructField("sibsp", T.IntegerType()), T.StructField("parch", T.IntegerType()),
    T.StructField("fare", T.DoubleType()), T.StructField("cabin", T.StringType()),
    T.StructField("embarked", T.StringType()),
])


def passengers_df(spark):
    from strata.operators.enrich import enrich
    return enrich(spark.createDataFrame(PASSENGER_ROWS, PASSENGER_SCHEMA))


# id -> title, family, cabin level, fam_size, sib_sp, age scaled, fare scaled, port imputed
PASSENGER_EXPECTED = {
    1: ("Mr", 1, "No Cabin", "small_fam", "less_4", 0.555556, 0.0, "S"),
    2: ("Mrs", 1, "C", "small_fam", "less_4", 1.0, 1.0, "C"),
    3: ("Miss", 0, "No Cabin", "small_fam", "less_4", 0.666667, 0.011719, "S"),
    4: ("the Countess", 4, "B", "medium_fam", "less_4", 0.611111, 0.667969, "C"),
    5: ("Mr", 10, "No Cabin", "large_fam", "over_4", 0.611111, 0.980469, "S"),
    6: ("Mr", 0, "No Cabin", "small_fam", "less_4", 0.777778, 0.011719, "C"),
    7: ("Master", 5, "No Cabin", "medium_fam", "less_4", 0.0, 0.355469, "Q"),
    8: ("Mrs", 1, "F", "small_fam", "less_4", 0.333333, 0.355469, "C"),
}
