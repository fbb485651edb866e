"""File sources and sinks with declared schemas; columns go by the header's names.

Schemas are always passed: inference costs a second scan and may type
``duration`` as an integer, after which ``duration == "60"`` never matches.
Empty CSV cells read as NULL, as pandas reads them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SALES_SCHEMA = T.StructType([
    T.StructField("date", T.TimestampNTZType(), False),
    T.StructField("region", T.StringType(), True),
    T.StructField("country", T.StringType(), True),
    T.StructField("customer_id", T.LongType(), True),
    T.StructField("delivery_type", T.StringType(), True),
    T.StructField("revenue", T.DoubleType(), True),
    T.StructField("cost", T.DoubleType(), True),
    T.StructField("duration", T.StringType(), True),
    T.StructField("cost_type", T.StringType(), True),
])

_PASSENGER_FIELDS = [
    ("passenger_id", T.LongType()), ("survived", T.IntegerType()), ("pclass", T.IntegerType()),
    ("name", T.StringType()), ("sex", T.StringType()), ("age", T.DoubleType()),
    ("sibsp", T.IntegerType()), ("parch", T.IntegerType()), ("ticket", T.StringType()),
    ("fare", T.DoubleType()), ("cabin", T.StringType()), ("embarked", T.StringType()),
]
# The classic passenger CSV header, in file order.
PASSENGER_CSV_HEADER = ("PassengerId", "Survived", "Pclass", "Name", "Sex", "Age", "SibSp",
                        "Parch", "Ticket", "Fare", "Cabin", "Embarked")

PASSENGER_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in _PASSENGER_FIELDS])
SCORING_SCHEMA = T.StructType([f for f in PASSENGER_SCHEMA.fields if f.name != "survived"])

PREDICTION_SCHEMA = T.StructType([
    T.StructField("PassengerId", T.LongType(), False),
    T.StructField("Survived", T.IntegerType(), False),
])


def _csv(spark: SparkSession, schema: T.StructType, path: str, **opts) -> DataFrame:
    """The columns of ``schema``, found by the names in the header wherever
    they stand; other columns are not read.  A name that is missing raises, and
    so does a file whose header differs from the first one's."""
    def reader():
        r = spark.read.option("header", True).option("sep", ",").option("nullValue", "")
        for k, v in opts.items():
            r = r.option(k, v)
        return r

    header = reader().csv(path).columns  # reads the first line
    missing = [f.name for f in schema.fields if f.name not in header]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    types = {f.name: f for f in schema.fields}
    in_file = T.StructType([types.get(h, T.StructField(h, T.StringType(), True)) for h in header])
    return reader().schema(in_file).option("mode", "FAILFAST").option("enforceSchema", False).csv(path).select(*schema.names)


def read_sales(spark: SparkSession, path: str) -> DataFrame:
    """Sales CSV: header, ``date`` parsed as a timestamp, ``duration`` a string."""
    return _csv(spark, SALES_SCHEMA, path, timestampNTZFormat="yyyy-MM-dd[ HH:mm:ss]")


def _passenger_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    named = dict(zip([f.name for f in PASSENGER_SCHEMA.fields], PASSENGER_CSV_HEADER))
    in_file = T.StructType([T.StructField(named[f.name], f.dataType, True) for f in schema.fields])
    return _csv(spark, in_file, path).toDF(*schema.names)


def read_passengers(spark: SparkSession, path: str) -> DataFrame:
    """Labelled passenger CSV with the classic header names."""
    return _passenger_csv(spark, path, PASSENGER_SCHEMA)


def read_scoring_set(spark: SparkSession, path: str) -> DataFrame:
    """Unlabelled passenger CSV (the header without ``Survived``)."""
    return _passenger_csv(spark, path, SCORING_SCHEMA)


def write_predictions(pred: DataFrame, path: str, id_col: str = "passenger_id",
                      label_col: str = "prediction") -> None:
    """CSV sink ``PassengerId,Survived`` with a header: a directory of part
    files written in parallel (no single-writer ``coalesce(1)``)."""
    (pred.selectExpr(f"CAST({id_col} AS BIGINT) AS PassengerId",
                     f"CAST({label_col} AS INT) AS Survived")
     .write.mode("overwrite").option("header", True).csv(path))


BAD_SCHEMA = "file string, line string, reason string"


def checked_csv(spark: SparkSession, schema: T.StructType, path: str, formats: dict[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, bad rows) of a CSV with a header, from one reader: a row that
    does not fit the schema is no null and stops nothing, it goes to BAD_SCHEMA
    with its line and the reasons: the number of fields, a value that is not of
    its column's type, none where the schema wants one.  ``formats``: of dates
    and timestamps, by column.  Columns go by the header's names."""
    opened = spark.read.option("header", True).option("nullValue", "").option("enforceSchema", False)
    header = opened.csv(path).columns  # reads the first line
    missing = [f.name for f in schema.fields if f.name not in header]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    if len(set(header)) < len(header):
        raise ValueError(f"{path} has two columns of the same name")
    # all columns are read as text, so that the reader sees every field of a line and each value keeps its spelling
    text = T.StructType([T.StructField(h, T.StringType()) for h in header] + [T.StructField("_line", T.StringType())])
    lines = (opened.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_line").option("columnPruning", False).schema(text).csv(path)
             .select(*[F.col(f"`{h}`").alias(f"t{i}") for i, h in enumerate(header)], F.col("_line").alias("line"), F.col("_metadata.file_path").alias("file")))
    value, wrong = {}, [F.when(F.col("line").isNotNull(), F.lit(f"not {len(header)} fields"))]
    for f in schema.fields:
        spelt = F.col(f"t{header.index(f.name)}")
        typed = (F.try_to_timestamp(spelt, F.lit(formats[f.name])) if formats and f.name in formats else spelt).try_cast(f.dataType)
        value[f.name] = typed
        wrong.append(F.when(F.col("line").isNull() & spelt.isNotNull() & typed.isNull(), F.lit(f"{f.name} is no {f.dataType.simpleString()}")))
        if not f.nullable:
            wrong.append(F.when(F.col("line").isNull() & spelt.isNull(), F.lit(f"{f.name} is missing")))
    checked = lines.withColumn("reason", F.concat_ws("; ", *wrong))
    rows = checked.where("reason = ''").select(*[v.alias(n) for n, v in value.items()])
    spelt = F.to_csv(F.struct(*[f"t{i}" for i in range(len(header))]))
    bad = checked.where("reason <> ''").select("file", F.coalesce("line", spelt).alias("line"), "reason")
    return rows, bad


def bad_counts(bad: DataFrame) -> DataFrame:
    """How many bad rows a reason has; a row of several reasons counts for each."""
    return bad.select(F.explode(F.split("reason", "; ")).alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def read_sales_checked(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``read_sales`` with the bad rows aside."""
    return checked_csv(spark, SALES_SCHEMA, path, {"date": "yyyy-MM-dd[ HH:mm:ss]"})


def read_scoring_set_checked(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``read_scoring_set`` with the bad rows aside."""
    named = dict(zip([f.name for f in PASSENGER_SCHEMA.fields], PASSENGER_CSV_HEADER))
    in_file = T.StructType([T.StructField(named[f.name], f.dataType, f.name != "passenger_id") for f in SCORING_SCHEMA.fields])
    rows, bad = checked_csv(spark, in_file, path)
    return rows.toDF(*SCORING_SCHEMA.names), bad


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark, PREDICTION_SCHEMA, path)
