import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from strata.operators.dictionary import dictionary, encode_ids, one_hot_sparse
from strata.operators.features import FeaturePipeline, FeatureSpec

ROWS = [("b", 1), ("a", 2), (None, 3), ("c", 4), ("a", 5), ("ä", 6), ("", 7)]


@pytest.fixture(scope="module")
def small(spark):
    return spark.createDataFrame(ROWS, "kind string, id int")


def test_ids_are_dense_and_in_order(small):
    words = sorted({k for k, _ in ROWS if k is not None})
    for n in (1, 9):
        assert [tuple(r) for r in dictionary(small.repartition(n), "kind").orderBy("id").collect()] == [(w, i) for i, w in enumerate(words)]


def test_equal_to_one_hot_columns(small):
    words = dictionary(small, "kind")
    got = {r["id"]: r["v"] for r in one_hot_sparse(small, "kind", words, "vec").select("id", vector_to_array("vec").alias("v")).collect()}
    keyed = small.withColumnRenamed("id", "passenger_id")  # which transform keeps
    model = FeaturePipeline(FeatureSpec(steps=(("one_hot", ("kind",)),)), handle_unknown="ignore").fit(keyed)
    flat = model.transform(keyed).collect()
    assert len(got) == len(ROWS)
    for r in flat:
        assert got[r["passenger_id"]] == [r[c] for c in model.feature_names]


def test_unknown_categories(spark, small):
    words = dictionary(small, "kind")
    new = spark.createDataFrame([("zz", 1), ("a", 2)], "kind string, id int")
    with pytest.raises(Exception, match="not in the dictionary: zz"):
        encode_ids(new, "kind", words, "code").collect()
    assert {r["id"]: r["code"] for r in encode_ids(new, "kind", words, "code", "ignore").collect()} == {1: None, 2: 1}
    assert {r["id"]: sum(r["v"]) for r in one_hot_sparse(new, "kind", words, "vec", "ignore").select("id", vector_to_array("vec").alias("v")).collect()} == {1: 0, 2: 1}
    with pytest.raises(ValueError):
        one_hot_sparse(small, "kind", dictionary(small.limit(0), "kind"), "vec")


def test_very_many_categories(spark):
    """A million categories: nothing but counts comes to the driver."""
    rows = spark.range(1_500_000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.format_string("c%07d", F.col("id"))).alias("kind"))
    words = dictionary(rows, "kind")
    got = one_hot_sparse(rows, "kind", words, "vec")
    size, n, ones = got.select(F.expr("1").alias("one"), "vec").limit(1).first()["vec"].size, got.count(), words.count()
    assert size == ones == 1_000_001 and n == 1_500_000
    assert words.agg(F.min("id"), F.max("id"), F.count_distinct("id")).first()[:] == (0, 1_000_000, 1_000_001)
