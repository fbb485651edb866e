from pyspark.sql import functions as F

from strata.operators.joins import scalar


def test_scalar_is_inlined(spark):
    df = spark.range(10).select(F.col("id").alias("v"))
    out = df.select((F.col("v") / scalar(df, F.sum("v"))).alias("share"))
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString()
    assert abs(sum(r.share for r in out.collect()) - 1) < 1e-12
