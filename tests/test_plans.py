"""Physical-plan properties of the flagship family (pushdown, pruning,
partial aggregation)."""

from __spark_entry__ import queries

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(spark, df):
    return df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_period_filter_reaches_orders_scan(spark):
    text = _formatted(spark, queries()["filter_date_period"](spark, SF))
    pushed = [ln for ln in text.splitlines() if ln.startswith("PushedFilters") and "o_orderdate" in ln]
    assert pushed and "GreaterThanOrEqual(o_orderdate" in pushed[0] \
        and "LessThan(o_orderdate" in pushed[0]


def test_rollup_aggregates_partially_before_each_shuffle(spark):
    text = _formatted(spark, queries()["sales_rollup"](spark, SF))
    # two aggregation levels, each with a partial (map-side) and a final step
    assert text.count("HashAggregate") >= 4
    assert "Expand" not in text


def test_grouping_sets_single_scan(spark):
    text = _formatted(spark, queries()["survival_rate_sets"](spark, SF))
    import re
    scans = re.findall(r"^\(\d+\) Scan parquet", text, flags=re.M)
    assert len(scans) == 3  # orders, customer, nation: each read once
    assert "Expand" in text  # the eleven sets share one pass
