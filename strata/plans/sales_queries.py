"""Queries over the ``sales`` binding (the roll-up family and its parts)."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions.scalars import date_literal, in_period, money, pct_growth, scale_unit
from strata.operators.rollup import (
    DRIVER_PERIODS as P, count_by_delivery, period_total, recency_by_group, sales_rollup,
)
from strata.plans.registry import query
from strata.plans.sql import SALES_CTE, money as m_sql, period, with_
from strata.sources.tables import sales

CUR, PREV = P.current, P.previous
CUR_SQL = period("date", *CUR)
PREV_SQL = period("date", *PREV)

ROLLUP_SQL = with_(SALES_CTE) + f"""
, g AS (
  SELECT region, country,
    max(date) AS last_date,
    count(DISTINCT CASE WHEN {CUR_SQL} AND delivery_type IN ('fast', 'fastest')
                        THEN customer_id END) AS n_fast,
    count(DISTINCT CASE WHEN {CUR_SQL} AND duration = '60' THEN customer_id END) AS n_60,
    count(DISTINCT CASE WHEN {CUR_SQL} AND duration = '60' AND cost_type = 'expert'
                        THEN customer_id END) AS n_60_exp,
    COALESCE(sum(CASE WHEN {CUR_SQL} THEN {m_sql('revenue')} END), 0) AS rc,
    COALESCE(sum(CASE WHEN {PREV_SQL} THEN {m_sql('revenue')} END), 0) AS rp,
    COALESCE(sum(CASE WHEN {CUR_SQL} THEN {m_sql('cost')} END), 0) AS cc,
    COALESCE(sum(CASE WHEN {CUR_SQL} AND cost_type = 'expert' THEN {m_sql('cost')} END), 0) AS ce,
    COALESCE(sum(CASE WHEN {CUR_SQL} AND duration = '60' THEN {m_sql('revenue')} END), 0) AS r60,
    COALESCE(sum(CASE WHEN {CUR_SQL} AND duration = '60' AND cost_type = 'expert'
                      THEN {m_sql('cost')} END), 0) AS c60
  FROM sales WHERE region IS NOT NULL AND country IS NOT NULL
  GROUP BY region, country)
SELECT region, country,
  CAST(date_diff('day', CAST(last_date AS DATE), DATE '{P.asof}') AS BIGINT) AS recency,
  CAST(n_fast AS BIGINT) AS fast_and_fastest,
  CAST(rc AS DOUBLE) / CAST(1000.0 AS DOUBLE) AS rev_2019,
  CAST(rp AS DOUBLE) / CAST(1000.0 AS DOUBLE) AS rev_2018,
  CAST(cc AS DOUBLE) / CAST(1000.0 AS DOUBLE) AS cost_2019,
  CAST(ce AS DOUBLE) / CAST(1000.0 AS DOUBLE) AS cost_2019_exp,
  CAST(cc - ce AS DOUBLE) / CAST(1000.0 AS DOUBLE) AS other_cost,
  (CAST(r60 AS DOUBLE) / NULLIF(CAST(n_60 AS DOUBLE), 0)) / CAST(1000.0 AS DOUBLE) AS rev_per_60,
  (CAST(rc - ce AS DOUBLE) / NULLIF(CAST(rc AS DOUBLE), 0)) * CAST(100.0 AS DOUBLE) AS profit_margin,
  (CAST(rc - cc AS DOUBLE) / NULLIF(CAST(rc AS DOUBLE), 0)) * CAST(100.0 AS DOUBLE)
      AS profit_margin_total_cost,
  (CAST(c60 AS DOUBLE) / NULLIF(CAST(n_60_exp AS DOUBLE), 0)) / CAST(1000.0 AS DOUBLE)
      AS cost_exp_per_60,
  ((CAST(rc AS DOUBLE) / NULLIF(CAST(rp AS DOUBLE), 0)) - CAST(1.0 AS DOUBLE))
      * CAST(100.0 AS DOUBLE) AS growth
FROM g
"""


@query("sales_rollup", ROLLUP_SQL)
def q_sales_rollup(spark, sf_dir):
    """Flagship: the eleven-metric roll-up per (region, country)."""
    return sales_rollup(sales(spark, sf_dir), P)


@query("sales_rollup_one_level", ROLLUP_SQL)
def q_sales_rollup_one_level(spark, sf_dir):
    """Same answer through a single aggregate with count(DISTINCT)."""
    return sales_rollup(sales(spark, sf_dir), P, how="one_level")


@query("read_sales", with_(SALES_CTE) + """
SELECT region, country, customer_id, CAST(date AS DATE) AS date, delivery_type,
       revenue, cost, cost_type, duration FROM sales
""")
def q_read_sales(spark, sf_dir):
    return sales(spark, sf_dir).withColumn("date", F.to_date("date"))


@query("recency_by_group", with_(SALES_CTE) + f"""
SELECT region, country,
       CAST(date_diff('day', CAST(max(date) AS DATE), DATE '{P.asof}') AS BIGINT) AS recency
FROM sales WHERE region IS NOT NULL AND country IS NOT NULL GROUP BY region, country
""")
def q_recency_by_group(spark, sf_dir):
    return recency_by_group(sales(spark, sf_dir), P.asof)


@query("date_recency", with_(SALES_CTE) + f"""
SELECT customer_id,
       CAST(date_diff('day', CAST(max(date) AS DATE), DATE '{P.asof}') AS BIGINT) AS recency
FROM sales GROUP BY customer_id
""")
def q_date_recency(spark, sf_dir):
    """Days since each customer's last purchase."""
    from strata.functions.scalars import date_recency
    return (sales(spark, sf_dir).groupBy("customer_id")
            .agg(date_recency(P.asof, F.max("date")).alias("recency")))


@query("period_revenue", with_(SALES_CTE) + f"""
SELECT region, country, CAST(sum({m_sql('revenue')}) AS DOUBLE) AS revenue_total
FROM sales WHERE {CUR_SQL} AND region IS NOT NULL AND country IS NOT NULL
GROUP BY region, country
""")
def q_period_revenue(spark, sf_dir):
    return period_total(sales(spark, sf_dir), "revenue", CUR, alias="revenue_total")


@query("period_cost", with_(SALES_CTE) + f"""
SELECT region, country, CAST(sum({m_sql('cost')}) AS DOUBLE) AS cost_total
FROM sales WHERE {CUR_SQL} AND region IS NOT NULL AND country IS NOT NULL
GROUP BY region, country
""")
def q_period_cost(spark, sf_dir):
    return period_total(sales(spark, sf_dir), "cost", CUR, alias="cost_total")


@query("count_by_delivery", with_(SALES_CTE) + f"""
, cur AS (SELECT customer_id, delivery_type, region, country FROM sales WHERE {CUR_SQL})
SELECT customer_id, delivery_type, region, country,
       CASE WHEN delivery_type IN ('fast', 'fastest')
            THEN CAST(count(customer_id) OVER (PARTITION BY region, country, delivery_type)
                      AS BIGINT)
       END AS fast_and_fastest
FROM cur
""")
def q_count_by_delivery(spark, sf_dir):
    return count_by_delivery(sales(spark, sf_dir), CUR)


@query("filter_date_period", with_(SALES_CTE) + f"""
SELECT region, country, customer_id, CAST(date AS DATE) AS date, revenue
FROM sales WHERE {CUR_SQL}
""")
def q_filter_date_period(spark, sf_dir):
    return (sales(spark, sf_dir).where(in_period(F.col("date"), *CUR))
            .select("region", "country", "customer_id", F.to_date("date").alias("date"), "revenue"))


@query("filter_in_set", with_(SALES_CTE) + """
SELECT region, country, customer_id, delivery_type, revenue FROM sales
WHERE delivery_type IN ('fast', 'fastest')
""")
def q_filter_in_set(spark, sf_dir):
    return (sales(spark, sf_dir).where(F.col("delivery_type").isin("fast", "fastest"))
            .select("region", "country", "customer_id", "delivery_type", "revenue"))


@query("filter_conjunction", with_(SALES_CTE) + f"""
SELECT region, country, customer_id, cost FROM sales
WHERE {CUR_SQL} AND duration = '60' AND cost_type = 'expert'
""")
def q_filter_conjunction(spark, sf_dir):
    """One reusable AND of masks: current period, duration 60, expert cost."""
    mask = (in_period(F.col("date"), *CUR) & (F.col("duration") == "60")
            & (F.col("cost_type") == "expert"))
    return sales(spark, sf_dir).where(mask).select("region", "country", "customer_id", "cost")


@query("date_literal", with_(SALES_CTE) + f"""
SELECT CAST(count(*) AS BIGINT) AS n_rows,
       CAST(count(*) FILTER (WHERE date >= DATE '{CUR[0]}') AS BIGINT) AS n_since
FROM sales
""")
def q_date_literal(spark, sf_dir):
    s = sales(spark, sf_dir)
    return s.agg(F.count(F.lit(1)).alias("n_rows"),
                 F.count(F.when(F.col("date") >= date_literal(CUR[0]), 1)).alias("n_since"))


@query("scale_thousands", with_(SALES_CTE) + f"""
SELECT region, CAST(sum({m_sql('revenue')}) AS DOUBLE) / CAST(1000.0 AS DOUBLE) AS revenue_k
FROM sales GROUP BY region
""")
def q_scale_thousands(spark, sf_dir):
    return (sales(spark, sf_dir).groupBy("region")
            .agg(scale_unit(F.sum(money("revenue")), 1000.0).alias("revenue_k")))


@query("pct_growth", with_(SALES_CTE) + f"""
, g AS (SELECT region,
          sum(CASE WHEN {CUR_SQL} THEN {m_sql('revenue')} END) AS rc,
          sum(CASE WHEN {PREV_SQL} THEN {m_sql('revenue')} END) AS rp
        FROM sales GROUP BY region)
SELECT region, ((CAST(rc AS DOUBLE) / NULLIF(CAST(rp AS DOUBLE), 0)) - CAST(1.0 AS DOUBLE))
               * CAST(100.0 AS DOUBLE) AS growth
FROM g
""")
def q_pct_growth(spark, sf_dir):
    s = sales(spark, sf_dir)
    g = s.groupBy("region").agg(
        F.sum(F.when(in_period(F.col("date"), *CUR), money("revenue"))).alias("rc"),
        F.sum(F.when(in_period(F.col("date"), *PREV), money("revenue"))).alias("rp"))
    return g.select("region", pct_growth(F.col("rc"), F.col("rp")).alias("growth"))


@query("sales_rollup_incremental", ROLLUP_SQL)
def q_sales_rollup_incremental(spark, sf_dir):
    """The roll-up computed by the streaming job: the sales rows are landed
    as parquet files in the shared checkpoint folder (as many as their
    partitions), streamed a few files to a micro-batch, reduced to exactly-once
    per-epoch partials and merged.  Same answer as the batch roll-up."""
    from strata.session import scratch_path
    from strata.streaming.rollup_stream import read_rollup, start_incremental_rollup

    base = scratch_path(spark, "rollup-stream")
    src = f"{base}/source"
    sales(spark, sf_dir).write.mode("overwrite").parquet(src)
    schema = spark.read.parquet(src).schema
    q = start_incremental_rollup(spark, src, schema, f"{base}/partials", f"{base}/checkpoint",
                                 P, max_files_per_trigger=64)
    q.awaitTermination()
    return read_rollup(spark, f"{base}/partials", P)


@query("metric_rollup_regions", with_(SALES_CTE) + f"""
SELECT region,
  CAST(count(DISTINCT customer_id) AS BIGINT) AS n_customers,
  CAST(count(*) AS BIGINT) AS n_lines,
  CAST(COALESCE(sum({m_sql('revenue')}), 0) AS DOUBLE)
      / NULLIF(CAST(count(DISTINCT customer_id) AS DOUBLE), 0) AS revenue_per_customer,
  CAST(COALESCE(sum(CASE WHEN cost_type = 'expert' THEN {m_sql('cost')} END), 0) AS DOUBLE)
      / NULLIF(CAST(COALESCE(sum({m_sql('cost')}), 0) AS DOUBLE), 0) * CAST(100.0 AS DOUBLE)
      AS expert_share_pct,
  max(revenue) AS max_line_revenue,
  CAST(COALESCE(sum({m_sql('revenue')}), 0) AS DOUBLE) / CAST(1000.0 AS DOUBLE) AS revenue_k
FROM sales WHERE region IS NOT NULL GROUP BY region
""")
def q_metric_rollup_regions(spark, sf_dir):
    """A user-defined metric list through the generic roll-up (two-level,
    since the one distinct metric counts customers)."""
    from strata.operators.metrics import Derived, Metric, metric_rollup

    d = lambda c: c.cast("double")
    metrics = [
        Metric("n_customers", "distinct", "customer_id"),
        Metric("n_lines", "count"),
        Metric("revenue", "money_sum", "revenue"),
        Metric("cost", "money_sum", "cost"),
        Metric("expert_cost", "money_sum", "cost", F.col("cost_type") == "expert"),
        Metric("max_line_revenue", "max", "revenue"),
    ]
    derived = [
        Derived("revenue_per_customer", lambda m: F.try_divide(d(m["revenue"]), d(m["n_customers"]))),
        Derived("expert_share_pct",
                lambda m: F.try_divide(d(m["expert_cost"]), d(m["cost"])) * F.lit(100.0)),
        Derived("revenue_k", lambda m: d(m["revenue"]) / F.lit(1000.0)),
    ]
    out = metric_rollup(sales(spark, sf_dir), ["region"], metrics, derived)
    return out.select("region", F.col("n_customers").cast("bigint").alias("n_customers"),
                      F.col("n_lines").cast("bigint").alias("n_lines"), "revenue_per_customer",
                      "expert_share_pct", "max_line_revenue", "revenue_k")


@query("read_sales_csv", with_(SALES_CTE) + """
SELECT region, country, customer_id, CAST(date AS DATE) AS date, delivery_type, revenue, cost,
       cost_type, duration
FROM sales
""")
def q_read_sales_csv(spark, sf_dir):
    """CSV round trip: the sales rows written as header CSV part files in the
    shared checkpoint folder, read back by the declared-schema CSV source."""
    from strata.session import scratch_path
    from strata.sources.files import read_sales
    path = scratch_path(spark, "sales-csv")
    (sales(spark, sf_dir).select("date", "region", "country", "customer_id", "delivery_type",
                                 "revenue", "cost", "duration", "cost_type")
     .write.mode("overwrite").option("header", True)
     .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path))
    return read_sales(spark, path).select("region", "country", "customer_id",
                                          F.to_date("date").alias("date"), "delivery_type",
                                          "revenue", "cost", "cost_type", "duration")


# every 97th order's dates are spelt another way, every 89th order's lines end early
@query("read_sales_bad_rows", with_(SALES_CTE) + """
, l AS (SELECT o_orderkey % 97 = 0 AS odd_date, o_orderkey % 89 = 0 AS short
        FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
SELECT reason, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT CASE WHEN short THEN 'not 9 fields' WHEN odd_date THEN 'date is no timestamp_ntz' ELSE 'good' END AS reason FROM l)
GROUP BY reason
""")
def q_read_sales_bad_rows(spark, sf_dir):
    """A sales CSV with dates of another format and lines that end early: good
    rows, and bad ones by reason, as the checked reader tells them apart."""
    from strata.session import scratch_path
    from strata.sources.files import bad_counts, read_sales_checked
    from strata.sources.tables import read_table

    path = scratch_path(spark, "sales-bad-csv")
    t = lambda name: read_table(spark, sf_dir, name)
    rows = (t("lineitem").join(t("part"), F.col("l_partkey") == F.col("p_partkey")).join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
            .join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")))
    date = F.when(F.col("o_orderkey") % 97 == 0, F.date_format("o_orderdate", "dd.MM.yyyy")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    whole = F.concat_ws(",", date, "r_name", "n_name", "o_custkey", F.lit("fast"), "l_extendedprice", "p_retailprice", F.col("l_linenumber") * 10, "l_returnflag")
    line = F.when(F.col("o_orderkey") % 89 == 0, F.concat_ws(",", date, "r_name")).otherwise(whole)
    header = "date,region,country,customer_id,delivery_type,revenue,cost,duration,cost_type"
    # a file for each partition, each with the header
    rows.select(line.alias("value")).mapInPandas(lambda frames: _headed(frames, header), "value string").write.text(path)
    good, bad = read_sales_checked(spark, path)
    return bad_counts(bad).unionByName(good.agg(F.count(F.lit(1)).alias("n")).select(F.lit("good").alias("reason"), "n").where("n > 0"))


def _headed(frames, header):
    import pandas as pd

    first = True
    for frame in frames:
        if first:
            yield pd.DataFrame({"value": [header]})
            first = False
        yield frame
