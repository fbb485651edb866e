"""Driver tables and the two bindings the analyses run on.

``sales``      one row per order line: region, country, customer_id, date,
               delivery_type, revenue, cost, cost_type, duration.
``passengers`` one row per order: passenger_id, survived, pclass, name, sex,
               age, sibsp, parch, fare, cabin, embarked.

Both are plain DataFrame joins over the parquet tables; Catalyst prunes every
scan to the columns used.  No side is hinted for broadcast: the planner
broadcasts a side only when its size estimate (file sizes at planning, the
measured shuffle size under AQE) is below ``autoBroadcastJoinThreshold`` —
the small dimensions (nation, region) pass that check, fact-sized sides fall
back to sort-merge joins whose skewed partitions AQE splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

# Fixed values of the sales binding: order priority -> delivery type, return
# flag -> cost type, line number -> duration label.
DELIVERY_BY_PRIORITY = {"1-URGENT": "fastest", "2-HIGH": "fast", "5-LOW": "slow"}
DELIVERY_OTHER = "normal"
EXPERT_RETURN_FLAG = "R"

# Fixed values of the passenger binding: priority -> class, survived status.
CLASS_BY_PRIORITY = {"1-URGENT": 1, "2-HIGH": 1, "5-LOW": 3}
CLASS_OTHER = 2
SURVIVED_STATUS = "F"
PORTS = ("S", "C", "Q")  # by o_custkey % 3 = 0, 1, 2


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation x region."""
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    return (nation.join(region, nation.n_regionkey == region.r_regionkey)
            .select("n_nationkey", "n_name", "r_name"))


def _case_map(col, mapping: dict, other):
    expr = None
    for k, v in mapping.items():
        expr = (F.when(col == k, F.lit(v)) if expr is None else expr.when(col == k, F.lit(v)))
    return expr.otherwise(F.lit(other))


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row-level sales fact built from lineitem, orders, part, customer, geo.

    Join order: the small geo dimension is attached to customers, customers
    to orders (shuffle on custkey), the result to lines (shuffle on orderkey).
    The roll-up's first aggregation level then moves only map-side partial
    aggregates, never raw lines, through its shuffle.
    """
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount",
        "l_returnflag", "l_linenumber")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    cust_geo = cust.join(_geo(spark, sf_dir), cust.c_nationkey == F.col("n_nationkey"))
    ord_geo = orders.join(cust_geo, orders.o_custkey == cust_geo.c_custkey)
    lines = li.join(part, li.l_partkey == part.p_partkey)
    joined = lines.join(ord_geo, lines.l_orderkey == ord_geo.o_orderkey)
    return joined.select(
        F.col("r_name").alias("region"),
        F.col("n_name").alias("country"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("date"),
        _case_map(F.col("o_orderpriority"), DELIVERY_BY_PRIORITY, DELIVERY_OTHER).alias("delivery_type"),
        (F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))).alias("revenue"),
        (F.col("l_quantity") * F.col("p_retailprice") * F.lit(0.5)).alias("cost"),
        F.when(F.col("l_returnflag") == EXPERT_RETURN_FLAG, F.lit("expert"))
         .otherwise(F.lit("normal")).alias("cost_type"),
        (F.col("l_linenumber") * F.lit(10)).cast("string").alias("duration"),
    )


def passengers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled passenger-shaped rows, one per order (o_orderkey is unique)."""
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    cust = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    cust_n = cust.join(nation, cust.c_nationkey == nation.n_nationkey)
    j = orders.join(cust_n, orders.o_custkey == cust_n.c_custkey)
    ok, ck = F.col("o_orderkey"), F.col("o_custkey")
    port = (F.when(ck % 3 == 0, F.lit(PORTS[0])).when(ck % 3 == 1, F.lit(PORTS[1]))
            .otherwise(F.lit(PORTS[2])))
    return j.select(
        ok.alias("passenger_id"),
        F.when(F.col("o_orderstatus") == SURVIVED_STATUS, F.lit(1)).otherwise(F.lit(0)).alias("survived"),
        _case_map(F.col("o_orderpriority"), CLASS_BY_PRIORITY, CLASS_OTHER).alias("pclass"),
        F.concat(F.col("n_name"), F.lit(", "), F.col("c_mktsegment"), F.lit(". "),
                 F.col("c_name")).alias("name"),
        F.when(ck % 2 == 0, F.lit("female")).otherwise(F.lit("male")).alias("sex"),
        F.when(ok % 5 == 0, F.lit(None).cast("double"))
         .otherwise((ok % 80).cast("double")).alias("age"),
        (ok % 9).cast("int").alias("sibsp"),
        (ck % 7).cast("int").alias("parch"),
        F.col("o_totalprice").alias("fare"),
        F.when(ok % 4 == 0, F.concat(F.substring(F.col("c_mktsegment"), 1, 1),
                                     (ok % 100).cast("string")))
         .otherwise(F.lit(None).cast("string")).alias("cabin"),
        F.when(ok % 211 == 0, F.lit(None).cast("string")).otherwise(port).alias("embarked"),
    )


def documents_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents joined to their labels: a second real-shaped binary target."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return docs.join(labels, "doc_id")
