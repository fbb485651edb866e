"""SQL building blocks for the oracle statements (DuckDB dialect, mostly
ANSI).  They restate the bindings of ``strata.sources.tables`` and the
periods of the roll-up in SQL, written independently of the Spark code."""

from __future__ import annotations

SALES_CTE = """
sales AS (
  SELECT r.r_name AS region, n.n_name AS country, o.o_custkey AS customer_id,
         o.o_orderdate AS date,
         CASE o.o_orderpriority WHEN '1-URGENT' THEN 'fastest' WHEN '2-HIGH' THEN 'fast'
              WHEN '5-LOW' THEN 'slow' ELSE 'normal' END AS delivery_type,
         l.l_extendedprice * (CAST(1.0 AS DOUBLE) - l.l_discount) AS revenue,
         l.l_quantity * p.p_retailprice * CAST(0.5 AS DOUBLE) AS cost,
         CASE WHEN l.l_returnflag = 'R' THEN 'expert' ELSE 'normal' END AS cost_type,
         CAST(l.l_linenumber * 10 AS VARCHAR) AS duration
  FROM lineitem l
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey)
"""

PASSENGERS_CTE = """
passengers AS (
  SELECT o.o_orderkey AS passenger_id,
         CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END AS survived,
         CASE o.o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 1
              WHEN '5-LOW' THEN 3 ELSE 2 END AS pclass,
         n.n_name || ', ' || c.c_mktsegment || '. ' || c.c_name AS name,
         CASE WHEN o.o_custkey % 2 = 0 THEN 'female' ELSE 'male' END AS sex,
         CASE WHEN o.o_orderkey % 5 = 0 THEN NULL
              ELSE CAST(o.o_orderkey % 80 AS DOUBLE) END AS age,
         CAST(o.o_orderkey % 9 AS INTEGER) AS sibsp,
         CAST(o.o_custkey % 7 AS INTEGER) AS parch,
         o.o_totalprice AS fare,
         CASE WHEN o.o_orderkey % 4 = 0
              THEN substr(c.c_mktsegment, 1, 1) || CAST(o.o_orderkey % 100 AS VARCHAR)
              ELSE NULL END AS cabin,
         CASE WHEN o.o_orderkey % 211 = 0 THEN NULL
              WHEN o.o_custkey % 3 = 0 THEN 'S' WHEN o.o_custkey % 3 = 1 THEN 'C'
              ELSE 'Q' END AS embarked
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey)
"""

# Hash split: the first twelve hex digits of md5('42:' || id) below 'cc...c'
# (= 0.8 of the range) put a row in the training set.
SPLIT_CTE = """
split AS (
  SELECT *, substr(md5('42:' || CAST(passenger_id AS VARCHAR)), 1, 12) < 'cccccccccccc' AS is_train
  FROM passengers)
"""

# Training rows with the derived columns (title, family size, cabin level).
TRAIN_CTE = """
train AS (
  SELECT passenger_id, survived, pclass, name, sex, age, sibsp, parch, fare, cabin, embarked,
         NULLIF(split_part(split_part(name, ', ', 2), '.', 1), '') AS title,
         sibsp + parch AS family_size,
         COALESCE(NULLIF(substr(cabin, 1, 1), ''), 'No Cabin') AS level_cabin
  FROM split WHERE is_train)
"""

TEST_CTE = """
test AS (
  SELECT passenger_id, survived, pclass, name, sex, age, sibsp, parch, fare, cabin, embarked,
         NULLIF(split_part(split_part(name, ', ', 2), '.', 1), '') AS title,
         sibsp + parch AS family_size,
         COALESCE(NULLIF(substr(cabin, 1, 1), ''), 'No Cabin') AS level_cabin
  FROM split WHERE NOT is_train)
"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


def period(col: str, start: str, end: str) -> str:
    """Inclusive calendar period (whole end day)."""
    return (f"({col} >= DATE '{start}' AND {col} < DATE '{end}' + INTERVAL 1 DAY)")


def money(expr: str) -> str:
    return f"CAST({expr} AS DECIMAL(18,4))"
