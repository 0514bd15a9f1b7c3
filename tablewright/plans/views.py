"""Deterministic views over the given tables that need cleaning: gaps, typos, repeats, wrong signs.

The given tables have none of these. The texts run unchanged in Spark SQL and in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    "dirty_customer": """
SELECT c_custkey, c_nationkey,
  CASE WHEN c_custkey % 19 = 0 THEN -abs(c_acctbal)
       WHEN c_custkey % 23 = 0 THEN NULL ELSE c_acctbal END AS acctbal,
  CASE WHEN c_custkey % 29 = 0 THEN 'none'
       WHEN c_custkey % 31 = 0 THEN ''
       WHEN c_custkey % 37 = 0 THEN NULL
       WHEN c_custkey % 41 = 0 THEN 'zzz'
       WHEN c_custkey % 11 = 0 THEN concat('  ', c_mktsegment, ' ')
       WHEN c_custkey % 13 = 0 THEN substr(c_mktsegment, 2)
       ELSE lower(c_mktsegment) END AS segment,
  CASE WHEN c_custkey % 17 = 0 THEN 'unknown'
       WHEN c_custkey % 7 = 0 THEN '26-39'
       ELSE concat('Age: ', CAST(10 + c_custkey % 70 AS STRING), ' years') END AS age_text,
  CASE WHEN c_custkey % 43 = 0 THEN 'n/a' ELSE CAST(c_custkey % 9 AS STRING) END AS score_text
FROM customer""",
    "dup_orders": """
SELECT o_orderkey, o_orderstatus, o_orderpriority,
  CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE CAST(floor(o_totalprice / 50000) AS DOUBLE) END AS price_band
FROM orders""",
    "gappy_events": """
SELECT event_id, user_id, ts,
  CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END AS value,
  CASE WHEN event_id % 5 = 0 THEN NULL ELSE event_type END AS event_type
FROM events""",
    "risk": """
SELECT o_orderkey AS ID,
  CASE WHEN o_orderkey % 101 < 20 THEN '16-25' WHEN o_orderkey % 101 < 50 THEN '26-39'
       WHEN o_orderkey % 101 < 80 THEN '40-64' WHEN o_orderkey % 101 < 95 THEN '65+'
       ELSE concat(CAST(o_orderkey % 101 AS STRING), ' yrs') END AS AGE,
  CASE WHEN o_orderkey % 53 = 0 THEN ' FEMALE' WHEN o_orderkey % 2 = 0 THEN 'female' ELSE 'male' END AS GENDER,
  CASE WHEN o_orderkey % 7 < 3 THEN '0-9y' WHEN o_orderkey % 7 < 5 THEN '10-19y'
       WHEN o_orderkey % 7 = 5 THEN '20-29y' ELSE '30y+' END AS DRIVING_EXPERIENCE,
  CASE WHEN o_orderkey % 11 < 2 THEN 'none' WHEN o_orderkey % 11 < 7 THEN 'high school'
       WHEN o_orderkey % 11 = 7 THEN 'universit' ELSE 'university' END AS EDUCATION,
  CASE WHEN o_orderkey % 13 < 3 THEN 'poverty' WHEN o_orderkey % 13 < 6 THEN 'working class'
       WHEN o_orderkey % 13 < 10 THEN 'middle class' ELSE 'upper class' END AS INCOME,
  CASE WHEN o_orderkey % 47 = 0 THEN NULL ELSE o_totalprice / 500000 END AS CREDIT_SCORE,
  CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE 1 END AS VEHICLE_OWNERSHIP,
  CASE WHEN o_orderkey % 17 < 11 THEN 'before 2015' ELSE 'after 2015' END AS VEHICLE_YEAR,
  CASE WHEN o_orderkey % 19 < 9 THEN 0 ELSE 1 END AS MARRIED,
  CASE WHEN o_orderkey % 23 < 8 THEN 0 ELSE 1 END AS CHILDREN,
  o_custkey AS POSTAL_CODE,
  CASE WHEN o_orderkey % 59 = 0 THEN NULL WHEN o_orderkey % 61 = 0 THEN -CAST(floor(o_totalprice / 25) AS DOUBLE)
       ELSE CAST(floor(o_totalprice / 25) AS DOUBLE) END AS ANNUAL_MILEAGE,
  CASE WHEN o_orderkey % 29 < 16 THEN 'sedan' WHEN o_orderkey % 29 < 22 THEN 'suv'
       WHEN o_orderkey % 29 < 26 THEN 'hatchback' ELSE 'sports car' END AS TYPE_OF_VEHICLE,
  o_orderkey % 5 AS SPEEDING_VIOLATIONS,
  o_orderkey % 4 AS DUIS,
  CASE WHEN o_orderkey % 31 < 15 THEN 0 ELSE o_orderkey % 31 - 14 END AS PAST_ACCIDENTS,
  CASE WHEN o_orderkey % 37 < 4 THEN 1 - (CASE WHEN o_orderkey % 7 < 3 AND o_orderkey % 17 < 11 THEN 1 ELSE 0 END)
       ELSE (CASE WHEN o_orderkey % 7 < 3 AND o_orderkey % 17 < 11 THEN 1 ELSE 0 END) END AS OUTCOME
FROM orders""",
    "scored": """
SELECT l_orderkey * 10 + l_linenumber AS row_key,
  CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label,
  round(l_discount + CASE WHEN l_returnflag = 'R' THEN 0.02 ELSE 0.0 END, 2) AS score,
  CASE WHEN round(l_discount + CASE WHEN l_returnflag = 'R' THEN 0.02 ELSE 0.0 END, 2) >= 0.06 THEN 1 ELSE 0 END AS prediction,
  l_linenumber % 3 AS fold
FROM lineitem""",
}

_SOURCES = {"dirty_customer": "customer", "dup_orders": "orders", "gappy_events": "events", "risk": "orders",
            "scored": "lineitem"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source = _SOURCES[name]
    return spark.sql(VIEWS[name].replace(f"FROM {source}", "FROM {src}"), src=table(spark, sf_dir, source))
