"""Stand-in inputs derived from the given tables, each with the same text in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.operators.cdc import scd2, scd2_refresh
from lakeloom.operators.windows import hot_keys
from lakeloom.session import scratch_path, spread, stage, table
from lakeloom.sources.generators import change_batches

UNKNOWN_ID = 999999
TODAY = "2001-07-01"

RETAIL_COLUMNS = {
    "order_id": "CASE WHEN l_orderkey % 101 = 0 THEN NULL ELSE l_orderkey END",
    "customer_id": "CASE WHEN l_orderkey % 97 = 0 THEN NULL WHEN l_orderkey % 89 = 0 THEN 999999 ELSE o_custkey END",
    "product_id": "CASE WHEN l_orderkey % 83 = 0 THEN 999999 ELSE l_partkey END",
    "store_id": "CAST(l_suppkey AS VARCHAR(20))",
    "order_datetime": "o_orderdate",
    "quantity": "CAST(CASE WHEN l_orderkey % 53 = 0 THEN -l_quantity WHEN l_orderkey % 59 = 0 THEN 0 ELSE l_quantity END AS INT)",
    "unit_price": "CASE WHEN l_orderkey % 61 = 0 THEN NULL ELSE l_extendedprice END",
    "discount_percent": "CAST(round(l_discount * 100) AS INT)",
    "total_amount": "l_extendedprice",
    "payment_method": "CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE o_orderpriority END",
    "source_system": "CASE WHEN o_orderdate < TIMESTAMP '1996-01-01 00:00:00' THEN 'batch' ELSE 'stream' END",
}
RETAIL_SQL = ("SELECT " + ", ".join(f"{e} AS {n}" for n, e in RETAIL_COLUMNS.items())
              + " FROM lineitem JOIN orders ON l_orderkey = o_orderkey")


def retail_orders(spark: SparkSession, d: str) -> DataFrame:
    """Retail order lines with nulls, returns, unknown members and missing codes."""
    lines, orders = spread(table(spark, d, "lineitem")), table(spark, d, "orders")
    return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).select(
        *[F.expr(e.replace("TIMESTAMP '", "TIMESTAMP_NTZ '").replace("VARCHAR(20)", "STRING")).alias(n)
          for n, e in RETAIL_COLUMNS.items()])


RETAIL_CUSTOMERS_SQL = """
SELECT CASE WHEN c_custkey % 211 = 0 THEN NULL ELSE c_custkey END AS customer_id, 'First' AS first_name,
       c_name AS last_name, ' ' || upper(c_name) || '@Example.com ' AS email, c_mktsegment AS customer_segment,
       c_acctbal AS version_tag
FROM customer
UNION ALL
SELECT c_custkey, 'Again', c_name, c_name || '@example.org', c_mktsegment, c_acctbal + 100000
FROM customer WHERE c_custkey % 7 = 0"""


def retail_customers(spark: SparkSession, d: str) -> DataFrame:
    """Customers with null ids, untidy emails and a second, later row for some keys."""
    c = table(spark, d, "customer")
    base = c.selectExpr("CASE WHEN c_custkey % 211 = 0 THEN NULL ELSE c_custkey END AS customer_id",
                        "'First' AS first_name", "c_name AS last_name",
                        "' ' || upper(c_name) || '@Example.com ' AS email", "c_mktsegment AS customer_segment",
                        "c_acctbal AS version_tag")
    again = c.filter("c_custkey % 7 = 0").selectExpr(
        "c_custkey", "'Again'", "c_name", "c_name || '@example.org'", "c_mktsegment", "c_acctbal + 100000")
    return base.union(again)


STEPS = (10, 5, 7, 3, 10)
CHANGES_SQL = """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, 'original' AS record_type, 0 AS seq FROM customer
UNION ALL SELECT c_custkey, 'UPDATED_V1: ' || c_name, c_nationkey, c_acctbal, c_mktsegment, 'modified', 1
FROM customer WHERE c_custkey % 10 = 0
UNION ALL SELECT c_custkey, c_name, c_nationkey, round(c_acctbal + 1500, 2),
  CASE c_mktsegment WHEN 'BUILDING' THEN 'AUTOMOBILE' WHEN 'AUTOMOBILE' THEN 'FURNITURE'
       WHEN 'MACHINERY' THEN 'HOUSEHOLD' ELSE 'BUILDING' END, 'modified', 2
FROM customer WHERE c_custkey % 5 = 0
UNION ALL SELECT c_custkey, 'UPDATED_V2: ' || c_name, c_nationkey, round(c_acctbal - 800, 2), 'MACHINERY', 'modified', 3
FROM customer WHERE c_custkey % 7 = 0
UNION ALL SELECT c_custkey, 'NEW_ADDR_V4: ' || c_name, c_nationkey, round(c_acctbal + 2500, 2), c_mktsegment, 'modified', 4
FROM customer WHERE c_custkey % 3 = 0
UNION ALL SELECT c_custkey, 'FINAL_UPDATE: ' || c_name, c_nationkey, round(c_acctbal + 5000, 2), 'HOUSEHOLD', 'modified', 5
FROM customer WHERE c_custkey % 10 = 0"""

RUNS_SQL = """
SELECT user_id, CAST(ts AS DATE) AS run_date, min(ts) AS start_time, max(ts) AS end_time,
       'user_' || CAST(user_id AS VARCHAR) AS job_name,
       'user_' || CAST(user_id AS VARCHAR) || '/' || CAST(CAST(ts AS DATE) AS VARCHAR) AS run_id,
       CASE WHEN sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) > 1 THEN 'FAILED' ELSE 'SUCCESS' END AS result
FROM events GROUP BY user_id, CAST(ts AS DATE)"""


def runs(spark: SparkSession, d: str) -> DataFrame:
    """Job runs: one per user and day, failed when it holds more than one error."""
    e = table(spark, d, "events")
    job = F.concat(F.lit("user_"), F.col("user_id").cast("string"))
    return (e.groupBy("user_id", F.to_date("ts").alias("run_date"))
            .agg(F.min("ts").cast("timestamp").alias("start_time"), F.max("ts").cast("timestamp").alias("end_time"),
                 F.count_if(F.col("event_type") == "error").alias("errors"))
            .select("user_id", "run_date", "start_time", "end_time", job.alias("job_name"),
                    F.concat(job, F.lit("/"), F.col("run_date").cast("string")).alias("run_id"),
                    F.when(F.col("errors") > 1, "FAILED").otherwise("SUCCESS").alias("result")))


def landing(spark: SparkSession, df: DataFrame, key: str, batches: int, fmt: str = "json") -> str:
    """Files of ``df`` arriving in ``batches`` folders ``_batch=0..``; returns their root."""
    path = scratch_path(spark, "landing")
    (df.withColumn("_batch", F.pmod(F.col(key), F.lit(batches)).cast("int"))
     .write.partitionBy("_batch").format(fmt).option("header", True).save(path))
    return path


def change_events(spark: SparkSession, d: str) -> DataFrame:
    return change_batches(table(spark, d, "customer"), STEPS)


def replay_scd2(spark: SparkSession, events: DataFrame) -> DataFrame:
    """The six change batches applied one after the other to a history."""
    hot = hot_keys(events, ["c_custkey"])  # known before, so that no batch counts again
    seen = events.filter("seq = 0")
    history = stage(scd2(seen, ["c_custkey"], ["seq"], hot=hot), "history")
    for number in range(1, 6):
        batch = events.filter(F.col("seq") == number)
        history = stage(scd2_refresh(history, seen, batch, ["c_custkey"], ["seq"], hot=hot), "history")
        seen = events.filter(F.col("seq") <= number)
    return history
