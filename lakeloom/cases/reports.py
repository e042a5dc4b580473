"""Operational rollups over event and order tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.cases.inputs import RUNS_SQL, runs
from lakeloom.cases.registry import case, plain
from lakeloom.functions.scalars import mean_of_cents
from lakeloom.operators.joins import lookup
from lakeloom.operators import rollups as r
from lakeloom.operators import windows as w
from lakeloom.session import scratch_path, stage, table
from lakeloom.streaming import flows

SINCE, UNTIL = "2024-01-15 00:00:00", "2024-01-22 00:00:00"
MICROS = "(epoch_us(end_time) - epoch_us(start_time))"


@case("q01_run_durations", f"""
SELECT CAST(run_date AS VARCHAR) AS run_date, job_name, count(*) AS runs, round(avg({MICROS} / 60e6), 1) AS avg_minutes FROM ({RUNS_SQL}) AS x
WHERE result = 'SUCCESS' AND start_time >= TIMESTAMP '{SINCE}' GROUP BY run_date, job_name""")
def q01(spark, d):
    return plain(r.run_durations(runs(spark, d), SINCE))


@case("q02_failed_runs", f"""
SELECT run_id, job_name, CAST(start_time AS VARCHAR) AS start_time, result FROM ({RUNS_SQL}) AS x
WHERE result <> 'SUCCESS' AND start_time >= TIMESTAMP '{SINCE}' AND start_time < TIMESTAMP '{UNTIL}' ORDER BY x.start_time DESC, run_id""")
def q02(spark, d):
    return plain(r.failed_runs(runs(spark, d), SINCE, UNTIL).select("run_id", "job_name", "start_time", "result"))


@case("q03_usage_by_day", """
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS usage_date, event_type AS sku, round(sum(value), 2) AS total_usage FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-10' GROUP BY 1, 2""")
def q03(spark, d):
    usage = table(spark, d, "events").select(F.to_date("ts").alias("usage_date"), F.col("event_type").alias("sku"), F.col("value").alias("quantity"))
    return plain(r.usage_by_day(usage, "2024-01-10"))


@case("q04_slow_queries", """
SELECT event_id AS query_id, substr('SELECT ' || event_type || ' FROM log WHERE user = ' || CAST(user_id AS VARCHAR) || ' AND ' || props || repeat(' AND true', 12), 1, 100) AS statement,
  round(CAST(round(value * 1000) AS BIGINT) / 1000.0, 3)::DOUBLE AS seconds FROM events WHERE ts >= TIMESTAMP '2024-01-20 00:00:00' AND value > 60""")
def q04(spark, d):
    log = table(spark, d, "events").select(
        F.col("event_id").alias("query_id"), F.col("ts").cast("timestamp").alias("start_time"), F.round(F.col("value") * 1000).cast("bigint").alias("duration_ms"),
        F.expr("'SELECT ' || event_type || ' FROM log WHERE user = ' || CAST(user_id AS STRING) || ' AND ' || props || repeat(' AND true', 12)").alias("statement"))
    return r.slow_queries(log, "2024-01-20 00:00:00", 60)


def _trips(spark, d):
    """A shipped line is a trip from order to shipment."""
    lines, orders = table(spark, d, "lineitem"), table(spark, d, "orders")
    return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).select(
        "l_orderkey", "l_linenumber", F.col("o_orderdate").alias("pickup"), F.col("l_shipdate").alias("dropoff"),
        F.expr("CASE WHEN l_orderkey % 31 = 0 THEN 0D ELSE 8D END").alias("distance"), F.col("l_extendedprice").alias("fare"),
        F.col("o_custkey").alias("pickup_zip"), F.col("l_suppkey").alias("dropoff_zip"))


TRIPS_SQL = """SELECT l_orderkey, l_linenumber, o_orderdate AS pickup, l_shipdate AS dropoff, CASE WHEN l_orderkey % 31 = 0 THEN 0.0 ELSE 8.0 END AS distance, l_extendedprice AS fare,
  o_custkey AS pickup_zip, l_suppkey AS dropoff_zip FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""


@case("q05_trip_metrics", f"""
SELECT l_orderkey, l_linenumber, fare, date_diff('minute', pickup, dropoff)::DOUBLE AS trip_minutes,
  CASE WHEN distance > 0 THEN round(CAST(fare AS DECIMAL(18,2)) * 0.125, 2)::DOUBLE ELSE 0 END AS cost_per_mile, '2024-06-01' AS processing_date FROM ({TRIPS_SQL}) AS t""")
def q05(spark, d):
    return r.trip_metrics(_trips(spark, d), "2024-06-01").select("l_orderkey", "l_linenumber", "fare", "trip_minutes", "cost_per_mile", "processing_date")


@case("q06_trip_report", f"""
SELECT count(*) AS total_trips, round(sum(fare), 2) AS total_revenue, round(sum(fare), 2) / count(fare) AS avg_fare,
  CAST(sum(distance) AS DOUBLE) / count(*) AS avg_distance, max(fare) AS max_fare FROM ({TRIPS_SQL}) AS t""")
def q06(spark, d):
    return r.trip_report(_trips(spark, d))


@case("q07_route_rollup", """
SELECT l_partkey % 50 AS start_zip, l_suppkey AS end_zip, count(*) AS trips, round(sum(l_extendedprice), 2) AS revenue, round(sum(l_extendedprice), 2) / count(*) AS avg_fare
FROM lineitem GROUP BY 1, 2 HAVING count(*) >= 12""")
def q07(spark, d):
    trips = table(spark, d, "lineitem").select((F.col("l_partkey") % 50).alias("start_zip"), F.col("l_suppkey").alias("end_zip"), "l_extendedprice")
    return r.route_rollup(trips, "start_zip", "end_zip", "l_extendedprice", 12)


def _sales(spark, d):
    o, c, n, g = (table(spark, d, t) for t in ("orders", "customer", "nation", "region"))
    places = lookup(c, n, F.col("c_nationkey") == F.col("n_nationkey"), "inner")
    places = (lookup(places, g, F.col("n_regionkey") == F.col("r_regionkey"), "inner")
              .select(F.col("c_custkey").alias("o_custkey"), F.col("r_name").alias("region"), F.col("c_mktsegment").alias("category")))
    return lookup(o, places, "o_custkey", "inner").select(F.date_format("o_orderdate", "yyyy-MM").alias("order_month"), "region", "category", "o_totalprice")


SALES_SQL = """SELECT strftime(o_orderdate, '%Y-%m') AS order_month, r_name AS region, c_mktsegment AS category, o_totalprice
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""


def _rollup_sql(keys: str) -> str:
    return (f"SELECT {keys}, round(sum(o_totalprice), 2) AS revenue, count(*) AS transactions, "
            f"round(sum(o_totalprice), 2) / count(*) AS avg_order_value FROM ({SALES_SQL}) AS s GROUP BY {keys}")


@case("q08_revenue_by_month", _rollup_sql("order_month"))
def q08_month(spark, d):
    return r.revenue_by(_sales(spark, d), ["order_month"], "o_totalprice")


@case("q08_revenue_by_region", _rollup_sql("region"))
def q08_region(spark, d):
    return r.revenue_by(_sales(spark, d), ["region"], "o_totalprice")


@case("q08_revenue_by_month_and_region", _rollup_sql("order_month, region"))
def q08_both(spark, d):
    return r.revenue_by(_sales(spark, d), ["order_month", "region"], "o_totalprice")


@case("q08_revenue_by_category", _rollup_sql("category"))
def q08_category(spark, d):
    return r.revenue_by(_sales(spark, d), ["category"], "o_totalprice")


def _fed_table(spark, d):
    target = scratch_path(spark, "live")
    stream = flows.table_stream(spark, d, "events")
    flows.drain(flows.append_flow(stream, target, scratch_path(spark, "checkpoint")))
    return spark.read.schema(stream.schema).parquet(target)


@case("q09_live_totals", "SELECT count(*) AS total_rows, CAST(max(ts) AS VARCHAR) AS latest_event, round(sum(value), 2) AS total_revenue FROM events")
def q09(spark, d):
    return plain(r.live_totals(_fed_table(spark, d), "ts", "value"))


@case("q09_newest_orders", "SELECT event_id, event_type, value, CAST(ts AS VARCHAR) AS ts FROM events ORDER BY events.ts DESC, event_id DESC LIMIT 5")
def q09_newest(spark, d):
    return plain(r.newest(_fed_table(spark, d), "ts", "event_id").select("event_id", "event_type", "value", "ts"))


@case("q10_churned_customers", """
SELECT o_custkey, CAST(max(CAST(o_orderdate AS DATE)) AS VARCHAR) AS last_order, date_diff('day', max(CAST(o_orderdate AS DATE)), DATE '2001-08-01') AS days_since FROM orders
GROUP BY o_custkey HAVING date_diff('day', max(CAST(o_orderdate AS DATE)), DATE '2001-08-01') > 90""")
def q10(spark, d):
    return plain(r.churned(table(spark, d, "orders"), "o_custkey", "o_orderdate", "2001-08-01"))


@case("q10_spend_segments", """
SELECT o_custkey, c_name, orders_count, total_spent, avg_order_value, rank() OVER (ORDER BY total_spent DESC) AS spending_rank,
  CASE WHEN total_spent >= 3000000 THEN 'High Value' WHEN total_spent >= 2000000 THEN 'Medium Value' ELSE 'Low Value' END AS value_segment
FROM (SELECT o_custkey, count(*) AS orders_count, round(sum(o_totalprice), 2) AS total_spent, round(sum(o_totalprice), 2) / count(*) AS avg_order_value
  FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey) AS t JOIN customer ON o_custkey = c_custkey""")
def q10_segments(spark, d):
    spent = table(spark, d, "orders").filter("o_orderstatus = 'F'").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("orders_count"), F.round(F.sum("o_totalprice"), 2).alias("total_spent"), mean_of_cents("o_totalprice").alias("avg_order_value"))
    ranked = w.with_ranks(stage(spent), [], ["total_spent desc"], "spending_rank").drop("dense_rank")
    names = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return ranked.join(names, "o_custkey").withColumn("value_segment", r.spend_segment(F.col("total_spent"), 3000000, 2000000))
