"""Operational reports over run, usage, query, trip and order tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.scalars import mean_of_cents


def run_durations(runs: DataFrame, since: str) -> DataFrame:
    """Mean minutes of successful runs per day and job."""
    minutes = F.unix_micros("end_time") - F.unix_micros("start_time")
    return (runs.filter((F.col("result") == "SUCCESS") & (F.col("start_time") >= F.lit(since).cast("timestamp")))
            .groupBy(F.to_date("start_time").alias("run_date"), "job_name")
            .agg(F.count(F.lit(1)).alias("runs"), F.round(F.avg(minutes / 60e6), 1).alias("avg_minutes")))


def failed_runs(runs: DataFrame, since: str, until: str) -> DataFrame:
    """Runs in a window that did not succeed, newest first."""
    began = F.col("start_time")
    return runs.filter((F.col("result") != "SUCCESS") & (began >= F.lit(since).cast("timestamp"))
                       & (began < F.lit(until).cast("timestamp"))).orderBy(F.desc("start_time"), "run_id")


def usage_by_day(usage: DataFrame, since: str) -> DataFrame:
    return (usage.filter(F.col("usage_date") >= F.lit(since).cast("date")).groupBy("usage_date", "sku")
            .agg(F.round(F.sum("quantity"), 2).alias("total_usage")))


def slow_queries(log: DataFrame, since: str, seconds: float, letters: int = 100) -> DataFrame:
    """Queries slower than ``seconds``, slowest first, with the first letters of their text."""
    return (log.filter((F.col("start_time") >= F.lit(since).cast("timestamp")) & (F.col("duration_ms") > seconds * 1000))
            .select("query_id", F.substring("statement", 1, letters).alias("statement"),
                    F.round(F.col("duration_ms") / 1000, 3).alias("seconds"))
            .orderBy(F.desc("seconds"), "query_id"))


def trip_metrics(trips: DataFrame, run_date: str) -> DataFrame:
    """Duration in minutes and cost per mile (0 without distance)."""
    micros = F.unix_micros(F.col("dropoff").cast("timestamp")) - F.unix_micros(F.col("pickup").cast("timestamp"))
    return trips.withColumns({
        "trip_minutes": F.round(micros / 60e6, 2),
        "cost_per_mile": F.when(F.col("distance") > 0, F.round(F.col("fare") / F.col("distance"), 2)).otherwise(0.0),
        "processing_date": F.lit(run_date)})


def trip_report(trips: DataFrame) -> DataFrame:
    return trips.agg(
        F.count(F.lit(1)).alias("total_trips"), F.round(F.sum("fare"), 2).alias("total_revenue"),
        mean_of_cents("fare").alias("avg_fare"), mean_of_cents("distance").alias("avg_distance"),
        F.round(F.max("fare"), 2).alias("max_fare"))


def route_rollup(trips: DataFrame, start: str, end: str, fare: str, at_least: int = 10) -> DataFrame:
    """Trips and revenue per route with enough trips, best revenue first."""
    return (trips.groupBy(start, end)
            .agg(F.count(F.lit(1)).alias("trips"), F.round(F.sum(fare), 2).alias("revenue"),
                 mean_of_cents(fare).alias("avg_fare"))
            .filter(F.col("trips") >= at_least).orderBy(F.desc("revenue"), start, end))


def revenue_by(sales: DataFrame, keys: list[str | Column], amount: str) -> DataFrame:
    return sales.groupBy(*keys).agg(
        F.round(F.sum(amount), 2).alias("revenue"), F.count(F.lit(1)).alias("transactions"),
        mean_of_cents(amount).alias("avg_order_value"))


def live_totals(rows: DataFrame, ts: str, amount: str) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("total_rows"), F.max(ts).alias("latest_event"),
                    F.round(F.sum(amount), 2).alias("total_revenue"))


def newest(rows: DataFrame, ts: str, key: str, n: int = 5) -> DataFrame:
    return rows.orderBy(F.desc(ts), F.desc(key)).limit(n)


def churned(orders: DataFrame, member: str, ts: str, as_of: str, days: int = 90) -> DataFrame:
    """Members whose last order is older than ``days`` before ``as_of``."""
    last = orders.groupBy(member).agg(F.max(F.to_date(ts)).alias("last_order"))
    return (last.withColumn("days_since", F.datediff(F.lit(as_of).cast("date"), "last_order"))
            .filter(F.col("days_since") > days))


def spend_segment(total: Column, high: float = 500, medium: float = 300) -> Column:
    return F.when(total >= high, "High Value").when(total >= medium, "Medium Value").otherwise("Low Value")
