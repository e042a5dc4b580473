"""Window functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.cases.registry import case, plain
from lakeloom.functions import scalars as fx
from lakeloom.operators import windows as w
from lakeloom.plans.star import extend_key_map
from lakeloom.session import stage, table


def _orders(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")


TIME = ["o_orderdate", "o_orderkey"]


@case("e01_ranking", """
SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS row_num,
  rank() OVER (PARTITION BY o_custkey ORDER BY year(o_orderdate) DESC) AS rank, dense_rank() OVER (PARTITION BY o_custkey ORDER BY year(o_orderdate) DESC) AS dense_rank FROM orders""")
def e01(spark, d):
    rows = _orders(spark, d).withColumn("y", F.year("o_orderdate"))
    hot = w.hot_keys(rows, ["o_custkey"])
    numbered = w.with_windows(rows, ["o_custkey"], ["o_totalprice desc", "o_orderkey"], {"row_num": w.row_number()}, hot=hot)
    return w.with_ranks(numbered, ["o_custkey"], ["y desc"], hot=hot).select("o_orderkey", "o_custkey", "row_num", "rank", "dense_rank")


@case("e02_lag_lead", """
SELECT o_orderkey, o_custkey, prev_amount, next_amount, round(o_totalprice - prev_amount, 2) AS amount_change,
  round((o_totalprice - prev_amount) / prev_amount * 100, 6) AS change_pct FROM (SELECT *, lag(o_totalprice) OVER t AS prev_amount, lead(o_totalprice) OVER t AS next_amount
  FROM orders WINDOW t AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)) AS x""")
def e02(spark, d):
    rows = w.with_windows(_orders(spark, d), ["o_custkey"], TIME, {"prev_amount": w.lag("o_totalprice"), "next_amount": w.lead("o_totalprice")})
    change = F.col("o_totalprice") - F.col("prev_amount")
    return rows.select("o_orderkey", "o_custkey", "prev_amount", "next_amount", F.round(change, 2).alias("amount_change"),
                       F.round(F.try_divide(change, F.col("prev_amount")) * 100, 6).alias("change_pct"))


@case("e03_running_totals", """
SELECT o_orderkey, o_custkey, round(sum(o_totalprice) OVER t, 2) AS running_sum, count(o_orderkey) OVER t AS running_count,
  round(sum(o_totalprice) OVER t, 2) / count(o_orderkey) OVER t AS running_avg
FROM orders WINDOW t AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def e03(spark, d):
    rows = w.with_windows(_orders(spark, d), ["o_custkey"], TIME, {
        "running_sum": w.running("sum", "o_totalprice"), "running_count": w.running("count", "o_orderkey")})
    return rows.select("o_orderkey", "o_custkey", F.round("running_sum", 2).alias("running_sum"), "running_count",
                       F.try_divide(F.round("running_sum", 2), "running_count").alias("running_avg"))


@case("e04_moving_frame", """
SELECT o_orderkey, round(avg(o_totalprice) OVER t, 6) AS moving_avg, round(sum(o_totalprice) OVER t, 2) AS moving_sum, max(o_totalprice) OVER t AS moving_max, min(o_totalprice) OVER t AS moving_min
FROM orders WINDOW t AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""")
def e04(spark, d):
    rows = w.with_windows(_orders(spark, d), ["o_custkey"], TIME, {f"moving_{fn}": w.frame(fn, "o_totalprice", 2) for fn in ("avg", "sum", "max", "min")})
    return rows.select("o_orderkey", F.round("moving_avg", 6).alias("moving_avg"), F.round("moving_sum", 2).alias("moving_sum"), "moving_max", "moving_min")


@case("e05_range_frame", """
SELECT o_orderkey, round(sum(o_totalprice) OVER t, 2) AS last_quarter, count(*) OVER t AS orders_in_range
FROM (SELECT *, date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS day_no FROM orders) AS x WINDOW t AS (PARTITION BY o_custkey ORDER BY day_no RANGE BETWEEN 90 PRECEDING AND CURRENT ROW)""")
def e05(spark, d):
    rows = _orders(spark, d).withColumn("day_no", F.unix_date(F.to_date("o_orderdate")))
    out = w.with_range_frame(rows, ["o_custkey"], "day_no", 90, {"last_quarter": ("sum", "o_totalprice"), "orders_in_range": ("count", "o_orderkey")})
    return out.select("o_orderkey", F.round("last_quarter", 2).alias("last_quarter"), "orders_in_range")


@case("e05_range_frame_nulls_hot", """
SELECT o_orderkey, round(sum(o_totalprice) OVER t, 2) AS last_quarter, count(*) OVER t AS orders_in_range
FROM (SELECT *, CASE WHEN o_orderkey % 3 <> 0 THEN o_custkey END AS customer,
  CASE WHEN o_orderkey % 11 <> 0 THEN date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) END AS day_no FROM orders) AS x
WINDOW t AS (PARTITION BY customer ORDER BY day_no NULLS FIRST RANGE BETWEEN 90 PRECEDING AND CURRENT ROW)""")
def e05_nulls(spark, d):
    """The null key holds a third of the rows and is split; null days share a frame of their own."""
    rows = _orders(spark, d).withColumns({
        "customer": F.when(F.col("o_orderkey") % 3 != 0, F.col("o_custkey")),
        "day_no": F.when(F.col("o_orderkey") % 11 != 0, F.unix_date(F.to_date("o_orderdate")))})
    out = w.with_range_frame(rows, ["customer"], "day_no", 90, {"last_quarter": ("sum", "o_totalprice"), "orders_in_range": ("count", "o_orderkey")}, hot_rows=50)
    return out.select("o_orderkey", F.round("last_quarter", 2).alias("last_quarter"), "orders_in_range")


@case("e05_wide_frame_hot", """
SELECT o_orderkey, round(sum(o_totalprice) OVER t, 2) AS total, count(*) OVER t AS orders_in_range, min(o_totalprice) OVER t AS cheapest, max(o_totalprice) OVER t AS dearest
FROM orders WINDOW t AS (PARTITION BY o_orderstatus ORDER BY o_orderkey RANGE BETWEEN 5000 PRECEDING AND CURRENT ROW)""")
def e05_wide(spark, d):
    """Every status is a hot key with a step for each order, and a frame spans many tasks."""
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"))
    out = w.with_range_frame(rows, ["o_orderstatus"], "o_orderkey", 5000, {
        "total": ("sum", "cents"), "orders_in_range": ("count", "cents"), "cheapest": ("min", "cents"), "dearest": ("max", "cents")}, hot_rows=500)
    money = {c: (F.col(c) / 100).alias(c) for c in ("total", "cheapest", "dearest")}
    return out.select("o_orderkey", F.round(money["total"], 2).alias("total"), "orders_in_range", money["cheapest"], money["dearest"])


@case("e06_whole_partition_frame", """
SELECT o_orderkey, o_custkey, round(o_totalprice / sum(o_totalprice) OVER (PARTITION BY o_custkey), 6) AS share, count(*) OVER (PARTITION BY o_custkey) AS orders FROM orders""")
def e06(spark, d):
    rows = w.with_totals(_orders(spark, d), ["o_custkey"], {"total": ("sum", "o_totalprice"), "orders": ("count", "o_orderkey")})
    return rows.select("o_orderkey", "o_custkey", fx.ratio(F.col("o_totalprice"), F.col("total"), 6).alias("share"), "orders")


@case("e07_unpartitioned_rank", """
SELECT o_custkey, total, rank() OVER (ORDER BY total DESC) AS spending_rank FROM (SELECT o_custkey, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY o_custkey) AS x""")
def e07(spark, d):
    totals = table(spark, d, "orders").groupBy("o_custkey").agg(F.round(F.sum("o_totalprice"), 2).alias("total"))
    return w.with_ranks(stage(totals), [], ["total desc"], "spending_rank").drop("dense_rank")


LATEST_SQL = """
SELECT o_custkey, o_orderkey, CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1"""


@case("e08_latest_per_key", LATEST_SQL)
def e08(spark, d):
    return plain(w.latest_per_key(_orders(spark, d), ["o_custkey"], TIME))


@case("e09_qualify", LATEST_SQL)
def e09(spark, d):
    return plain(w.top_per_group(_orders(spark, d), ["o_custkey"], ["o_orderdate desc", "o_orderkey desc"], 1).drop("rn"))


@case("e10_subset_dedup", "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def e10(spark, d):
    return table(spark, d, "lineitem").select("l_partkey", "l_suppkey", "l_extendedprice").dropDuplicates(["l_partkey", "l_suppkey"]).drop("l_extendedprice")


@case("e11_surrogate_key", "SELECT row_number() OVER (ORDER BY c_name) AS customer_key, c_name FROM customer")
def e11(spark, d):
    return w.surrogate_key(table(spark, d, "customer").select("c_name"), "customer_key", ["c_name"])


@case("e11_stable_key_map", """
SELECT row_number() OVER (ORDER BY c_custkey) AS customer_key, c_custkey FROM customer WHERE c_custkey % 3 = 0
UNION ALL SELECT (SELECT count(*) FROM customer WHERE c_custkey % 3 = 0) + row_number() OVER (ORDER BY c_custkey), c_custkey FROM customer WHERE c_custkey % 3 <> 0""")
def e11_map(spark, d):
    """Known members keep their key; members that arrive later get the next numbers."""
    members = table(spark, d, "customer").select("c_custkey")
    known = stage(w.surrogate_key(members.filter("c_custkey % 3 = 0"), "customer_key", ["c_custkey"]))
    return extend_key_map(known, members, "customer_key", "c_custkey")
