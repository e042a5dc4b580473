"""Joins, aggregations, sorting, top-k and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.cases.inputs import RETAIL_SQL, retail_orders
from lakeloom.cases.registry import case, plain
from lakeloom.operators import aggregates as ag
from lakeloom.operators import joins, sets
from lakeloom.operators import windows as w
from lakeloom.session import table
from lakeloom.streaming import flows
from lakeloom.session import scratch_path

# ---- joins ----------------------------------------------------------------------


@case("c01_inner_join", """
SELECT o_orderkey, c_name || ' ' || c_mktsegment AS customer_name, o_totalprice, o_orderstatus FROM orders JOIN customer ON o_custkey = c_custkey""")
def c01(spark, d):
    o, c = table(spark, d, "orders"), table(spark, d, "customer")
    return o.join(c, o["o_custkey"] == c["c_custkey"], "inner").select(
        "o_orderkey", F.concat_ws(" ", "c_name", "c_mktsegment").alias("customer_name"), "o_totalprice", "o_orderstatus")


@case("c02_left_join", f"""
SELECT order_id, product_id, customer_id, c_name FROM ({RETAIL_SQL}) AS r LEFT JOIN customer ON customer_id = c_custkey""")
def c02(spark, d):
    names = table(spark, d, "customer").select(F.col("c_custkey").alias("customer_id"), "c_name")
    return joins.lookup(retail_orders(spark, d), names, "customer_id").select("order_id", "product_id", "customer_id", "c_name")


@case("c04_semi_join", """
SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders GROUP BY o_custkey HAVING count(*) > 10)""")
def c04(spark, d):
    busy = (table(spark, d, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")).filter("n > 10")
            .select(F.col("o_custkey").alias("c_custkey")))
    return joins.in_keys(table(spark, d, "customer"), busy, ["c_custkey"]).select("c_custkey", "c_name")


@case("c05_anti_join", """
SELECT p_partkey, p_name FROM part WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_returnflag = 'R' AND l_quantity > 45)""")
def c05(spark, d):
    returned = table(spark, d, "lineitem").filter("l_returnflag = 'R' AND l_quantity > 45").select(F.col("l_partkey").alias("p_partkey"))
    return joins.not_in_keys(table(spark, d, "part"), returned, ["p_partkey"]).select("p_partkey", "p_name")


PART_JOIN_SQL = """
SELECT p_brand, count(*) AS lines, round(sum(l_extendedprice), 2) AS revenue FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand"""


def _by_brand(df):
    return df.groupBy("p_brand").agg(F.count(F.lit(1)).alias("lines"), F.round(F.sum("l_extendedprice"), 2).alias("revenue"))


def _lines_and_parts(spark, d):
    lines = table(spark, d, "lineitem").select(F.col("l_partkey").alias("p_partkey"), "l_extendedprice")
    return lines, table(spark, d, "part").select("p_partkey", "p_brand")


@case("c06_broadcast_join", PART_JOIN_SQL)
def c06(spark, d):
    lines, parts = _lines_and_parts(spark, d)
    return _by_brand(joins.broadcast_join(lines, parts, "p_partkey", "inner"))


@case("c07_sort_merge_join", PART_JOIN_SQL)
def c07(spark, d):
    lines, parts = _lines_and_parts(spark, d)
    return _by_brand(joins.sort_merge_join(lines, parts, "p_partkey"))


SKEW_SQL = """
SELECT n_name, count(*) AS orders, round(sum(o_totalprice), 2) AS revenue FROM
 (SELECT CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey % 25 END AS k, o_totalprice FROM orders) AS o JOIN nation ON k = n_nationkey GROUP BY n_name"""


def _skewed(spark, d):
    """One key holds a third of the orders and more."""
    key = F.when(F.col("o_orderkey") % 3 == 0, 7).otherwise(F.col("o_custkey") % 25).cast("int")
    big = table(spark, d, "orders").select("o_orderkey", key.alias("n_nationkey"), "o_totalprice")
    return big, table(spark, d, "nation").select("n_nationkey", "n_name")


def _by_nation(df):
    return df.groupBy("n_name").agg(F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("revenue"))


@case("c09_salted_join", SKEW_SQL)
def c09(spark, d):
    big, small = _skewed(spark, d)
    return _by_nation(joins.salted_join(big, small, "n_nationkey", ["o_orderkey"], salts=10, heavy_rows=2000))


@case("c10_isolated_key_join", SKEW_SQL)
def c10(spark, d):
    big, small = _skewed(spark, d)
    return _by_nation(joins.isolated_join(big, small, "n_nationkey", ["o_orderkey"], heavy_rows=2000))


@case("c08_stream_static_join", """
SELECT o_orderkey, o_custkey, o_totalprice, c_name, c_mktsegment FROM orders LEFT JOIN customer ON o_custkey = c_custkey""")
def c08(spark, d):
    """The static side is read again in every micro-batch."""
    stream = flows.table_stream(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    target = scratch_path(spark, "enriched")

    def static():
        return table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")

    flows.drain(flows.join_static(stream, static, lambda rows, dim: joins.lookup(rows, dim, "o_custkey"),
                                  target, scratch_path(spark, "checkpoint")))
    return spark.read.parquet(target).drop("batch_id")


# ---- aggregations -----------------------------------------------------------------


@case("d01_grouped_aggregate", """
SELECT o_custkey, count(o_orderkey) AS order_count, round(sum(o_totalprice), 2) AS total_revenue, round(sum(o_totalprice), 2) / count(o_totalprice) AS avg_order_value,
  min(o_totalprice) AS min_amount, max(o_totalprice) AS max_amount FROM orders GROUP BY o_custkey""")
def d01(spark, d):
    return ag.order_stats(table(spark, d, "orders"), ["o_custkey"], "o_orderkey", "o_totalprice")


@case("d02_global_aggregate", """
SELECT count(*) AS total_lines, round(sum(l_extendedprice), 2) AS revenue, round(avg(l_quantity), 4) AS mean_quantity, max(l_extendedprice) AS largest FROM lineitem""")
def d02(spark, d):
    return table(spark, d, "lineitem").agg(
        F.count(F.lit(1)).alias("total_lines"), F.round(F.sum("l_extendedprice"), 2).alias("revenue"),
        F.round(F.avg("l_quantity"), 4).alias("mean_quantity"), F.max("l_extendedprice").alias("largest"))


@case("d03_distinct_count", """
SELECT l_returnflag, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY l_returnflag""")
def d03(spark, d):
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(
        F.count_distinct("l_partkey").alias("parts"), F.count_distinct("l_suppkey").alias("suppliers"))


@case("d04_conditional_aggregate", """
SELECT l_shipdate < TIMESTAMP '1998-01-01 00:00:00' AS early, sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS returned,
  count(*) FILTER (WHERE l_discount > 0.05) AS discounted, round(sum(CASE WHEN l_linestatus = 'F' THEN l_extendedprice ELSE 0 END), 2) AS finished FROM lineitem GROUP BY 1""")
def d04(spark, d):
    early = F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    return table(spark, d, "lineitem").groupBy(early.alias("early")).agg(
        F.sum((F.col("l_returnflag") == "R").cast("int")).alias("returned"), F.count_if(F.col("l_discount") > 0.05).alias("discounted"),
        F.round(F.sum(F.when(F.col("l_linestatus") == "F", F.col("l_extendedprice")).otherwise(0.0)), 2).alias("finished"))


@case("d05_having", """
SELECT l_partkey, l_returnflag, count(*) AS n, round(sum(l_extendedprice), 2) AS revenue FROM lineitem GROUP BY l_partkey, l_returnflag HAVING count(*) >= 15""")
def d05(spark, d):
    return table(spark, d, "lineitem").groupBy("l_partkey", "l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("revenue")).filter("n >= 15")


@case("d06_two_level_aggregate", """
SELECT CAST(month AS VARCHAR) AS month, count(*) AS active_members, round(sum(spent), 2) AS total_revenue, round(sum(spent), 2) / count(spent) AS avg_spend, round(max(spent), 2) AS max_spend
FROM (SELECT CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS month, o_custkey, sum(o_totalprice) AS spent FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2) AS m GROUP BY month""")
def d06(spark, d):
    done = table(spark, d, "orders").filter("o_orderstatus = 'F'")
    return plain(ag.monthly_activity(done, "o_orderdate", "o_custkey", "o_totalprice"))


@case("d07_daily_rollup", """
SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_date, count(o_orderkey) AS order_count, round(sum(o_totalprice), 2) AS total_revenue,
  round(sum(o_totalprice), 2) / count(o_totalprice) AS avg_order_value FROM orders GROUP BY 1""")
def d07(spark, d):
    return plain(ag.daily_rollup(table(spark, d, "orders"), "o_orderdate", "o_orderkey", "o_totalprice"))


@case("d08_distinct_rows", "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem")
def d08(spark, d):
    return table(spark, d, "lineitem").select("l_suppkey", "l_returnflag", "l_linestatus").distinct()


@case("d09_salted_aggregate", """
SELECT k, count(*) AS rows, round(sum(o_totalprice), 2) AS total, round(sum(o_totalprice), 2) / count(*) AS mean FROM
 (SELECT CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey % 25 END AS k, o_totalprice FROM orders) AS o GROUP BY k""")
def d09(spark, d):
    return ag.salted_sum(_skewed(spark, d)[0].withColumnRenamed("n_nationkey", "k"), "k", "o_totalprice", ["o_orderkey"])


@case("d10_column_statistics", """
SELECT 'o_totalprice' AS "column", count(o_totalprice) AS count, round(avg(o_totalprice), 4) AS mean, min(o_totalprice) AS min, max(o_totalprice) AS max FROM orders
UNION ALL SELECT 'o_custkey', count(o_custkey), round(avg(o_custkey), 4), min(o_custkey), max(o_custkey) FROM orders""")
def d10(spark, d):
    return ag.column_stats(table(spark, d, "orders"), ["o_totalprice", "o_custkey"])


@case("d10_describe", """
SELECT 'count' AS summary, CAST(count(o_totalprice) AS DOUBLE) AS o_totalprice, CAST(count(o_custkey) AS DOUBLE) AS o_custkey FROM orders
UNION ALL SELECT 'mean', round(avg(o_totalprice), 4), round(avg(o_custkey), 4) FROM orders
UNION ALL SELECT 'stddev', round(stddev(o_totalprice), 4), round(stddev(o_custkey), 4) FROM orders
UNION ALL SELECT 'min', min(o_totalprice), min(o_custkey) FROM orders
UNION ALL SELECT 'max', max(o_totalprice), max(o_custkey) FROM orders""")
def d10_describe(spark, d):
    """``describe``, and ``summary`` asked for the same statistics, agree."""
    orders = table(spark, d, "orders").select("o_totalprice", "o_custkey")
    told = lambda df: df.select("summary", *[F.round(F.col(c).cast("double"), 4).alias(c) for c in orders.columns])
    both = told(orders.describe()).intersect(told(orders.summary("count", "mean", "stddev", "min", "max")))
    return both


LINE_NUMBERS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@case("d10_exact_quartiles", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 4) AS q1, round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 4) AS q2, round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 4) AS q3 FROM lineitem""" for c in LINE_NUMBERS))
def d10_quartiles(spark, d):
    """Quartiles of every numeric column, by ranges of values narrowed side by side."""
    found = ag.exact_quantiles(table(spark, d, "lineitem"), LINE_NUMBERS)
    return found.select("column", *[F.round(q, 4).alias(q) for q in ("q1", "q2", "q3")])


@case("d11_quality_profile", f"""
SELECT count(*) AS total_rows, sum(CASE WHEN customer_id IS NULL THEN 1 ELSE 0 END) AS null_keys, count(DISTINCT customer_id) AS distinct_keys,
  sum(CASE WHEN quantity <= 0 THEN 1 ELSE 0 END) AS bad_quantity, sum(CASE WHEN unit_price IS NULL THEN 1 ELSE 0 END) AS no_price FROM ({RETAIL_SQL}) AS r""")
def d11(spark, d):
    return ag.quality_profile(retail_orders(spark, d), "customer_id", {"bad_quantity": "quantity <= 0", "no_price": "unit_price IS NULL"})


# ---- sort, limit, top-k -------------------------------------------------------------


@case("f01_global_sort", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_custkey, o_totalprice DESC, o_orderkey")
def f01(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice").orderBy("o_custkey", F.desc("o_totalprice"), "o_orderkey")


@case("f02_top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def f02(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10)


@case("f03_top_k_per_group", """
SELECT o_custkey, o_orderkey, o_totalprice, rn FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) AS x WHERE rn <= 3""")
def f03(spark, d):
    return w.top_per_group(table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"],
                           ["o_totalprice desc", "o_orderkey"], 3)


# ---- set operations -----------------------------------------------------------------


@case("g01_union_constant_row", """
SELECT p_partkey, p_name, p_brand FROM part UNION ALL SELECT -1, 'Unknown product', 'Unknown'""")
def g01(spark, d):
    return sets.with_constant_row(table(spark, d, "part").select("p_partkey", "p_name", "p_brand"),
                                  {"p_partkey": -1, "p_name": "Unknown product", "p_brand": "Unknown"})


@case("g02_union_by_name", """
SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer
UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL FROM supplier""")
def g02(spark, d):
    c = table(spark, d, "customer").selectExpr("c_custkey AS id", "c_name AS name", "c_acctbal AS balance", "c_mktsegment AS segment")
    s = table(spark, d, "supplier").selectExpr("s_acctbal AS balance", "s_name AS name", "s_suppkey AS id")
    return sets.union_by_name([c, s])


@case("g03_many_sources", """
SELECT CASE WHEN o_orderdate < TIMESTAMP '1997-01-01 00:00:00' THEN 'batch' ELSE 'stream' END AS source_system, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1""")
def g03(spark, d):
    """A history batch and two streaming flows land in one table, tagged by source."""
    target = scratch_path(spark, "united")
    columns = ["o_orderkey", "o_totalprice"]
    split = F.lit("1997-01-01").cast("timestamp_ntz")
    orders = table(spark, d, "orders")
    orders.filter(F.col("o_orderdate") < split).select(*columns, F.lit("batch").alias("source_system")).write.parquet(f"{target}/flow=history")
    for parity in (0, 1):
        live = (flows.table_stream(spark, d, "orders").filter((F.col("o_orderdate") >= split) & (F.col("o_orderkey") % 2 == parity))
                .select(*columns, F.lit("stream").alias("source_system")))
        flows.drain(flows.append_flow(live, f"{target}/flow=live{parity}", scratch_path(spark, "checkpoint")))
    return spark.read.parquet(f"{target}/*").groupBy("source_system").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
