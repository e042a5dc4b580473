"""Data-quality operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.cases.inputs import RETAIL_SQL, retail_orders
from lakeloom.cases.ingest import DIRTY_SQL
from lakeloom.cases.registry import case, plain
from lakeloom.operators import quality as q
from lakeloom.plans import order_flow
from lakeloom.plans.retail import ORDER_RULES
from lakeloom.session import scratch_path, table
from lakeloom.sources.generators import dirty_orders
from lakeloom.streaming import flows

OUT = "o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DOUBLE) AS o_totalprice, CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority"
VALID = "o_custkey IS NOT NULL AND o_totalprice >= 0 AND o_orderdate IS NOT NULL"


def _dirty(spark, d):
    return dirty_orders(table(spark, d, "orders"))


@case("k01_expect_warn", f"""
SELECT 'reasonable_price' AS rule, sum(CASE WHEN o_totalprice < 400000 THEN 0 ELSE 1 END) AS violations, count(*) AS row_count FROM ({DIRTY_SQL}) AS x
UNION ALL SELECT 'known_date', sum(CASE WHEN o_orderdate IS NOT NULL THEN 0 ELSE 1 END), count(*) FROM ({DIRTY_SQL}) AS x""")
def k01(spark, d):
    """All rows are written; the violations are counted in the same pass."""
    rules = {"reasonable_price": "o_totalprice < 400000", "known_date": "o_orderdate IS NOT NULL"}
    kept, seen = q.expect(_dirty(spark, d), rules)
    kept.write.parquet(scratch_path(spark, "warned"))
    return spark.createDataFrame([(r, seen.get[r], seen.get["rows"]) for r in rules], "rule string, violations bigint, row_count bigint")


@case("k02_expect_or_drop", f"SELECT {OUT} FROM ({DIRTY_SQL}) AS x WHERE {VALID}")
def k02(spark, d):
    return plain(q.expect_or_drop(_dirty(spark, d), order_flow.DROP))


@case("k03_expect_or_fail", f"SELECT {OUT} FROM ({DIRTY_SQL}) AS x WHERE o_orderkey IS NOT NULL")
def k03(spark, d):
    """Passes because no order key is null; a violating row would end the job."""
    return plain(q.expect_or_fail(_dirty(spark, d), order_flow.FAIL))


@case("k03_fail_then_filter", f"SELECT o_orderkey, o_orderstatus FROM ({DIRTY_SQL}) AS x WHERE o_orderstatus = 'F' AND o_orderkey IS NOT NULL")
def k03_filter(spark, d):
    """A filter or join after the rule does not hide rows from it: a rule that rows outside the
    filter violate ends the job."""
    dirty = _dirty(spark, d)
    keys = dirty.filter("o_orderstatus = 'F'").select("o_orderkey").distinct()
    for later in (lambda df: df.filter("o_orderstatus = 'F'"), lambda df: df.join(keys, "o_orderkey")):
        try:
            later(q.expect_or_fail(dirty, {"no_open_orders": "o_orderstatus <> 'O'"})).count()
        except q.CheckFailed as refused:
            assert "no_open_orders" in str(refused)
            continue
        raise AssertionError("the violation was hidden")
    return q.expect_or_fail(dirty, order_flow.FAIL).filter("o_orderstatus = 'F'").select("o_orderkey", "o_orderstatus")


@case("k04_rule_sets", f"""
SELECT 'orders' AS dataset, count(*) AS kept FROM ({DIRTY_SQL}) AS x WHERE {VALID}
UNION ALL SELECT 'clean', count(*) FROM orders WHERE {VALID}""")
def k04(spark, d):
    """One rule set used on two tables."""
    counted = [q.expect_or_drop(df, order_flow.DROP).agg(F.lit(n).alias("dataset"), F.count(F.lit(1)).alias("kept"))
               for n, df in (("orders", _dirty(spark, d)), ("clean", table(spark, d, "orders")))]
    return counted[0].unionByName(counted[1])


@case("k05_quarantine_split", f"""
SELECT o_orderkey, NOT coalesce({VALID}, false) AS quarantined FROM ({DIRTY_SQL}) AS x""")
def k05(spark, d):
    good, bad = q.split_quarantine(_dirty(spark, d), order_flow.DROP)
    return (good.select("o_orderkey", F.lit(False).alias("quarantined"))
            .unionByName(bad.select("o_orderkey", F.lit(True).alias("quarantined"))))


LOG_RULES = {"valid_quantity": "quantity <> 0", "valid_price": "unit_price >= 0", "valid_customer": "customer_id IS NOT NULL"}


@case("k06_metric_log", " UNION ALL ".join(
    f"SELECT 'run-1' AS run_id, 'orders' AS dataset, '{n}' AS rule, count(*) FILTER (WHERE {r}) AS passed, "
    f"count(*) - count(*) FILTER (WHERE {r}) AS failed FROM ({RETAIL_SQL}) AS r" for n, r in LOG_RULES.items()))
def k06(spark, d):
    path = scratch_path(spark, "metric-log")
    q.metric_log(retail_orders(spark, d), LOG_RULES, "run-1", "orders").write.mode("append").parquet(path)
    return spark.read.parquet(path)


STREAM_RULES = {"valid_customer": "o_custkey IS NOT NULL AND o_custkey % 10 <> 3", "valid_total": "o_totalprice < 200000", "urgent": "o_orderpriority = '1-URGENT'"}


@case("k06_stream_metrics", " UNION ALL ".join(
    f"SELECT 'run-1' AS run_id, 'orders' AS dataset, '{n}' AS rule, CAST(o_orderkey % 4 AS BIGINT) AS batch, count(*) FILTER (WHERE {r}) AS passed, "
    f"count(*) - count(*) FILTER (WHERE {r}) AS failed FROM orders GROUP BY o_orderkey % 4" for n, r in STREAM_RULES.items()))
def k06_stream(spark, d):
    """Four micro-batches of one checkpoint, each in a run of its own; a run without new files adds
    nothing to the log."""
    orders = table(spark, d, "orders")
    source, target, checkpoint, log = (scratch_path(spark, n) for n in ("arriving", "checked", "checkpoint", "metrics"))
    for batch in (0, 1, 2, 3, None):
        if batch is not None:
            orders.filter(F.col("o_orderkey") % 4 == batch).coalesce(1).write.mode("append").parquet(source)
        rows = q.observe_rules(flows.file_stream(spark, source, "parquet", orders.schema), STREAM_RULES, "orders")
        told = q.drain_with_metrics(lambda rows=rows: flows.append_flow(rows, target, checkpoint), spark, "orders", "run-1", log)
        assert told == (batch is not None)
    return q.read_metrics(spark, log)


@case("k07_row_count_gate", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus")
def k07(spark, d):
    return q.require_rows(table(spark, d, "orders"), 100).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@case("k08_table_set_validation", """
SELECT 'orders' AS table_name, 'PASS' AS status, count(*) AS row_count, NULL AS error FROM orders
UNION ALL SELECT 'customer', 'PASS', count(*), NULL FROM customer
UNION ALL SELECT 'empty', 'FAIL', 0, 'fewer than 1 rows'""")
def k08(spark, d):
    orders = table(spark, d, "orders")
    report = q.validate_tables({"orders": orders, "customer": table(spark, d, "customer"), "empty": orders.filter("o_orderkey < 0")})
    q.log_validation(report, scratch_path(spark, "events"), "run-1", raise_on_fail=False)
    return report


@case("k09_write_constraints", "SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_custkey % 2 = 0")
def k09(spark, d):
    """A violating insert is refused as a whole and leaves the table as it was."""
    rows = table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal")
    path, rules = scratch_path(spark, "constrained"), {"named": "c_name LIKE 'Customer#%'", "keyed": "c_custkey IS NOT NULL"}
    q.append_checked(rows.filter("c_custkey % 2 = 0"), path, rules)
    try:
        q.append_checked(rows.filter("c_custkey % 2 = 1").withColumn("c_name", F.lit("nobody")), path, rules)
    except q.CheckFailed as refused:
        assert "named" in str(refused)
        return spark.read.parquet(path)
    raise AssertionError("constraint did not hold")


@case("k10_schema_enforcement", "SELECT c_custkey, c_name FROM customer")
def k10(spark, d):
    """An append with another type or an unknown column is refused."""
    rows = table(spark, d, "customer").select("c_custkey", "c_name")
    path = scratch_path(spark, "strict")
    q.append_checked(rows, path)
    for wrong in (rows.withColumn("c_custkey", F.col("c_custkey").cast("string")), rows.withColumn("tier", F.lit("x"))):
        try:
            q.append_checked(wrong, path)
        except q.CheckFailed:
            continue
        raise AssertionError("schema was not enforced")
    return spark.read.parquet(path)


@case("k11_schema_evolution", """
SELECT c_custkey, c_name, NULL AS customer_tier FROM customer UNION ALL SELECT c_custkey + 1000000, c_name, 'Gold' FROM customer WHERE c_custkey % 10 = 0""")
def k11(spark, d):
    rows = table(spark, d, "customer").select("c_custkey", "c_name")
    path = scratch_path(spark, "widened")
    q.append_checked(rows, path)
    q.append_checked(rows.filter("c_custkey % 10 = 0").select(
        (F.col("c_custkey") + 1000000).alias("c_custkey"), "c_name", F.lit("Gold").alias("customer_tier")), path, widen=True)
    return spark.read.option("mergeSchema", True).parquet(path)


@case("k11_merge_schema_frames", """
SELECT c_custkey, c_name, NULL AS customer_tier FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT c_custkey, NULL, 'Gold' FROM customer WHERE c_custkey % 2 = 1""")
def k11_frames(spark, d):
    c = table(spark, d, "customer")
    return q.merge_schema(c.filter("c_custkey % 2 = 0").select("c_custkey", "c_name"),
                          c.filter("c_custkey % 2 = 1").select("c_custkey", F.lit("Gold").alias("customer_tier")))


@case("k_star_rules_hold", f"""
SELECT order_id, quantity FROM ({RETAIL_SQL}) AS r WHERE order_id IS NOT NULL AND customer_id IS NOT NULL AND product_id IS NOT NULL
 AND quantity IS NOT NULL AND quantity <> 0 AND unit_price IS NOT NULL AND unit_price >= 0""")
def k_rules(spark, d):
    return q.expect_or_drop(retail_orders(spark, d), ORDER_RULES).select("order_id", "quantity")
