"""Expectations, gates, masks, privileges, pipelines."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lakeloom.operators import governance as g
from lakeloom.operators import quality as q
from lakeloom.plans import order_flow, retail, sales, star
from lakeloom.session import scratch_path, table
from lakeloom.sources.generators import dirty_orders, fatal_orders
from tests.conftest import rows

RULES = {"key": "id IS NOT NULL", "positive": "v > 0"}


@pytest.fixture()
def mixed(spark):
    return spark.createDataFrame([(1, 5), (None, 5), (2, -1), (3, None)], "id int, v int")


def test_null_rule_counts_as_failed(mixed):
    good, bad = q.split_quarantine(mixed, RULES)
    assert good.count() == 1 and bad.count() == 3
    log = {r["rule"]: (r["passed"], r["failed"]) for r in q.metric_log(mixed, RULES, "r", "t").collect()}
    assert log == {"key": (3, 1), "positive": (2, 2)}


def test_warn_counts_in_the_same_pass(mixed, spark):
    kept, seen = q.expect(mixed, RULES)
    kept.write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 4, "key": 1, "positive": 2}


def test_fail_writes_nothing(mixed, spark):
    path = scratch_path(spark, "never")
    with pytest.raises(Exception, match="expectation key failed"):
        q.expect_or_fail(mixed, {"key": RULES["key"]}).coalesce(1).write.parquet(path)
    with pytest.raises(Exception):
        spark.read.parquet(path).count()


def test_dirty_batches_drop_and_fail(spark, data):
    orders = table(spark, data, "orders")
    assert order_flow.silver_orders(dirty_orders(orders)).count() < orders.count()
    assert order_flow.silver_orders(orders).count() == orders.count()
    with pytest.raises(Exception, match="valid_order_key"):
        order_flow.silver_orders(fatal_orders(orders)).collect()
    with pytest.raises(Exception, match="valid_customer"):
        sales.clean_headers(spark.createDataFrame([(1, None, 5.0)], "SalesOrderID int, CustomerID int, TotalDue double")).collect()


def test_row_gate_and_validation_log(spark, mixed, data):
    with pytest.raises(q.CheckFailed):
        q.require_rows(mixed, 5)
    report = q.validate_folder(spark, data, ["orders", "no_such_table"])
    status = {r["table_name"]: r["status"] for r in report.collect()}
    assert status == {"orders": "PASS", "no_such_table": "FAIL"}
    path = scratch_path(spark, "log")
    with pytest.raises(q.CheckFailed):
        q.log_validation(report, path, "run-1")
    log = q.log_validation(q.validate_tables({"mixed": mixed}), path, "run-2")
    assert {r["job_run_id"]: r["status"] for r in log.collect()} == {"run-1": "FAIL", "run-2": "PASS"}


def test_masks_and_filters(spark):
    people = spark.createDataFrame([("john.doe@example.com", "East"), (None, "West"), ("x", None)], "email string, region string")
    seen = [r["m"] for r in people.select(g.mask_keep_domain(F.col("email")).alias("m")).collect()]
    assert seen == ["***@example.com", None, "***@x"]
    assert people.select(g.mask_keep_prefix(F.col("email")).alias("m")).first()["m"] == "jo***@***.***"
    rules = {"admins": "true", "us_team": "region = 'East'"}
    assert g.apply_row_filter(people, rules, {"us_team"}).count() == 1
    assert g.apply_row_filter(people, rules, set()).count() == 0
    assert rows(g.secured_view(people, "sv", {"email": g.mask_keep_domain}, rules, {"admins"})) == rows(people)


def test_generated_calendar(spark):
    days = star.date_dimension(spark)
    assert days.count() == 4018 and days.select("date_key").distinct().count() == 4018
    row = days.filter("date_key = 20240615").first()
    assert (row["day_of_week"], row["is_weekend"], row["season"], row["day_of_week_num"]) == ("Sat", 1, "Summer", 7)


def test_unknown_member_is_single(spark):
    orders = spark.createDataFrame([("Cash", "1"), ("Unknown", "2"), ("Credit Card", None), (None, "UNKNOWN")], "payment_method_code string, store_id string")
    pay = {r["payment_method_code"]: (r["payment_method_key"], r["payment_method_group"]) for r in star.payment_dimension(orders).collect()}
    assert pay == {"Cash": (1, "Cash"), "Credit Card": (2, "Card"), "Unknown": (-1, "Other")}
    assert sorted((r["store_id"], r["store_key"]) for r in star.store_dimension(orders).collect()) == [("1", 1), ("2", 2), ("UNKNOWN", -1)]


def test_layers_rerun_gives_the_same_tables(spark, data):
    from lakeloom.cases.inputs import retail_customers, retail_orders
    root = scratch_path(spark, "lake")
    customers = retail_customers(spark, data).select("customer_id", "version_tag", "first_name", "last_name", "email", "customer_segment")
    first = {n: df.count() for n, df in retail.run_layers(spark, customers, retail_orders(spark, data), root).items()}
    second = {n: df.count() for n, df in retail.run_layers(spark, customers, retail_orders(spark, data), root).items()}
    assert first == second and len(first) == 6 and all(first.values())
