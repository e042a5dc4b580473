"""Layer pipelines and star schemas."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.cases.inputs import (CHANGES_SQL, RETAIL_CUSTOMERS_SQL, RETAIL_SQL, STEPS, TODAY, UNKNOWN_ID,
                                   retail_customers, retail_orders)
from lakeloom.cases.registry import case, plain
from lakeloom.operators import cdc, materialised
from lakeloom.operators import changes as changes_mod
from lakeloom.operators.quality import expect, expect_or_fail
from lakeloom.plans import order_flow, retail, sales, star
from lakeloom.session import scratch_path, stage, table, together
from lakeloom.sources import incremental, writers
from lakeloom.sources.generators import change_batches, dirty_orders
from lakeloom.streaming import flows
from lakeloom.cases.ingest import DIRTY_SQL

# fixed values: output columns of the calendar
DATE_SQL = """CAST(strftime(dd, '%Y%m%d') AS INT) AS date_key, CAST(dd AS VARCHAR) AS date, year(dd) AS year, quarter(dd) AS quarter, month(dd) AS month, day(dd) AS day,
  strftime(dd, '%a') AS day_of_week, dayofweek(dd) + 1 AS day_of_week_num, weekofyear(dd) AS week_of_year, strftime(dd, '%B') AS month_name,
  CASE WHEN dayofweek(dd) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
  CASE WHEN month(dd) IN (12, 1, 2) THEN 'Winter' WHEN month(dd) IN (3, 4, 5) THEN 'Spring' WHEN month(dd) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS season"""

# ---- N01: retail layers -----------------------------------------------------------

SILVER_CUSTOMERS = f"""SELECT customer_id, first_name, last_name, lower(trim(email)) AS email, customer_segment, version_tag
FROM ({RETAIL_CUSTOMERS_SQL}) AS b WHERE customer_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY version_tag DESC) = 1"""
SILVER_ORDERS = f"""SELECT order_id, customer_id, product_id, quantity, order_datetime, CAST(round(g, 2) AS DOUBLE) AS total_amount, CAST(round(g * p * 0.01, 2) AS DOUBLE) AS discount_amount,
  round(g, 2) - round(g * p * 0.01, 2) AS net FROM (SELECT *, CAST(unit_price AS DECIMAL(14,2)) * CAST(quantity AS DECIMAL(8,0)) AS g, CAST(discount_percent AS DECIMAL(5,2)) AS p
  FROM ({RETAIL_SQL}) AS r) AS b WHERE order_id IS NOT NULL AND customer_id IS NOT NULL AND quantity > 0"""


@case("n01_silver_customers", SILVER_CUSTOMERS)
def n01_customers(spark, d):
    return retail.silver_customers(retail_customers(spark, d), by=("version_tag",))


@case("n01_silver_orders", f"SELECT order_id, customer_id, product_id, quantity, total_amount, discount_amount, CAST(net AS DOUBLE) AS net_amount FROM ({SILVER_ORDERS}) AS s")
def n01_orders(spark, d):
    return plain(retail.silver_orders(retail_orders(spark, d)).select(
        "order_id", "customer_id", "product_id", "quantity", "total_amount", "discount_amount", "net_amount"))


@case("n01_gold_customer_summary", f"""
SELECT customer_id, first_name, last_name, customer_segment, count(order_id) AS total_orders, CAST(sum(net) AS DOUBLE) AS total_revenue,
  CAST(sum(net) AS DOUBLE) / count(net) AS avg_order_value, CAST(max(order_datetime) AS VARCHAR) AS last_order_date FROM ({SILVER_ORDERS}) AS o LEFT JOIN ({SILVER_CUSTOMERS}) AS c USING (customer_id) GROUP BY ALL""")
def n01_summary(spark, d):
    """The whole run, bronze to gold, written layer by layer."""
    customers = retail_customers(spark, d)
    # the batch load stamps one time on every row, so the source's own version decides
    layers = retail.run_layers(spark, customers.select("customer_id", "version_tag", "first_name", "last_name", "email", "customer_segment"),
                                  retail_orders(spark, d), scratch_path(spark, "lake"))
    return plain(layers["gold_customer_summary"])


@case("n01_gold_daily_orders", f"""
SELECT CAST(CAST(order_datetime AS DATE) AS VARCHAR) AS order_date, count(order_id) AS order_count, CAST(sum(net) AS DOUBLE) AS total_revenue,
  CAST((2 * CAST(sum(net) * 100 AS BIGINT) + count(net)) // (2 * count(net)) AS DOUBLE) / 100 AS avg_order_value
FROM ({SILVER_ORDERS}) AS o GROUP BY CAST(order_datetime AS DATE)""")
def n01_daily(spark, d):
    return plain(retail.gold_daily(retail.silver_orders(retail_orders(spark, d))))


# ---- dimensions ---------------------------------------------------------------------


@case("n05_date_dimension", f"""
SELECT {DATE_SQL} FROM (SELECT CAST(unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)), INTERVAL 1 DAY)) AS DATE) AS dd FROM orders) AS x""")
def n05(spark, d):
    return plain(star.date_dimension_covering(table(spark, d, "orders"), "o_orderdate"))


@case("n06_date_dimension_from_facts", """
SELECT DISTINCT CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS "DateKey", year(l_shipdate) AS "Year", month(l_shipdate) AS "Month", day(l_shipdate) AS "Day", quarter(l_shipdate) AS "Quarter",
  dayofweek(l_shipdate) + 1 AS "DayOfWeek", strftime(l_shipdate, '%B') AS "MonthName", strftime(l_shipdate, '%A') AS "DayName" FROM lineitem""")
def n06(spark, d):
    return plain(star.date_dimension_from(table(spark, d, "lineitem"), "l_shipdate"))


UNKNOWN_CUSTOMER = {"customer_id": "UNKNOWN", "c_name": "Unknown", "c_mktsegment": "Unknown"}
DIM_CUSTOMER = f"""
SELECT row_number() OVER (ORDER BY customer_id) AS customer_key, * FROM (SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name, c_mktsegment FROM ({CHANGES_SQL}) AS e
  QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY seq DESC) = 1) AS x UNION ALL SELECT -1, 'UNKNOWN', 'Unknown', 'Unknown'"""


def _dim_customer(spark, d):
    events = change_batches(table(spark, d, "customer"), STEPS).select(
        F.col("c_custkey").cast("string").alias("customer_id"), "c_name", "c_mktsegment", "seq")
    history = cdc.scd2(events, ["customer_id"], ["seq"]).drop("seq")
    return star.customer_dimension(history, "customer_id", UNKNOWN_CUSTOMER)


@case("n07_customer_dimension", DIM_CUSTOMER)
def n07(spark, d):
    return _dim_customer(spark, d)


STATUS = "CASE p_partkey % 4 WHEN 0 THEN 'Active' WHEN 1 THEN 'AVAILABLE' WHEN 2 THEN 'discontinued' ELSE 'active' END"
DIM_PRODUCT = f"""
SELECT row_number() OVER (ORDER BY product_id) AS product_key, *, CASE WHEN upper(status) IN ('ACTIVE', 'AVAILABLE') THEN 1 ELSE 0 END AS is_active, 0 AS is_unknown
FROM (SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name, p_brand AS brand, p_retailprice * CAST(0.6 AS DOUBLE) AS unit_cost, p_retailprice AS list_price, {STATUS} AS status FROM part) AS p
UNION ALL SELECT -1, 'UNKNOWN', 'Unknown product', 'Unknown', NULL, NULL, 'Unknown', 0, 1"""
UNKNOWN_PRODUCT = {"product_id": "UNKNOWN", "product_name": "Unknown product", "brand": "Unknown"}


def _dim_product(spark, d):
    products = table(spark, d, "part").selectExpr(
        "CAST(p_partkey AS STRING) AS product_id", "p_name AS product_name", "p_brand AS brand",
        "p_retailprice * 0.6D AS unit_cost", "p_retailprice AS list_price", f"{STATUS} AS status")
    return star.product_dimension(products, "product_id", UNKNOWN_PRODUCT)


@case("n08_product_dimension", DIM_PRODUCT)
def n08(spark, d):
    return _dim_product(spark, d)


SILVER_LINES = f"""SELECT order_id, CAST(customer_id AS VARCHAR) AS customer_id, CAST(product_id AS VARCHAR) AS product_id, store_id, order_datetime AS order_ts,
  CAST(strftime(order_datetime, '%Y%m%d') AS INT) AS order_date_key, quantity, unit_price, discount_percent, CAST(g AS DOUBLE) AS gross_amount, CAST(g * p * 0.01 AS DOUBLE) AS discount_amount,
  CAST(g - g * p * 0.01 AS DOUBLE) AS net_amount, coalesce(payment_method, 'Unknown') AS payment_method_code, source_system,
  CASE WHEN quantity < 0 OR total_amount < 0 THEN 1 ELSE 0 END AS is_return, CASE WHEN CAST(order_datetime AS DATE) > DATE '{TODAY}' THEN 1 ELSE 0 END AS is_future_dated,
  CASE WHEN customer_id = {UNKNOWN_ID} THEN 1 ELSE 0 END AS is_unknown_customer, CASE WHEN product_id = {UNKNOWN_ID} THEN 1 ELSE 0 END AS is_unknown_product
FROM (SELECT *, CAST(unit_price AS DECIMAL(14,2)) * CAST(quantity AS DECIMAL(8,0)) AS g, CAST(discount_percent AS DECIMAL(5,2)) AS p FROM ({RETAIL_SQL}) AS r) AS b
WHERE order_id IS NOT NULL AND customer_id IS NOT NULL AND product_id IS NOT NULL AND quantity IS NOT NULL AND quantity <> 0 AND unit_price IS NOT NULL AND unit_price >= 0"""


def _silver_lines(bronze):
    lines = retail.silver_order_lines(bronze, F.lit(TODAY).cast("date"), unknown_customer=UNKNOWN_ID, unknown_product=UNKNOWN_ID)
    return lines.withColumns({c: F.col(c).cast("string") for c in ("customer_id", "product_id")})


@case("n02_silver_order_lines", f"SELECT * REPLACE (CAST(order_ts AS VARCHAR) AS order_ts) FROM ({SILVER_LINES}) AS s")
def n02_silver(spark, d):
    return plain(_silver_lines(retail_orders(spark, d)).drop("order_date"))


DIM_PAYMENT = f"""
SELECT row_number() OVER (ORDER BY payment_method_code) AS payment_method_key, payment_method_code, 'Other' AS payment_method_group
FROM (SELECT DISTINCT payment_method_code FROM ({SILVER_LINES}) AS s WHERE payment_method_code <> 'Unknown') AS c UNION ALL SELECT -1, 'Unknown', 'Other'"""
DIM_STORE = f"""
SELECT row_number() OVER (ORDER BY store_id) AS store_key, store_id, store_id AS store_code FROM (SELECT DISTINCT store_id FROM ({SILVER_LINES}) AS s) AS c
UNION ALL SELECT -1, 'UNKNOWN', 'UNKNOWN'"""


@case("n09_payment_dimension", DIM_PAYMENT)
def n09_payment(spark, d):
    return star.payment_dimension(_silver_lines(retail_orders(spark, d)))


@case("n09_store_dimension", DIM_STORE)
def n09_store(spark, d):
    return star.store_dimension(_silver_lines(retail_orders(spark, d)))


FACT_SQL = f"""
WITH s AS ({SILVER_LINES}), dc AS ({DIM_CUSTOMER}), dp AS ({DIM_PRODUCT}), ds AS ({DIM_STORE}), dm AS ({DIM_PAYMENT})
SELECT order_id, coalesce(store_key, -1) AS store_key, coalesce(customer_key, -1) AS customer_key, coalesce(product_key, -1) AS product_key,
  coalesce(payment_method_key, -1) AS payment_method_key, order_date_key, CAST(order_ts AS VARCHAR) AS order_ts, quantity, unit_price, discount_percent, gross_amount, discount_amount, net_amount,
  coalesce(unit_cost, CAST(0 AS DOUBLE)) * quantity AS total_cost, net_amount - coalesce(unit_cost, CAST(0 AS DOUBLE)) * quantity AS profit_amount,
  CASE WHEN net_amount > 0 THEN (net_amount - coalesce(unit_cost, CAST(0 AS DOUBLE)) * quantity) / net_amount * 100 ELSE 0 END AS margin_percent,
  is_return, is_future_dated, is_unknown_customer, is_unknown_product, source_system
FROM s LEFT JOIN dc USING (customer_id) LEFT JOIN dp USING (product_id) LEFT JOIN ds USING (store_id) LEFT JOIN dm USING (payment_method_code)"""
# fixed values: output columns of the fact
FACT_COLUMNS = """order_id store_key customer_key product_key payment_method_key order_date_key order_ts quantity unit_price discount_percent gross_amount
 discount_amount net_amount total_cost profit_amount margin_percent is_return is_future_dated is_unknown_customer is_unknown_product source_system""".split()


def _dims(spark, d, lines):
    days = table(spark, d, "orders").filter("o_orderdate < TIMESTAMP_NTZ'2000-01-01 00:00:00'")
    return together(lambda: _dim_customer(spark, d), lambda: _dim_product(spark, d), lambda: star.store_dimension(lines),
                    lambda: star.payment_dimension(lines), lambda: star.date_dimension_covering(days, "o_orderdate"))


def _fact(lines, *dims):
    """The fail rule concerns a column of the lines alone, so it is tested before the joins."""
    fact = star.sales_fact(expect_or_fail(lines, star.FACT_FAIL), *dims)
    return expect(fact, star.FACT_WARN)[0].select(*FACT_COLUMNS)


@case("c03_star_lookup", FACT_SQL)
def c03(spark, d):
    """Five lookups with an unknown member; dates after 1999 are outside the calendar and
    keep their natural key."""
    lines = stage(_silver_lines(retail_orders(spark, d)), "silver")  # read by two dimensions and the fact
    return plain(_fact(lines, *_dims(spark, d, lines)))


@case("n02_retail_layers", FACT_SQL)
def n02(spark, d):
    """Backfill and stream into bronze, cleansed silver, dimensions and fact, each layer stored."""
    bronze = retail_orders(spark, d)
    root = scratch_path(spark, "retail")
    bronze.filter("source_system = 'batch'").write.parquet(f"{root}/bronze/flow=backfill")
    bronze.filter("source_system = 'stream'").write.parquet(f"{root}/arrivals")
    live = flows.file_stream(spark, f"{root}/arrivals", "parquet", bronze.schema)
    flows.drain(flows.append_flow(live, f"{root}/bronze/flow=live", f"{root}/checkpoints/live"))
    lines = stage(_silver_lines(spark.read.schema(bronze.schema).parquet(f"{root}/bronze/*")), "silver")
    dims = [stage(dim, "dim") for dim in _dims(spark, d, lines)]
    return plain(stage(_fact(lines, *dims), "fact"))


@case("j10_streaming_fact", FACT_SQL)
def j10(spark, d):
    """Fact rows appended per batch against the dimensions as they are then."""
    lines = stage(_silver_lines(retail_orders(spark, d)), "silver")
    root = scratch_path(spark, "fact")
    stored = [scratch_path(spark, "dim") for _ in range(5)]
    for dim, path in zip(_dims(spark, d, lines), stored):
        dim.write.parquet(path)
    lines.write.partitionBy("source_system").parquet(f"{root}/lines")
    schema = lines.drop("source_system").schema
    for source in ("batch", "stream"):
        stream = flows.file_stream(spark, f"{root}/lines/source_system={source}", "parquet", schema).withColumn("source_system", F.lit(source))
        flows.drain(flows.fact_flow(stream, lambda: [spark.read.parquet(p) for p in stored], _fact,
                                    f"{root}/fact/source={source}", f"{root}/checkpoints/{source}"))
    return plain(spark.read.parquet(f"{root}/fact").select(*FACT_COLUMNS))


@case("n11_profit_measures", f"""
SELECT is_return, count(*) AS n, round(sum(total_cost), 2) AS cost, CAST(sum(CAST(round(profit_amount * 10000) AS BIGINT)) AS DOUBLE) / 10000 AS profit,
  CAST(sum(CAST(round(margin_percent * 1000000) AS BIGINT)) AS DOUBLE) / 1000000 / count(*) AS mean_margin, sum(CASE WHEN margin_percent = 0 THEN 1 ELSE 0 END) AS zero_margin FROM ({FACT_SQL}) AS f GROUP BY is_return""")
def n11(spark, d):
    lines = stage(_silver_lines(retail_orders(spark, d)), "silver")
    return _fact(lines, *_dims(spark, d, lines)).groupBy("is_return").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("total_cost"), 2).alias("cost"),
        (F.sum(F.round(F.col("profit_amount") * 10000).cast("bigint")) / 10000.0).alias("profit"),
        (F.sum(F.round(F.col("margin_percent") * 1000000).cast("bigint")) / 1000000.0 / F.count(F.lit(1))).alias("mean_margin"), F.count_if(F.col("margin_percent") == 0).alias("zero_margin"))


# ---- N03: header and detail star ------------------------------------------------------


def _headers(spark, d):
    return table(spark, d, "orders").selectExpr("o_orderkey AS SalesOrderID", "o_custkey AS CustomerID",
                                                "CASE WHEN o_orderkey % 97 = 0 THEN -o_totalprice ELSE o_totalprice END AS TotalDue",
                                                "o_orderdate AS OrderDate", "o_orderstatus AS Status")


@case("n03_sales_fact", """
SELECT l_orderkey AS "SalesOrderID", l_linenumber AS "SalesOrderDetailID", CAST(o_orderdate AS VARCHAR) AS "OrderDate", o_custkey AS "CustomerID", l_partkey AS "ProductID",
  l_quantity AS "OrderQty", l_extendedprice / l_quantity AS "UnitPrice", l_discount AS "UnitPriceDiscount", l_extendedprice AS "LineTotal", o_orderstatus AS "Status" FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderkey % 97 <> 0 AND o_totalprice > 0""")
def n03_fact(spark, d):
    details = table(spark, d, "lineitem").selectExpr("l_orderkey AS SalesOrderID", "l_linenumber AS SalesOrderDetailID", "l_partkey AS ProductID",
                                                     "l_quantity AS OrderQty", "l_extendedprice / l_quantity AS UnitPrice",
                                                     "l_discount AS UnitPriceDiscount", "l_extendedprice AS LineTotal")
    return plain(sales.sales_lines(details, sales.clean_headers(_headers(spark, d))))


@case("n03_product_dimension", """
SELECT p_partkey AS "ProductID", p_name AS "ProductName", 'P-' || CAST(p_partkey AS VARCHAR) AS "ProductNumber", p_brand AS "Color", p_retailprice * CAST(0.6 AS DOUBLE) AS "StandardCost", p_retailprice AS "ListPrice", CASE WHEN p_size % 10 <> 0 THEN 'Category ' || CAST(p_size % 10 AS VARCHAR) END AS "CategoryName" FROM part""")
def n03_product(spark, d):
    """N10: left join to the category; a missing category keeps the product."""
    parts = table(spark, d, "part")
    products = parts.selectExpr("p_partkey AS ProductID", "p_name AS ProductName", "concat('P-', p_partkey) AS ProductNumber", "p_brand AS Color",
                                "p_retailprice * 0.6D AS StandardCost", "p_retailprice AS ListPrice", "p_size % 10 AS ProductCategoryID")
    categories = (parts.selectExpr("p_size % 10 AS ProductCategoryID").distinct().filter("ProductCategoryID <> 0")
                  .selectExpr("ProductCategoryID", "'Category ' || CAST(ProductCategoryID AS STRING) AS Name"))
    return sales.product_with_category(products, categories).drop("ProductCategoryID")


SALES_CUSTOMERS_SQL = f"""
WITH e AS (SELECT c_custkey AS "CustomerID", c_name AS "CompanyName", c_mktsegment AS "SalesPerson", seq FROM ({CHANGES_SQL}) AS ev),
c AS (SELECT *, lag(row("CompanyName", "SalesPerson")) OVER (PARTITION BY "CustomerID" ORDER BY seq) AS before FROM e),
k AS (SELECT * EXCLUDE (before) FROM c WHERE before IS DISTINCT FROM row("CompanyName", "SalesPerson"))
SELECT *, seq AS __START_AT, lead(seq) OVER (PARTITION BY "CustomerID" ORDER BY seq) AS __END_AT FROM k"""


def _sales_customers(spark, d):
    return cdc.scd2(change_batches(table(spark, d, "customer"), STEPS).select(
        F.col("c_custkey").alias("CustomerID"), F.col("c_name").alias("CompanyName"), F.col("c_mktsegment").alias("SalesPerson"), "seq"), ["CustomerID"], ["seq"])


@case("n03_customer_history", SALES_CUSTOMERS_SQL)
def n03_history(spark, d):
    """Type 2 customers of the sales star."""
    return _sales_customers(spark, d)


@case("n03_dim_customer", f"""SELECT "CustomerID", "CompanyName", "SalesPerson" FROM ({SALES_CUSTOMERS_SQL}) AS h WHERE __END_AT IS NULL""")
def n03_dim_customer(spark, d):
    """The dimension that reports read: current versions only."""
    return cdc.current_rows(_sales_customers(spark, d)).drop("seq")


@case("n03_products_type1", """
SELECT p_partkey AS "ProductID", CASE WHEN p_partkey % 5 = 0 THEN 'New ' || p_name ELSE p_name END AS "Name", CASE WHEN p_partkey % 5 = 0 THEN 2 ELSE 1 END AS seq FROM part""")
def n03_products(spark, d):
    """Type 1 products: the newest row of each, without history."""
    first = table(spark, d, "part").select(F.col("p_partkey").alias("ProductID"), F.col("p_name").alias("Name"), F.lit(1).alias("seq"))
    again = first.filter("ProductID % 5 = 0").select("ProductID", F.concat(F.lit("New "), "Name").alias("Name"), F.lit(2).alias("seq"))
    return cdc.scd1(again.unionByName(first), ["ProductID"], ["seq"])


@case("n10_category_enrichment", """
WITH c AS (SELECT DISTINCT p_type || '/' || p_brand AS id, p_type AS parent, p_brand AS child FROM part)
SELECT p_partkey, p_name, child AS category, parent AS parent_category FROM part LEFT JOIN c ON c.id = CASE WHEN p_size % 10 = 0 THEN NULL ELSE p_type || '/' || p_brand END""")
def n10(spark, d):
    parts = table(spark, d, "part")
    leaf = F.concat_ws("/", "p_type", "p_brand")
    categories = parts.select(leaf.alias("category_id"), F.col("p_brand").alias("Name"), "p_type").distinct()
    parents = categories.select("category_id", F.col("p_type").alias("parent_category"))
    products = parts.select("p_partkey", "p_name", F.when(F.col("p_size") % 10 != 0, leaf).alias("category_id"))
    named = sales.product_with_category(products, categories, "category_id")
    return named.join(parents, "category_id", "left").select("p_partkey", "p_name", F.col("CategoryName").alias("category"), "parent_category")


# ---- N04: order stream ------------------------------------------------------------------


@case("n04_customer_order_summary", f"""
WITH o AS (SELECT * FROM ({DIRTY_SQL}) AS x WHERE o_custkey IS NOT NULL AND o_totalprice >= 0 AND o_orderdate IS NOT NULL),
c AS (SELECT * FROM ({CHANGES_SQL}) AS e QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY seq DESC) = 1)
SELECT o_custkey, c_name, c_mktsegment, count(o_orderkey) AS total_orders, round(sum(o_totalprice), 2) AS total_revenue, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / 100 / count(o_totalprice) AS avg_order_value, CAST(max(o_orderdate) AS VARCHAR) AS last_order_date
FROM o LEFT JOIN c ON o_custkey = c_custkey GROUP BY o_custkey, c_name, c_mktsegment""")
def n04_summary(spark, d):
    orders = order_flow.silver_orders(dirty_orders(table(spark, d, "orders")))
    customers = cdc.scd1(change_batches(table(spark, d, "customer"), STEPS), ["c_custkey"], ["seq"], ignore_nulls="keep_old")
    return plain(order_flow.customer_summary(orders, customers))


@case("n04_daily_orders", f"""
SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_date, o_orderstatus, count(o_orderkey) AS order_count, round(sum(o_totalprice), 2) AS total_revenue,
  CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / 100 / count(o_totalprice) AS avg_order_value FROM ({DIRTY_SQL}) AS x WHERE o_custkey IS NOT NULL AND o_totalprice >= 0 AND o_orderdate IS NOT NULL GROUP BY CAST(o_orderdate AS DATE), o_orderstatus""")
def n04_daily(spark, d):
    """Live stream plus one backfill, by name, of the range the live flow leaves out; both run
    twice and the second run adds nothing."""
    ends = "1997-01-01"
    root = scratch_path(spark, "daily")
    order_flow.silver_orders(dirty_orders(table(spark, d, "orders"))).write.parquet(f"{root}/silver")
    silver = spark.read.parquet(f"{root}/silver")
    for _ in range(2):
        live = order_flow.live_rows(flows.file_stream(spark, f"{root}/silver", "parquet", silver.schema), ends)
        flows.drain(flows.append_flow(live, f"{root}/live", f"{root}/checkpoints/live"))
        incremental.once(spark, f"{root}/history", "orders_backfill", order_flow.history_rows(silver, ends))
    backfill = incremental.read_loaded(spark, f"{root}/history").select(*silver.columns)
    return plain(order_flow.daily_totals(spark.read.schema(silver.schema).parquet(f"{root}/live").unionByName(backfill)))


# ---- refresh and bronze ingest ------------------------------------------------------------


@case("n12_materialised_refresh", """
SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_date, o_orderstatus, count(o_orderkey) AS order_count, round(sum(o_totalprice), 2) AS total_revenue,
  CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / 100 / count(o_totalprice) AS avg_order_value FROM orders GROUP BY CAST(o_orderdate AS DATE), o_orderstatus""")
def n12(spark, d):
    """Two refreshes over the same input leave the same table."""
    path = scratch_path(spark, "materialised")
    for _ in range(2):
        order_flow.daily_totals(table(spark, d, "orders")).write.mode("overwrite").parquet(path)
    return plain(spark.read.parquet(path))


DAILY_CHANGES = """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date, o_orderstatus, CAST(round(o_totalprice * 100) AS BIGINT) + CASE WHEN o_orderkey % 10 = 2 AND o_orderstatus = 'F' THEN 100 ELSE 0 END AS cents
FROM orders WHERE NOT (o_orderkey % 10 = 3 AND o_orderdate < TIMESTAMP '1994-01-01 00:00:00')"""


@case("n12_incremental_refresh", f"""
SELECT CAST(order_date AS VARCHAR) AS order_date, o_orderstatus, count(*) AS order_count, CAST(sum(cents) AS DOUBLE) / 100 AS total_revenue, CAST(min(cents) AS DOUBLE) / 100 AS smallest, CAST(max(cents) AS DOUBLE) / 100 AS largest
FROM ({DAILY_CHANGES}) AS x GROUP BY 1, 2""")
def n12_incremental(spark, d):
    """Daily totals after inserts, updates and deletes of their base, from the changes alone; sent twice."""
    orders = table(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("order_date"), "o_orderstatus",
                                              F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"))
    keys = ["order_date", "o_orderstatus"]
    view = materialised.View(scratch_path(spark, "daily"), keys, {"revenue": "cents"}, {"smallest": ("min", "cents"), "largest": ("max", "cents")}, 32)
    early, dear = "o_orderkey % 10 = 3 AND order_date < DATE'1994-01-01'", "o_orderkey % 10 = 2 AND o_orderstatus = 'F'"
    after = orders.filter(f"NOT ({early})").withColumn("cents", F.col("cents") + F.when(F.expr(dear), 100).otherwise(0))
    base = scratch_path(spark, "base")
    changes_mod.write_buckets(after, base, keys, view.buckets)
    materialised.create(view, orders.filter("o_orderkey % 10 <> 1"))
    tagged = lambda df, kind: df.withColumn("_change_type", F.lit(kind))
    changes = [tagged(orders.filter("o_orderkey % 10 = 1"), "insert"), tagged(orders.filter(dear), "update_preimage"),
               tagged(after.filter(dear), "update_postimage"), tagged(orders.filter(early), "delete")]
    changed = stage(reduce(DataFrame.unionByName, changes), "changes")
    materialised.refresh(view, changed, 1, spark.read.parquet(base))
    assert materialised.refresh(view, changed, 1, spark.read.parquet(base)) == {"buckets": 0, "reread": 0}
    rows = materialised.read(spark, view)
    return plain(rows.select(*keys, F.col("_rows").alias("order_count"), (F.col("revenue") / 100).alias("total_revenue"),
                             (F.col("smallest") / 100).alias("smallest"), (F.col("largest") / 100).alias("largest")))


@case("n13_bronze_ingest", """
SELECT 'customer' AS table_name, count(*) AS row_count, count(*) AS with_source FROM customer
UNION ALL SELECT 'events', count(*), count(*) FROM events UNION ALL SELECT 'part', count(*), count(*) FROM part""")
def n13(spark, d):
    """CSV, JSON and Parquet into bronze, loaded twice."""
    root, target = scratch_path(spark, "inbox"), scratch_path(spark, "bronze")
    table(spark, d, "customer").write.option("header", True).csv(f"{root}/customer")
    table(spark, d, "events").write.json(f"{root}/events")
    sources = {"customer": ("csv", f"{root}/customer"), "events": ("json", f"{root}/events"), "part": ("parquet", f"{d}/part.parquet")}
    writers.ingest_to_bronze(spark, sources, target)
    loaded = writers.ingest_to_bronze(spark, sources, target)
    counts = [df.agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("row_count"), F.count("_source_file").alias("with_source"))
              for n, df in loaded.items()]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])
