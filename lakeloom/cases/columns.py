"""Projections, filters, cleaning, scalar and array functions, user functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.cases.inputs import RETAIL_SQL, TODAY, retail_orders
from lakeloom.cases.registry import case, plain
from lakeloom.functions import arrays, udfs
from lakeloom.functions import scalars as fx
from lakeloom.operators import hierarchy
from lakeloom.plans import retail
from lakeloom.plans.sales import category_paths
from lakeloom.session import scratch_path, stage, table

# ---- projections, filters, cleaning ------------------------------------------


@case("b01_projection", "SELECT o_orderkey AS order_id, o_totalprice * 2 AS doubled FROM orders")
def b01(spark, d):
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("order_id"), (F.col("o_totalprice") * 2).alias("doubled"))


@case("b02_add_rename_drop", """
SELECT o_orderkey, o_custkey AS customer_id, o_orderstatus, o_totalprice, 'PLN' AS currency FROM orders""")
def b02(spark, d):
    return (table(spark, d, "orders").withColumn("currency", F.lit("PLN"))
            .withColumnRenamed("o_custkey", "customer_id").drop("o_orderdate", "o_orderpriority"))


@case("b03_projection_except", "SELECT * EXCLUDE (o_orderdate, o_orderpriority) FROM orders")
def b03(spark, d):
    return spark.sql("SELECT * EXCEPT (o_orderdate, o_orderpriority) FROM {orders}", orders=table(spark, d, "orders"))


@case("b04_cast", """
SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_date, CAST(o_totalprice AS DECIMAL(12,2))::DOUBLE AS price,
       CAST(o_custkey AS VARCHAR) AS customer, CAST(o_custkey AS DOUBLE) AS as_double,
       TRY_CAST(substr(o_orderpriority, 1, 1) AS INT) AS level, TRY_CAST(o_orderpriority AS INT) AS not_a_number FROM orders""")
def b04(spark, d):
    return plain(table(spark, d, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("price"), F.col("o_custkey").cast("string").alias("customer"),
        F.col("o_custkey").cast("double").alias("as_double"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("level"),
        F.col("o_orderpriority").try_cast("int").alias("not_a_number")))


@case("b05_filter_forms", """
SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE (o_orderstatus = 'F' AND o_totalprice > 100000)
  OR o_orderpriority LIKE '1-%' OR o_custkey IN (1, 2, 3) OR o_custkey IS NULL OR o_totalprice BETWEEN 5000 AND 6000""")
def b05(spark, d):
    c = F.col
    return table(spark, d, "orders").filter(
        ((c("o_orderstatus") == "F") & (c("o_totalprice") > 100000)) | c("o_orderpriority").like("1-%")
        | c("o_custkey").isin(1, 2, 3) | c("o_custkey").isNull() | F.expr("o_totalprice BETWEEN 5000 AND 6000")
    ).select("o_orderkey", "o_custkey", "o_orderstatus")


@case("b06_searched_case", """
SELECT o_orderkey, CASE WHEN o_totalprice >= 300000 THEN 'Large' WHEN o_totalprice >= 100000 THEN 'Medium' ELSE 'Small' END AS order_size,
  CASE WHEN month(o_orderdate) IN (12, 1, 2) THEN 'Winter' WHEN month(o_orderdate) IN (3, 4, 5) THEN 'Spring'
       WHEN month(o_orderdate) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS season FROM orders""")
def b06(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey", fx.order_size(F.col("o_totalprice"), 300000, 100000).alias("order_size"),
        fx.season(F.col("o_orderdate")).alias("season"))


@case("b07_simple_case", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'P' THEN 0 ELSE -1 END AS status_code FROM orders""")
def b07(spark, d):
    return spark.sql("SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'P' THEN 0 ELSE -1 END AS status_code FROM {o}",
                     o=table(spark, d, "orders"))


@case("b08_null_functions", """
SELECT o_orderkey, NULLIF(o_orderstatus, 'P') AS status_or_null, COALESCE(NULLIF(o_orderstatus, 'P'), 'N/A') AS status_clean,
  COALESCE(CASE WHEN o_orderkey % 97 <> 0 THEN o_totalprice END, 0) AS price_nvl,
  COALESCE(CASE WHEN o_orderkey % 89 <> 0 THEN o_custkey END, -1) AS customer_ifnull FROM orders""")
def b08(spark, d):
    return spark.sql("""SELECT o_orderkey, NULLIF(o_orderstatus, 'P') AS status_or_null,
        COALESCE(NULLIF(o_orderstatus, 'P'), 'N/A') AS status_clean,
        NVL(CASE WHEN o_orderkey % 97 <> 0 THEN o_totalprice END, 0) AS price_nvl,
        IFNULL(CASE WHEN o_orderkey % 89 <> 0 THEN o_custkey END, -1) AS customer_ifnull FROM {o}""", o=table(spark, d, "orders"))


@case("b09_null_rows_and_fills", f"""
SELECT order_id, customer_id, COALESCE(unit_price, 0) AS unit_price, COALESCE(payment_method, 'Unknown') AS payment_method
FROM ({RETAIL_SQL}) AS r WHERE order_id IS NOT NULL AND customer_id IS NOT NULL""")
def b09(spark, d):
    return (retail_orders(spark, d).na.drop(subset=["order_id", "customer_id"])
            .na.fill({"unit_price": 0.0, "payment_method": "Unknown"})
            .select("order_id", "customer_id", "unit_price", "payment_method"))


@case("b10_flag_columns", f"""
SELECT order_id, product_id, quantity, CASE WHEN quantity < 0 OR total_amount < 0 THEN 1 ELSE 0 END AS is_return,
  CASE WHEN CAST(order_datetime AS DATE) > DATE '{TODAY}' THEN 1 ELSE 0 END AS is_future_dated,
  CASE WHEN customer_id IS NULL OR customer_id = 999999 THEN 1 ELSE 0 END AS is_unknown_customer,
  CASE WHEN product_id IS NULL OR product_id = 999999 THEN 1 ELSE 0 END AS is_unknown_product FROM ({RETAIL_SQL}) AS r""")
def b10(spark, d):
    flags = retail.order_flags(F.lit(TODAY).cast("date"), 999999, 999999)
    return retail_orders(spark, d).withColumns(flags).select("order_id", "product_id", "quantity", *flags)


@case("b11_money_measures", f"""
SELECT order_id, product_id, CAST(round(g, 2) AS DOUBLE) AS total_amount, CAST(round(g * p * 0.01, 2) AS DOUBLE) AS discount_amount,
  CAST(round(g, 2) - round(g * p * 0.01, 2) AS DOUBLE) AS net_amount, CAST(g - g * p * 0.01 AS DOUBLE) AS exact_net
FROM (SELECT *, CAST(unit_price AS DECIMAL(14,2)) * CAST(quantity AS DECIMAL(8,0)) AS g,
        CAST(discount_percent AS DECIMAL(5,2)) AS p FROM ({RETAIL_SQL}) AS r) AS x""")
def b11(spark, d):
    args = ("quantity", "unit_price", "discount_percent")
    money = fx.rounded_money(*args)
    return plain(retail_orders(spark, d).select(
        "order_id", "product_id", *[c.alias(n) for n, c in money.items()], fx.net_amount(*args).alias("exact_net")))


@case("b12_key_standardisation", """
SELECT c_custkey, lower(trim('  ' || upper(c_name) || '@Mail.COM ')) AS email, upper(c_mktsegment) AS segment FROM customer""")
def b12(spark, d):
    raw = table(spark, d, "customer").withColumn("email", F.expr("'  ' || upper(c_name) || '@Mail.COM '"))
    return raw.select("c_custkey", fx.clean_email("email").alias("email"), F.upper("c_mktsegment").alias("segment"))


@case("b13_split_part", """
SELECT c_custkey, split_part(c_name, '#', 2) AS number, CASE WHEN contains(c_mktsegment, 'X') THEN split_part(c_mktsegment, 'X', 2) END AS missing
FROM customer""")
def b13(spark, d):
    return table(spark, d, "customer").select(
        "c_custkey", fx.part("c_name", "#", 1).alias("number"), fx.part("c_mktsegment", "X", 1).alias("missing"))


@case("b14_region_from_code", """
SELECT s_suppkey, s_name, CASE WHEN n <= 10 THEN 'East' WHEN n <= 20 THEN 'West' ELSE 'Central' END AS store_region
FROM (SELECT *, TRY_CAST(regexp_extract(CASE WHEN s_suppkey % 13 = 0 THEN 'none' ELSE s_name END, '([0-9]+)', 1) AS INT) AS n FROM supplier) AS x""")
def b14(spark, d):
    coded = table(spark, d, "supplier").withColumn("code", F.expr("CASE WHEN s_suppkey % 13 = 0 THEN 'none' ELSE s_name END"))
    return coded.select("s_suppkey", "s_name", fx.store_region("code").alias("store_region"))


# ---- scalar functions ---------------------------------------------------------


@case("h01_string_functions", """
SELECT c_custkey, upper(c_name) AS up, lower(c_name) AS low, trim('  ' || c_name || ' ') AS trimmed, 'C' || CAST(c_custkey AS VARCHAR) AS code,
  concat_ws('-', c_mktsegment, NULL, c_name) AS joined, lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS padded, substr(c_name, 3, 4) AS middle,
  split_part(c_name, '#', -1) AS after_hash, left(c_name, 2) AS first_two, c_name LIKE 'Customer#%5' AS ends_in_five,
  regexp_extract(c_name, '([0-9]+)', 1) AS digits FROM customer""")
def h01(spark, d):
    n = F.col("c_name")
    return table(spark, d, "customer").select(
        "c_custkey", F.upper(n).alias("up"), F.lower(n).alias("low"), F.trim(F.concat(F.lit("  "), n, F.lit(" "))).alias("trimmed"),
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("code"),
        F.concat_ws("-", "c_mktsegment", F.lit(None).cast("string"), n).alias("joined"),
        F.lpad(F.col("c_custkey").cast("string"), 8, "0").alias("padded"), F.substring(n, 3, 4).alias("middle"),
        F.substring_index(n, "#", -1).alias("after_hash"), F.left(n, F.lit(2)).alias("first_two"),
        n.like("Customer#%5").alias("ends_in_five"), F.regexp_extract(n, r"(\d+)", 1).alias("digits"))


@case("h02_date_parts", """
SELECT o_orderkey, year(o_orderdate) AS y, quarter(o_orderdate) AS q, month(o_orderdate) AS m, day(o_orderdate) AS d,
  dayofweek(o_orderdate) + 1 AS dow, weekofyear(o_orderdate) AS week FROM orders""")
def h02(spark, d):
    t = F.col("o_orderdate")
    return table(spark, d, "orders").select(
        "o_orderkey", F.year(t).alias("y"), F.quarter(t).alias("q"), F.month(t).alias("m"), F.dayofmonth(t).alias("d"),
        F.dayofweek(t).alias("dow"), F.weekofyear(t).alias("week"))


@case("h03_date_format", """
SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS compact, strftime(o_orderdate, '%a') AS short_day,
  strftime(o_orderdate, '%A') AS long_day, strftime(o_orderdate, '%B') AS month_name, strftime(o_orderdate, '%Y-%m') AS month FROM orders""")
def h03(spark, d):
    t = F.col("o_orderdate")
    return table(spark, d, "orders").select(
        "o_orderkey", F.date_format(t, "yyyyMMdd").alias("compact"), F.date_format(t, "E").alias("short_day"),
        F.date_format(t, "EEEE").alias("long_day"), F.date_format(t, "MMMM").alias("month_name"), F.date_format(t, "yyyy-MM").alias("month"))


@case("h04_date_arithmetic", """
SELECT o_orderkey, date_diff('day', dd, DATE '2002-01-01') AS age, CAST(dd + 30 AS VARCHAR) AS due,
  CAST(CAST(date_trunc('month', dd) AS DATE) AS VARCHAR) AS month_start, CAST(CAST(dd - INTERVAL 14 DAY AS DATE) AS VARCHAR) AS two_weeks_before,
  CAST(CAST(dd + INTERVAL 2 MONTH AS DATE) AS VARCHAR) AS two_months_on, CAST(last_day(dd) AS VARCHAR) AS month_end
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS dd FROM orders) AS x""")
def h04(spark, d):
    t = F.to_date("o_orderdate")
    return plain(table(spark, d, "orders").select(
        "o_orderkey", F.datediff(F.lit("2002-01-01").cast("date"), t).alias("age"), F.date_add(t, 30).alias("due"),
        F.trunc(t, "month").alias("month_start"), (t - F.expr("INTERVAL 14 DAYS")).cast("date").alias("two_weeks_before"),
        F.add_months(t, 2).alias("two_months_on"), F.last_day(t).alias("month_end")))


@case("h05_parse_and_epoch", """
SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS parsed_date, CAST(date_trunc('second', ts) AS VARCHAR) AS parsed_ts,
  CAST(floor(epoch(ts)) AS BIGINT) AS seconds, CAST(date_trunc('second', ts) AS VARCHAR) AS from_epoch, NULL AS bad
FROM events""")
def h05(spark, d):
    text = F.date_format("ts", "dd/MM/yyyy HH:mm:ss")
    parsed = F.to_timestamp("text", "dd/MM/yyyy HH:mm:ss")
    return plain(table(spark, d, "events").withColumn("text", text).select(
        "event_id", F.to_date("text", "dd/MM/yyyy HH:mm:ss").alias("parsed_date"), parsed.alias("parsed_ts"),
        F.unix_timestamp("text", "dd/MM/yyyy HH:mm:ss").alias("seconds"),
        F.from_unixtime(parsed.cast("long")).alias("from_epoch"),
        F.try_to_timestamp(F.concat(F.lit("x"), "text"), F.lit("dd/MM/yyyy HH:mm:ss")).alias("bad")))


@case("h06_time_zones", """
SELECT event_id, CAST(ts - to_hours(CAST(user_id % 3 AS INT)) AS VARCHAR) AS utc, CAST(ts + to_hours(2) AS VARCHAR) AS shown FROM events""")
def h06(spark, d):
    """Wall-clock time with the zone in a column to UTC, and UTC to a display zone."""
    zone = F.concat(F.lit("+0"), (F.col("user_id") % 3).cast("string"), F.lit(":00"))
    wall = F.col("ts").cast("timestamp")
    return plain(table(spark, d, "events").select(
        "event_id", fx.local_to_utc(wall, zone).alias("utc"), F.from_utc_timestamp(wall, "+02:00").alias("shown")))


WALL = "o_orderdate + to_hours(CAST(o_orderkey % 24 AS INT))"
LAST_SUNDAY = "(last_day(make_date(year({0}), {1}, 1)) - CAST(dayofweek(last_day(make_date(year({0}), {1}, 1))) AS INT))"
SUNDAY_ON = "(make_date(year({0}), {1}, {2}) + CAST((7 - dayofweek(make_date(year({0}), {1}, {2}))) % 7 AS INT))"
# fixed values: the days on which Berlin's and New York's clocks change
BERLIN_SUMMER = (f"wall >= {LAST_SUNDAY.format('wall', 3)} + INTERVAL 3 HOUR AND wall < "
                 f"CASE WHEN year(wall) < 1996 THEN {LAST_SUNDAY.format('wall', 9)} ELSE {LAST_SUNDAY.format('wall', 10)} END + INTERVAL 3 HOUR")
NEW_YORK_SUMMER = (f"CASE WHEN year(wall) < 2007 THEN wall >= {SUNDAY_ON.format('wall', 4, 1)} + INTERVAL 7 HOUR AND wall < {LAST_SUNDAY.format('wall', 10)} + INTERVAL 6 HOUR "
                   f"ELSE wall >= {SUNDAY_ON.format('wall', 3, 8)} + INTERVAL 7 HOUR AND wall < {SUNDAY_ON.format('wall', 11, 1)} + INTERVAL 6 HOUR END")


@case("h06_zones_all_orders", f"""
SELECT o_orderkey, CAST(wall - to_hours(CASE WHEN {BERLIN_SUMMER} THEN 2 ELSE 1 END) AS VARCHAR) AS utc,
  CAST(wall - to_hours(CASE WHEN {NEW_YORK_SUMMER} THEN 4 ELSE 5 END) AS VARCHAR) AS shown, CAST(wall AS VARCHAR) AS wall
FROM (SELECT o_orderkey, {WALL} AS wall FROM orders) AS x""")
def h06_zones(spark, d):
    """Named zones with summer time over all orders: wall-clock to UTC, UTC to a zone, and a time without
    zone, which no zone moves.  A missing hour reads with the offset before the change, a doubled one
    as its first."""
    wall = F.timestamp_add("HOUR", (F.col("o_orderkey") % 24).cast("int"), F.col("o_orderdate"))
    return plain(table(spark, d, "orders").select(
        "o_orderkey", fx.local_to_utc(wall.cast("timestamp"), F.lit("Europe/Berlin")).alias("utc"),
        F.from_utc_timestamp(wall.cast("timestamp"), "America/New_York").alias("shown"), wall.alias("wall")))


@case("h07_math", """
SELECT l_orderkey, l_linenumber, CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)), 1) AS DOUBLE) AS rounded, l_orderkey % 7 AS remainder,
  CASE WHEN l_discount <> 0 THEN round(l_tax / l_discount, 6) END AS guarded FROM lineitem""")
def h07(spark, d):
    return plain(table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.round(F.col("l_extendedprice").cast("decimal(18,2)"), 1).alias("rounded"),
        (F.col("l_orderkey") % 7).alias("remainder"), fx.ratio(F.col("l_tax"), F.col("l_discount"), 6).alias("guarded")))


@case("h08_current_values", "SELECT count(*) AS row_count, true AS now_after_data, true AS named FROM orders")
def h08(spark, d):
    return table(spark, d, "orders").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.bool_and((F.current_date() > F.to_date("o_orderdate")) & (F.current_timestamp() > F.col("o_orderdate").cast("timestamp"))).alias("now_after_data"),
        F.bool_and(F.current_user().isNotNull() & F.current_catalog().isNotNull() & F.current_schema().isNotNull()).alias("named"))


@case("h09_array_build_and_access", """
SELECT o_orderkey, CASE CAST(o_custkey % 3 AS INT) WHEN 0 THEN 'PL' WHEN 1 THEN 'DE' ELSE 'US' END AS country,
  date_diff('month', date_trunc('month', o_orderdate), TIMESTAMP '2001-12-01 00:00:00') + 1 AS months_left FROM orders""")
def h09(spark, d):
    countries = F.array(F.lit("PL"), F.lit("DE"), F.lit("US"))
    months = F.sequence(F.trunc("o_orderdate", "month"), F.lit("2001-12-01").cast("date"), F.expr("INTERVAL 1 MONTH"))
    return table(spark, d, "orders").select(
        "o_orderkey", F.element_at(countries, (F.col("o_custkey") % 3 + 1).cast("int")).alias("country"),
        F.size(months).alias("months_left"))


@case("h10_explode", """
SELECT vec_id, CAST(g.i AS INT) - 1 AS pos, embedding[CAST(g.i AS INT)] AS value, 'array' AS kind
FROM embeddings, generate_series(1, 64) AS g(i)
UNION ALL SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT), NULL, 'map' FROM events""")
def h10(spark, d):
    """posexplode over an array, explode over a map, both in one table."""
    vectors = table(spark, d, "embeddings").select("vec_id", F.posexplode("embedding").alias("pos", "value"), F.lit("array").alias("kind"))
    props = F.from_json("props", "map<string,int>")
    pairs = table(spark, d, "events").select(F.col("event_id").alias("vec_id"), F.explode(props).alias("key", "pos"))
    return vectors.unionByName(pairs.select(
        "vec_id", "pos", F.lit(None).cast("float").alias("value"), F.lit("map").alias("kind")))


@case("h10_lateral_view", """
SELECT o_orderkey, CAST(g.i AS INT) - 1 AS pos, split_part(o_orderpriority, '-', CAST(g.i AS INT)) AS part FROM orders, generate_series(1, 2) AS g(i)""")
def h10_lateral(spark, d):
    return spark.sql("SELECT o_orderkey, pos, part FROM {orders} LATERAL VIEW posexplode(split(o_orderpriority, '-', 2)) v AS pos, part",
                     orders=table(spark, d, "orders").withColumn("o_orderpriority", F.concat_ws("-", F.slice(F.split("o_orderpriority", "-"), 1, 2))))


@case("h11_array_higher_order", """
SELECT vec_id, len(list_filter(embedding, lambda x: x > 0.1)) AS above, len(list_filter(embedding, lambda x: x > 0.3)) > 0 AS any_above,
  len(list_filter(embedding, lambda x: x > -0.3)) = len(embedding) AS all_above,
  round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * 0.5)), 6) AS half_sum FROM embeddings""")
def h11(spark, d):
    e = F.col("embedding")
    half = F.transform(e, lambda x: x.cast("double") * 0.5)
    return table(spark, d, "embeddings").select(
        "vec_id", F.size(arrays.above(e, 0.1)).alias("above"), arrays.any_above(e, 0.3).alias("any_above"),
        arrays.all_above(e, -0.3).alias("all_above"), F.round(arrays.total(half), 6).alias("half_sum"))


@case("h12_json", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS parsed, json_extract_string(props, '$.k') AS by_path,
  '{"id":' || CAST(event_id AS VARCHAR) || ',"type":"' || event_type || '"}' AS rendered FROM events""")
def h12(spark, d):
    return table(spark, d, "events").select(
        "event_id", F.from_json("props", "k int")["k"].alias("parsed"), F.get_json_object("props", "$.k").alias("by_path"),
        F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("type"))).alias("rendered"))


@case("h12_variant_and_schema", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS by_variant, CAST(json_extract_string(props, '$.k') AS BIGINT) AS by_schema, 'k' AS fields FROM events""")
def h12_variant(spark, d):
    """Path access into a variant, and a schema found from the data itself."""
    events = table(spark, d, "events")
    sample = events.select(F.max("props")).first()[0]
    found = events.sparkSession.range(1).select(F.schema_of_json(F.lit(sample))).first()[0]
    parsed = F.from_json("props", found)
    return events.select("event_id", F.variant_get(F.parse_json("props"), "$.k", "int").alias("by_variant"),
                         parsed["k"].alias("by_schema"), F.array_join(F.json_object_keys("props"), ",").alias("fields"))


@case("h01_uuid", "SELECT count(*) AS row_count, count(*) AS different, true AS shaped FROM orders")
def h01_uuid(spark, d):
    """A random identifier for each row."""
    named = stage(table(spark, d, "orders").select("o_orderkey", F.uuid().alias("id")), "uuid")
    return named.agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct("id").alias("different"),
                     F.bool_and(F.col("id").rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$")).alias("shaped"))


CTE_BODY = """
WITH busy AS (SELECT l_suppkey, count(DISTINCT l_partkey) AS parts FROM {lineitem} WHERE l_quantity >= 25 GROUP BY l_suppkey),
middle AS (SELECT min(parts) + (max(parts) - min(parts)) / 2 AS half FROM busy)
SELECT s_suppkey, s_name, parts FROM busy JOIN {supplier} ON l_suppkey = s_suppkey
WHERE parts >= (SELECT half FROM middle) AND s_nationkey IN (SELECT n_nationkey FROM {nation} WHERE n_regionkey < 4)
  AND NOT EXISTS (SELECT 1 FROM {customer} WHERE c_nationkey = s_nationkey AND c_acctbal < -999.9)"""


@case("h13_subqueries_and_cte", CTE_BODY.format(lineitem="lineitem", supplier="supplier", nation="nation", customer="customer"))
def h13(spark, d):
    return spark.sql(CTE_BODY, **{n: table(spark, d, n) for n in ("lineitem", "supplier", "nation", "customer")})


@case("h14_recursive_cte", """
WITH RECURSIVE categories AS (
  SELECT 'all' AS id, CAST(NULL AS VARCHAR) AS parent, 'all' AS name
  UNION ALL SELECT DISTINCT p_type, 'all', p_type FROM part
  UNION ALL SELECT DISTINCT p_type || '/' || p_brand, p_type, p_brand FROM part),
tree AS (SELECT id, name, 0 AS depth, name AS path FROM categories WHERE parent IS NULL
  UNION ALL SELECT c.id, c.name, t.depth + 1, t.path || ' > ' || c.name FROM categories c JOIN tree t ON c.parent = t.id)
SELECT t.depth, t.path, count(*) AS parts FROM tree t JOIN part ON t.id = p_type || '/' || p_brand GROUP BY t.depth, t.path""")
def h14(spark, d):
    """Category walk: types below the root, brands below their type; parts counted per leaf."""
    p = table(spark, d, "part")
    leaf = F.concat_ws("/", "p_type", "p_brand")
    categories = (spark.range(1).select(F.lit("all").alias("id"), F.lit(None).cast("string").alias("parent"), F.lit("all").alias("name"))
                  .union(p.select("p_type", F.lit("all"), F.col("p_type")).distinct())
                  .union(p.select(leaf, "p_type", "p_brand").distinct()))
    view = scratch_path(spark, "cat").rsplit("/", 1)[1].replace("-", "_")
    categories.createOrReplaceTempView(view)
    tree = category_paths(spark, view)
    return p.select(leaf.alias("id")).join(tree, "id").groupBy("depth", "path").agg(F.count(F.lit(1)).alias("parts"))


HEAP_SQL = """
WITH RECURSIVE n AS (SELECT c_custkey AS id, CASE WHEN c_custkey = 11 THEN 12 WHEN c_custkey = 12 THEN 11 WHEN c_custkey % 97 = 5 THEN NULL WHEN c_custkey > 1 THEN c_custkey // 2 END AS parent FROM customer),
r AS (SELECT n.id, p.id AS parent FROM n LEFT JOIN n AS p ON n.parent = p.id),
t AS (SELECT id, id AS root, CAST(0 AS BIGINT) AS depth, CAST(id AS VARCHAR) AS path FROM r WHERE parent IS NULL
  UNION ALL SELECT r.id, t.root, t.depth + 1, t.path || '/' || CAST(r.id AS VARCHAR) FROM r JOIN t ON r.parent = t.id)
SELECT id, root, depth, path, 'tree' AS state FROM t
UNION ALL SELECT id, NULL, NULL, NULL, CASE WHEN id IN (11, 12) THEN 'on a cycle' ELSE 'below a cycle' END FROM n WHERE id NOT IN (SELECT id FROM t)"""


@case("h14_closure_by_doubling", HEAP_SQL)
def h14_closure(spark, d):
    """All customers as a heap-shaped hierarchy with several roots, one cycle and what hangs below it."""
    parent = "CASE WHEN c_custkey = 11 THEN 12 WHEN c_custkey = 12 THEN 11 WHEN c_custkey % 97 = 5 THEN NULL WHEN c_custkey > 1 THEN c_custkey div 2 END AS parent"
    return hierarchy.closure(table(spark, d, "customer").selectExpr("c_custkey AS id", parent), "id", "/")


# ---- user functions -----------------------------------------------------------

CLASS_SQL = """
SELECT o_orderkey, CASE WHEN v IS NULL THEN 'Unknown' WHEN v > 300000 THEN 'High Value' WHEN v > 100000 THEN 'Medium Value'
  ELSE 'Low Value' END AS order_class FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 97 <> 0 THEN o_totalprice END AS v FROM orders) AS x"""


def _priced(spark, d):
    return table(spark, d, "orders").select("o_orderkey", F.expr("CASE WHEN o_orderkey % 97 <> 0 THEN o_totalprice END").alias("v"))


@case("i00_expression_classify", CLASS_SQL)
def i00(spark, d):
    return _priced(spark, d).select("o_orderkey", udfs.order_class(F.col("v"), 300000, 100000).alias("order_class"))


@case("i01_python_udf", CLASS_SQL)
def i01(spark, d):
    return _priced(spark, d).select("o_orderkey", udfs.order_class_udf(300000, 100000)("v").alias("order_class"))


@case("i02_pandas_udf", CLASS_SQL)
def i02(spark, d):
    return _priced(spark, d).select("o_orderkey", udfs.order_class_pandas(300000, 100000)("v").alias("order_class"))


@case("i03_sql_udf", CLASS_SQL)
def i03(spark, d):
    name = udfs.create_order_class_sql(spark, high=300000.0, medium=100000.0)
    return _priced(spark, d).selectExpr("o_orderkey", f"{name}(v) AS order_class")
