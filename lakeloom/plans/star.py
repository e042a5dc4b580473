"""Dimensions, key maps and the sales fact of the star schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.functions import scalars as fx
from lakeloom.operators.aggregates import distinct_codes
from lakeloom.operators.cdc import current_rows
from lakeloom.operators.joins import lookup
from lakeloom.operators.sets import with_constant_row
from lakeloom.operators.windows import surrogate_key
from lakeloom.session import stage

UNKNOWN_KEY = -1
# fixed values: payment codes per group
PAYMENT_GROUPS = {"Card": ("Credit Card", "Debit Card"), "Cash": ("Cash",), "Digital wallet": ("PayPal",)}

# fixed values: expectations of the sales fact
FACT_FAIL = {"valid_order_id": "order_id IS NOT NULL"}
FACT_WARN = {
    "valid_store_key": "store_key IS NOT NULL AND store_key >= -1",
    "valid_customer_key": "customer_key IS NOT NULL AND customer_key >= -1",
    "valid_product_key": "product_key IS NOT NULL AND product_key >= -1",
    "valid_payment_key": "payment_method_key IS NOT NULL AND payment_method_key >= -1",
    "valid_date_key": "order_date_key IS NOT NULL",
    "valid_amounts": "gross_amount >= 0 AND net_amount >= 0",
    "valid_quantity": "quantity IS NOT NULL AND quantity <> 0",
}


def date_columns(day: Column) -> list[Column]:
    return [
        fx.date_key(day).alias("date_key"), day.alias("date"), F.year(day).alias("year"),
        F.quarter(day).alias("quarter"), F.month(day).alias("month"), F.dayofmonth(day).alias("day"),
        F.date_format(day, "E").alias("day_of_week"), F.dayofweek(day).alias("day_of_week_num"),
        F.weekofyear(day).alias("week_of_year"), F.date_format(day, "MMMM").alias("month_name"),
        F.when(F.dayofweek(day).isin(1, 7), 1).otherwise(0).alias("is_weekend"), fx.season(day).alias("season")]


def date_dimension(spark: SparkSession, first: str = "2020-01-01", last: str = "2030-12-31") -> DataFrame:
    """One row per day of a closed range."""
    days = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"), F.make_dt_interval(days=F.lit(1)))
    return spark.range(1).select(F.explode(days).alias("d")).select(*date_columns(F.col("d")))


def date_dimension_covering(df: DataFrame, ts: str) -> DataFrame:
    """One row per day from the first to the last date in ``df``, gaps included."""
    span = df.agg(F.min(F.to_date(ts)).alias("a"), F.max(F.to_date(ts)).alias("b"))
    days = F.sequence("a", "b", F.make_dt_interval(days=F.lit(1)))
    return span.select(F.explode(days).alias("d")).select(*date_columns(F.col("d")))


def date_dimension_from(df: DataFrame, ts: str) -> DataFrame:
    """One row per date that occurs."""
    day = F.col("DateKey")
    return df.select(F.to_date(ts).alias("DateKey")).distinct().select(
        "DateKey", F.year(day).alias("Year"), F.month(day).alias("Month"), F.dayofmonth(day).alias("Day"),
        F.quarter(day).alias("Quarter"), F.dayofweek(day).alias("DayOfWeek"),
        F.date_format(day, "MMMM").alias("MonthName"), F.date_format(day, "EEEE").alias("DayName"))


def keyed_dimension(df: DataFrame, key: str, natural: str, unknown: dict[str, object]) -> DataFrame:
    """Surrogate keys in natural-key order plus exactly one unknown member with key -1."""
    # stored first: the size check and the numbering then read the members, not their plan
    members = stage(df.filter(~F.col(natural).eqNullSafe(F.lit(unknown[natural]))), "members")
    return with_constant_row(surrogate_key(members, key, [natural]), {key: UNKNOWN_KEY, **unknown})


def customer_dimension(history: DataFrame, natural: str, unknown: dict[str, object]) -> DataFrame:
    return keyed_dimension(current_rows(history), "customer_key", natural, unknown)


def typed_products(products: DataFrame) -> DataFrame:
    """Costs as doubles and the activity flag."""
    active = F.upper("status").isin("ACTIVE", "AVAILABLE")
    return products.withColumns({
        "unit_cost": F.col("unit_cost").cast("double"), "list_price": F.col("list_price").cast("double"),
        "is_active": fx.flag(active), "is_unknown": F.lit(0)})


def product_dimension(products: DataFrame, natural: str, unknown: dict[str, object]) -> DataFrame:
    return keyed_dimension(typed_products(products), "product_key", natural,
                           {"status": "Unknown", "is_active": 0, "is_unknown": 1, **unknown})


def payment_group(code: Column) -> Column:
    out = F.lit("Other")
    for group, codes in PAYMENT_GROUPS.items():
        out = F.when(code.isin(*codes), group).otherwise(out)
    return out


def payment_dimension(orders: DataFrame, column: str = "payment_method_code") -> DataFrame:
    codes = distinct_codes(orders, column, "Unknown")
    dim = keyed_dimension(codes, "payment_method_key", column, {column: "Unknown"})
    return dim.withColumn("payment_method_group", payment_group(F.col(column)))


def store_dimension(orders: DataFrame, column: str = "store_id") -> DataFrame:
    codes = distinct_codes(orders.select(F.col(column).cast("string").alias(column)), column, "UNKNOWN")
    return keyed_dimension(codes, "store_key", column, {column: "UNKNOWN"}).withColumn("store_code", F.col(column))


def extend_key_map(keys: DataFrame, naturals: DataFrame, key: str, natural: str) -> DataFrame:
    """Keeps the key of every known natural key and numbers the new ones after the largest,
    so refreshed dimensions do not renumber old facts."""
    new = stage(naturals.select(natural).where(F.col(natural).isNotNull()).distinct()
                .join(keys, natural, "left_anti"), "new-members")
    top = F.coalesce(keys.agg(F.max(key)).scalar(), F.lit(0))
    numbered = surrogate_key(new, key, [natural]).withColumn(key, F.col(key) + top)
    return keys.select(key, natural).unionByName(numbered.select(key, natural))


def profit_measures(net: Column, unit_cost: Column, quantity: Column) -> dict[str, Column]:
    """Cost, profit and margin percent (0 unless net is positive)."""
    cost = F.coalesce(unit_cost, F.lit(0.0)) * quantity
    net = net.cast("double")
    return {"total_cost": cost, "profit_amount": net - cost,
            "margin_percent": F.when(net > 0, (net - cost) / net * 100).otherwise(0.0)}


def sales_fact(orders: DataFrame, customers: DataFrame, products: DataFrame, stores: DataFrame,
               payments: DataFrame, dates: DataFrame) -> DataFrame:
    """Order lines with five dimension keys; a missing member becomes -1 and a date outside
    the calendar keeps its own key.  Dimensions are broadcast while they are small."""
    dims = [
        (customers.select("customer_id", "customer_key"), "customer_id"),
        (products.select("product_id", "product_key", "unit_cost"), "product_id"),
        (stores.select("store_id", "store_key"), "store_id"),
        (payments.select("payment_method_code", "payment_method_key"), "payment_method_code"),
        (dates.select(F.col("date_key").alias("order_date_key"), F.col("date_key").alias("_date_key")), "order_date_key"),
    ]
    out = orders
    for dim, on in dims:
        out = lookup(out, dim, on)
    unknown = {k: F.coalesce(F.col(k), F.lit(UNKNOWN_KEY).cast("bigint"))
               for k in ("customer_key", "product_key", "store_key", "payment_method_key")}
    return (out.withColumns({**unknown, "order_date_key": F.coalesce("_date_key", "order_date_key"),
                             **profit_measures(F.col("net_amount"), F.col("unit_cost"), F.col("quantity"))})
            .drop("_date_key", "unit_cost", "payment_method_code"))
