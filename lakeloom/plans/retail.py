"""Retail layers: bronze to gold in batch, and the cleansed order table of the star."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.functions import scalars as fx
from lakeloom.operators.joins import lookup
from lakeloom.operators.quality import expect_or_drop
from lakeloom.operators.windows import latest_per_key

# fixed values: expectations of the cleansed orders
ORDER_RULES = {
    "valid_order_id": "order_id IS NOT NULL",
    "valid_customer": "customer_id IS NOT NULL",
    "valid_product": "product_id IS NOT NULL",
    "valid_quantity": "quantity IS NOT NULL AND quantity <> 0",
    "valid_unit_price": "unit_price IS NOT NULL AND unit_price >= 0",
}
UNKNOWN_CUSTOMER, UNKNOWN_PRODUCT = "CUST999999", "PROD999999"


def order_flags(today: Column, unknown_customer=UNKNOWN_CUSTOMER, unknown_product=UNKNOWN_PRODUCT) -> dict[str, Column]:
    customer, product = F.col("customer_id"), F.col("product_id")
    return {
        "is_return": fx.flag((F.col("quantity") < 0) | (F.col("total_amount") < 0)),
        "is_future_dated": fx.flag(F.to_date("order_datetime") > today),
        "is_unknown_customer": fx.flag(customer.isNull() | (customer == F.lit(unknown_customer))),
        "is_unknown_product": fx.flag(product.isNull() | (product == F.lit(unknown_product))),
    }


def silver_order_lines(bronze: DataFrame, today: Column, **unknown) -> DataFrame:
    """Cleansed order lines with computed measures; negative quantities stay as returns."""
    day = F.to_date("order_datetime")
    kept = expect_or_drop(bronze, ORDER_RULES)
    return kept.select(
        "order_id", "customer_id", "product_id", "store_id",
        F.col("order_datetime").cast("timestamp_ntz").alias("order_ts"), day.alias("order_date"),
        fx.date_key(day).alias("order_date_key"), "quantity", "unit_price", "discount_percent",
        fx.gross_amount("quantity", "unit_price").alias("gross_amount"),
        fx.discount_amount("quantity", "unit_price", "discount_percent").alias("discount_amount"),
        fx.net_amount("quantity", "unit_price", "discount_percent").alias("net_amount"),
        F.coalesce("payment_method", F.lit("Unknown")).alias("payment_method_code"), "source_system",
        *[c.alias(n) for n, c in order_flags(today, **unknown).items()])


def silver_customers(bronze: DataFrame, key: str = "customer_id", by: tuple[str, ...] = ("_load_ts",)) -> DataFrame:
    """Latest row per customer, email standardised."""
    rows = latest_per_key(bronze.filter(F.col(key).isNotNull()), [key], list(by))
    return rows.withColumn("email", fx.clean_email("email"))


def silver_orders(bronze: DataFrame) -> DataFrame:
    """Orders with keys and a positive quantity, money rounded to cents."""
    kept = bronze.filter(F.col("order_id").isNotNull() & F.col("customer_id").isNotNull() & (F.col("quantity") > 0))
    return kept.withColumns(fx.rounded_money("quantity", "unit_price", "discount_percent"))


def gold_customer_summary(orders: DataFrame, customers: DataFrame, key: str = "customer_id",
                          attributes: tuple[str, ...] = ("first_name", "last_name", "customer_segment"),
                          order_id: str = "order_id", amount: str = "net_amount", ts: str = "order_datetime") -> DataFrame:
    """Order statistics per customer.  Orders are aggregated before the join, so only one
    row per customer is joined and a dominant customer costs nothing."""
    totals = orders.groupBy(key).agg(
        F.count(order_id).alias("total_orders"), fx.sum_of_cents(amount).alias("total_revenue"),
        fx.mean_of_cents(amount).alias("avg_order_value"), F.max(ts).alias("last_order_date"))
    return lookup(totals, customers.select(key, *attributes), key)


def gold_daily(orders: DataFrame, ts: str = "order_datetime") -> DataFrame:
    return (orders.groupBy(F.to_date(ts).alias("order_date"))
            .agg(F.count("order_id").alias("order_count"), fx.sum_of_cents("net_amount").alias("total_revenue"),
                 fx.rounded_mean_of_cents("net_amount").alias("avg_order_value")).orderBy("order_date"))


def run_layers(spark: SparkSession, customers: DataFrame, orders: DataFrame, root: str) -> dict[str, DataFrame]:
    """All six tables in order; every table is overwritten, so a rerun gives the same."""
    def save(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{root}/{name}")
        return spark.read.parquet(f"{root}/{name}")

    out = {}
    stamp = F.current_timestamp().alias("_load_ts")
    out["bronze_customers"] = save(customers.select("*", stamp), "bronze/customers")
    out["bronze_orders"] = save(orders.select("*", stamp), "bronze/orders")
    rest = [c for c in customers.columns if c != "customer_id"]
    out["silver_customers"] = save(
        silver_customers(out["bronze_customers"], by=("_load_ts", *rest)), "silver/customers")
    out["silver_orders"] = save(silver_orders(out["bronze_orders"]), "silver/orders")
    out["gold_customer_summary"] = save(
        gold_customer_summary(out["silver_orders"], out["silver_customers"]), "gold/customer_summary")
    out["gold_daily"] = save(gold_daily(out["silver_orders"]), "gold/daily")
    return out
