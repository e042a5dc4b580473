"""Derived inputs: arriving batches, change batches, dirty batches and filler columns.

Everything is a function of a table's own keys, so a rerun gives the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: market segment each segment moves to in the second change batch
SEGMENT_MOVES = {"BUILDING": "AUTOMOBILE", "AUTOMOBILE": "FURNITURE", "MACHINERY": "HOUSEHOLD"}
# fixed values: every k-th key changes in change batches 1 to 5; batch 5 edits batch 1's keys again
CHANGE_STEPS = (1000, 500, 750, 333, 1000)


def with_batch(df: DataFrame, key: str, batches: int, name: str = "_batch") -> DataFrame:
    """Number of the arriving batch, by key."""
    return df.withColumn(name, F.pmod(F.col(key), F.lit(batches)).cast("int"))


def random_batches(df: DataFrame, weights: list[float], seed: int = 42) -> list[DataFrame]:
    return df.randomSplit(weights, seed)


def filler_rows(ids: DataFrame, key: str, categories: list[str], start: str, days: int) -> DataFrame:
    """Order-like rows for given ids: padded code, category, day and amount by arithmetic."""
    k = F.col(key)
    options = F.array(*[F.lit(c) for c in categories])
    return ids.select(
        k.alias("id"),
        F.concat(F.lit("CUST"), F.lpad((k % 1000).cast("string"), 6, "0")).alias("customer_code"),
        F.element_at(options, (k % len(categories) + 1).cast("int")).alias("category"),
        F.date_add(F.to_date(F.lit(start)), (k % days).cast("int")).alias("order_date"),
        F.from_unixtime(F.unix_timestamp(F.lit(f"{start} 00:00:00")) + k % 86400).alias("order_time"),
        F.round((k % 997) * 1.25 + 5, 2).alias("amount"))


def change_batches(customers: DataFrame, steps: tuple[int, ...] = CHANGE_STEPS) -> DataFrame:
    """Original customers (batch 0) and five batches of edits of every k-th customer, with
    ``record_type`` and the batch number as sequence."""
    def part(number: int, edits: dict[str, Column]) -> DataFrame:
        rows = customers if number == 0 else customers.filter(F.col("c_custkey") % steps[number - 1] == 0)
        kind = "original" if number == 0 else "modified"
        return (rows.withColumns(edits)
                .withColumn("record_type", F.lit(kind)).withColumn("seq", F.lit(number).cast("bigint")))

    # fixed values: the prefixes, segments and amounts of the edits below
    segment = F.col("c_mktsegment")
    moved = F.lit("BUILDING")
    for old, new in SEGMENT_MOVES.items():
        moved = F.when(segment == old, new).otherwise(moved)
    balance, name = F.col("c_acctbal"), F.col("c_name")
    batches = [
        part(0, {}),
        part(1, {"c_name": F.concat(F.lit("UPDATED_V1: "), name)}),
        part(2, {"c_mktsegment": moved, "c_acctbal": F.round(balance + 1500, 2)}),
        part(3, {"c_name": F.concat(F.lit("UPDATED_V2: "), name), "c_mktsegment": F.lit("MACHINERY"),
                 "c_acctbal": F.round(balance - 800, 2)}),
        part(4, {"c_name": F.concat(F.lit("NEW_ADDR_V4: "), name), "c_acctbal": F.round(balance + 2500, 2)}),
        part(5, {"c_name": F.concat(F.lit("FINAL_UPDATE: "), name), "c_mktsegment": F.lit("HOUSEHOLD"),
                 "c_acctbal": F.round(balance + 5000, 2)}),
    ]
    out = batches[0]
    for batch in batches[1:]:
        out = out.unionByName(batch)
    return out


def dirty_orders(orders: DataFrame, null_key: int = 97, bad_price: int = 89, null_date: int = 83) -> DataFrame:
    """All orders, with a null customer, a price of -999.99 or a null date on every k-th."""
    key = F.col("o_orderkey")
    return orders.withColumns({
        "o_custkey": F.when(key % null_key != 0, F.col("o_custkey")),
        "o_totalprice": F.when(key % bad_price == 0, F.lit(-999.99)).otherwise(F.col("o_totalprice")),
        "o_orderdate": F.when(key % null_date != 0, F.col("o_orderdate")),
    })


def fatal_orders(orders: DataFrame, step: int = 1001) -> DataFrame:
    """All orders, with a null order key on every ``step``-th."""
    return orders.withColumn("o_orderkey", F.when(F.col("o_orderkey") % step != 0, F.col("o_orderkey")))
