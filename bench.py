"""Times the headline work at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Per entry: one warm-up, then the median of five runs.  Results go to the no-op sink, so
every row is computed and none is collected."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import functions as F

from lakeloom import cases
from lakeloom.cases import inputs
from lakeloom.cases.registry import QUERIES
from lakeloom.operators import aggregates, joins, layout
from lakeloom.plans import order_flow
from lakeloom.session import build_session, scratch_path, stage, table
from lakeloom.sources import incremental, readers

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "5"))

# registered queries timed as they are
HEADLINE = """d01_grouped_aggregate d03_distinct_count d06_two_level_aggregate d07_daily_rollup c01_inner_join
e01_ranking e02_lag_lead e03_running_totals e04_moving_frame e05_range_frame e07_unpartitioned_rank e08_latest_per_key f03_top_k_per_group
c03_star_lookup m01_scd1 m02_scd2 m11_as_of_join k05_quarantine_split l06_merge l09_multiset_diff
n01_gold_daily_orders n03_sales_fact n04_customer_order_summary q07_route_rollup q08_revenue_by_month_and_region j04_tumbling_window""".split()


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def median(action) -> float:
    action()
    times = []
    for _ in range(RUNS):
        start = time.perf_counter()
        action()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 4)


def once(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 4)


def main() -> None:
    spark = build_session("bench", f"local[{CPUS}]", spark__sql__shuffle__partitions=CPUS, spark__driver__memory="16g")
    spark.sparkContext.setLogLevel("OFF")
    cases.load()
    seconds: dict[str, float] = {}
    facts: dict[str, object] = {}
    lines, orders, parts = (table(spark, FOLDER, n) for n in ("lineitem", "orders", "part"))

    seconds["customer_order_summary"] = median(lambda: run(order_flow.customer_summary(
        order_flow.silver_orders(orders), table(spark, FOLDER, "customer"))))
    for name in HEADLINE:
        seconds[name] = median(lambda name=name: run(QUERIES[name](spark, FOLDER)))

    # point query on three layouts
    columns = lines.select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    layouts = {n: scratch_path(spark, f"bench-{n}") for n in ("base", "z_order", "cluster")}
    columns.repartition(64).write.parquet(layouts["base"])
    layout.write_clustered(columns, ["l_partkey", "l_suppkey"], layouts["z_order"], 64)
    layout.write_clustered(columns, ["l_partkey"], layouts["cluster"], 64)
    point = lambda df: df.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"), F.sum("l_extendedprice").alias("v"))
    seconds["point_base"] = median(lambda: run(point(spark.read.parquet(layouts["base"]).filter("l_partkey = 42"))))
    for name in ("z_order", "cluster"):
        seconds[f"point_{name}"] = median(lambda name=name: run(point(layout.read_skipping(spark, layouts[name], "l_partkey", 42))))
        facts[f"files_{name}"] = layout.files_for(spark.read.parquet(f"{layouts[name]}/_stats"), "l_partkey", 42).count()

    # inferred against declared CSV schema
    text = scratch_path(spark, "bench-csv")
    orders.write.option("header", True).csv(text)
    schema = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
    seconds["csv_inferred"] = median(lambda: run(readers.read_csv(spark, text)))
    seconds["csv_declared"] = median(lambda: run(readers.read_csv(spark, text, schema, by_name=False)))
    seconds["csv_declared_by_name"] = median(lambda: run(readers.read_csv(spark, text, schema)))

    # compaction of small files
    small = scratch_path(spark, "bench-small")
    orders.repartition(5_000).write.parquet(small)
    seconds["scan_small_files"] = median(lambda: run(spark.read.parquet(small)))
    seconds["compact"] = once(lambda: facts.update(compacted=layout.compact_folder(spark, small)))
    seconds["scan_compacted"] = median(lambda: run(spark.read.parquet(small)))

    # one key with nine tenths of the rows
    skewed = stage(lines.select(
        F.when(F.monotonically_increasing_id() % 10 != 0, 99).otherwise(F.col("l_partkey") % 100).alias("k"),
        F.col("l_extendedprice").alias("v"), F.monotonically_increasing_id().alias("id")))
    names = spark.range(100).select(F.col("id").alias("k"), F.concat(F.lit("n"), F.col("id").cast("string")).alias("name"))
    total = lambda df: df.groupBy("k").agg(F.sum("v").alias("v"))
    seconds["skew_sum_plain"] = median(lambda: run(total(skewed)))
    seconds["skew_sum_salted"] = median(lambda: run(aggregates.salted_sum(skewed, "k", "v", ["id"])))
    seconds["skew_join_merge"] = median(lambda: run(total(joins.sort_merge_join(skewed, names, "k"))))
    seconds["skew_join_salted"] = median(lambda: run(total(joins.salted_join(skewed, names, "k", ["id"], heavy_rows=10_000))))

    # broadcast against sort-merge
    keyed = lines.select(F.col("l_partkey").alias("p_partkey"), "l_extendedprice")
    seconds["join_broadcast"] = median(lambda: run(joins.broadcast_join(keyed, parts, "p_partkey")))
    seconds["join_sort_merge"] = median(lambda: run(joins.sort_merge_join(keyed, parts, "p_partkey")))

    # rerunnable load of small files
    source, target = scratch_path(spark, "bench-in"), scratch_path(spark, "bench-loaded")
    orders.repartition(1_000).write.json(source)
    seconds["copy_into_first"] = once(lambda: incremental.copy_into(spark, target, source, "json"))
    seconds["copy_into_nothing_new"] = once(lambda: incremental.copy_into(spark, target, source, "json"))

    # change batches, one by one, into a type 2 history
    events = stage(inputs.change_events(spark, FOLDER))
    seconds["scd2_six_batches"] = once(lambda: inputs.replay_scd2(spark, events))

    print(json.dumps({
        "metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": FOLDER.rstrip("/").rsplit("sf", 1)[-1], "cpus": CPUS, **facts}))
    spark.stop()


if __name__ == "__main__":
    sys.exit(main())
