"""Physical plans: pushdown, pruning, join strategies, limits before the shuffle."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.operators import joins, layout
from lakeloom.operators import windows as w
from lakeloom.plans import order_flow
from lakeloom.session import plan_bytes, scratch_path, table


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_filter_and_columns_reach_the_scan(spark, data):
    text = plan(table(spark, data, "lineitem").filter("l_quantity < 10").select("l_orderkey"))
    assert "GreaterThan" in text or "LessThan(l_quantity,10.0)" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in text


def test_partition_filter(spark, data):
    path = scratch_path(spark, "p")
    layout.write_partitioned(table(spark, data, "orders"), path, ["o_orderstatus"])
    text = plan(spark.read.parquet(path).filter("o_orderstatus = 'F'"))
    assert "PartitionFilters: [isnotnull(o_orderstatus" in text


def test_join_strategy_follows_the_checked_size(spark, data):
    lines = table(spark, data, "lineitem").withColumnRenamed("l_partkey", "p_partkey")
    part = table(spark, data, "part")
    assert "BroadcastHashJoin" in plan(joins.broadcast_join(lines, part, "p_partkey"))
    assert "SortMergeJoin" in plan(joins.sort_merge_join(lines, part, "p_partkey"))
    assert "SortMergeJoin" in plan(joins.broadcast_join(lines, part.limit(100), "p_partkey").join(
        joins.broadcast_if_small(part, max_bytes=1).withColumnRenamed("p_name", "again"), "p_partkey"))


def test_a_compressible_dimension_is_measured_not_guessed(spark):
    """Rows of one repeated text: next to nothing on disk, far above the bound in memory."""
    path = scratch_path(spark, "wide")
    spark.range(20_000).select(F.col("id").alias("k"), F.repeat(F.lit("x"), 1000).alias("text")).write.parquet(path)
    dim, fact = spark.read.parquet(path), spark.range(100).select(F.col("id").alias("k"))
    bound = 4 << 20
    assert plan_bytes(dim) < bound < joins.measured_bytes(dim)
    assert "Broadcast" not in plan(fact.join(joins.broadcast_if_small(dim, bound), "k"))
    assert "BroadcastHashJoin" not in plan(joins.lookup(fact, dim, "k"))
    ids = spark.range(100_000).select(F.col("id").alias("k"))
    small = joins.lookup(ids, dim.filter("k < 10").select("k"), "k", "inner")
    assert small.collect() and "BroadcastHashJoin" in plan(small)  # by its size at run time


def test_top_k_is_limited_before_the_shuffle(spark, data):
    text = plan(w.top_per_group(table(spark, data, "orders"), ["o_custkey"], ["o_totalprice desc", "o_orderkey"], 3))
    assert "WindowGroupLimit" in text and "Partial" in text
    assert "TakeOrderedAndProject" in plan(table(spark, data, "orders").orderBy("o_orderkey").limit(5))


def test_summary_aggregates_before_the_join(spark, data):
    orders, customers = table(spark, data, "orders"), table(spark, data, "customer")
    text = plan(order_flow.customer_summary(orders, customers))
    assert "partial_sum" in text and text.index("Join") < text.index("partial_sum")  # the aggregate lies below the join


def test_no_cross_join_or_python_in_queries(spark, data):
    import __spark_entry__ as entry
    for name in ("c03_star_lookup", "m02_scd2", "m11_as_of_join", "e07_unpartitioned_rank", "n01_gold_daily_orders", "q08_revenue_by_region"):
        text = plan(entry.queries()[name](spark, data))
        assert "CartesianProduct" not in text and "NestedLoop" not in text and "EvalPython" not in text, name


def test_hot_plans_have_no_nested_loops(spark, data):
    orders = table(spark, data, "orders")
    for df in (w.with_windows(orders, [], ["o_totalprice", "o_orderkey"], {"n": w.row_number(), "s": w.running("count", "o_custkey")}, hot_rows=100),
               w.with_ranks(orders, [], ["o_totalprice"], hot_rows=100),
               w.with_windows(orders, ["o_orderstatus"], ["o_orderkey"], {"n": w.row_number()}, hot_rows=100)):
        assert "NestedLoop" not in plan(df) and "Cartesian" not in plan(df)


def test_slices_do_not_grow_with_the_table(spark):
    """More than 2,000 hot keys, and a limit that stays what it was."""
    df = spark.range(50_000).select((F.col("id") % 2_500).alias("k"), "id")
    hot = w.hot_keys(df, ["k"], 10)
    assert len(hot.rows) == 2_500 and hot.limit == 10
    assert w.hot_keys(df, [], 10).limit == 10


def test_scalar_subquery_instead_of_cross_join(spark, data):
    df = w.with_totals(table(spark, data, "orders").select("o_totalprice"), [], {"t": ("sum", "o_totalprice")})
    assert "NestedLoop" not in plan(df) and df.agg(F.count_distinct("t")).first()[0] == 1
