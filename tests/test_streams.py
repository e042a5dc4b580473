"""Stream semantics that a batch result cannot show."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from lakeloom.session import scratch_path
from lakeloom.sources.incremental import list_files
from lakeloom.streaming import flows

SCHEMA = "id bigint, v bigint"


def put(spark, path, a, b):
    spark.range(a, b).select("id", (F.col("id") * 2).alias("v")).coalesce(1).write.mode("append").json(path)


def test_rate_orders(spark):
    stream = flows.rate_orders(spark, 20, ["A", "B"], ["North", "South", "East"])
    query = flows.in_memory(stream, "rate_orders", checkpoint=scratch_path(spark, "cp"), trigger={"processingTime": "0 seconds"})
    for _ in range(200):
        if spark.table("rate_orders").count() >= 40:
            break
        time.sleep(0.2)
    query.stop()
    got = spark.table("rate_orders").filter("order_id < 40").orderBy("order_id").collect()
    assert [r["category"] for r in got[:4]] == ["A", "B", "A", "B"]
    assert got[4]["store_region"] == "South" and float(got[4]["order_amount"]) == 14.0 and len(got) == 40


def test_archive_and_delete(spark):
    for mode in ("archive", "delete"):
        source, target, cp, done = (scratch_path(spark, n) for n in ("in", "out", "cp", "done"))
        put(spark, source, 0, 5)
        for extra in (None, 5, 10):
            if extra:
                put(spark, source, extra, extra + 5)
            options = {"archive_to": done} if mode == "archive" else {"delete_source": True}
            flows.drain(flows.append_flow(flows.file_stream(spark, source, "json", SCHEMA, **options), target, cp), 120)
        assert spark.read.schema(SCHEMA).parquet(target).count() == 15
        # the files of the last batch go only with the next one
        assert list_files(spark, source, "*.json").count() < 3
        if mode == "archive":
            assert list_files(spark, done, "*.json").count() >= 1


def test_skip_existing_files(spark):
    source, target = scratch_path(spark, "in"), scratch_path(spark, "out")
    put(spark, source, 0, 5)
    now = list_files(spark, source, "*.json").agg(F.max("modified").cast("string")).first()[0]
    time.sleep(1.1)
    put(spark, source, 5, 8)
    stream = flows.file_stream(spark, source, "json", SCHEMA, newer_than=now)
    flows.drain(flows.append_flow(stream, target, scratch_path(spark, "cp")), 120)
    assert spark.read.schema(SCHEMA).parquet(target).count() == 3


def test_replayed_batch_overwrites_its_folder(spark):
    source, target, cp = (scratch_path(spark, n) for n in ("in", "out", "cp"))
    put(spark, source, 0, 5)
    put(spark, source, 5, 9)
    flows.drain(flows.land_batches(flows.file_stream(spark, source, "json", SCHEMA), target, cp), 120)
    again = flows.land_batches(flows.file_stream(spark, source, "json", SCHEMA), target, scratch_path(spark, "cp"))
    flows.drain(again, 120)
    assert spark.read.parquet(target).count() == 9


def test_update_mode_hands_out_changed_groups(spark):
    source, target = scratch_path(spark, "in"), scratch_path(spark, "out")
    put(spark, source, 0, 4)
    put(spark, source, 4, 5)
    counts = flows.file_stream(spark, source, "json", SCHEMA, max_files=1).groupBy((F.col("id") % 2).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    flows.drain(flows.land_batches(counts, target, scratch_path(spark, "cp"), mode="update"), 120)
    got = spark.read.parquet(target)
    assert got.filter("batch_id = 1").count() == 1
    assert got.groupBy("p").agg(F.max_by("n", "batch_id").alias("n")).agg(F.sum("n")).first()[0] == 5


def test_static_side_is_read_again(spark):
    source, target, cp = (scratch_path(spark, n) for n in ("in", "out", "cp"))
    dims = scratch_path(spark, "dim")

    def run():
        stream = flows.file_stream(spark, source, "json", SCHEMA)
        join = lambda rows, dim: rows.join(dim, "id", "left")
        flows.drain(flows.join_static(stream, lambda: spark.read.schema("id bigint, name string").json(dims), join, target, cp), 120)

    spark.createDataFrame([(0, "zero")], "id bigint, name string").write.json(dims)
    put(spark, source, 0, 2)
    run()
    spark.createDataFrame([(3, "three")], "id bigint, name string").write.mode("append").json(dims)
    put(spark, source, 2, 4)
    run()
    assert {r["id"]: r["name"] for r in spark.read.parquet(target).collect()} == {0: "zero", 1: None, 2: None, 3: "three"}


def test_console_sink(spark):
    source = scratch_path(spark, "in")
    put(spark, source, 0, 2)
    flows.drain(flows.to_console(flows.file_stream(spark, source, "json", SCHEMA), checkpoint=scratch_path(spark, "cp")), 120)


def test_change_stream_starts_at_a_version(spark):
    feed = scratch_path(spark, "feed")
    df = spark.createDataFrame([(1, "insert", 0), (1, "delete", 2)], "id bigint, _change_type string, _commit_version bigint")
    df.write.parquet(feed)
    query = flows.in_memory(flows.change_stream(spark, feed, df.schema, 1), "feed_rows", checkpoint=scratch_path(spark, "cp"))
    flows.drain(query, 120)
    assert [r["_change_type"] for r in spark.table("feed_rows").collect()] == ["delete"]
