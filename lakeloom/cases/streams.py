"""Structured Streaming semantics over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.cases.inputs import landing
from lakeloom.cases.registry import case, plain
from lakeloom.operators import changes as ch
from lakeloom.operators import snapshots as sn
from lakeloom.operators.windows import latest_per_key
from lakeloom.session import scratch_path, stage, table
from lakeloom.sources import incremental
from lakeloom.streaming import flows

ORDER_JSON = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderpriority string"


def _name(spark) -> str:
    return scratch_path(spark, "mem").rsplit("/", 1)[1].replace("-", "_")


@case("j01_triggers", """
SELECT t AS trigger, event_type, count(*) AS n FROM events, (VALUES ('availableNow'), ('processingTime')) AS x(t) GROUP BY 1, 2""")
def j01(spark, d):
    """The same flow drained once and run on an interval until all is read, then stopped."""
    parts = []
    for label in ("availableNow", "processingTime"):
        target, checkpoint = scratch_path(spark, "triggered"), scratch_path(spark, "checkpoint")
        stream = flows.table_stream(spark, d, "events").select("event_type")
        if label == "availableNow":
            flows.drain(flows.append_flow(stream, target, checkpoint))
        else:
            query = flows.append_flow(stream, target, checkpoint, {"processingTime": "1 second"})
            query.processAllAvailable()
            query.stop()
        parts.append(spark.read.schema("event_type string").parquet(target).withColumn("trigger", F.lit(label)))
    return parts[0].unionByName(parts[1]).groupBy("trigger", "event_type").agg(F.count(F.lit(1)).alias("n"))


@case("j02_output_modes", """
SELECT m AS output_mode, event_type, count(*) AS n FROM events, (VALUES ('append'), ('complete'), ('update')) AS x(m) GROUP BY 1, 2""")
def j02(spark, d):
    """append hands out rows, complete the whole result, update the changed groups; all end
    in the same counts."""
    rows = flows.table_stream(spark, d, "events").select("event_type")
    counts = rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    appended, updated, whole = scratch_path(spark, "append"), scratch_path(spark, "update"), _name(spark)
    flows.drain(flows.append_flow(rows, appended, scratch_path(spark, "checkpoint")))
    flows.drain(flows.land_batches(counts, updated, scratch_path(spark, "checkpoint"), mode="update"))
    flows.drain(flows.in_memory(counts, whole, "complete", scratch_path(spark, "checkpoint")))
    last = latest_per_key(spark.read.parquet(updated), ["event_type"], ["batch_id"])
    from_rows = spark.read.schema("event_type string").parquet(appended).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    tagged = [("append", from_rows), ("complete", spark.table(whole)), ("update", last)]
    out = [df.select(F.lit(mode).alias("output_mode"), "event_type", "n") for mode, df in tagged]
    return out[0].unionByName(out[1]).unionByName(out[2])


@case("j03_checkpoint_restart", """
SELECT CASE WHEN o_orderkey % 4 < 2 THEN 1 ELSE 2 END AS run, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1""")
def j03(spark, d):
    """Each run reads the new files only; the third finds none."""
    source = landing(spark, table(spark, d, "orders"), "o_orderkey", 4)
    target, checkpoint = scratch_path(spark, "restarted"), scratch_path(spark, "checkpoint")
    for run, arrived in ((1, "[0-1]"), (2, "[0-3]"), (3, "[0-3]")):
        stream = flows.file_stream(spark, f"{source}/_batch={arrived}", "json", ORDER_JSON).withColumn("run", F.lit(run))
        flows.drain(flows.append_flow(stream, target, checkpoint))
    return spark.read.schema(f"{ORDER_JSON}, run int").parquet(target).groupBy("run").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


WINDOW_SQL = """
SELECT CAST(date_trunc('hour', ts) AS VARCHAR) AS window_start, event_type, count(*) AS n FROM events {where}
GROUP BY date_trunc('hour', ts), event_type
HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 1 MINUTE FROM events)"""


@case("j04_tumbling_window", WINDOW_SQL.format(where=""))
def j04(spark, d):
    """Append mode emits a window once the watermark has passed its end."""
    counts = flows.windowed_counts(flows.table_stream(spark, d, "events"), "ts", "1 hour", "1 minute", "event_type")
    target = scratch_path(spark, "windows")
    flows.drain(flows.append_flow(counts.select("window_start", "event_type", "n"), target, scratch_path(spark, "checkpoint")))
    return plain(spark.read.schema("window_start timestamp, event_type string, n bigint").parquet(target))


@case("j05_late_rows", WINDOW_SQL.format(where="WHERE ts >= TIMESTAMP '2024-01-10 00:00:00'"))
def j05(spark, d):
    """The older days arrive in a second run, behind the watermark, and are dropped."""
    events = table(spark, d, "events")
    source, target, checkpoint = (scratch_path(spark, n) for n in ("late", "windows", "checkpoint"))
    recent = F.col("ts") >= F.lit("2024-01-10").cast("timestamp_ntz")
    for rows in (events.filter(recent), events.filter(~recent)):
        rows.write.mode("append").parquet(source)
        stream = flows.file_stream(spark, source, "parquet", events.schema)
        counts = flows.windowed_counts(stream, "ts", "1 hour", "1 minute", "event_type").select("window_start", "event_type", "n")
        flows.drain(flows.append_flow(counts, target, checkpoint))
    return plain(spark.read.schema("window_start timestamp, event_type string, n bigint").parquet(target))


STATE_SQL = """
WITH runs AS (SELECT 1 AS run, * FROM events WHERE ts < TIMESTAMP '{cut}' UNION ALL SELECT 2, * FROM events),
marks AS (SELECT run, date_trunc('milliseconds', max(ts)) - INTERVAL 1 MINUTE AS mark FROM runs GROUP BY run)
SELECT r.run, CAST(date_trunc('hour', ts) AS VARCHAR) AS window_start, event_type, count(*) AS n FROM runs r JOIN marks m ON r.run = m.run
GROUP BY r.run, date_trunc('hour', ts), event_type, mark HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR > mark"""
CUT = "2024-01-20 10:30:00"


@case("j05_state_held_and_freed", STATE_SQL.format(cut=CUT))
def j05_state(spark, d):
    """The windows in the state store after each of two runs: those behind the watermark are gone."""
    events = table(spark, d, "events")
    source, target, checkpoint = (scratch_path(spark, n) for n in ("halves", "windows", "checkpoint"))
    early = F.col("ts") < F.lit(CUT).cast("timestamp_ntz")
    held = []
    for run, rows in ((1, events.filter(early)), (2, events.filter(~early))):
        rows.write.mode("append").parquet(source)
        counts = flows.windowed_counts(flows.file_stream(spark, source, "parquet", events.schema), "ts", "1 hour", "1 minute", "event_type")
        flows.drain(flows.append_flow(counts, target, checkpoint))
        held.append(stage(flows.held_windows(spark, checkpoint, "event_type").select(F.lit(run).alias("run"), "window_start", "event_type", "n")))
    return plain(held[0].unionByName(held[1]))


@case("j06_stream_enrichment", """
SELECT o_orderstatus, count(*) AS n, count(*) AS with_file, count(*) AS with_time FROM orders GROUP BY o_orderstatus""")
def j06(spark, d):
    target = scratch_path(spark, "enriched")
    flows.drain(flows.append_flow(flows.enrich(flows.table_stream(spark, d, "orders")), target, scratch_path(spark, "checkpoint")))
    return spark.read.parquet(target).groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.count("source_file_name").alias("with_file"), F.count("processing_time").alias("with_time"))


@case("j07_table_as_stream_source", """
SELECT 'stream' AS read_as, CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 2 END AS run, count(*) AS n FROM orders GROUP BY 2
UNION ALL SELECT 'snapshot', 1, count(*) FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT 'snapshot', 2, count(*) FROM orders""")
def j07(spark, d):
    """A stream over a table delivers new rows only, a plain read the full snapshot."""
    orders = table(spark, d, "orders").select("o_orderkey")
    bronze, target, checkpoint = (scratch_path(spark, n) for n in ("bronze", "silver", "checkpoint"))
    snapshots = []
    for run in (1, 2):
        orders.filter(F.col("o_orderkey") % 2 == run - 1).write.mode("append").parquet(bronze)
        stream = flows.file_stream(spark, bronze, "parquet", orders.schema).withColumn("run", F.lit(run))
        flows.drain(flows.append_flow(stream, target, checkpoint))
        # counted now: two scans of one path in a single plan would be taken for the same
        snapshots.append(stage(spark.read.parquet(bronze).agg(
            F.lit("snapshot").alias("read_as"), F.lit(run).alias("run"), F.count(F.lit(1)).alias("n"))))
    streamed = spark.read.schema("o_orderkey bigint, run int").parquet(target).groupBy("run").agg(F.count(F.lit(1)).alias("n"))
    return streamed.select(F.lit("stream").alias("read_as"), "run", "n").unionByName(snapshots[0]).unionByName(snapshots[1])


@case("j08_change_feed_stream", """
SELECT 'update_preimage' AS change, 1 AS version, count(*) AS n FROM customer WHERE c_mktsegment = 'BUILDING'
UNION ALL SELECT 'update_postimage', 1, count(*) FROM customer WHERE c_mktsegment = 'BUILDING'
UNION ALL SELECT 'delete', 2, count(*) FROM customer WHERE c_custkey % 10 = 0""")
def j08(spark, d):
    """The change feed is written per version and streamed from version 1 on."""
    root = scratch_path(spark, "customers")
    sn.write(table(spark, d, "customer"), root, "CREATE")
    sn.write(ch.update(sn.read(spark, root), {"c_acctbal": "c_acctbal + 1"}, "c_mktsegment = 'BUILDING'"), root, "UPDATE")
    sn.write(ch.delete(sn.read(spark, root), "c_custkey % 10 = 0"), root, "DELETE")
    feed = sn.changes(spark, root, 1, key=["c_custkey"])
    folder, target = scratch_path(spark, "feed"), scratch_path(spark, "consumed")
    feed.write.parquet(folder)
    flows.drain(flows.append_flow(flows.change_stream(spark, folder, feed.schema, 1), target, scratch_path(spark, "checkpoint")))
    return spark.read.schema(feed.schema).parquet(target).groupBy(
        F.col("_change_type").alias("change"), F.col("_commit_version").alias("version")).agg(F.count(F.lit(1)).alias("n"))


@case("j09_backfill_and_live_flow", """
SELECT CASE WHEN o_orderdate < TIMESTAMP '1997-01-01 00:00:00' THEN 'backfill' ELSE 'live' END AS flow, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1""")
def j09(spark, d):
    """The backfill runs once by name; reruns of both flows add nothing."""
    split = F.lit("1997-01-01").cast("timestamp_ntz")
    orders = table(spark, d, "orders")
    target, live, checkpoint = (scratch_path(spark, n) for n in ("history", "live", "checkpoint"))
    for _ in range(2):
        incremental.once(spark, target, "orders_backfill", orders.filter(F.col("o_orderdate") < split).select("o_orderkey", "o_totalprice"))
        stream = flows.table_stream(spark, d, "orders").filter(F.col("o_orderdate") >= split).select("o_orderkey", "o_totalprice")
        flows.drain(flows.append_flow(stream, live, checkpoint))
    both = (incremental.read_loaded(spark, target).select(F.lit("backfill").alias("flow"), "o_totalprice")
            .unionByName(spark.read.schema("o_orderkey bigint, o_totalprice double").parquet(live).select(F.lit("live").alias("flow"), "o_totalprice")))
    return both.groupBy("flow").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
