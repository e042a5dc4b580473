"""Change data capture and slowly changing dimensions."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.cases.inputs import CHANGES_SQL, STEPS
from lakeloom.cases.registry import case, plain
from lakeloom.operators import cdc
from lakeloom.operators import windows as w
from lakeloom.operators.quality import CheckFailed
from lakeloom.session import scratch_path, stage, table
from lakeloom.sources.generators import change_batches
from lakeloom.streaming import flows
from lakeloom.streaming.keyed_history import KeyedHistory, history_flow

KEYS, SEQ = ["c_custkey"], ["seq"]
VALUES = "c_name, c_nationkey, c_acctbal, c_mktsegment, record_type"


def _events(spark, d):
    return change_batches(table(spark, d, "customer"), STEPS)


OPS_SQL = f"""SELECT *, CASE WHEN seq = 4 AND c_custkey % 2 = 0 THEN 'DELETE' ELSE 'UPSERT' END AS op FROM ({CHANGES_SQL}) AS ev"""


def _with_ops(spark, d):
    gone = (F.col("seq") == 4) & (F.col("c_custkey") % 2 == 0)
    return _events(spark, d).withColumn("op", F.when(gone, "DELETE").otherwise("UPSERT"))


SCD1_SQL = f"SELECT * FROM ({CHANGES_SQL}) AS e QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY seq DESC) = 1"


@case("m01_scd1", SCD1_SQL)
def m01(spark, d):
    return cdc.scd1(_events(spark, d), KEYS, SEQ)


def _event_folder(spark, events, first=None):
    """Change events arriving in two folders, later sequence numbers partly first."""
    path = scratch_path(spark, "events")
    first = F.col("seq").isin(0, 1, 3, 5) if first is None else first
    events.withColumn("_batch", F.when(first, 0).otherwise(1)).write.partitionBy("_batch").parquet(path)
    return path


def _streamed(spark, source, flow, **options):
    """The dimension that a flow keeps over two runs of one checkpoint."""
    store, target, checkpoint = (scratch_path(spark, n) for n in ("store", "dimension", "checkpoint"))
    schema = spark.read.parquet(source).drop("_batch").schema
    for arrived in ("0", "[0-1]"):
        stream = flows.file_stream(spark, f"{source}/_batch={arrived}", "parquet", schema)
        flows.drain(flow(stream, store, target, KEYS, SEQ, checkpoint, **options))
    return flows.read_dimension(spark, target)


@case("m01_scd1_stream", SCD1_SQL)
def m01_stream(spark, d):
    """Merged batch by batch; events that come late change nothing."""
    return _streamed(spark, _event_folder(spark, _events(spark, d)), flows.scd1_flow)


SCD2_SQL = f"""
WITH e AS ({CHANGES_SQL}),
c AS (SELECT *, lag(row(c_name, c_nationkey, c_acctbal, c_mktsegment, record_type)) OVER w AS before FROM e WINDOW w AS (PARTITION BY c_custkey ORDER BY seq)),
k AS (SELECT * EXCLUDE (before) FROM c WHERE before IS DISTINCT FROM row(c_name, c_nationkey, c_acctbal, c_mktsegment, record_type))
SELECT *, seq AS __START_AT, lead(seq) OVER (PARTITION BY c_custkey ORDER BY seq) AS __END_AT FROM k"""


@case("m02_scd2", SCD2_SQL)
def m02(spark, d):
    return cdc.scd2(_events(spark, d), KEYS, SEQ)


@case("m02_scd2_stream", SCD2_SQL)
def m02_stream(spark, d):
    """Two batches, the second with late events: chains of its keys are rebuilt."""
    return _streamed(spark, _event_folder(spark, _events(spark, d)), flows.scd2_flow)


NULL_KEYS_SQL = f"""
WITH e AS (SELECT CASE WHEN c_custkey % 50 = 0 THEN NULL ELSE c_custkey END AS c_custkey, c_name, c_acctbal, seq * 1000000 + CASE WHEN c_custkey % 50 = 0 THEN c_custkey ELSE 0 END AS seq FROM ({CHANGES_SQL}) AS ev),
c AS (SELECT *, lag(row(c_name, c_acctbal)) OVER w AS before FROM e WINDOW w AS (PARTITION BY c_custkey ORDER BY seq)),
k AS (SELECT * EXCLUDE (before) FROM c WHERE before IS DISTINCT FROM row(c_name, c_acctbal))
SELECT *, seq AS __START_AT, lead(seq) OVER (PARTITION BY c_custkey ORDER BY seq) AS __END_AT FROM k"""


@case("m02_scd2_stream_null_keys", NULL_KEYS_SQL)
def m02_stream_nulls(spark, d):
    """The null key is a key like any other and gets one chain, over all batches."""
    none = F.col("c_custkey") % 50 == 0
    events = _events(spark, d).select(
        F.when(~none, F.col("c_custkey")).alias("c_custkey"), "c_name", "c_acctbal",
        (F.col("seq").cast("bigint") * 1000000 + F.when(none, F.col("c_custkey")).otherwise(0)).alias("seq"))
    return _streamed(spark, _event_folder(spark, events, F.col("seq") < 2500000), flows.scd2_flow)


M03_SQL = f"""
WITH e AS ({OPS_SQL}), g AS (SELECT c_custkey, max(seq) AS gone FROM e WHERE op = 'DELETE' GROUP BY c_custkey)
SELECT e.* FROM e LEFT JOIN g USING (c_custkey) WHERE gone IS NULL OR seq > gone QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY seq DESC) = 1"""


@case("m03_delete_scd1", M03_SQL)
def m03(spark, d):
    return cdc.scd1(_with_ops(spark, d), KEYS, SEQ, delete_when="op = 'DELETE'")


@case("m03_delete_scd1_stream", M03_SQL)
def m03_stream(spark, d):
    return _streamed(spark, _event_folder(spark, _with_ops(spark, d)), flows.scd1_flow, delete_when="op = 'DELETE'")


@case("m03_delete_scd2", f"""
WITH e AS ({OPS_SQL}),
c AS (SELECT *, lag(row(op = 'DELETE', c_name, c_acctbal, c_mktsegment, record_type)) OVER (PARTITION BY c_custkey ORDER BY seq) AS before FROM e),
k AS (SELECT *, lead(seq) OVER (PARTITION BY c_custkey ORDER BY seq) AS __END_AT FROM c
  WHERE before IS DISTINCT FROM row(op = 'DELETE', c_name, c_acctbal, c_mktsegment, record_type))
SELECT c_custkey, c_name, c_acctbal, c_mktsegment, record_type, seq, seq AS __START_AT, __END_AT FROM k WHERE op <> 'DELETE'""")
def m03_scd2(spark, d):
    events = _with_ops(spark, d).drop("c_nationkey")
    return cdc.scd2(events, KEYS, SEQ, delete_when="op = 'DELETE'", untracked=["op"]).drop("op")


@case("m03_late_event_after_delete", f"""
WITH e AS ({OPS_SQL}) SELECT c_custkey, c_name, c_acctbal, seq FROM e QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY seq DESC) = 1 AND op <> 'DELETE'""")
def m03_late(spark, d):
    """The delete comes in the first batch, older upserts in the second: they stay hidden."""
    events = _with_ops(spark, d).select("c_custkey", "c_name", "c_acctbal", "seq", "op")
    empty = events.withColumn("_deleted", F.lit(False)).limit(0)
    state = cdc.scd1_apply(empty, events.filter("seq >= 4"), KEYS, SEQ, "op = 'DELETE'")
    state = cdc.scd1_apply(stage(state), events.filter("seq < 4"), KEYS, SEQ, "op = 'DELETE'")
    return cdc.scd1_view(state).drop("op")


M04_SQL = f"""
SELECT c_custkey, {VALUES}, seq FROM ({CHANGES_SQL}) AS e WHERE seq > 2 QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY seq DESC) = 1"""


def _with_truncate(spark, d):
    """One event truncates the table at sequence 2."""
    events = _events(spark, d).withColumn("op", F.lit("UPSERT"))
    first = table(spark, d, "customer").agg(F.min("c_custkey")).scalar()
    cut = events.filter((F.col("seq") == 0) & (F.col("c_custkey") == first)).withColumns({"op": F.lit("TRUNCATE"), "seq": F.lit(2).cast(events.schema["seq"].dataType)})
    return events.unionByName(cut)


@case("m04_truncate_event", M04_SQL)
def m04(spark, d):
    """Everything up to the truncate event (sequence 2) is dropped."""
    return cdc.scd1(_with_truncate(spark, d), KEYS, SEQ, truncate_when="op = 'TRUNCATE'", exclude=["op"])


@case("m04_truncate_stream", M04_SQL)
def m04_stream(spark, d):
    """The truncate comes in the second batch and reaches every bucket."""
    return _streamed(spark, _event_folder(spark, _with_truncate(spark, d)), flows.scd1_flow, truncate_when="op = 'TRUNCATE'", exclude=["op"])


HOLES_SQL = f"""SELECT c_custkey, CASE WHEN seq IN (2, 4) THEN NULL ELSE c_name END AS c_name,
  CASE WHEN seq IN (1, 4) THEN NULL ELSE c_acctbal END AS c_acctbal, seq FROM ({CHANGES_SQL}) AS ev"""


def _with_holes(spark, d):
    return _events(spark, d).selectExpr(
        "c_custkey", "CASE WHEN seq IN (2, 4) THEN NULL ELSE c_name END AS c_name",
        "CASE WHEN seq IN (1, 4) THEN NULL ELSE c_acctbal END AS c_acctbal", "seq")


M05_SQL = f"""
SELECT c_custkey, arg_max(c_name, seq) AS c_name, arg_max(c_acctbal, seq) AS c_acctbal, max(seq) AS seq FROM ({HOLES_SQL}) AS e GROUP BY c_custkey"""


@case("m05_ignore_nulls_keep_old", M05_SQL)
def m05(spark, d):
    return cdc.scd1(_with_holes(spark, d), KEYS, SEQ, ignore_nulls="keep_old")


@case("m01_scd1_stream_ignore_nulls", M05_SQL)
def m05_stream(spark, d):
    return _streamed(spark, _event_folder(spark, _with_holes(spark, d)), flows.scd1_flow, ignore_nulls="keep_old")


@case("m05_ignore_nulls_skip_row", f"""
SELECT * FROM ({HOLES_SQL}) AS e WHERE c_name IS NOT NULL OR c_acctbal IS NOT NULL QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY seq DESC) = 1""")
def m05_skip(spark, d):
    return cdc.scd1(_with_holes(spark, d), KEYS, SEQ, ignore_nulls="skip_row")


@case("m05_ignore_nulls_scd2", f"""
WITH f AS (SELECT c_custkey, last_value(c_name IGNORE NULLS) OVER w AS c_name, last_value(c_acctbal IGNORE NULLS) OVER w AS c_acctbal, seq
  FROM ({HOLES_SQL}) AS e WINDOW w AS (PARTITION BY c_custkey ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
c AS (SELECT *, lag(row(c_name, c_acctbal)) OVER (PARTITION BY c_custkey ORDER BY seq) AS before FROM f),
k AS (SELECT * EXCLUDE (before) FROM c WHERE before IS DISTINCT FROM row(c_name, c_acctbal))
SELECT *, seq AS __START_AT, lead(seq) OVER (PARTITION BY c_custkey ORDER BY seq) AS __END_AT FROM k""")
def m05_scd2(spark, d):
    return cdc.scd2(_with_holes(spark, d), KEYS, SEQ, ignore_nulls=True)


@case("m06_column_exclusion", f"""
SELECT c_custkey, c_name, c_acctbal, c_mktsegment, seq FROM ({SCD1_SQL}) AS x""")
def m06(spark, d):
    events = _events(spark, d).withColumn("_rescued_data", F.col("record_type"))
    return cdc.scd1(events, KEYS, SEQ, exclude=["_rescued_data", "record_type", "c_nationkey"])


@case("m07_null_and_double_keys", """
WITH k AS (SELECT CASE WHEN c_custkey % 1000 = 4 THEN NULL ELSE c_custkey END AS k, min(c_custkey) AS first, min(c_name) AS c_name, min(c_acctbal) AS c_acctbal FROM customer GROUP BY 1)
SELECT k AS c_custkey, c_name, c_acctbal, first % 4 <> 0 AS is_current, '2024-01-01' AS start_date, CASE WHEN first % 4 = 0 THEN '2024-06-01' END AS end_date FROM k WHERE first % 2 = 0
UNION ALL SELECT k, c_name, c_acctbal + 1, true, '2024-06-01', NULL FROM k WHERE first % 4 = 0
UNION ALL SELECT k, c_name, c_acctbal, true, '2024-06-01', NULL FROM k WHERE first % 2 = 1""")
def m07_nulls(spark, d):
    """One key is null; the step runs twice and the second time changes nothing; a source with two rows
    for a key is refused."""
    key = F.when(F.col("c_custkey") % 1000 != 4, F.col("c_custkey"))
    c = table(spark, d, "customer").groupBy(key.alias("k")).agg(F.min("c_custkey").alias("first"), F.min("c_name").alias("c_name"), F.min("c_acctbal").alias("c_acctbal"))
    c = stage(c.withColumnRenamed("k", "c_custkey"))
    dim = c.filter("first % 2 = 0").selectExpr("c_custkey", "c_name", "c_acctbal", "true AS is_current", "DATE'2024-01-01' AS start_date", "CAST(NULL AS DATE) AS end_date")
    source = c.selectExpr("c_custkey", "c_name", "c_acctbal + CASE WHEN first % 4 = 0 THEN 1 ELSE 0 END AS c_acctbal")
    for _ in range(2):
        dim = stage(cdc.scd2_merge(dim, source, ["c_custkey"], ["c_name", "c_acctbal"], "2024-06-01"))
    try:
        cdc.scd2_merge(dim, source.unionByName(source.filter("c_custkey IS NULL")), ["c_custkey"], ["c_name", "c_acctbal"], "2024-06-01")
    except CheckFailed:
        return plain(dim)
    raise AssertionError("two rows for one key were taken")


@case("m07_manual_scd2", """
SELECT c_custkey, c_name, c_acctbal, c_custkey % 4 <> 0 AS is_current, '2024-01-01' AS start_date, CASE WHEN c_custkey % 4 = 0 THEN '2024-06-01' END AS end_date
FROM customer WHERE c_custkey % 2 = 0
UNION ALL SELECT c_custkey, c_name, c_acctbal + 1, true, '2024-06-01', NULL FROM customer WHERE c_custkey % 4 = 0
UNION ALL SELECT c_custkey, c_name, c_acctbal, true, '2024-06-01', NULL FROM customer WHERE c_custkey % 2 = 1""")
def m07(spark, d):
    """Close and insert in one step; unchanged rows stay, unknown keys are new."""
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal")
    dim = c.filter("c_custkey % 2 = 0").selectExpr(
        "*", "true AS is_current", "DATE'2024-01-01' AS start_date", "CAST(NULL AS DATE) AS end_date")
    source = c.withColumn("c_acctbal", F.expr("CASE WHEN c_custkey % 4 = 0 THEN c_acctbal + 1 ELSE c_acctbal END"))
    return plain(cdc.scd2_merge(dim, source, ["c_custkey"], ["c_name", "c_acctbal"], "2024-06-01"))


@case("m08_scd0", f"SELECT * FROM ({CHANGES_SQL}) AS e QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY seq) = 1")
def m08(spark, d):
    return cdc.scd0(_events(spark, d), KEYS, SEQ)


@case("m08_scd3", f"""
WITH c AS (SELECT c_custkey, c_mktsegment, seq, lag(c_mktsegment) OVER (PARTITION BY c_custkey ORDER BY seq) AS before FROM ({CHANGES_SQL}) AS e),
k AS (SELECT c_custkey, c_mktsegment, seq, lag(c_mktsegment) OVER (PARTITION BY c_custkey ORDER BY seq) AS previous FROM c WHERE before IS DISTINCT FROM c_mktsegment)
SELECT c_custkey, c_mktsegment AS current_c_mktsegment, previous AS previous_c_mktsegment FROM k QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY seq DESC) = 1""")
def m08_scd3(spark, d):
    return cdc.scd3(_events(spark, d), KEYS, SEQ, "c_mktsegment")


@case("m09_current_snapshot", f"SELECT c_custkey, {VALUES}, seq FROM ({SCD2_SQL}) AS h WHERE __END_AT IS NULL")
def m09(spark, d):
    return cdc.current_rows(cdc.scd2(_events(spark, d), KEYS, SEQ))


@case("m10_history_audit", f"""
SELECT *, CASE WHEN __END_AT IS NULL THEN 'Current' ELSE 'Historical' END AS version_status FROM ({SCD2_SQL}) AS h
WHERE c_custkey IN (SELECT c_custkey FROM ({SCD2_SQL}) AS i GROUP BY c_custkey HAVING count(*) > 1)""")
def m10(spark, d):
    return cdc.history_audit(stage(cdc.scd2(_events(spark, d), KEYS, SEQ), "history"), KEYS)


@case("m10_original_and_modified", f"""
SELECT c_custkey, arg_min(c_name, seq) AS old_name, arg_max(c_name, seq) AS new_name, arg_min(record_type, seq) AS old_type, arg_max(record_type, seq) AS new_type,
  arg_max(c_acctbal, seq) - arg_min(c_acctbal, seq) AS gained FROM ({CHANGES_SQL}) AS e GROUP BY c_custkey HAVING count(DISTINCT seq) > 1""")
def m10_listing(spark, d):
    """What changed customers looked like at first and look like now."""
    pairs = cdc.original_and_modified(_events(spark, d), KEYS, SEQ)
    return pairs.select("c_custkey", F.col("original.c_name").alias("old_name"), F.col("modified.c_name").alias("new_name"),
                        F.col("original.record_type").alias("old_type"), F.col("modified.record_type").alias("new_type"),
                        (F.col("modified.c_acctbal") - F.col("original.c_acctbal")).alias("gained"))


PRICES_SQL = f"""
SELECT c_custkey, c_acctbal, TIMESTAMP '1995-01-01 00:00:00' + to_days(CAST(seq * 400 AS INT)) AS since FROM ({CHANGES_SQL}) AS ev"""


@case("m11_as_of_join", f"""
WITH v AS (SELECT c_custkey, c_acctbal, since AS s, lead(since) OVER (PARTITION BY c_custkey ORDER BY since) AS t FROM ({PRICES_SQL}) AS p WHERE c_custkey % 17 <> 0 OR since > TIMESTAMP '1996-01-01 00:00:00')
SELECT o_orderkey, o_custkey, c_acctbal AS balance_then FROM orders LEFT JOIN v ON o_custkey = c_custkey AND o_orderdate >= s AND (t IS NULL OR o_orderdate < t)""")
def m11(spark, d):
    """Orders with the balance that was valid then; some customers start later."""
    at = F.timestamp_add("DAY", F.col("seq") * 400, F.lit("1995-01-01").cast("timestamp_ntz"))
    versions = (_events(spark, d).select(F.col("c_custkey").alias("o_custkey"), F.col("c_acctbal").alias("balance_then"), at.alias("at"))
                .filter((F.col("o_custkey") % 17 != 0) | (F.col("at") > F.lit("1996-01-01").cast("timestamp_ntz"))))
    facts = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    hot = w.hot_keys(facts.select("o_custkey").unionByName(versions.select("o_custkey")), ["o_custkey"])
    history = cdc.scd2(versions, ["o_custkey"], ["at"], hot=hot)
    return cdc.as_of_join(facts, history, ["o_custkey"], "o_orderdate", ["balance_then"], hot).drop("o_orderdate")


# ---- histories that grow by the batch --------------------------------------------------------------


def _grown(spark, events, **options):
    """Events in four batches, late ones among them, into a history of few, splitting buckets."""
    source, seq = scratch_path(spark, "events"), F.col("seq")
    batch = F.when(seq <= 1, 0).when(seq.isin(3, 4), 1).when(seq == 2, 2).otherwise(3)  # sequence 2 comes late
    events.withColumn("_batch", batch).write.partitionBy("_batch").parquet(source)
    schema = spark.read.parquet(source).drop("_batch").schema
    history = KeyedHistory(spark, scratch_path(spark, "history"), schema, KEYS, SEQ, first=2, bucket_rows=300, **options)
    checkpoint = scratch_path(spark, "checkpoint")
    for arrived in ("0", "[0-1]", "[0-2]", "[0-3]"):
        stream = flows.file_stream(spark, f"{source}/_batch={arrived}", "parquet", schema)
        flows.drain(history_flow(stream, history, checkpoint))
    return history


@case("m02_growing_history", SCD2_SQL)
def m02_growing(spark, d):
    """Type 2 over chain ends by bucket: on-time events go on from them, late ones read the log."""
    return _grown(spark, _events(spark, d)).versions()


@case("m03_growing_current_with_deletes", M03_SQL)
def m03_growing(spark, d):
    return _grown(spark, _with_ops(spark, d), delete_when="op = 'DELETE'").current()


@case("m04_growing_current_with_truncate", M04_SQL)
def m04_growing(spark, d):
    """A truncate event is a mark that older rows are measured by; no bucket is built anew."""
    return _grown(spark, _with_truncate(spark, d), truncate_when="op = 'TRUNCATE'").current().drop("op")
