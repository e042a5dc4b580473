"""Sources, scans and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.cases.inputs import CHANGES_SQL, STEPS, landing
from lakeloom.cases.registry import case, plain
from lakeloom.session import scratch_path, stage, table
from lakeloom.sources import dirty, generators, incremental, ordered, readers, writers
from lakeloom.streaming import flows


def _write(df, fmt: str, **options) -> str:
    path = scratch_path(df.sparkSession, fmt)
    df.write.format(fmt).options(**options).save(path)
    return path


@case("a01_csv_inferred", "SELECT * FROM part")
def a01(spark, d):
    return readers.read_csv(spark, _write(table(spark, d, "part"), "csv", header=True))


@case("a02_csv_schema_by_name", "SELECT c_mktsegment, c_custkey, c_acctbal, c_name FROM customer")
def a02(spark, d):
    path = _write(table(spark, d, "customer"), "csv", header=True)
    return readers.read_csv(spark, path, "c_mktsegment string, c_custkey bigint, c_acctbal double, c_name string")


@case("a02_mixed_headers", "SELECT c_custkey, c_acctbal, CASE WHEN c_custkey % 3 <> 2 THEN c_name END AS c_name FROM customer")
def a02_mixed(spark, d):
    """Files list their columns in different orders; one kind lacks a column."""
    customers, path = table(spark, d, "customer"), scratch_path(spark, "headers")
    for n, columns in enumerate((["c_custkey", "c_name", "c_acctbal"], ["c_acctbal", "c_custkey", "c_name"], ["c_acctbal", "c_custkey"])):
        customers.filter(F.col("c_custkey") % 3 == n).select(*columns).write.mode("append").option("header", True).csv(path)
    return readers.read_csv(spark, path, "c_custkey bigint, c_acctbal double, c_name string")


@case("a03_csv_dialect", """
SELECT o_orderkey, CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_custkey END AS o_custkey,
       CASE WHEN o_orderkey % 89 = 0 THEN '<empty>' ELSE o_orderpriority || '; "x"' END AS note,
       CAST(o_orderdate AS VARCHAR) AS o_orderdate FROM orders""")
def a03(spark, d):
    rows = table(spark, d, "orders").selectExpr(
        "o_orderkey", "CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_custkey END AS o_custkey",
        """CASE WHEN o_orderkey % 89 = 0 THEN '' ELSE o_orderpriority || '; "x"' END AS note""", "o_orderdate")
    dialect = dict(header=True, sep=";", quote='"', escape='"', nullValue="NA",
                   timestampNTZFormat="dd/MM/yyyy HH:mm:ss", encoding="UTF-8")
    path = _write(rows, "csv", **dialect)
    return plain(readers.read_csv(
        spark, path, "o_orderkey bigint, o_custkey bigint, note string, o_orderdate timestamp_ntz", by_name=False,
        **dialect, emptyValue="<empty>", comment="#", ignoreLeadingWhiteSpace=True, maxColumns=20, mode="FAILFAST"))


@case("a04_json_inferred", "SELECT event_id, user_id, event_type, value, props, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS ts FROM events")
def a04(spark, d):
    """Times arrive as text in JSON and are inferred as such."""
    events = table(spark, d, "events")
    return readers.read_json(spark, _write(events.withColumn("ts", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")), "json"))


@case("a05_json_partial_schema", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def a05(spark, d):
    path = _write(table(spark, d, "orders"), "json")
    return readers.read_json(spark, path, "o_orderkey bigint, o_custkey bigint, o_totalprice double")


@case("a06_json_dialect", """
SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(value AS VARCHAR) AS value, event_type FROM events""")
def a06(spark, d):
    path = _write(table(spark, d, "events").select("event_id", "value", "event_type", F.lit(None).cast("string").alias("gone")),
                  "json", ignoreNullFields=False)
    return readers.read_json(spark, path, primitivesAsString=True, dropFieldIfAllNull=True, allowComments=True,
                             allowSingleQuotes=True, allowNumericLeadingZeros=True, allowNonNumericNumbers=True)


@case("a07_parquet_scan", """
SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_shipdate >= DATE '1999-01-01' AND l_quantity < 10""")
def a07(spark, d):
    return readers.read_parquet(spark, f"{d}/lineitem.parquet").filter(
        (F.col("l_shipdate") >= F.lit("1999-01-01").cast("timestamp_ntz")) & (F.col("l_quantity") < 10)
    ).select("l_orderkey", "l_linenumber", "l_extendedprice")


@case("a08_path_query", "SELECT c_mktsegment, count(*) AS customers FROM customer GROUP BY c_mktsegment")
def a08(spark, d):
    return readers.query_path(spark, "parquet", f"{d}/customer.parquet").groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("customers"))


@case("a09_read_files", """
SELECT p_brand, count(*) AS parts, round(sum(p_retailprice), 2) AS price, 0 AS without_file FROM part GROUP BY p_brand""")
def a09(spark, d):
    path = _write(table(spark, d, "part"), "csv", header=True)
    return readers.read_files(spark, f"{path}/*.csv", "csv").groupBy("p_brand").agg(
        F.count(F.lit(1)).alias("parts"), F.round(F.sum("p_retailprice"), 2).alias("price"),
        F.count_if(F.col("source_file_name").isNull()).alias("without_file"))


@case("a10_file_provenance", "SELECT count(*) AS row_count, count(*) AS with_path, count(*) AS with_load_ts FROM orders")
def a10(spark, d):
    return readers.with_provenance(table(spark, d, "orders")).agg(
        F.count(F.lit(1)).alias("row_count"), F.count("source_file_path").alias("with_path"),
        F.count("load_ts").alias("with_load_ts"))


@case("a12_managed_write", "SELECT * FROM supplier UNION ALL SELECT * FROM supplier WHERE s_suppkey % 2 = 0")
def a12(spark, d):
    name = f"{writers.create_database(spark)}.supplier"
    suppliers = table(spark, d, "supplier")
    writers.save_managed(suppliers, name)
    writers.save_managed(suppliers.filter("s_suppkey % 2 = 0"), name, "append")
    return spark.table(name)


@case("a13_external_write", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def a13(spark, d):
    path, name = scratch_path(spark, "external"), f"{writers.create_database(spark)}.nation"
    writers.save_external(table(spark, d, "nation"), path, name)
    spark.sql(f"DROP TABLE {name}")
    return readers.read_parquet(spark, path)  # the files outlive the table


@case("a14_create_table_as", """
SELECT o_orderkey, upper(o_orderpriority) AS priority, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_date,
       date_diff('day', CAST(o_orderdate AS DATE), DATE '2002-01-01') AS age_days FROM orders WHERE o_custkey IS NOT NULL""")
def a14(spark, d):
    name = f"{writers.create_database(spark)}.orders_typed"
    select = f"""SELECT o_orderkey, upper(o_orderpriority) AS priority, to_date(o_orderdate) AS order_date,
        datediff(DATE'2002-01-01', to_date(o_orderdate)) AS age_days
        FROM parquet.`{d}/orders.parquet` WHERE o_custkey IS NOT NULL"""
    writers.create_table_as(spark, name, select)
    writers.create_table_as(spark, name, select)  # a rerun replaces, it does not add
    return plain(spark.table(name))


def _dirty_csv(spark, d) -> str:
    return _write(table(spark, d, "orders").selectExpr(
        "o_orderkey", "CASE WHEN o_orderkey % 97 = 0 THEN 'NOT_A_DATE' ELSE date_format(o_orderdate, 'yyyy-MM-dd') END AS order_date",
        "o_totalprice"), "csv", header=True)


DIRTY_SCHEMA = "o_orderkey bigint, order_date date, o_totalprice double"


@case("a15_parse_modes", """
SELECT 'PERMISSIVE' AS parse_mode, count(*) AS row_count, sum(CASE WHEN o_orderkey % 97 = 0 THEN 1 ELSE 0 END) AS corrupt FROM orders
UNION ALL SELECT 'DROPMALFORMED', count(*), 0 FROM orders WHERE o_orderkey % 97 <> 0""")
def a15(spark, d):
    path = _dirty_csv(spark, d)
    kept = dirty.read_with_mode(spark, path, "csv", DIRTY_SCHEMA).agg(
        F.lit("PERMISSIVE").alias("parse_mode"), F.count("o_orderkey").alias("row_count"), F.count(dirty.CORRUPT).alias("corrupt"))
    dropped = dirty.read_with_mode(spark, path, "csv", DIRTY_SCHEMA, "DROPMALFORMED").agg(
        F.lit("DROPMALFORMED").alias("parse_mode"), F.count("o_orderkey").alias("row_count"), F.lit(0).cast("bigint").alias("corrupt"))
    return kept.unionByName(dropped)


@case("a16_bad_record_output", """
SELECT o_orderkey, o_orderkey % 97 = 0 AS is_bad FROM orders""")
def a16(spark, d):
    bad_path = scratch_path(spark, "bad")
    good = dirty.split_bad_records(spark, _dirty_csv(spark, d), "csv", DIRTY_SCHEMA, bad_path)
    bad = dirty.read_bad_records(spark, bad_path)
    key = F.split("record", ",").getItem(0).cast("bigint")
    return good.select("o_orderkey", F.lit(False).alias("is_bad")).unionByName(
        bad.select(key.alias("o_orderkey"), F.lit(True).alias("is_bad")))


@case("a17_rescued_data", """
SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice,
       CASE WHEN o_orderkey % 97 = 0 AND o_orderkey % 89 = 0 THEN '{"o_totalprice":"INVALID_NUMBER","new_col":"x"}'
            WHEN o_orderkey % 97 = 0 THEN '{"o_totalprice":"INVALID_NUMBER"}'
            WHEN o_orderkey % 89 = 0 THEN '{"new_col":"x"}' END AS _rescued_data
FROM orders""")
def a17(spark, d):
    path = _write(table(spark, d, "orders").selectExpr(
        "o_orderkey", "o_custkey",
        "CASE WHEN o_orderkey % 97 = 0 THEN 'INVALID_NUMBER' ELSE CAST(o_totalprice AS STRING) END AS o_totalprice",
        "CASE WHEN o_orderkey % 89 = 0 THEN 'x' END AS new_col"), "json")
    return dirty.rescue_json(spark.read.text(path), "o_orderkey bigint, o_custkey bigint, o_totalprice double")


@case("a17_rescued_csv", """
SELECT p_partkey, p_retailprice, '{"p_name":"' || p_name || '"}' AS _rescued_data FROM part""")
def a17_csv(spark, d):
    path = _write(table(spark, d, "part").select("p_partkey", "p_name", "p_retailprice"), "csv", header=True)
    return dirty.rescue_csv(spark, path, "p_partkey bigint, p_retailprice double")


@case("a18_copy_into", """
SELECT CASE WHEN o_orderkey % 4 = 0 THEN 1 WHEN o_orderkey % 4 < 3 THEN 2 ELSE 3 END AS load_id, count(*) AS row_count,
       round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1""")
def a18(spark, d):
    """First load, no-op rerun, three more files (two loads), no-op rerun."""
    source = landing(spark, table(spark, d, "orders"), "o_orderkey", 4)
    target = scratch_path(spark, "copied")
    args = dict(fmt="json", select=["o_orderkey", "o_totalprice"])
    assert incremental.copy_into(spark, target, f"{source}/_batch=0", **args) == 1
    assert incremental.copy_into(spark, target, f"{source}/_batch=0", **args) == -1
    assert incremental.copy_into(spark, target, f"{source}/_batch=[0-2]", **args) == 2
    assert incremental.copy_into(spark, target, f"{source}/_batch=*", **args) == 3
    assert incremental.copy_into(spark, target, f"{source}/_batch=*", **args) == -1
    return incremental.read_loaded(spark, target).groupBy("load_id").agg(
        F.count(F.lit(1)).alias("row_count"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@case("a18_ordered_load", """
SELECT CASE WHEN o_orderdate < TIMESTAMP '1997-01-01' THEN 1 WHEN o_orderkey % 5 = 0 THEN 3 ELSE 2 END AS load_id, count(*) AS row_count,
       round(sum(o_totalprice), 2) AS total, true AS tail_only FROM orders GROUP BY 1""")
def a18_ordered(spark, d):
    """Files in folders by month: the first load takes all up to 1996, the next ones list the newest
    months alone, files that come late to the last months among them."""
    orders, source, target = table(spark, d, "orders"), scratch_path(spark, "monthly"), scratch_path(spark, "copied")
    rows = orders.select("o_orderkey", "o_totalprice", F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    put = lambda df: df.repartition("month").write.mode("append").partitionBy("month").json(source)
    load = lambda: ordered.load_ordered(spark, target, source, "json", "o_orderkey bigint, o_totalprice double", look_back=1)
    put(rows.filter("month < '1997-01'"))
    first = stage(ordered.tail_files(spark, target, source)[0]).count()
    assert load() == [1] and load() == []
    late = "o_orderkey % 5 = 0"
    put(rows.filter(f"month >= '1997-01' AND NOT {late}"))
    assert load() == [2]
    # late files of the two newest months are found, older folders are not listed any more
    last = sorted(r[0] for r in rows.select("month").distinct().collect())[-2:]
    put(rows.filter(f"month >= '1997-01' AND {late}").withColumn("month", F.lit(last[1])))
    listed = stage(ordered.tail_files(spark, target, source)[0])
    seen = {r["name"] for r in listed.select("name").distinct().collect()}
    assert load() == [3]
    out = ordered.read_ordered(spark, target, "o_orderkey bigint, o_totalprice double, load_id bigint")
    return out.groupBy("load_id").agg(F.count(F.lit(1)).alias("row_count"), F.round(F.sum("o_totalprice"), 2).alias("total")).withColumn(
        "tail_only", F.lit(seen == {f"month={m}" for m in last} and listed.count() < first))


@case("a18_type_change", """
SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN floor(o_totalprice) ELSE o_totalprice END AS price,
  CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_custkey AS VARCHAR) ELSE 'c' || CAST(o_custkey AS VARCHAR) END AS customer FROM orders""")
def a18_types(spark, d):
    """Whole prices and numeric customers in the first load, fractions and texts in the second."""
    orders, source, target = table(spark, d, "orders"), scratch_path(spark, "arriving"), scratch_path(spark, "copied")
    orders.filter("o_orderkey % 2 = 0").select("o_orderkey", F.floor("o_totalprice").alias("price"), F.col("o_custkey").alias("customer")).write.json(f"{source}/1")
    assert incremental.copy_into(spark, target, f"{source}/1", "json") == 1
    orders.filter("o_orderkey % 2 = 1").select("o_orderkey", F.col("o_totalprice").alias("price"), F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("customer")).write.json(f"{source}/2")
    assert incremental.copy_into(spark, target, f"{source}/*", "json") == 2
    return incremental.read_loaded(spark, target).select("o_orderkey", F.col("price").cast("double").alias("price"), "customer")


ORDER_JSON = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderpriority string"


@case("a19_incremental_files", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders""")
def a19(spark, d):
    """Two runs on one checkpoint: half of the files, then the rest."""
    source = landing(spark, table(spark, d, "orders"), "o_orderkey", 4)
    target, checkpoint = scratch_path(spark, "landed"), scratch_path(spark, "checkpoint")
    for arrived in ("[0-1]", "[0-3]", "[0-3]"):
        stream = flows.file_stream(spark, f"{source}/_batch={arrived}", "json", ORDER_JSON)
        flows.drain(flows.append_flow(stream, target, checkpoint))
    return spark.read.schema(ORDER_JSON).parquet(target)


@case("a20_schema_evolution", """
SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 1 THEN o_orderpriority END AS o_orderpriority FROM orders""")
def a20(spark, d):
    """The second arrival has one more column; the first rows are null there."""
    orders, root = table(spark, d, "orders"), scratch_path(spark, "evolving")
    target, state = scratch_path(spark, "evolved"), scratch_path(spark, "state")

    def run():
        stream = flows.evolving_stream(spark, root, "json", state, "addNewColumns")
        flows.drain(flows.append_flow(stream, target, f"{state}/checkpoint"))

    orders.filter("o_orderkey % 2 = 0").select("o_orderkey").write.mode("append").json(root)
    run()
    orders.filter("o_orderkey % 2 = 1").select("o_orderkey", "o_orderpriority").write.mode("append").json(root)
    run()
    return spark.read.schema("o_orderkey bigint, o_orderpriority string").parquet(target)


@case("a20_rescue_stream", """
SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 3 THEN o_custkey END AS o_custkey,
  CASE o_orderkey % 4 WHEN 1 THEN '{"o_orderpriority":"' || o_orderpriority || '"}' WHEN 3 THEN '{"o_custkey":"unknown"}' END AS _rescued_data FROM orders""")
def a20_rescue(spark, d):
    """A running stream keeps its schema; new fields and misfits go to the rescued column."""
    orders, root = table(spark, d, "orders"), scratch_path(spark, "rescued")
    target, state = scratch_path(spark, "evolved"), scratch_path(spark, "state")

    def run():
        stream = flows.evolving_stream(spark, root, "json", state, "rescue")
        flows.drain(flows.append_flow(stream, target, f"{state}/checkpoint"))

    orders.filter("o_orderkey % 2 = 0").select("o_orderkey", "o_custkey").write.mode("append").json(root)
    run()
    orders.filter("o_orderkey % 4 = 1").select("o_orderkey", "o_custkey", "o_orderpriority").write.mode("append").json(root)
    orders.filter("o_orderkey % 4 = 3").select("o_orderkey", F.lit("unknown").alias("o_custkey")).write.mode("append").json(root)
    run()
    return spark.read.schema("o_orderkey bigint, o_custkey bigint, _rescued_data string").parquet(target)


@case("a21_batch_cap", "SELECT count(*) AS row_count, true AS one_file_per_batch FROM orders")
def a21(spark, d):
    source = landing(spark, table(spark, d, "orders"), "o_orderkey", 4)
    target = scratch_path(spark, "capped")
    stream = flows.enrich(flows.file_stream(spark, f"{source}/_batch=*", "json", ORDER_JSON, max_files=1))
    flows.drain(flows.land_batches(stream, target, scratch_path(spark, "checkpoint")))
    return spark.read.parquet(target).agg(
        F.count(F.lit(1)).alias("row_count"),
        (F.count_distinct("source_file_path") == F.count_distinct("batch_id")).alias("one_file_per_batch"))


@case("a22_archive_source", "SELECT o_orderstatus, count(*) AS row_count, true AS archived FROM orders GROUP BY o_orderstatus")
def a22(spark, d):
    """A consumed file moves to the archive after the batch that follows its own."""
    source = landing(spark, table(spark, d, "orders"), "o_orderkey", 2)
    target, done = scratch_path(spark, "archived"), scratch_path(spark, "archive")
    stream = flows.file_stream(spark, f"{source}/_batch=*", "json", ORDER_JSON, max_files=1, archive_to=done)
    flows.drain(flows.append_flow(stream, target, scratch_path(spark, "checkpoint")))
    moved = incremental.list_files(spark, done, "*.json").agg((F.count(F.lit(1)) > 0).alias("archived"))
    return spark.read.schema(ORDER_JSON).parquet(target).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("row_count")).withColumn(
        "archived", moved.scalar())


@case("a23_file_state", """
SELECT count(*) AS row_count, true AS every_file_in_one_batch, true AS times_known FROM orders""")
def a23(spark, d):
    source = landing(spark, table(spark, d, "orders"), "o_orderkey", 3)
    target = scratch_path(spark, "state")
    stream = flows.enrich(flows.file_stream(spark, f"{source}/_batch=*", "json", ORDER_JSON, max_files=1))
    flows.drain(flows.land_batches(stream, target, scratch_path(spark, "checkpoint")))
    report = flows.file_state(spark.read.parquet(target))
    return report.agg(
        F.sum("rows").alias("row_count"),
        (F.count(F.lit(1)) == F.count_distinct("source_file_path")).alias("every_file_in_one_batch"),
        F.bool_and(F.col("commit_time").isNotNull() & F.col("ingestion_ts").isNotNull()).alias("times_known"))


@case("a25_foreach_batch", "SELECT event_type, count(*) AS n, round(sum(value), 2) AS total, CAST(max(ts) AS VARCHAR) AS newest FROM events GROUP BY event_type")
def a25(spark, d):
    events = table(spark, d, "events")
    source, target = scratch_path(spark, "events"), scratch_path(spark, "batches")
    events.write.parquet(source)
    stream = flows.file_stream(spark, source, "parquet", events.schema, max_files=1)
    flows.drain(flows.land_batches(stream, target, scratch_path(spark, "checkpoint")))
    return plain(spark.read.parquet(target).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total"), F.max("ts").alias("newest")))


@case("a26_memory_sink", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def a26(spark, d):
    """Complete mode into the memory sink: five rows, whatever the size of the stream."""
    stream = flows.table_stream(spark, d, "events")
    counts = stream.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    name = scratch_path(spark, "mem").rsplit("/", 1)[1].replace("-", "_")
    flows.drain(flows.in_memory(counts, name, "complete", scratch_path(spark, "checkpoint")))
    return spark.table(name)


@case("a27_views", """
SELECT c_mktsegment, count(*) AS n, round(sum(c_acctbal), 2) AS balance FROM customer WHERE c_acctbal > 0 GROUP BY c_mktsegment""")
def a27(spark, d):
    """Session, global and stored view over one table; the stored one is queried."""
    customers = table(spark, d, "customer")
    base = f"{writers.create_database(spark)}.customer"
    writers.create_views(customers, "v_customer", shared=True)
    writers.save_external(customers, scratch_path(spark, "customer"), base)
    writers.create_permanent_view(spark, f"{base}_rich", f"SELECT * FROM {base} WHERE c_acctbal > 0")
    return spark.sql(f"""SELECT c_mktsegment, count(*) AS n, round(sum(c_acctbal), 2) AS balance FROM {base}_rich
        WHERE c_custkey IN (SELECT c_custkey FROM global_temp.v_customer) GROUP BY c_mktsegment""")


@case("a28_inline_tables", """
SELECT t.tier, count(*) AS customers FROM customer JOIN
  (VALUES ('BUILDING', 'Premium'), ('MACHINERY', 'Premium'), ('HOUSEHOLD', 'Standard')) AS t(segment, tier)
  ON c_mktsegment = t.segment GROUP BY t.tier""")
def a28(spark, d):
    tiers = spark.createDataFrame([("BUILDING", "Premium"), ("MACHINERY", "Premium")], "segment string, tier string").unionAll(
        spark.sql("SELECT * FROM VALUES ('HOUSEHOLD', 'Standard') AS t(segment, tier)"))
    customers = table(spark, d, "customer")
    return customers.join(F.broadcast(tiers), F.col("c_mktsegment") == F.col("segment")).groupBy("tier").agg(
        F.count(F.lit(1)).alias("customers"))


@case("a29_batch_splitter", """
SELECT o_orderkey % 4 AS batch, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1""")
def a29(spark, d):
    return generators.with_batch(table(spark, d, "orders"), "o_orderkey", 4, "batch").groupBy("batch").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@case("a30_filler_rows", """
SELECT o_orderkey AS id, 'CUST' || lpad(CAST(o_orderkey % 1000 AS VARCHAR), 6, '0') AS customer_code,
       CASE o_orderkey % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END AS category,
       CAST(DATE '2024-01-01' + CAST(o_orderkey % 365 AS INT) AS VARCHAR) AS order_date,
       CAST(TIMESTAMP '2024-01-01 00:00:00' + to_seconds(o_orderkey % 86400) AS VARCHAR) AS order_time,
       round((o_orderkey % 997) * 1.25 + 5, 2)::DOUBLE AS amount FROM orders""")
def a30(spark, d):
    return plain(generators.filler_rows(table(spark, d, "orders"), "o_orderkey", ["A", "B", "C"], "2024-01-01", 365))


@case("a31_change_batches", CHANGES_SQL)
def a31(spark, d):
    return generators.change_batches(table(spark, d, "customer"), STEPS)


DIRTY_SQL = """
SELECT o_orderkey, CASE WHEN o_orderkey % 97 <> 0 THEN o_custkey END AS o_custkey, o_orderstatus,
       CASE WHEN o_orderkey % 89 = 0 THEN -999.99 ELSE o_totalprice END AS o_totalprice,
       CASE WHEN o_orderkey % 83 <> 0 THEN o_orderdate END AS o_orderdate, o_orderpriority FROM orders"""


@case("a32_dirty_batches", f"""
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DOUBLE) AS o_totalprice,
       CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority FROM ({DIRTY_SQL}) AS x""")
def a32(spark, d):
    return plain(generators.dirty_orders(table(spark, d, "orders")))
