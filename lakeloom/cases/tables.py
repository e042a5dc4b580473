"""Table changes, versions, time travel and change feeds."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lakeloom.cases.registry import case, plain
from lakeloom.operators import changes as ch
from lakeloom.operators import digests as dg
from lakeloom.operators import quality as q
from lakeloom.operators import snapshots as sn
from lakeloom.operators.changes import When
from lakeloom.session import scratch_path, stage, table

COLUMNS = ["c_custkey", "c_name", "c_acctbal", "c_mktsegment"]
T0, T1, T2, T3 = ("2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-03 00:00:00", "2024-01-20 00:00:00")


def _customers(spark, d):
    return table(spark, d, "customer").select(*COLUMNS)


def _four_versions(spark, d):
    """Copies in plain folders: create even keys, insert odd keys, update one segment, delete
    every tenth key.  Returns the root."""
    c, root = _customers(spark, d), scratch_path(spark, "versions")
    newest = lambda: sn.read(spark, root)
    sn.write(c.filter("c_custkey % 2 = 0"), root, "CREATE", T0)
    sn.write(ch.insert(newest(), c.filter("c_custkey % 2 = 1")), root, "INSERT", T1)
    sn.write(ch.update(newest(), {"c_acctbal": "c_acctbal + 1"}, "c_mktsegment = 'BUILDING'"), root, "UPDATE", T2)
    sn.write(ch.delete(newest(), "c_custkey % 10 = 0"), root, "DELETE", T3)
    return root


@case("l01_versioned_write", """
SELECT 0 AS version, 'CREATE' AS operation, (SELECT count(*) FROM customer WHERE c_custkey % 2 = 0) AS rows_written, 0 AS rows_matched
UNION ALL SELECT 1, 'INSERT', (SELECT count(*) FROM customer WHERE c_custkey % 2 = 1), 0
UNION ALL SELECT 2, 'UPDATE', (SELECT count(*) FROM customer), (SELECT count(*) FROM customer WHERE c_mktsegment = 'BUILDING')
UNION ALL SELECT 3, 'DELETE', (SELECT count(*) FROM customer WHERE c_custkey % 10 <> 0), (SELECT count(*) FROM customer WHERE c_custkey % 10 = 0)""")
def l01(spark, d):
    """Rows each write added or rewrote, and rows its condition met, from copy to copy."""
    root = _four_versions(spark, d)
    kinds = sn.changes(spark, root, 1, key=["c_custkey"]).groupBy(F.col("_commit_version").alias("version")).agg(
        F.count_if(F.col("_change_type") == "insert").alias("inserted"),
        F.count_if(F.col("_change_type").isin("update_preimage", "delete")).alias("rows_matched"))
    sizes = None
    for version in range(4):
        size = sn.read(spark, root, version).agg(F.lit(version).cast("bigint").alias("version"), F.count(F.lit(1)).alias("n"))
        sizes = size if sizes is None else sizes.unionByName(size)
    told = sn.history(spark, root).join(sizes, "version").join(kinds, "version", "left")
    matched = F.coalesce("rows_matched", F.lit(0))
    return told.select("version", "operation", F.when(F.col("inserted") > 0, F.col("inserted")).otherwise(F.col("n")).alias("rows_written"),
                       matched.alias("rows_matched"))


@case("l02_insert", """
SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer UNION ALL SELECT c_custkey + 1000000, c_name, NULL, 'NEW' FROM customer WHERE c_custkey % 7 = 0""")
def l02(spark, d):
    """Partial column list: a default for one column, null for the other."""
    c = _customers(spark, d)
    extra = c.filter("c_custkey % 7 = 0").select((F.col("c_custkey") + 1000000).alias("c_custkey"), "c_name")
    return ch.insert(c, extra, {"c_mktsegment": "NEW"})


@case("l03_update", """
SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'P' AND o_totalprice > 100000 THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
  CASE WHEN o_orderstatus = 'P' AND o_totalprice > 100000 THEN o_totalprice + 10 ELSE o_totalprice END AS o_totalprice FROM orders""")
def l03(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return ch.update(rows, {"o_orderstatus": "'F'", "o_totalprice": "o_totalprice + 10"}, "o_orderstatus = 'P' AND o_totalprice > 100000")


@case("l04_delete", """
SELECT o_orderkey, CASE WHEN o_orderkey % 97 <> 0 THEN o_custkey END AS o_custkey FROM orders WHERE o_orderkey % 97 = 0 OR o_custkey <> 5""")
def l04(spark, d):
    """Rows whose condition is null stay."""
    rows = table(spark, d, "orders").selectExpr("o_orderkey", "CASE WHEN o_orderkey % 97 <> 0 THEN o_custkey END AS o_custkey")
    return ch.delete(rows, "o_custkey = 5")


@case("l05_truncate", """
SELECT count(*) AS before_rows, 0 AS after_rows, 4 AS after_columns FROM customer""")
def l05(spark, d):
    """The folder keeps its columns and loses its rows."""
    path = scratch_path(spark, "truncated")
    _customers(spark, d).write.parquet(path)
    before = stage(spark.read.parquet(path).agg(F.count(F.lit(1)).alias("before_rows")))
    stage(ch.truncate(spark.read.parquet(path))).write.mode("overwrite").parquet(path)
    after = spark.read.parquet(path)
    return before.withColumn("after_rows", after.agg(F.count(F.lit(1)).alias("n")).scalar()).withColumn("after_columns", F.lit(len(after.columns)))


MERGE_SQL = """
SELECT t.c_custkey, t.c_name, CASE WHEN s.k IS NOT NULL AND s.bal > 0 THEN s.bal ELSE t.c_acctbal END AS c_acctbal,
  CASE WHEN s.k IS NOT NULL AND s.bal > 0 THEN 'MERGED' ELSE t.c_mktsegment END AS c_mktsegment
FROM customer t LEFT JOIN (SELECT c_custkey AS k, round(c_acctbal - 500, 2) AS bal FROM customer WHERE c_custkey % 3 = 0) s ON t.c_custkey = s.k
WHERE t.c_custkey % 2 = 0 AND NOT (s.k IS NOT NULL AND s.bal <= 0) AND NOT (s.k IS NULL AND t.c_mktsegment = 'MACHINERY')
UNION ALL SELECT c_custkey, c_name, round(c_acctbal - 500, 2), c_mktsegment FROM customer WHERE c_custkey % 3 = 0 AND c_custkey % 2 = 1"""

CLAUSES = [
    When("matched", "delete", "s.c_acctbal <= 0"),
    When("matched", "update", values={"c_acctbal": "s.c_acctbal", "c_mktsegment": "'MERGED'"}),
    When("not_matched", "insert"),
    When("not_matched_by_source", "delete", "t.c_mktsegment = 'MACHINERY'"),
]


def _merge_sides(spark, d):
    c = _customers(spark, d)
    source = c.filter("c_custkey % 3 = 0").withColumn("c_acctbal", F.round(F.col("c_acctbal") - 500, 2))
    return c.filter("c_custkey % 2 = 0"), source


@case("l06_merge", MERGE_SQL)
def l06(spark, d):
    target, source = _merge_sides(spark, d)
    return ch.merge(target, source, ["c_custkey"], CLAUSES)


@case("l06_merge_versioned", MERGE_SQL)
def l06_versioned(spark, d):
    target, source = _merge_sides(spark, d)
    path = scratch_path(spark, "merged")
    ch.write_buckets(target, path, ["c_custkey"], 4)
    assert ch.merge_buckets(path, source, ["c_custkey"], CLAUSES, 4) == [0, 1, 2, 3]
    return spark.read.parquet(path).drop(ch.BUCKET)


@case("l06_merge_upsert_parts", """
SELECT c_custkey, CASE WHEN c_custkey % 12 = 0 THEN 'UPSERTED' ELSE c_name END AS c_name, c_acctbal, c_mktsegment FROM customer
UNION ALL SELECT c_custkey + 1000000, 'UPSERTED', c_acctbal, c_mktsegment FROM customer WHERE c_custkey % 12 = 0""")
def l06_upsert(spark, d):
    """SET * / INSERT *; only buckets that the source's keys fall into are rewritten."""
    c, path = _customers(spark, d), scratch_path(spark, "upserted")
    ch.write_buckets(c, path, ["c_custkey"], 64)
    hit = c.filter("c_custkey % 12 = 0").withColumn("c_name", F.lit("UPSERTED"))
    both = hit.unionByName(hit.withColumn("c_custkey", F.col("c_custkey") + 1000000))
    ch.merge_buckets(path, both, ["c_custkey"], [When("matched", "update"), When("not_matched", "insert")], 64)
    return spark.read.parquet(path).drop(ch.BUCKET)


@case("l07_read_as_of", """
SELECT 'version 0' AS asked, count(*) AS n, round(sum(c_acctbal), 2) AS total FROM customer WHERE c_custkey % 2 = 0
UNION ALL SELECT 'time 2', count(*), round(sum(c_acctbal), 2) FROM customer
UNION ALL SELECT 'newest', count(*), round(sum(c_acctbal + CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END), 2) FROM customer WHERE c_custkey % 10 <> 0""")
def l07(spark, d):
    root = _four_versions(spark, d)
    asked = [("version 0", sn.read(spark, root, 0)), ("time 2", sn.read(spark, root, at="2024-01-02 12:00:00")), ("newest", sn.read(spark, root))]
    rows = [df.agg(F.lit(n).alias("asked"), F.count(F.lit(1)).alias("n"), F.round(F.sum("c_acctbal"), 2).alias("total")) for n, df in asked]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@case("l08_restore", """
SELECT c_custkey, c_name, c_acctbal + CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS c_acctbal, c_mktsegment FROM customer""")
def l08(spark, d):
    """Back to the version before the last delete, found in the history."""
    root = _four_versions(spark, d)
    assert sn.restore(spark, root, sn.last_before(spark, root, "DELETE")) == 4
    return sn.read(spark, root)


FEED_SQL = """
SELECT c_custkey, c_acctbal, 'insert' AS change, 1 AS version FROM customer WHERE c_custkey % 2 = 1
UNION ALL SELECT c_custkey, c_acctbal, 'update_preimage', 2 FROM customer WHERE c_mktsegment = 'BUILDING'
UNION ALL SELECT c_custkey, c_acctbal + 1, 'update_postimage', 2 FROM customer WHERE c_mktsegment = 'BUILDING'
UNION ALL SELECT c_custkey, c_acctbal + CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END, 'delete', 3 FROM customer WHERE c_custkey % 10 = 0"""


def _feed(df):
    return df.select("c_custkey", "c_acctbal", F.col("_change_type").alias("change"), F.col("_commit_version").alias("version"))


@case("l09_change_feed", FEED_SQL)
def l09(spark, d):
    return _feed(sn.changes(spark, _four_versions(spark, d), 1, key=["c_custkey"]))


@case("l09_change_feed_range", f"SELECT * FROM ({FEED_SQL}) AS f WHERE version BETWEEN 2 AND 2")
def l09_range(spark, d):
    return _feed(sn.changes(spark, _four_versions(spark, d), 2, 2, key=["c_custkey"]))


@case("l09_bucket_digests", """
SELECT c_custkey, c_acctbal, 'update_preimage' AS change, true AS bounded FROM customer WHERE c_custkey <= 10 AND c_custkey > 0
UNION ALL SELECT c_custkey, c_acctbal + 1, 'update_postimage', true FROM customer WHERE c_custkey <= 10 AND c_custkey > 0
UNION ALL SELECT c_custkey, c_acctbal, 'delete', true FROM customer WHERE c_custkey = 13
UNION ALL SELECT -5, c_acctbal, 'insert', true FROM customer WHERE c_custkey = 14""")
def l09_digests(spark, d):
    """A dozen changed rows between two whole copies: digests tell the few buckets that are joined."""
    customers, old, new = _customers(spark, d), scratch_path(spark, "copy"), scratch_path(spark, "copy")
    changed = ch.update(customers.filter("c_custkey <> 13"), {"c_acctbal": "c_acctbal + 1"}, "c_custkey <= 10 AND c_custkey > 0")
    changed = changed.unionByName(customers.filter("c_custkey = 14").withColumn("c_custkey", F.lit(-5).cast("bigint")))
    dg.write_copy(customers, old, ["c_custkey"], 128)
    dg.write_copy(changed, new, ["c_custkey"], 128)
    unlike = dg.changed_buckets(spark, old, new)
    return dg.feed(spark, old, new, ["c_custkey"]).select(
        "c_custkey", "c_acctbal", F.col("_change_type").alias("change"), F.lit(0 < len(unlike) <= 12).alias("bounded"))


@case("l09_multiset_diff", """
WITH a AS (SELECT l_partkey, l_returnflag, count(*) AS n FROM lineitem WHERE l_quantity < 30 GROUP BY 1, 2),
     b AS (SELECT l_partkey, l_returnflag, count(*) AS n FROM lineitem WHERE l_quantity > 10 GROUP BY 1, 2)
SELECT l_partkey, l_returnflag, CASE WHEN coalesce(b.n, 0) > coalesce(a.n, 0) THEN 'insert' ELSE 'delete' END AS change,
  abs(coalesce(b.n, 0) - coalesce(a.n, 0)) AS copies FROM a FULL JOIN b USING (l_partkey, l_returnflag) WHERE coalesce(b.n, 0) <> coalesce(a.n, 0)""")
def l09_multiset(spark, d):
    """Tables without a key differ as multisets."""
    lines = table(spark, d, "lineitem")
    old, new = (lines.filter(c).select("l_partkey", "l_returnflag") for c in ("l_quantity < 30", "l_quantity > 10"))
    return ch.changes_between(old, new).groupBy("l_partkey", "l_returnflag", F.col("_change_type").alias("change")).agg(
        F.count(F.lit(1)).alias("copies"))


@case("l10_incremental_consumption", """
SELECT c_custkey, c_acctbal, 'a' || CAST(c_custkey AS VARCHAR) AS tag FROM customer WHERE c_custkey % 2 = 1
UNION ALL SELECT c_custkey, c_acctbal + 1, 'a' || CAST(c_custkey AS VARCHAR) FROM customer WHERE c_mktsegment = 'BUILDING'""")
def l10(spark, d):
    """Consumer that had processed version 0: inserts and new versions after it, transformed."""
    feed = sn.changes(spark, _four_versions(spark, d), 0 + 1, key=["c_custkey"])
    return ch.upserts(feed).select("c_custkey", "c_acctbal", F.concat(F.lit("a"), F.col("c_custkey").cast("string")).alias("tag"))


@case("l11_deep_clone", """
SELECT 'source' AS side, count(*) AS n FROM customer WHERE c_custkey % 10 <> 0
UNION ALL SELECT 'clone of version 0', count(*) + 1 FROM customer WHERE c_custkey % 2 = 0""")
def l11(spark, d):
    root, copy = _four_versions(spark, d), scratch_path(spark, "clone")
    first = sn.read(spark, root, 0)
    sn.write(first, copy, "CLONE")
    sn.write(ch.insert(sn.read(spark, copy), first.orderBy("c_custkey").limit(1)), copy, "INSERT")  # does not reach the source
    count = lambda df, n: df.agg(F.lit(n).alias("side"), F.count(F.lit(1)).alias("n"))
    return count(sn.read(spark, root), "source").unionByName(count(sn.read(spark, copy), "clone of version 0"))


@case("l12_shallow_clone", "SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer")
def l12(spark, d):
    """A view of version 1; later commits do not show."""
    name = scratch_path(spark, "clone").rsplit("/", 1)[1].replace("-", "_")
    sn.read(spark, _four_versions(spark, d), 1).createOrReplaceTempView(name)
    return spark.table(name)


@case("l13_retention", """
SELECT v AS version, o AS operation FROM (VALUES (0, 'CREATE'), (1, 'INSERT'), (2, 'UPDATE')) AS x(v, o) WHERE (SELECT count(*) FROM customer) > 0""")
def l13(spark, d):
    """Versions older than seven days on the 21st; the current one stays."""
    root = _four_versions(spark, d)
    listed = stage(sn.expirable(spark, root, "2024-01-21 00:00:00").select("version", "operation"))
    assert sn.expire(spark, root, "2024-01-21 00:00:00") == [0, 1, 2]
    assert sn.read(spark, root).limit(1).count() == 1
    return listed


@case("l13_what_is_left", """
SELECT 'read' AS how, c_custkey, c_acctbal + CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS c_acctbal FROM customer WHERE c_custkey % 10 <> 0
UNION ALL SELECT 'version 1', count(*) FILTER (WHERE false), NULL FROM customer""")
def l13_left(spark, d):
    """After expiry the newest rows can be read; an expired version cannot, and a shallow clone of it,
    which held no rows of its own, breaks."""
    root = _four_versions(spark, d)
    clone = scratch_path(spark, "clone").rsplit("/", 1)[1].replace("-", "_")
    sn.read(spark, root, 1).createOrReplaceTempView(clone)
    whole = spark.table(clone).count()
    sn.expire(spark, root, "2024-01-21 00:00:00")
    found = 0
    for reader in (lambda: sn.read(spark, root, 1), lambda: spark.table(clone).withColumn("again", F.lit(whole))):
        try:
            found += len(reader().collect())
        except (sn.NoSnapshot, PySparkException, Py4JJavaError):
            pass
    left = sn.read(spark, root).select(F.lit("read").alias("how"), "c_custkey", "c_acctbal")
    return left.unionByName(spark.range(1).select(F.lit("version 1").alias("how"), F.lit(found).cast("bigint").alias("c_custkey"), F.lit(None).cast("double").alias("c_acctbal")))


@case("l14_history_and_detail", """
SELECT 4 AS versions, 'DELETE' AS newest, (SELECT count(*) FROM customer WHERE c_custkey % 10 <> 0) AS num_rows, true AS sized""")
def l14(spark, d):
    root = _four_versions(spark, d)
    newest = sn.history(spark, root).agg(F.count(F.lit(1)).alias("versions"), F.max_by("operation", "version").alias("newest"))
    detail = sn.detail(spark, root)
    return newest.withColumn("num_rows", detail.select("num_rows").scalar()).withColumn(
        "sized", detail.select((F.col("size_in_bytes") > 0) & (F.col("num_files") > 0)).scalar())


@case("l15_identity_column", """
SELECT count(*) AS row_count, count(*) AS identities, true AS above_old FROM orders""")
def l15(spark, d):
    """Numbers continue above the largest used one; unique, gaps allowed."""
    orders = table(spark, d, "orders").select("o_orderkey")
    old = stage(ch.with_identity(orders.filter("o_orderkey % 3 = 0"), "row_id"))
    top = old.agg(F.max("row_id")).first()[0]
    new = ch.with_identity(orders.filter("o_orderkey % 3 <> 0"), "row_id", above=top)
    both = old.withColumn("new", F.lit(False)).unionByName(new.withColumn("new", F.lit(True)))
    return both.agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct("row_id").alias("identities"),
                    (F.min(F.when(F.col("new"), F.col("row_id"))) > F.max(F.when(~F.col("new"), F.col("row_id")))).alias("above_old"))


@case("l16_generated_column", """
SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS event_date, user_id % 10 AS bucket FROM events""")
def l16(spark, d):
    rows = ch.with_generated(table(spark, d, "events"), {"event_date": "CAST(ts AS DATE)", "bucket": "user_id % 10"})
    return plain(stage(rows, "generated").select("event_id", "event_date", "bucket"))


@case("l17_append_log", """
SELECT event_id, event_type, CAST(ts AS VARCHAR) AS ts, false AS processed FROM events ORDER BY events.ts DESC, event_id DESC LIMIT 5""")
def l17(spark, d):
    """Signals appended in two batches; the five newest."""
    events, log = table(spark, d, "events"), scratch_path(spark, "log")
    rows = events.select("event_id", "event_type", "ts", F.lit(False).alias("processed"))
    for part in (0, 1):
        q.append_checked(rows.filter(F.col("event_id") % 2 == part), log)
    return plain(spark.read.parquet(log).orderBy(F.desc("ts"), F.desc("event_id")).limit(5))
