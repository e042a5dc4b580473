"""File layout and skew."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.cases.inputs import landing
from lakeloom.cases.registry import case
from lakeloom.operators import layout
from lakeloom.session import scratch_path, stage, table


def _lines(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


@case("o01_compaction", "SELECT o_orderkey, o_custkey, o_totalprice, true AS fewer_files FROM orders")
def o01(spark, d):
    """Many small files packed without a shuffle; the rows stay."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    small = landing(spark, orders, "o_orderkey", 16, "parquet")
    packed = layout.compact(spark, small, scratch_path(spark, "packed"))
    files = lambda df: df.select(F.col("_metadata.file_path").alias("f")).agg(F.count_distinct("f")).scalar()
    before, after = files(spark.read.parquet(small)), files(packed)
    return packed.drop("_batch").withColumn("fewer_files", after < before)


@case("o01_compact_versions", "SELECT o_orderkey, o_totalprice FROM orders")
def o01_versions(spark, d):
    """One folder of fifty small files becomes one file; large files stay as they are."""
    path = scratch_path(spark, "parts")
    table(spark, d, "orders").select("o_orderkey", "o_totalprice").repartition(50).write.parquet(path)
    assert layout.compact_folder(spark, path) == (50, 1)
    assert layout.compact_folder(spark, path) == (0, 0)
    return spark.read.parquet(path)


@case("o01_compact_partitioned", "SELECT o_orderkey, o_totalprice, o_orderstatus, 1 AS files FROM orders")
def o01_partitioned(spark, d):
    """Three partitions of twenty small files each, after a run that was stopped between its two
    renames: every partition ends as one file in its own folder."""
    path = scratch_path(spark, "partitions")
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    orders.repartition(20).write.partitionBy("o_orderstatus").parquet(path)
    held = f"{layout._hold(path)}/o_orderstatus%3DF"
    spark.read.parquet(f"{path}/o_orderstatus=F").coalesce(1).write.parquet(f"{held}/new")
    layout._rename(spark, f"{path}/o_orderstatus=F", f"{held}/old")
    layout.recover_compaction(spark, path)
    assert layout.compact_folder(spark, path)[1] == 2  # the third was done before the stop
    files = F.count_distinct(F.col("_metadata.file_path")).alias("files")
    rows = spark.read.parquet(path)
    return rows.join(rows.groupBy("o_orderstatus").agg(files), "o_orderstatus").select("o_orderkey", "o_totalprice", "o_orderstatus", "files")


@case("o02_partition_pruning", """
SELECT o_orderkey, o_totalprice, o_orderstatus, CAST(year(o_orderdate) AS INT) AS order_year FROM orders WHERE year(o_orderdate) = 1998 AND o_orderstatus = 'F'""")
def o02(spark, d):
    path = scratch_path(spark, "partitioned")
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus", F.year("o_orderdate").alias("order_year"))
    layout.write_partitioned(orders, path, ["order_year", "o_orderstatus"])
    return spark.read.parquet(path).filter("order_year = 1998 AND o_orderstatus = 'F'")


POINT_SQL = "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM lineitem WHERE l_partkey BETWEEN 40 AND 60"


@case("o03_z_order", POINT_SQL)
def o03(spark, d):
    """Clustered by part and supplier; only files whose range meets the predicate are read."""
    path = scratch_path(spark, "zorder")
    layout.write_clustered(_lines(spark, d), ["l_partkey", "l_suppkey"], path, 16)
    return layout.read_skipping(spark, path, "l_partkey", 40, 60)


@case("o04_incremental_clustering", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM lineitem")
def o04(spark, d):
    """Every arrival is a folder that is clustered when it comes; earlier ones stay as they are
    and a point query skips files in all of them."""
    lines, root = _lines(spark, d), scratch_path(spark, "clustered")
    for n, part in enumerate(("l_linenumber < 4", "l_linenumber >= 4")):
        layout.write_clustered(lines.filter(part), ["l_partkey"], f"{root}/arrival={n}", 8)
    stats = spark.read.parquet(*[f"{root}/arrival={n}/_stats" for n in (0, 1)])
    hit = layout.files_for(stats, "l_partkey", 50).count()
    assert 0 < hit < stats.count()
    return spark.read.parquet(root).drop("arrival")


@case("o04_recluster_overlap", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, true AS kept_names, true AS bounded FROM lineitem""")
def o04_recluster(spark, d):
    """Seven arrivals, five of them in the upper half of the parts: the files that lie deep there are
    rewritten along the curve, the others keep their names, and a point meets few files afterwards.  A file
    that holds the rows of several rewritten ones counts as that many, as the arrivals' files grow with the table."""
    lines, root = _lines(spark, d), scratch_path(spark, "growing")
    columns, half = ["l_partkey", "l_suppkey"], lines.agg(F.max("l_partkey")).first()[0] // 2
    layout.arrive(lines.filter("l_orderkey % 6 = 0"), root, columns, 4)
    layout.arrive(lines.filter(f"l_orderkey % 6 > 0 AND l_partkey < {half}"), root, columns, 4)
    for n in range(1, 6):
        layout.arrive(lines.filter(f"l_orderkey % 6 = {n} AND l_partkey >= {half}"), root, columns)
    before = stage(layout.cluster_files(spark, root))
    deep = layout.overlap_depth(before, 3).filter("deep").count()
    assert layout.recluster(spark, root, columns, 3, 20_000)[0] == deep < before.count()
    assert layout.recluster(spark, root, columns, 3, 20_000) == (0, 0)
    after = layout.cluster_files(spark, root)
    kept = before.join(after.select("file_path"), "file_path", "left_semi").count()
    point = [files.filter(layout.meets("l_partkey", half + 10)).agg(F.coalesce(F.sum(F.ceil(F.col("rows") / 20_000)), F.lit(0))).first()[0] for files in (after, before)]
    return layout.read_growing(spark, root).drop("_place").withColumns(
        {"kept_names": F.lit(kept == before.count() - deep and kept > 0), "bounded": F.lit(point[0] < point[1])})


@case("o05_file_statistics", "SELECT count(*) AS row_count, min(l_partkey) AS low, max(l_partkey) AS high, true AS skips FROM lineitem")
def o05(spark, d):
    path, lines = scratch_path(spark, "sorted"), _lines(spark, d)
    lines.repartitionByRange(layout.files_for_size(lines, 8), "l_partkey").write.parquet(path)
    stats = layout.file_statistics(spark.read.parquet(path), ["l_partkey"])
    hit = layout.files_for(stats, "l_partkey", 50).agg(F.count(F.lit(1))).scalar()
    return stats.agg(F.sum("rows").alias("row_count"), F.min("min_l_partkey").alias("low"), F.max("max_l_partkey").alias("high"),
                     F.count(F.lit(1)).alias("files")).select("row_count", "low", "high", (hit < F.col("files")).alias("skips"))


@case("o06_layout_comparison", """
SELECT x.layout, count(*) AS rows, round(sum(l_extendedprice), 2) AS total, x.layout <> 'base' AS skips FROM lineitem, (VALUES ('base'), ('z_order'), ('cluster')) AS x(layout) WHERE l_partkey = 42 GROUP BY x.layout""")
def o06(spark, d):
    lines = _lines(spark, d)
    paths = {n: scratch_path(spark, n) for n in ("base", "z_order", "cluster")}
    lines.repartition(8).write.parquet(paths["base"])
    layout.cluster(lines, ["l_partkey", "l_suppkey"], 8).write.parquet(paths["z_order"])
    layout.cluster(lines, ["l_partkey"], 8).write.parquet(paths["cluster"])
    found = layout.compare_layouts(spark, paths, "l_partkey", 42, "l_extendedprice")
    return found.select("layout", "rows", "total", (F.col("files_read") < F.col("files")).alias("skips"))


@case("o07_key_skew_report", """
SELECT o_orderpriority, count(*) AS rows, round(count(*) / (SELECT count(*) FROM orders), 6) AS share FROM orders GROUP BY o_orderpriority""")
def o07(spark, d):
    return layout.key_skew(table(spark, d, "orders"), "o_orderpriority")


@case("o07_dominant_keys", """
SELECT k, count(*) AS rows, round(count(*) / (SELECT count(*) FROM orders)::DOUBLE, 6) AS share
FROM (SELECT CASE WHEN o_orderkey % 3 = 0 THEN 7 WHEN o_orderkey % 20 = 1 THEN NULL ELSE o_custkey END AS k FROM orders) AS o
GROUP BY k HAVING count(*) > floor((SELECT count(*) FROM orders) * 0.02)""")
def o07_dominant(spark, d):
    """A third of the orders belong to one customer and a twentieth to none."""
    key = F.when(F.col("o_orderkey") % 3 == 0, 7).when(F.col("o_orderkey") % 20 == 1, None).otherwise(F.col("o_custkey")).alias("k")
    return layout.dominant_keys(table(spark, d, "orders").select(key), "k", 0.02)


@case("o08_repartition_coalesce", "SELECT 'coalesce' AS how, count(*) AS row_count, true AS bounded FROM orders UNION ALL SELECT 'repartition', count(*), true FROM orders")
def o08(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    wide = layout.files_for_size(orders, 16, 128 << 20)
    forms = {"repartition": orders.repartition(wide, "o_custkey"), "coalesce": orders.repartition(wide).coalesce(wide // 4)}
    limit = {"repartition": wide, "coalesce": wide // 4}
    out = [layout.partition_skew(df).agg(F.lit(n).alias("how"), F.sum("rows").alias("row_count"), (F.count(F.lit(1)) <= limit[n]).alias("bounded"))
           for n, df in forms.items()]
    return out[0].unionByName(out[1])


@case("o08_rebalanced_copy", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey")
def o08_rebalance(spark, d):
    """Rebalance before a write splits a hot key's partition and merges small ones."""
    rows = stage(table(spark, d, "orders").hint("rebalance", "o_custkey"), "balanced")
    return rows.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
