"""Layouts that survive a stop, and clustering that grows."""

from __future__ import annotations

import itertools

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from lakeloom.operators import layout
from lakeloom.session import scratch_path
from tests.conftest import rows


class Stop(Exception):
    pass


@pytest.mark.parametrize(("partitioned", "stop_at"), [(False, 0), (False, 1), (False, 2), (False, 3), (True, 1), (True, 5)])
def test_compaction_stopped_at_every_step(spark, monkeypatch, partitioned, stop_at):
    """A stop before each rename or removal: rows are there once or, between the renames, not at all,
    and the next run ends with all of them once."""
    path = scratch_path(spark, "stopped")
    df = spark.range(1000).withColumn("p", F.col("id") % 2)
    writer = df.repartition(10).write
    (writer.partitionBy("p") if partitioned else writer).parquet(path)
    left = itertools.count()

    def stopping(real):
        def step(*args):
            if next(left) == stop_at:
                raise Stop
            return real(*args)
        return step

    with monkeypatch.context() as patch:
        patch.setattr(layout, "_rename", stopping(layout._rename))
        patch.setattr(layout, "delete_path", stopping(layout.delete_path))
        with pytest.raises(Stop):
            layout.compact_folder(spark, path, at_once=1)
    if layout._exists(spark, path) and not partitioned:
        assert rows(spark.read.parquet(path)) == rows(df)
    layout.compact_folder(spark, path)
    assert rows(spark.read.parquet(path).select("id", F.col("p").cast("long").alias("p"))) == rows(df)
    assert spark.read.parquet(path).select("_metadata.file_path").distinct().count() == (2 if partitioned else 1)
    assert not layout._exists(spark, layout._hold(path))


def slow_hilbert(axes, bits):
    """The curve's order of a whole grid by its recursive definition: walks where neighbours differ by
    one step in one axis."""
    return sum(abs(a - b) for a, b in zip(*axes, strict=True)) == 1


@pytest.mark.parametrize(("n", "bits"), [(1, 4), (2, 4), (3, 3)])
def test_hilbert_curve(spark, n, bits):
    """Every cell has its own place, places follow without gaps, and each step goes to a neighbour."""
    grid = spark.createDataFrame(list(itertools.product(range(1 << bits), repeat=n)), ", ".join(f"a{i} long" for i in range(n)))
    placed = layout.with_hilbert(grid, [F.col(f"a{i}") for i in range(n)], "place", bits).orderBy("place").collect()
    assert [r["place"] for r in placed] == list(range(1 << bits * n))
    cells = [tuple(r[f"a{i}"] for i in range(n)) for r in placed]
    assert all(slow_hilbert(pair, bits) for pair in itertools.pairwise(cells))
    assert n == 1 or cells[0] == (0,) * n


def test_overlap_depth_by_brute_force(spark):
    import random
    rng = random.Random(5)
    files = [(f"f{i}", rng.choice("ab"), *sorted((rng.randrange(60), rng.randrange(60)))) for i in range(80)]
    df = spark.createDataFrame(files, "file_path string, curve string, low long, high long")
    for most in (0, 3, 12, 80):
        want = {f[0]: any(sum(g[1] == f[1] and g[2] <= at <= g[3] for g in files) > most for at in range(f[2], f[3] + 1)) for f in files}
        assert {r["file_path"]: r["deep"] for r in layout.overlap_depth(df, most).collect()} == want


def test_growing_clusters(spark):
    """Ten arrivals, keys changed on the way: a point meets few files, untouched files keep their
    names, rows stay."""
    root, df = scratch_path(spark, "growing"), spark.range(4000).select("id", (F.col("id") * 37 % 1009).alias("a"), (F.col("id") * 11 % 503).alias("b"))
    names = []
    for n in range(10):
        layout.arrive(df.filter(F.col("id") % 10 == n), root, ["a", "b"], 4)
        layout.recluster(spark, root, ["a", "b"], 3, 400)
        files = layout.cluster_files(spark, root)
        names.append({r["file_path"] for r in files.collect()})
        assert files.filter(layout.meets("a", 500)).count() <= 16
        assert rows(layout.read_growing(spark, root).drop("_place")) == rows(df.filter(F.col("id") % 10 <= n))
    layout.arrive(df.withColumn("id", F.col("id") + 10_000), root, ["b"], 4)
    assert names[-1] < {r["file_path"] for r in layout.cluster_files(spark, root).collect()}
    assert rows(layout.read_growing(spark, root).drop("_place").filter("id < 10000")) == rows(df)


def test_unfinished_step_is_not_read(spark, monkeypatch):
    root, df = scratch_path(spark, "growing"), spark.range(300).select("id", (F.col("id") % 50).alias("a"))
    layout.arrive(df.filter("id < 200"), root, ["a"], 2)
    with monkeypatch.context() as patch:
        patch.setattr(layout, "stage", lambda *a, **k: (_ for _ in ()).throw(Stop()))
        with pytest.raises(Stop):
            layout.arrive(df.filter("id >= 200"), root, ["a"])
    assert layout.read_growing(spark, root).count() == 200
    layout.arrive(df.filter("id >= 200"), root, ["a"])
    assert rows(layout.read_growing(spark, root).drop("_place")) == rows(df)


def test_files_of_one_cell_settle(spark):
    """All rows have the same keys: no curve tells them apart, still no file lies over another once rewritten."""
    root, df = scratch_path(spark, "growing"), spark.range(3000).select("id", F.lit(7).alias("a"), F.lit(None).cast("string").alias("b"))
    for n in range(5):
        layout.arrive(df.filter(F.col("id") % 5 == n), root, ["a", "b"], 2)
    assert layout.recluster(spark, root, ["a", "b"], 1, 100) == (10, 30)
    assert layout.recluster(spark, root, ["a", "b"], 1, 100) == (0, 0)
    assert rows(layout.read_growing(spark, root).drop("_place")) == rows(df)


def test_curve_is_refined_for_many_files(spark):
    """A curve drawn for four files is refined for 300: a point meets few of them, and files that stay keep their names."""
    root, df = scratch_path(spark, "growing"), spark.range(30_000).select("id", (F.col("id") * 7919 % 30_011).alias("a"), (F.col("id") * 104_729 % 30_013).alias("b"))
    few, high = df.filter("id % 10 = 0"), df.filter("id % 10 > 0 AND a >= 17000")
    layout.arrive(few, root, ["a", "b"], 4)
    for n in range(3):
        layout.arrive(high.filter(F.col("id") % 3 == n), root, ["a", "b"])
    before = {r["file_path"] for r in layout.cluster_files(spark, root).collect()}
    read, written = layout.recluster(spark, root, ["a", "b"], 3, 50)
    assert 3 < read < 7 and written > 250
    assert layout.recluster(spark, root, ["a", "b"], 3, 50) == (0, 0)
    files = layout.cluster_files(spark, root)
    assert len(before & {r["file_path"] for r in files.collect()}) == 7 - read
    assert files.filter(layout.meets("a", 20_000)).count() < 60
    assert [r["bits"] for r in spark.read.json(f"{root}/_curves").orderBy("bits").collect()] == [5, 8]
    assert rows(layout.read_growing(spark, root).drop("_place")) == rows(few.unionByName(high))


def test_refined_cells_lie_in_their_old_cell(spark):
    """Of numbers, dates, texts and nulls, with values that come often and ones beyond those the curve was drawn from."""
    df = spark.range(2000).select(
        F.when(F.col("id") % 3 > 0, F.col("id") * F.col("id") % 977 / 8).alias("a"), F.expr("DATE'2020-01-01' + CAST(id % 700 AS INT)").alias("b"),
        F.when(F.col("id") % 11 > 0, F.md5(F.col("id").cast("string"))).alias("c"))
    bits, finer, columns = 2, 4, df.columns
    bounds = layout._bounds(df.filter("b < '2020-09-01'"), columns, 1 << bits)
    cuts = {c: [[str(v), n] for n, v in enumerate(bounds[c], 1)] for c in columns}
    fine = {c: [[str(v), n] for v, n in found] for c, found in layout._refined(df, cuts, bits, finer).items()}
    assert all(len(fine[c]) > 2 * len(cuts[c]) and fine[c][-1][1] < 1 << finer for c in columns)

    def placed(of, k):
        ranks = [F.get(F.lit([0, *[n for _, n in of[c]]]), layout._rank_in(F.col(c), [v for v, _ in of[c]], df.schema[c].dataType)) for c in columns]
        return [r["place"] for r in layout.with_hilbert(df, ranks, "place", k).collect()]

    coarse, small = placed(cuts, bits), placed(fine, finer)
    assert coarse == [p >> (finer - bits) * len(columns) for p in small]
    assert len(set(small)) > 4 * len(set(coarse))


def test_recluster_query_with_a_hot_pair(spark, tmp_path):
    """A quarter of the lines are of one part and supplier: more rows than three files hold."""
    n = F.col("id")
    part = F.when(n % 4 < 2, 1 + F.floor(n / 4) % 50).when(n % 4 == 2, 75).otherwise(51 + F.floor(n / 4) % 50)
    spark.range(480_000).select(
        n.alias("l_orderkey"), F.lit(1).alias("l_linenumber"), part.alias("l_partkey"), F.when(n % 4 == 2, 9).otherwise(n * 31 % 40).alias("l_suppkey"),
        (n % 50).cast("double").alias("l_quantity"), (n * 3).cast("double").alias("l_extendedprice")).write.parquet(f"{tmp_path}/lineitem.parquet")
    got = queries()["o04_recluster_overlap"](spark, str(tmp_path))
    assert got.agg(F.count(F.lit(1)), F.count_distinct("l_orderkey"), F.min("kept_names"), F.min("bounded")).first() == (480_000, 480_000, True, True)
