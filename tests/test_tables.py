"""Versioned tables, merge, change feed, constraints."""

from __future__ import annotations

import random
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from lakeloom.operators import changes as ch
from lakeloom.operators import layout
from lakeloom.operators import quality as q
from lakeloom.operators import snapshots as sn
from lakeloom.operators.changes import When
from lakeloom.session import scratch_path
from tests.conftest import rows


def numbers(spark, a, b):
    return spark.range(a, b).select("id", (F.col("id") * 10).alias("v"))


def test_bucket_merge_rewrites_touched_folders_only(spark):
    path, files = scratch_path(spark, "buckets"), lambda: {r[0] for r in spark.read.parquet(path).select("_metadata.file_path").distinct().collect()}
    ch.write_buckets(numbers(spark, 0, 200), path, ["id"], 8)
    before = files()
    touched = ch.merge_buckets(path, numbers(spark, 50, 51).withColumn("v", F.lit(-5).cast("bigint")), ["id"], [When("matched", "update")], 8)
    assert len(touched) == 1 and len(before & files()) == len(before) - 1
    assert spark.read.parquet(path).filter("v = -5").select("id").collect()[0]["id"] == 50
    assert ch.merge_buckets(path, numbers(spark, 0, 200), ["id"], [When("matched", "delete")], 8) == list(range(8))
    assert not any(f.exists() for f in Path(path).glob("_bucket=*"))


def test_replacing_partitions_removes_those_left_empty(spark):
    path = scratch_path(spark, "parts")
    numbers(spark, 0, 9).withColumn("p", F.col("id") % 3).write.partitionBy("p").parquet(path)
    ch.replace_partitions(numbers(spark, 100, 101).withColumn("p", F.lit(1).cast("bigint")), path, "p", [0, 1])
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == [2, 5, 8, 100]


def test_copies_by_version_and_time(spark):
    root = scratch_path(spark, "copies")
    sn.write(numbers(spark, 0, 5), root, "CREATE", "2024-01-01 00:00:00")
    sn.write(numbers(spark, 0, 3), root, "OVERWRITE", "2024-01-02 00:00:00")
    sn.write(numbers(spark, 0, 4), root, "INSERT", "2024-02-01 00:00:00")
    numbers(spark, 0, 99).write.parquet(f"{root}/version=3/operation=INSERT/at=1/half")  # a writer that died
    assert sn.read(spark, root, at="2024-01-01 12:00:00").count() == 5
    assert sn.read(spark, root).count() == 4
    with pytest.raises(sn.NoSnapshot):
        sn.read(spark, root, at="2023-01-01 00:00:00")
    with pytest.raises(ValueError):
        sn.expire(spark, root, "2024-02-01 01:00:00", hours=1)
    assert sn.restore(spark, root, 0) == 3 and sn.read(spark, root).count() == 5
    assert [r["version"] for r in sn.expirable(spark, root, "2024-02-01 01:00:00").orderBy("version").collect()] == [0, 1]
    assert sn.expire(spark, root, "2024-02-01 01:00:00") == [0, 1]
    with pytest.raises(sn.NoSnapshot):
        sn.read(spark, root, 0)
    assert sn.expire(spark, root, "2024-02-01 01:00:00") == []


def test_checked_appends(spark):
    path, rules = scratch_path(spark, "checked"), {"positive": "v >= 0"}
    q.append_checked(numbers(spark, 0, 5), path, rules)
    for wrong in (numbers(spark, 5, 6).withColumn("extra", F.lit(1)), numbers(spark, 5, 6).withColumn("v", F.col("v").cast("string"))):
        with pytest.raises(q.CheckFailed, match="schema"):
            q.append_checked(wrong, path, rules)
    with pytest.raises(q.CheckFailed, match="positive"):
        q.append_checked(numbers(spark, 5, 6).withColumn("v", -F.col("v")), path, rules)
    assert spark.read.parquet(path).count() == 5
    q.append_checked(numbers(spark, 5, 6).withColumn("extra", F.lit("e")), path, rules, widen=True)
    assert spark.read.option("mergeSchema", True).parquet(path).filter("extra IS NULL").count() == 5


def test_compaction_in_place(spark):
    path = scratch_path(spark, "small")
    numbers(spark, 0, 1000).repartition(60).write.parquet(path)
    assert layout.compact_folder(spark, path) == (60, 1)
    assert rows(spark.read.parquet(path)) == rows(numbers(spark, 0, 1000))
    assert layout.compact_folder(spark, path, bytes_per_file=1) == (0, 0)


def test_rank_bits_grow_with_the_files():
    assert [layout.rank_bits(f, 2) for f in (1, 64, 10_000, 1_000_000)] == [6, 6, 9, 12]


def test_merge_refuses_two_source_rows(spark):
    target, twice = numbers(spark, 0, 3), numbers(spark, 1, 2).unionAll(numbers(spark, 1, 2))
    with pytest.raises(q.CheckFailed):
        ch.merge(target, twice, ["id"], [When("matched", "update")])
    fresh = numbers(spark, 7, 8).unionAll(numbers(spark, 7, 8))
    assert ch.merge(target, fresh, ["id"], [When("not_matched", "insert")]).count() == 5


@pytest.mark.parametrize("seed", [1, 2])
def test_merge_equals_row_by_row(spark, seed):
    r = random.Random(seed)
    target = {i: r.randrange(100) for i in r.sample(range(60), 40)}
    source = {i: r.randrange(100) for i in r.sample(range(80), 40)}
    clauses = [When("matched", "delete", "s.v < 20"), When("matched", "update", "s.v > t.v", {"v": "s.v + t.v"}),
               When("not_matched", "insert", "s.v >= 50"), When("not_matched", "insert", "s.v < 10", {"id": "s.id", "v": "-s.v"}),
               When("not_matched_by_source", "update", "t.v > 90", {"v": "0"}), When("not_matched_by_source", "delete", "t.v < 10")]
    want = {}
    for i, v in target.items():
        if i in source:
            if source[i] < 20:
                continue
            want[i] = source[i] + v if source[i] > v else v
        elif v > 90:
            want[i] = 0
        elif v >= 10:
            want[i] = v
    for i, v in source.items():
        if i not in target and v >= 50:
            want[i] = v
        elif i not in target and v < 10:
            want[i] = -v
    frame = lambda d: spark.createDataFrame(sorted(d.items()), "id bigint, v bigint")
    assert {x["id"]: x["v"] for x in ch.merge(frame(target), frame(source), ["id"], clauses).collect()} == want
    path = scratch_path(spark, "merged")
    ch.write_buckets(frame(target), path, ["id"], 3)
    ch.merge_buckets(path, frame(source), ["id"], clauses, 3)
    assert {x["id"]: x["v"] for x in spark.read.parquet(path).collect()} == want


def test_change_feed_replays_to_the_newest_version(spark):
    root = scratch_path(spark, "feed")
    newest = lambda: sn.read(spark, root)
    sn.write(numbers(spark, 0, 6), root, "CREATE")
    sn.write(ch.update(newest(), {"v": "v + 1"}, "id < 2"), root, "UPDATE")
    sn.write(ch.delete(newest(), "id = 5"), root, "DELETE")
    sn.write(ch.insert(newest(), numbers(spark, 8, 9)), root, "INSERT")
    state = {x["id"]: x["v"] for x in sn.read(spark, root, 0).collect()}
    for c in sn.changes(spark, root, 1, key=["id"]).orderBy("_commit_version").collect():
        if c["_change_type"] in ("insert", "update_postimage"):
            state[c["id"]] = c["v"]
        elif c["_change_type"] == "delete":
            state.pop(c["id"])
    assert state == {x["id"]: x["v"] for x in newest().collect()}


def test_multiset_diff(spark):
    old = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "x string")
    new_ = spark.createDataFrame([("a",), ("c",), (None,), (None,)], "x string")
    assert rows(ch.changes_between(old, new_)) == rows(spark.createDataFrame(
        [("a", "delete"), ("b", "delete"), ("c", "insert"), (None, "insert")], "x string, _change_type string"))


def test_identity_and_defaults(spark):
    ids = ch.with_identity(spark.range(1000).repartition(7), "n", above=50)
    assert ids.select("n").distinct().count() == 1000 and ids.agg(F.min("n")).first()[0] > 50
    base = spark.createDataFrame([(1, "x", 2)], "a int, b string, c int")
    out = ch.insert(base, spark.createDataFrame([(2,)], "a int"), {"c": 9})
    assert rows(out) == rows(spark.createDataFrame([(1, "x", 2), (2, None, 9)], "a int, b string, c int"))


def test_z_order_skips_files_on_both_columns(spark):
    path, base = scratch_path(spark, "z"), scratch_path(spark, "base")
    df = spark.range(20000).select(F.pmod(F.hash("id"), F.lit(1000)).alias("a"), F.pmod(F.xxhash64("id"), F.lit(1000)).alias("b"), "id")
    df.repartition(16).write.parquet(base)
    layout.write_clustered(df, ["a", "b"], path, 16)
    assert rows(spark.read.parquet(path)) == rows(df)
    stats, plain = spark.read.parquet(f"{path}/_stats"), layout.file_statistics(spark.read.parquet(base), ["a", "b"])
    for column in ("a", "b"):
        assert layout.files_for(stats, column, 500).count() < layout.files_for(plain, column, 500).count() == 16
        got = layout.read_skipping(spark, path, column, 500)
        assert rows(got) == rows(df.filter(f"{column} = 500"))
    assert layout.read_skipping(spark, path, "a", 5000).count() == 0
    assert layout.partition_skew(df.repartition(4)).count() == 4


def test_oracle_engine_is_available():
    assert duckdb.connect().execute("SELECT 1").fetchall() == [(1,)]
