"""Work that goes by what changed: views, feeds, streamed histories, ordered loads; closure and quantiles."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom import session
from lakeloom.operators import aggregates as ag
from lakeloom.operators import cdc, digests, hierarchy, materialised
from lakeloom.operators import changes as ch
from lakeloom.operators import quality as q
from lakeloom.session import scratch_path, stage
from lakeloom.sources import ordered
from lakeloom.streaming import flows, keyed_history
from tests.conftest import rows

# ---- views ------------------------------------------------------------------------------------------


def test_refresh_equals_full_computation(spark):
    """Random inserts, updates and deletes, null keys and values among them; every batch is sent twice."""
    rng = random.Random(1)
    schema, keys = "id long, k long, v long", ["k"]
    table = {i: (i, rng.choice([None, 1, 2, 3]), rng.choice([None, 1, 5, 9])) for i in range(60)}
    view = materialised.View(scratch_path(spark, "view"), keys, {"total": "v"}, {"low": ("min", "v"), "high": ("max", "v")}, 4)
    materialised.create(view, spark.createDataFrame(list(table.values()), schema))
    for batch in range(1, 3):
        changes = []
        for i in rng.sample(sorted(table), 12):
            old = table.pop(i)
            if rng.random() < 0.5:
                table[i] = (i, rng.choice([old[1], 4]), rng.choice([None, 0, 5, 20]))
                changes += [(*old, "update_preimage"), (*table[i], "update_postimage")]
            else:
                changes.append((*old, "delete"))
        table[100 + batch] = (100 + batch, 7 + batch, batch)
        changes.append((*table[100 + batch], "insert"))
        df = spark.createDataFrame(changes, f"{schema}, _change_type string")
        base = spark.createDataFrame(list(table.values()), schema)
        assert materialised.refresh(view, df, batch, base)["buckets"] > 0
        assert materialised.refresh(view, df, batch, base) == {"buckets": 0, "reread": 0}
        want = base.groupBy("k").agg(F.count(F.lit(1)).alias("_rows"), F.coalesce(F.sum("v"), F.lit(0)).alias("total"), F.min("v").alias("low"), F.max("v").alias("high"))
        assert rows(materialised.read(spark, view)) == rows(want)


def test_refresh_stopped_between_buckets(spark, monkeypatch):
    base = spark.range(200).select((F.col("id") % 40).alias("k"), F.col("id").alias("v"))
    view = materialised.View(scratch_path(spark, "view"), ["k"], {"total": "v"}, {}, 8)
    materialised.create(view, base)
    more = base.withColumn("_change_type", F.lit("insert"))
    real = materialised.replace_partitions

    def half(df, path, column, values):
        real(df.filter(F.col(column).isin(values[:3])), path, column, values[:3])
        raise RuntimeError("stopped")

    with monkeypatch.context() as patch:
        patch.setattr(materialised, "replace_partitions", half)
        with pytest.raises(RuntimeError):
            materialised.refresh(view, more, 1, base)
    assert materialised.refresh(view, more, 1, base)["buckets"] == 5
    assert rows(materialised.read(spark, view)) == rows(base.groupBy("k").agg((F.count("v") * 2).alias("_rows"), (F.sum("v") * 2).alias("total")))


def test_refresh_reads_touched_groups_only(spark):
    base = spark.range(1000).select((F.col("id") % 100).alias("k"), F.col("id").alias("v"))
    view = materialised.View(scratch_path(spark, "view"), ["k"], {"total": "v"}, {"low": ("min", "v")}, 50)
    materialised.create(view, base)
    gone = base.filter("v IN (7, 507)")
    told = materialised.refresh(view, gone.withColumn("_change_type", F.lit("delete")), 1, base.filter("v NOT IN (7, 507)"))
    assert told == {"buckets": 1, "reread": 1}
    more = base.filter("v = 9").withColumn("_change_type", F.lit("insert"))
    assert materialised.refresh(view, more, 2, base) == {"buckets": 1, "reread": 0}


# ---- change feeds -----------------------------------------------------------------------------------


def test_feed_by_digests(spark):
    base = spark.range(2000).select("id", F.when(F.col("id") % 7 > 0, F.col("id") % 5).alias("a"), F.col("id").cast("string").alias("b"))
    changed = (base.filter("id NOT IN (3, 1999)").withColumn("a", F.when(F.col("id") == 14, 1).otherwise(F.col("a")))
               .unionByName(spark.createDataFrame([(5000, None, "x"), (None, 1, "y")], "id long, a long, b string")))
    paths = [scratch_path(spark, "copy") for _ in range(3)]
    for df, path in zip((base, changed, base.repartition(7)), paths, strict=True):
        digests.write_copy(df, path, ["id"], 64, 8)
    unlike = digests.changed_buckets(spark, *paths[:2])
    assert 1 <= len(unlike) <= 5
    assert rows(digests.feed(spark, *paths[:2], ["id"])) == rows(ch.changes_between(base, changed, ["id"]))
    assert digests.changed_buckets(spark, paths[0], paths[2]) == []
    read = digests.read_copy(spark, paths[0], spark.read.parquet(f"{paths[0]}/rows").schema, unlike).count()
    assert read < 2000 / 64 * 3 * len(unlike)


def test_digests_tell_rows_apart(spark):
    """Values that change places, doubles that cancel out, and nulls in other columns."""
    pairs = [([(1, None, 2)], [(1, 2, None)]), ([(1, 2, 2), (1, 2, 2)], []), ([(1, 2, 3), (1, 4, 5)], [(1, 2, 5), (1, 4, 3)])]
    for left, right in pairs:
        paths = []
        for data in (left + [(9, 9, 9)], right + [(9, 9, 9)]):
            paths.append(scratch_path(spark, "copy"))
            digests.write_copy(spark.createDataFrame(data, "k long, a long, b long"), paths[-1], ["k"], 4, 2)
        assert digests.changed_buckets(spark, *paths)


# ---- hierarchies and quantiles ------------------------------------------------------------------------


def test_closure_of_a_long_chain_and_cycles(spark):
    chain = spark.range(10_000).select(F.col("id"), F.when(F.col("id") > 0, F.col("id") - 1).alias("parent"))
    out = hierarchy.closure(chain)
    assert out.filter("root = 0 AND depth = id AND state = 'tree'").count() == 10_000
    rng = random.Random(2)
    parents = {i: rng.choice([None, rng.randrange(80), 999]) for i in range(80)}
    got = {r["id"]: (r["root"], r["depth"], r["path"], r["state"]) for r in hierarchy.closure(
        spark.createDataFrame(list(parents.items()), "id long, parent long"), "id", "/").collect()}
    for node in parents:
        path, at = [node], parents[node]
        while at in parents and at not in path:
            path.append(at)
            at = parents[at]
        if at in parents:
            want = (None, None, None, "on a cycle" if at == node or node in path[path.index(at):] else "below a cycle")
        else:
            want = (path[-1], len(path) - 1, "/".join(map(str, reversed(path))), "tree")
        assert got[node] == want
    assert hierarchy.closure(spark.createDataFrame([], "id long, parent long")).count() == 0


def test_closure_builds_no_paths_around_cycles(spark):
    """Nodes of a cycle and a long tail below it: what a run stages stays in proportion to the nodes (before,
    names were joined around the cycle: 2 ** 12 of them for each node)."""
    nodes = spark.range(4_000).select(F.col("id"), F.when(F.col("id") == 0, 2).otherwise(F.col("id") - 1).alias("parent"))
    before = len(session._staged)
    out = hierarchy.closure(nodes, "id", "/")
    assert {r["state"]: r["n"] for r in out.groupBy("state").agg(F.count(F.lit(1)).alias("n")).collect()} == {"on a cycle": 3, "below a cycle": 3_997}
    assert {r["id"] for r in out.filter("state = 'on a cycle'").collect()} == {0, 1, 2}
    assert out.filter("root IS NOT NULL OR depth IS NOT NULL OR path IS NOT NULL").count() == 0
    for path in session._staged[before:]:
        staged = spark.read.parquet(path)
        assert "path" not in staged.columns or staged.agg(F.coalesce(F.max(F.length("path")), F.lit(0))).first()[0] <= 4


def test_closure_of_repeated_and_null_ids(spark):
    """Each copy of a row meets each copy of its parent, as a recursive join has it, below a root or a cycle;
    copies on a cycle do not multiply around it."""
    data = [(1, None), (2, 1), (2, 1), (3, 2), (5, 6), (6, 5), (7, 6), (7, 6), (8, 7), (None, None), (None, 1), (15, 16), (15, 16), (16, 15)]
    got = Counter((r["id"], r["path"], r["state"]) for r in hierarchy.closure(spark.createDataFrame(data, "id long, parent long"), "id", "/").collect())
    assert got == Counter({(1, "1", "tree"): 1, (2, "1/2", "tree"): 2, (3, "1/2/3", "tree"): 4, (None, None, "tree"): 2,
                           (5, None, "on a cycle"): 1, (6, None, "on a cycle"): 1, (7, None, "below a cycle"): 2, (8, None, "below a cycle"): 4,
                           (15, None, "on a cycle"): 2, (16, None, "on a cycle"): 2})


def test_order_statistics(spark):
    rng = random.Random(3)
    data = [(rng.choice([1.5, 2.0, None, -7.25]), rng.randrange(10 ** 9), rng.gauss(0, 1) * 10 ** rng.randrange(-9, 9), None) for _ in range(3_000)]
    df = spark.createDataFrame(data, "few double, many long, wide double, none double")
    for column, place in (("few", 0), ("many", 1), ("wide", 2)):
        values = sorted(r[place] for r in data if r[place] is not None)
        ranks = [0, 1, len(values) // 3, len(values) // 2, len(values) - 1]
        found = ag.order_statistics(df, {column: [*ranks, 10 ** 7]})
        assert found == {(column, k): float(values[k]) for k in ranks}
    quartiles = {r["column"]: r for r in ag.exact_quantiles(df, ["few", "many", "none"]).collect()}
    assert quartiles["none"]["q2"] is None
    assert quartiles["many"]["q2"] == df.agg(F.percentile("many", 0.5)).first()[0]
    assert ag.exact_quantiles(df.limit(0), ["many"]).first()["q1"] is None


def test_order_statistics_count_a_value_once_a_pass(spark, monkeypatch):
    """Ranks in the same range share it (before, each rank had the rows of its range to itself)."""
    df = spark.range(2_000).select((F.col("id") * 7919 % 2_003).alias("v"), F.when(F.col("id") % 3 == 0, float("nan")).otherwise(F.col("id").cast("double")).alias("w"))
    sent, plain = [], ag.F.broadcast
    monkeypatch.setattr(ag.F, "broadcast", lambda ranges: sent.append(ranges.count()) or plain(ranges))
    monkeypatch.setattr(ag, "LAST_VALUES", 2)
    ranks = [0, 500, 501, 1_000, 1_001, 1_999]
    found = ag.order_statistics(df, {"v": ranks, "w": ranks})
    assert sent[0] == 2
    values = sorted(i * 7919 % 2_003 for i in range(2_000))
    assert [found["v", k] for k in ranks] == [float(values[k]) for k in ranks]
    numbers = [float(i) for i in range(2_000) if i % 3]
    assert [found["w", k] for k in ranks[:-1]] == [numbers[k] for k in ranks[:-1]] and found["w", 1_999] != found["w", 1_999]


# ---- streamed histories ---------------------------------------------------------------------------------


def test_linear_hashing(spark):
    """A bucket is split into itself and one new bucket; no other key moves."""
    keys = spark.range(3000).withColumnRenamed("id", "k")
    for n in (4, 5, 7, 8, 11):
        before, after = (stage(keys.withColumn("b", keyed_history.address(["k"], m, 4))) for m in (n, n + 1))
        moved = before.join(after.withColumnRenamed("b", "c"), "k").filter("b <> c")
        assert {(r["b"], r["c"]) for r in moved.select("b", "c").distinct().collect()} == {(keyed_history.parent_bucket(n, 4), n)}
    assert keyed_history.ancestors([17, 2], 4) == [1, 2, 17] and keyed_history.ancestors([13], 4) == [1, 5, 13]


def _events(seed, count, start=0):
    rng = random.Random(seed)
    return [(rng.choice([None, *range(12)]), start + i, rng.choice("abc"), rng.random() < 0.15) for i in range(count)]


EVENT = T.StructType().add("k", "long").add("seq", "long").add("v", "string").add("dead", "boolean")


def test_history_equals_full_build(spark):
    """Batches in order, late ones and batches sent again give the chains that all events give."""
    history = keyed_history.KeyedHistory(spark, scratch_path(spark, "history"), EVENT, ["k"], ["seq"], "dead", untracked=("dead",), first=2, bucket_rows=3)
    batches = [_events(1, 40), _events(2, 40, 100), _events(3, 25, 60)]
    for n, batch in enumerate(batches):
        df = spark.createDataFrame(batch, EVENT)
        history.apply(df, n)
        if n == 2:
            history.apply(df, n)  # sent again
        seen = spark.createDataFrame([e for b in batches[:n + 1] for e in b], EVENT)
        assert rows(history.versions()) == rows(cdc.scd2(seen, ["k"], ["seq"], "dead", untracked=("dead",)))
        live = cdc.scd2(seen, ["k"], ["seq"], "dead", untracked=("dead",)).filter(F.col(cdc.END).isNull()).drop(cdc.START, cdc.END)
        assert rows(history.current()) == rows(live)
    assert history.bucket_count() > 2


def test_rows_read_do_not_grow_with_batches(spark):
    """Batches over the same keys: a later one reads what the second read; a late event reads the log
    of its key alone."""
    history = keyed_history.KeyedHistory(spark, scratch_path(spark, "history"), EVENT, ["k"], ["seq"])
    read = []
    for n in range(4):
        batch = spark.range(30).select(F.col("id").alias("k"), F.lit(n).cast("long").alias("seq"), F.lit(f"v{n}").alias("v"), F.lit(False).alias("dead"))
        read.append(history.apply(batch, n))
    assert read[0] == {"open": 0, "log": 0} and all(r == {"open": 30, "log": 0} for r in read[1:])
    late = spark.createDataFrame([(4, -1, "early", False)], EVENT)
    assert history.apply(late, 4)["log"] == 5
    assert history.versions().filter("k = 4").count() == 5


# ---- metrics and loads ------------------------------------------------------------------------------------


def test_metrics_of_a_replayed_batch_count_once(spark):
    df = spark.range(50).withColumn("v", F.col("id") % 5)
    source, log = scratch_path(spark, "arriving"), scratch_path(spark, "metrics")
    df.coalesce(1).write.parquet(source)
    for _ in range(2):  # the second run has a new checkpoint and so the same batch number again
        rows_in = q.observe_rules(flows.file_stream(spark, source, "parquet", df.schema), {"small": "v < 2", "null": "null"}, "numbers")
        target, checkpoint = scratch_path(spark, "out"), scratch_path(spark, "checkpoint")
        assert q.drain_with_metrics(lambda r=rows_in, t=target, c=checkpoint: flows.append_flow(r, t, c), spark, "numbers", "r", log) == 1
    assert sorted(tuple(r) for r in q.read_metrics(spark, log).collect()) == [("r", "numbers", "null", 0, 50, 0), ("r", "numbers", "small", 20, 30, 0)]


def test_names_from(spark):
    """The pattern meets the mark and all later names, and no earlier one."""
    source = scratch_path(spark, "named")
    names = ["2023-12-31", "2024-01-09", "2024-01-10", "2024-01-10-b", "2024-02-01", "2024-1", "2025-01-01", "a", "hour=3"]
    for name in names:
        spark.range(1).write.parquet(f"{source}/{name}")
    for mark in names:
        assert ordered._folders(spark, f"{source}/{ordered.names_from(mark)}") == sorted(n for n in names if n >= mark)


def test_ordered_load_lists_the_tail(spark):
    source, target = scratch_path(spark, "daily"), scratch_path(spark, "loaded")
    df = spark.range(600).select("id", F.format_string("d%03d", F.col("id") % 60).alias("day"))
    df.repartition(4).write.partitionBy("day").parquet(source)
    loads = ordered.load_ordered(spark, target, source, "parquet", "id long", piece_files=50)
    assert len(loads) > 1 and ordered.load_ordered(spark, target, source, "parquet", "id long") == []
    files = ordered.read_ledger(spark, target)
    assert files.count() == files.select("path").distinct().count()
    spark.range(600, 610).select("id", F.lit("d060").alias("day")).write.mode("append").partitionBy("day").parquet(source)
    spark.range(700, 703).select("id", F.lit("d059").alias("day")).write.mode("append").partitionBy("day").parquet(source)
    tail, names = ordered.tail_files(spark, target, source)
    assert names == ["day=d058", "day=d059", "day=d060"] and tail.count() < 30
    assert len(ordered.load_ordered(spark, target, source, "parquet", "id long")) == 1
    got = ordered.read_ordered(spark, target, "id long, load_id long")
    assert sorted(r["id"] for r in got.collect()) == [*range(610), 700, 701, 702]
