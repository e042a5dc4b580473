"""Dimension histories against a brute-force walk over each key's events."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from lakeloom.operators import cdc, changes
from lakeloom.session import scratch_path
from lakeloom.streaming import flows
from tests.conftest import rows

SCHEMA = "k int, a string, b int, seq bigint, op string"


def random_events(seed: int, n: int = 300):
    r = random.Random(seed)
    found = {}
    for _ in range(n):
        k, seq = r.randrange(12), r.randrange(60)
        found[k, seq] = (k, r.choice(["x", "y", None]), r.choice([1, 2, None]), seq, r.choice("UUUUD"))
    return list(found.values())


def brute(events, keep_old: bool = False):
    history = []
    for key in sorted({e[0] for e in events}):
        open_row, a, b = None, None, None
        for _, va, vb, seq, op in sorted((e for e in events if e[0] == key), key=lambda e: e[3]):
            if op == "D":
                if open_row:
                    history.append((*open_row, seq))
                open_row, a, b = None, None, None
                continue
            a, b = (va if va is not None else a, vb if vb is not None else b) if keep_old else (va, vb)
            if open_row and open_row[1:3] == (a, b):
                continue
            if open_row:
                history.append((*open_row, seq))
            open_row = (key, a, b, seq)
        if open_row:
            history.append((*open_row, None))
    return sorted(map(str, history))


def found(df):
    return sorted(str((r["k"], r["a"], r["b"], r[cdc.START], r[cdc.END])) for r in df.collect())


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("keep_old", [False, True])
def test_scd2(spark, seed, keep_old):
    events = random_events(seed)
    df = spark.createDataFrame(events, SCHEMA)
    got = cdc.scd2(df, ["k"], ["seq"], delete_when="op = 'D'", untracked=["op"], ignore_nulls=keep_old)
    assert found(got) == brute(events, keep_old)


@pytest.mark.parametrize("seed", [4, 5])
def test_scd1_is_the_open_part_of_the_history(spark, seed):
    events = random_events(seed)
    df = spark.createDataFrame(events, SCHEMA)
    for mode, keep_old in ((None, False), ("keep_old", True)):
        got = cdc.scd1(df, ["k"], ["seq"], delete_when="op = 'D'", ignore_nulls=mode)
        want = [h for h in brute(events, keep_old) if h.endswith("None)")]
        assert sorted(str((r["k"], r["a"], r["b"])) for r in got.collect()) == sorted(
            h[: h.rindex(", ", 0, h.rindex(", "))] + ")" for h in want)


@pytest.mark.parametrize("seed", [6, 7])
def test_late_batches_give_the_same_history(spark, seed):
    events = random_events(seed)
    random.Random(seed).shuffle(events)
    first, second = (spark.createDataFrame(part, SCHEMA) for part in (events[:150], events[150:]))
    args = dict(keys=["k"], seq=["seq"], delete_when="op = 'D'", untracked=["op"])
    published = cdc.scd2(first, **args)
    assert found(cdc.scd2_refresh(published, first, second, **args)) == brute(events)


def test_streamed_history_with_null_keys(spark):
    events = random_events(8) + [(None, a, b, seq, op) for _, a, b, seq, op in random_events(9, 20) if op != "D"]
    events = list({(e[0], e[3]): e for e in events}.values())
    source, store, target, checkpoint = (scratch_path(spark, n) for n in ("events", "store", "dimension", "checkpoint"))
    for part in (events[:100], events[100:200], events[200:]):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        stream = flows.file_stream(spark, source, "parquet", spark.createDataFrame([], SCHEMA).schema)
        flows.drain(flows.scd2_flow(stream, store, target, ["k"], ["seq"], checkpoint, buckets=4, delete_when="op = 'D'", untracked=["op"]), 120)
    known = [(-1 if e[0] is None else e[0], *e[1:]) for e in events]
    assert sorted(h.replace("(None,", "(-1,", 1) if h.startswith("(None") else h for h in found(flows.read_dimension(spark, target))) == brute(known)


@pytest.mark.parametrize("broken", ["events", "dimension"])
def test_a_flow_that_stops_half_way_starts_again(spark, monkeypatch, broken):
    """The first batch dies after its events, or after its dimension, was written."""
    events = random_events(10)
    source, store, target, checkpoint = (scratch_path(spark, n) for n in ("events", "store", "dimension", "checkpoint"))
    spark.createDataFrame(events, SCHEMA).coalesce(1).write.parquet(source)

    def run():
        stream = flows.file_stream(spark, source, "parquet", spark.createDataFrame([], SCHEMA).schema)
        flows.drain(flows.scd2_flow(stream, store, target, ["k"], ["seq"], checkpoint, buckets=4, delete_when="op = 'D'", untracked=["op"]), 120)

    replace = changes.replace_partitions

    def dies(*args):
        if broken == "dimension":
            replace(*args)
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(changes, "replace_partitions", dies)
        with pytest.raises(Exception, match="stopped"):
            run()
    run()
    assert found(flows.read_dimension(spark, target)) == brute(events)


def test_truncate_and_tombstones(spark):
    events = spark.createDataFrame([(1, "x", 1, 1, "U"), (2, "y", 2, 2, "U"), (9, None, None, 3, "T"), (2, "z", 3, 4, "U"), (3, "q", 4, 5, "U")], SCHEMA)
    got = cdc.scd1(events, ["k"], ["seq"], truncate_when="op = 'T'")
    assert sorted(r["k"] for r in got.collect()) == [2, 3]
    none = cdc.scd1(events.filter("op <> 'T'"), ["k"], ["seq"], truncate_when="op = 'T'")
    assert sorted(r["k"] for r in none.collect()) == [1, 2, 3]


def test_null_update_modes(spark):
    events = spark.createDataFrame([(1, "x", 1, 1, "U"), (1, None, None, 2, None), (1, None, 5, 3, "U")], SCHEMA)
    assert cdc.scd1(events, ["k"], ["seq"], ignore_nulls="keep_old").collect()[0].asDict() == {"k": 1, "a": "x", "b": 5, "seq": 3, "op": "U"}
    assert cdc.scd1(events, ["k"], ["seq"], ignore_nulls="skip_row").collect()[0]["a"] is None
    assert cdc.skip_null_rows(events, ["a", "b"]).count() == 2


def test_manual_scd2_step(spark):
    dim = spark.sql("""SELECT * FROM VALUES (1, 'a', true, DATE'2024-01-01', CAST(NULL AS DATE)), (2, 'b', true, DATE'2024-01-01', NULL),
        (1, 'old', false, DATE'2023-01-01', DATE'2024-01-01') AS t(id, v, is_current, start_date, end_date)""")
    source = spark.createDataFrame([(1, "A"), (2, "b"), (3, "c")], "id int, v string")
    out = cdc.scd2_merge(dim, source, ["id"], ["v"], "2024-06-01")
    assert rows(out.select("id", "v", "is_current", F.col("end_date").isNull().alias("open"))) == rows(spark.createDataFrame(
        [(1, "old", False, False), (1, "a", False, False), (1, "A", True, True), (2, "b", True, True), (3, "c", True, True)],
        "id int, v string, is_current boolean, open boolean"))


def test_zones_on_changing_days(spark):
    """Missing and doubled hours, and all others around them, as Python's zoneinfo has them."""
    import datetime as dt
    from zoneinfo import ZoneInfo

    from pyspark.sql import functions as F

    from lakeloom.functions import scalars as fx
    walls = [dt.datetime(y, m, 24) + dt.timedelta(minutes=30 * k) for y in (1994, 1996, 2024) for m in (3, 9, 10) for k in range(8 * 48)]
    df = spark.createDataFrame([(str(w),) for w in walls], "t string").withColumn("wall", F.col("t").cast("timestamp"))
    got = df.select("t", fx.local_to_utc(F.col("wall"), F.lit("Europe/Berlin")).cast("string").alias("u"), F.from_utc_timestamp("wall", "America/New_York").cast("string").alias("s")).collect()
    for r in got:
        wall = dt.datetime.fromisoformat(r["t"])
        assert r["u"] == str(wall.replace(tzinfo=ZoneInfo("Europe/Berlin")).astimezone(dt.UTC).replace(tzinfo=None))
        assert r["s"] == str(wall.replace(tzinfo=dt.UTC).astimezone(ZoneInfo("America/New_York")).replace(tzinfo=None))
