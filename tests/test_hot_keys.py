"""Split windows, joins and aggregates give what the plain forms give, with one key holding
a third of the rows and more."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakeloom.operators import aggregates as ag
from lakeloom.operators import cdc, joins
from lakeloom.operators import windows as w
from tests.conftest import rows

SPECS = {
    "rn": w.row_number(), "total": w.running("sum", "x"), "seen": w.running("count", "x"), "mean": w.running("avg", "x"),
    "low": w.running("min", "x"), "high": w.running("max", "x"), "last": w.running("last", "x"),
    "before": w.lag("x", 2), "after": w.lead("id"), "near": w.frame("sum", "x", 3), "near_max": w.frame("max", "id", 3),
}


@pytest.fixture(scope="module")
def skewed(spark):
    """8,000 rows; the null key holds a third, key 1 a fifth; x has nulls and ties in v."""
    key = F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 5 == 0, 1).otherwise(F.col("id") % 40)
    return spark.range(8000).select(
        key.alias("k"), F.pmod(F.hash("id"), F.lit(300)).alias("v"), F.when(F.col("id") % 7 != 0, F.col("id")).alias("x"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 90).cast("int")).alias("day"),
        F.concat(F.lit("s"), F.col("id").cast("string")).alias("name"), "id").cache()


@pytest.mark.parametrize("keys", [["k"], []])
@pytest.mark.parametrize("order", [["v", "id"], ["x desc", "name"], ["day", "name desc"]])
def test_windows(skewed, keys, order):
    assert w.hot_keys(skewed, keys, 300).rows
    split = w.with_windows(skewed, keys, order, SPECS, hot_rows=300)
    assert rows(split) == rows(w.with_windows(skewed, keys, order, SPECS))


def test_windows_against_native(skewed):
    window = Window.partitionBy("k").orderBy("day", "id")
    native = skewed.select("id", F.row_number().over(window).alias("rn"), F.sum("x").over(window.rowsBetween(Window.unboundedPreceding, 0)).alias("total"),
                           F.lag("x").over(window).alias("before"), F.max("x").over(window.rowsBetween(-4, 0)).alias("near"))
    split = w.with_windows(skewed, ["k"], ["day", "id"], {
        "rn": w.row_number(), "total": w.running("sum", "x"), "before": w.lag("x"), "near": w.frame("max", "x", 4)}, hot_rows=250)
    assert rows(split.select("id", "rn", "total", "before", "near")) == rows(native)


@pytest.mark.parametrize("keys", [["k"], []])
@pytest.mark.parametrize("order", [["v desc"], ["day"], ["x"]])
def test_ranks(skewed, keys, order):
    assert rows(w.with_ranks(skewed, keys, order, hot_rows=300)) == rows(w.with_ranks(skewed, keys, order))


@pytest.mark.parametrize("keys", [["k"], []])
def test_range_frame(skewed, keys):
    wanted = {"s": ("sum", "x"), "n": ("count", "id"), "m": ("min", "v"), "a": ("avg", "x")}
    framed = Window.partitionBy(*keys).orderBy("v").rangeBetween(-25, 0)
    native = skewed.select("*", F.sum("x").over(framed).alias("s"), F.count("id").over(framed).alias("n"),
                           F.min("v").over(framed).alias("m"), F.avg("x").over(framed).alias("a"))
    for limit in (None, 60):
        assert rows(w.with_range_frame(skewed, keys, "v", 25, wanted, hot_rows=limit)) == rows(native)


@pytest.mark.parametrize("keys", [["k"], []])
def test_range_frame_with_null_order_values(skewed, keys):
    holes = skewed.withColumn("v", F.when(F.col("id") % 9 != 0, F.col("v")))
    framed = Window.partitionBy(*keys).orderBy("v").rangeBetween(-25, 0)
    native = holes.select("*", F.sum("x").over(framed).alias("s"), F.count("id").over(framed).alias("n"))
    for limit in (None, 60):
        assert rows(w.with_range_frame(holes, keys, "v", 25, {"s": ("sum", "x"), "n": ("count", "id")}, hot_rows=limit)) == rows(native)


def test_totals_and_latest(skewed):
    window = Window.partitionBy("k")
    native = skewed.select("id", F.sum("x").over(window).alias("t"))
    assert rows(w.with_totals(skewed, ["k"], {"t": ("sum", "x")}).select("id", "t")) == rows(native)
    latest = skewed.withColumn("r", F.row_number().over(window.orderBy(F.desc("v"), F.desc("id")))).filter("r = 1").drop("r")
    assert rows(w.latest_per_key(skewed, ["k"], ["v", "id"])) == rows(latest)
    assert w.with_totals(skewed, [], {"t": ("count", "id")}).select("t").distinct().collect()[0]["t"] == 8000


def test_surrogate_key(skewed):
    plain = w.surrogate_key(skewed.select("name"), "key", ["name"])
    assert rows(w.surrogate_key(skewed.select("name"), "key", ["name"], hot_rows=500)) == rows(plain)


def test_joins(spark, skewed):
    small = spark.range(0, 30).select(F.col("id").alias("k"), F.concat(F.lit("n"), F.col("id").cast("string")).alias("label"))
    for how in ("inner", "left"):
        assert rows(joins.salted_join(skewed, small, "k", ["id"], 7, how, heavy_rows=500)) == rows(skewed.join(small, "k", how))
    plain = rows(skewed.join(small, "k"))
    assert rows(joins.isolated_join(skewed, small, "k", ["id"], heavy_rows=500)) == plain
    for how in ("inner", "left"):  # salts by the rows of each key
        assert rows(joins.salted_join(skewed, small, "k", ["id"], how=how, heavy_rows=50)) == rows(skewed.join(small, "k", how))


def test_salted_sum(skewed):
    plain = skewed.groupBy("k").agg(F.count(F.lit(1)).alias("rows"), F.round(F.sum("x"), 2).alias("total"),
                                    F.try_divide(F.sum("x"), F.count("x")).alias("mean"))
    assert rows(ag.salted_sum(skewed, "k", "x", ["id"])) == rows(plain)


def test_scd2_and_as_of_split(spark):
    """One key has most of the events; split and plain histories and lookups agree."""
    events = spark.range(3000).select(
        F.when(F.col("id") % 3 != 0, 1).otherwise(F.col("id") % 20).alias("k"), (F.col("id") / 4).cast("int").alias("price"),
        F.col("id").alias("seq"), F.when(F.col("id") % 50 == 0, "D").otherwise("U").alias("op"))
    hot = w.hot_keys(events, ["k"], 200)
    assert [r["k"] for r in hot.rows] == [1]
    args = dict(keys=["k"], seq=["seq"], delete_when="op = 'D'", untracked=["op"])
    plain, split = cdc.scd2(events, **args), cdc.scd2(events, **args, hot=hot)
    assert rows(split) == rows(plain)
    assert plain.count() < 2900  # unchanged neighbours are one version
    holes = events.withColumn("price", F.when(F.col("seq") % 3 != 1, F.col("price")))
    assert rows(cdc.scd2(holes, **args, ignore_nulls=True, hot=hot)) == rows(cdc.scd2(holes, **args, ignore_nulls=True))
    facts = spark.range(2500).select(F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id") % 20).alias("k"),
                                     (F.col("id") * 7 % 3000).alias("t"), F.col("id").alias("fact"))
    history = plain.select("k", F.col("price").alias("p"), cdc.START, cdc.END)
    native = facts.join(history, (facts["k"] == history["k"]) & (F.col("t") >= F.col(cdc.START))
                        & (F.col(cdc.END).isNull() | (F.col("t") < F.col(cdc.END))), "left").select(facts["k"], "t", "fact", "p")
    joined = cdc.as_of_join(facts, history, ["k"], "t", ["p"], w.hot_keys(facts, ["k"], 200))
    assert rows(joined) == rows(native)
    assert rows(cdc.as_of_join(facts, history, ["k"], "t", ["p"], w.Hot([], 0))) == rows(native)


@pytest.mark.parametrize(("keys", "width"), [(["k"], 120), ([], 100_000)])
def test_wide_range_frame(skewed, keys, width):
    """Frames over many blocks, up to one frame over all steps of a hot key."""
    wanted = {"s": ("sum", "x"), "n": ("count", "x"), "low": ("min", "x"), "high": ("max", "id"), "a": ("avg", "x")}
    holes = skewed.withColumn("v", F.when(F.col("id") % 9 != 0, F.col("id") * 7 % 5003)).withColumn("x", F.when(F.col("id") % 4 != 1, F.col("x")))
    framed = Window.partitionBy(*keys).orderBy("v").rangeBetween(-width, 0)
    native = holes.select("*", F.sum("x").over(framed).alias("s"), F.count("x").over(framed).alias("n"), F.min("x").over(framed).alias("low"),
                          F.max("id").over(framed).alias("high"), F.avg("x").over(framed).alias("a"))
    assert rows(w.with_range_frame(holes, keys, "v", width, wanted, hot_rows=40)) == rows(native)


def test_wide_frames_hold_no_key_in_one_task(spark):
    """One key, one frame over all its steps: no window of the plan is over the key alone, but for one
    row a block."""
    steps = spark.range(5_000).select(F.lit(1).alias("k"), F.col("id").alias("v"), (F.col("id") % 91).alias("_v_low"))
    out = w._wide_frames(steps, ["k"], "v", 100_000, {"_v_low": (F.min, "_v_low")}, w.hot_keys(steps, ["k"], 100))
    assert out.filter("_f_v_low <> 0").count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "rangebetween" not in plan.lower() and "RangeFrame" not in plan


def test_slices_meet_no_list_of_bounds(spark):
    """Slices hold ``limit`` rows at most and follow the order; no row is joined to the bounds of all slices
    (before, each row met a list as long as the number of its key's slices)."""
    df = spark.range(6_000).select((F.col("id") % 2).alias("k"), (F.col("id") * 7919 % 6_007).alias("v"))
    hot = w.hot_keys(df, ["k"], 10)
    out = w._with_slices(df, ["k"], ["v desc"], hot)
    assert sorted(out.columns) == ["_slice", "k", "v"] and out.count() == 6_000
    slices = out.groupBy("k", "_slice").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).orderBy("k", "_slice").collect()
    assert all(r["n"] <= 10 for r in slices) and 600 <= len(slices) <= 640
    assert all(a["low"] > b["high"] for a, b in zip(slices, slices[1:]) if a["k"] == b["k"])


def test_wide_frames_double_their_runs(spark):
    """Extremes over whole blocks come from two runs of half the length, never from a sliding frame over blocks."""
    steps = spark.range(3_000).select(F.lit(1).alias("k"), F.col("id").alias("v"), F.pmod(F.hash("id"), F.lit(1_000)).alias("_v_low"))
    framed = Window.partitionBy("k").orderBy("v").rangeBetween(-700, 0)
    out = w._wide_frames(steps, ["k"], "v", 700, {"_v_low": (F.min, "_v_low")}, w.hot_keys(steps, ["k"], 20))
    assert rows(out) == rows(steps.select("*", F.min("_v_low").over(framed).alias("_f_v_low")))


def test_frequent_keys(skewed):
    """No key above the limit is missed, whatever the number of counters, and none below is named."""
    for keys, limit, bins in ((["k"], 100, 1), (["k"], 700, 7), (["k", "v"], 1, 7), (["k", "v"], 9, 4096), (["name"], 0, None), (["k"], 10_000, None)):
        counts = skewed.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > limit)
        assert rows(joins.frequent_keys(skewed, keys, limit, bins)) == rows(counts), (keys, limit, bins)


def test_frequent_bins_bound(skewed):
    """A counter never falls short of a key, so the error is one-sided; a map task sends as many rows
    as there are counters at most, and keys are not part of the exchange."""
    bins = joins.frequent_bins(skewed, ["name"], 0, 16)
    assert bins.count() == 16 and bins.agg(F.sum("_n")).first()[0] == 8000
    plan = bins._jdf.queryExecution().executedPlan().toString()
    exchange = [line for line in plan.splitlines() if "Exchange" in line]
    assert exchange and all("name" not in line for line in exchange)


def test_salts_by_size(skewed):
    plain = skewed.groupBy("k").agg(F.count(F.lit(1)).alias("rows"), F.round(F.sum("x"), 2).alias("total"), F.try_divide(F.sum("x"), F.count("x")).alias("mean"))
    assert rows(ag.salted_sum(skewed, "k", "x", ["id"], heavy_rows=100)) == rows(plain)
