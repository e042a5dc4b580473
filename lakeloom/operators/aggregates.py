"""Grouped, two-level and salted aggregates, profiles and statistics."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.scalars import mean_of_cents
from lakeloom.operators.joins import HEAVY_ROWS, heavy_keys, salts_for
from lakeloom.session import setting


def order_stats(df: DataFrame, keys: list[str | Column], key: str, amount: str) -> DataFrame:
    """count, sum, average, smallest and largest amount per group."""
    return df.groupBy(*keys).agg(
        F.count(key).alias("order_count"), F.round(F.sum(amount), 2).alias("total_revenue"),
        mean_of_cents(amount).alias("avg_order_value"),
        F.min(amount).alias("min_amount"), F.max(amount).alias("max_amount"))


def daily_rollup(df: DataFrame, ts: str, key: str, amount: str, *extra: str) -> DataFrame:
    """Count, revenue and mean per calendar day (and ``extra`` columns)."""
    return (df.groupBy(F.to_date(ts).alias("order_date"), *extra)
            .agg(F.count(key).alias("order_count"), F.round(F.sum(amount), 2).alias("total_revenue"),
                 mean_of_cents(amount).alias("avg_order_value")))


def monthly_activity(df: DataFrame, ts: str, member: str, amount: str) -> DataFrame:
    """Two levels: spend per month and member, then per month."""
    spend = df.groupBy(F.date_trunc("month", ts).alias("month"), member).agg(F.sum(amount).alias("spent"))
    return spend.groupBy("month").agg(
        F.count(member).alias("active_members"), F.round(F.sum("spent"), 2).alias("total_revenue"),
        mean_of_cents("spent").alias("avg_spend"), F.round(F.max("spent"), 2).alias("max_spend"))


def quality_profile(df: DataFrame, key: str, invalid: dict[str, str]) -> DataFrame:
    """One pass: rows, null keys, distinct keys and the rows meeting each ``invalid`` condition."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"), F.count_if(F.col(key).isNull()).alias("null_keys"),
        F.count_distinct(key).alias("distinct_keys"),
        *[F.count_if(F.expr(rule)).alias(name) for name, rule in invalid.items()])


def column_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, mean, min and max per column as rows, in one pass."""
    packed = df.agg(*[
        F.struct(F.lit(c).alias("column"), F.count(c).alias("count"),
                 F.round(F.avg(c), 4).alias("mean"), F.min(c).cast("double").alias("min"),
                 F.max(c).cast("double").alias("max")).alias(c) for c in columns])
    return packed.select(F.inline(F.array(*columns)))


BINS = 512
#: Values of the last range that are fetched to pick an order statistic.
LAST_VALUES = 1_000


def _stacked(df: DataFrame, columns: list[str]) -> DataFrame:
    """A row (c, v) for each value of the columns: the column's number, the value as a double."""
    cells = [F.struct(F.lit(i).alias("c"), F.col(c).cast("double").alias("v")) for i, c in enumerate(columns)]
    return df.select(F.inline(F.array(*cells))).filter("v IS NOT NULL")


def _spans(df: DataFrame, columns: list[str]) -> dict[str, tuple[float, float, int]]:
    """Smallest and largest value and number of values of each column that has any."""
    found = _stacked(df, columns).groupBy("c").agg(F.min("v").alias("a"), F.max("v").alias("b"), F.count("v").alias("n"))
    return {columns[r["c"]]: (r["a"], r["b"], r["n"]) for r in found.collect()} if columns else {}


def order_statistics(df: DataFrame, ranks: dict[str, list[int]],
                     spans: dict[str, tuple[float, float, int]] | None = None) -> dict[tuple[str, int], float]:
    """The values at the given ranks (from 0, nulls aside, NaN above all numbers) of numeric columns, as
    doubles: exact, without sorting the table or gathering a column in a task.

    All ranks narrow their range of values side by side, and ranks in the same range share it: ranges of
    a column are apart, so a value is counted once a pass.  A pass counts the values of each range by
    ``BINS`` equal parts (combined before the shuffle, so each map task sends some rows a range) and
    keeps the part that holds the rank with its smallest and largest value, until few values or one
    are left, which are fetched.  Equal values make one part whatever their number.  ``spans``: what
    ``_spans`` found, if known."""
    columns = list(ranks)
    spans = _spans(df, columns) if spans is None else spans
    open_ranges = {(c, k): (spans[c][0], spans[c][1], k, spans[c][2]) for c in columns if c in spans for k in ranks[c] if k < spans[c][2]}
    found = {}
    while open_ranges:
        for key, (low, high, _, _) in list(open_ranges.items()):
            if low == high or (low != low and high != high):
                found[key] = low
                del open_ranges[key]
        if not open_ranges:
            break
        last = {key for key, r in open_ranges.items() if r[3] <= LAST_VALUES}
        shared: dict[tuple, list] = {}
        for c, k in last or open_ranges:
            low, high, _, _ = open_ranges[c, k]
            shared.setdefault((c, low, high if high == high else None), []).append((c, k))
        used = sorted({c for c, _, _ in shared})
        ranges = [(i, used.index(c), low, high if high is not None else float("nan"), (high if high is not None else 1e308) - low)
                  for i, (c, low, high) in enumerate(shared)]
        wanted = F.broadcast(df.sparkSession.createDataFrame(ranges, "i int, r int, low double, high double, width double"))
        rows = _stacked(df, used).join(wanted, (F.col("c") == F.col("r")) & (F.col("v") >= F.col("low")) & (F.col("v") <= F.col("high")))
        keys = dict(enumerate(shared.values()))
        if last:
            for r in rows.groupBy("i").agg(F.sort_array(F.collect_list("v")).alias("v")).collect():
                for key in keys[r["i"]]:
                    found[key] = r["v"][open_ranges.pop(key)[2]]
            continue
        part = F.when(F.isnan("v"), F.lit(float(BINS))).otherwise(
            F.least(F.lit(BINS - 1.0), F.floor((F.col("v") - F.col("low")) / F.col("width") * BINS).cast("double")))
        parts: dict[int, list] = {}
        for r in rows.groupBy("i", part.alias("part")).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("a"), F.max("v").alias("b")).collect():
            parts.setdefault(r["i"], []).append(r)
        for i, held in keys.items():
            ordered = sorted(parts[i], key=lambda r: r["part"])
            for key in held:
                left = open_ranges[key][2]
                for r in ordered:
                    if left < r["n"]:
                        open_ranges[key] = (r["a"], r["b"], left, r["n"])
                        break
                    left -= r["n"]
    return found


def exact_quantiles(df: DataFrame, columns: list[str], shares: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """A row (column, q1, q2, ...) for each column: the exact quantiles, between two values by their
    distance; null for a column without values."""
    spans = _spans(df, columns)
    places = {c: [(s * (spans[c][2] - 1)) for s in shares] if c in spans else [] for c in columns}
    stats = order_statistics(df, {c: sorted({k for p in ps for k in (math.floor(p), math.ceil(p))}) for c, ps in places.items() if ps}, spans)

    def between(c: str, p: float) -> float:
        low, high = stats[c, math.floor(p)], stats[c, math.ceil(p)]
        return low + (high - low) * (p - math.floor(p)) if low != high else low

    rows = [(c, *([between(c, p) for p in ps] or [None] * len(shares))) for c, ps in places.items()]
    return df.sparkSession.createDataFrame(rows, "column string, " + ", ".join(f"q{i + 1} double" for i in range(len(shares))))


def salted_sum(df: DataFrame, key: str, amount: str, spread: list[str], salts: int | None = None,
               heavy_rows: int | None = None) -> DataFrame:
    """Two-phase sum and count: first per (key, salt), then per key.

    A key has as many salts as its rows need (or ``salts``), ordinary keys have one; heavy keys are
    found by ``frequent_keys``.  The salt is a hash of the ``spread`` columns (a row id), so a retried
    task puts a row in the same group."""
    limit = heavy_rows or setting(df.sparkSession, "hotRows", HEAVY_ROWS)
    parts = F.lit(salts) if salts else salts_for(F.col("rows"), limit)
    heavy = F.broadcast(heavy_keys(df, key, limit).select(F.col(key).alias("_h"), parts.alias("_salts")))
    placed = df.join(heavy, F.col(key).eqNullSafe(F.col("_h")), "left")
    salt = F.pmod(F.xxhash64(*spread), F.coalesce("_salts", F.lit(1))).alias("_salt")
    part = placed.groupBy(key, salt).agg(F.sum(amount).alias("_sum"), F.count(F.lit(1)).alias("_n"),
                                         F.count(amount).alias("_seen"))
    return part.groupBy(key).agg(
        F.sum("_n").alias("rows"), F.round(F.sum("_sum"), 2).alias("total"),
        F.try_divide(F.round(F.sum("_sum"), 2), F.sum("_seen")).alias("mean"))


def distinct_codes(df: DataFrame, column: str, unknown: str) -> DataFrame:
    """Distinct codes plus exactly one unknown code, whether or not the data holds it."""
    codes = df.select(column).where(F.col(column).isNotNull())
    return codes.union(df.sparkSession.range(1).select(F.lit(unknown))).distinct()
