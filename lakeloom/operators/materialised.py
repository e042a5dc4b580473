"""Aggregates that are kept up to date from the changes of their base table.

The groups lie in plain folders by bucket of their keys.  A refresh turns changes into signed sums per
group and reads, joins and rewrites only the buckets those groups fall into.  Sums and counts add
up; a smallest or largest value that a removed row may have held is read again from the base, for
such groups alone.  Give whole numbers (cents) as sums, so that what is added can be taken away."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.operators.changes import BUCKET, replace_partitions, with_bucket, write_buckets
from lakeloom.operators.joins import join_null_safe
from lakeloom.session import stage

ROWS, BATCH = "_rows", "_batch"


@dataclass(frozen=True)
class View:
    """``sums`` maps names to SQL over the base (whole numbers), ``extremes`` to ("min" or "max", column)."""
    path: str
    keys: list[str]
    sums: dict[str, str]
    extremes: dict[str, tuple[str, str]] = field(default_factory=dict)
    buckets: int = 64


_PICK = {"min": (F.min, F.least), "max": (F.max, F.greatest)}


def _extremes(view: View) -> list[Column]:
    return [_PICK[fn][0](col).alias(name) for name, (fn, col) in view.extremes.items()]


def create(view: View, base: DataFrame) -> None:
    """The first full computation."""
    state = base.groupBy(*view.keys).agg(
        F.count(F.lit(1)).alias(ROWS), *[F.coalesce(F.sum(F.expr(e)), F.lit(0)).alias(n) for n, e in view.sums.items()], *_extremes(view))
    write_buckets(state.withColumn(BATCH, F.lit(-1).cast("bigint")), view.path, view.keys, view.buckets)


def signed_deltas(view: View, changes: DataFrame) -> DataFrame:
    """Per touched group: rows and sums that came less those that went, and the extremes of both."""
    plus = F.col("_change_type").isin("insert", "update_postimage")
    sign = F.when(plus, 1).otherwise(-1)
    sides = [_PICK[fn][0](F.when(side, F.col(col))).alias(f"{mark}{name}")
             for name, (fn, col) in view.extremes.items() for mark, side in (("_add_", plus), ("_cut_", ~plus))]
    return changes.groupBy(*view.keys).agg(
        F.sum(sign).alias(f"_d{ROWS}"), *[F.coalesce(F.sum(sign * F.expr(e)), F.lit(0)).alias(f"_d{n}") for n, e in view.sums.items()], *sides)


def refresh(view: View, changes: DataFrame, batch: int, base: DataFrame) -> dict[str, int]:
    """Applies ``changes`` (rows of the base with ``_change_type``) as batch number ``batch``; ``base`` is the
    base table after them and is read only where an extreme may be gone (keep it in the same
    buckets, then that read is pruned too).  Tells how many buckets were rewritten and how many
    groups read again.

    Every bucket keeps the number of its last batch, so a batch that is sent again, or was stopped
    between two buckets, is applied to the rest alone.  Groups without rows stay as empty marks."""
    spark = changes.sparkSession
    deltas = stage(with_bucket(signed_deltas(view, changes), view.keys, view.buckets), "deltas")
    touched = sorted(r[0] for r in deltas.select(BUCKET).distinct().collect())  # bucket numbers
    state = spark.read.parquet(view.path).filter(F.col(BUCKET).isin(touched))
    done = {r[0] for r in state.filter(F.col(BATCH) >= batch).select(BUCKET).distinct().collect()}
    touched = [b for b in touched if b not in done]
    if not touched:
        return {"buckets": 0, "reread": 0}
    state = state.filter(F.col(BUCKET).isin(touched)).drop(BUCKET, BATCH)
    delta = deltas.filter(F.col(BUCKET).isin(touched)).drop(BUCKET)
    keys = view.keys
    both = join_null_safe(state.select(*keys).unionByName(delta.select(*keys)).distinct(), state, keys, "left")
    both = stage(join_null_safe(both, delta, keys, "left"), "merged")

    def total(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0)) + F.coalesce(F.col(f"_d{name}"), F.lit(0))

    gone = F.lit(False)
    for name, (fn, _) in view.extremes.items():
        cut, old = F.col(f"_cut_{name}"), F.col(name)
        gone = gone | F.coalesce(cut <= old if fn == "min" else cut >= old, F.lit(False))
    both = both.withColumn("_again", gone & (total(ROWS) > 0))
    again = both.filter("_again").select(*keys)
    reread = again.count() if view.extremes else 0
    merged = both
    if reread:
        near = base.filter(F.col(BUCKET).isin(touched)) if BUCKET in base.columns else base
        fresh = join_null_safe(near, F.broadcast(again) if reread < 100_000 else again, keys, "left_semi").groupBy(*keys).agg(
            *[_PICK[fn][0](col).alias(f"_new_{name}") for name, (fn, col) in view.extremes.items()])
        merged = join_null_safe(both, fresh, keys, "left")
    picked = {}
    for name, (fn, _) in view.extremes.items():
        kept = _PICK[fn][1](F.col(name), F.col(f"_add_{name}"))
        value = F.when(F.col("_again"), F.col(f"_new_{name}")).otherwise(kept) if reread else kept
        picked[name] = F.when(total(ROWS) > 0, value)
    out = merged.select(*keys, total(ROWS).alias(ROWS), *[total(n).alias(n) for n in view.sums],
                        *[c.alias(n) for n, c in picked.items()], F.lit(batch).cast("bigint").alias(BATCH))
    replace_partitions(with_bucket(out, keys, view.buckets), view.path, BUCKET, touched)
    return {"buckets": len(touched), "reread": reread}


def read(spark: SparkSession, view: View) -> DataFrame:
    """The groups that have rows: keys, ``_rows``, sums and extremes."""
    return spark.read.parquet(view.path).filter(F.col(ROWS) > 0).drop(BUCKET, BATCH)
