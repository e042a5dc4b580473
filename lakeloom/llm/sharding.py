"""Sharding by longest processing time: groups that must stay together, largest first, each to
the shard with the least load."""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.session import stage

SHARDS = 16
#: Small groups travel in so many bundles; groups above the mean bundle travel alone.  Both are
#: at most so many, so what the driver schedules is bounded whatever the number of groups.
BUNDLES = 1 << 16
#: Rows of a shard that are numbered in one task, on average.
BUCKET_ROWS = 5_000


def longest_first(units: list[tuple[object, int]], shards: int) -> dict:
    """{unit: shard}: units by falling size (ties by name), each to the least-loaded shard."""
    loads = [(0, s) for s in range(shards)]
    placed = {}
    for name, size in sorted(units, key=lambda u: (-u[1], str(u[0]))):
        load, shard = loads[0]
        placed[name] = shard
        heapq.heapreplace(loads, (load + size, shard))
    return placed


def byte_size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def shard(docs: DataFrame, shards: int = SHARDS, group: Column | None = None, size: Column | None = None,
          bundles: int = BUNDLES, id_column: str = "doc_id", keep: tuple[Column, ...] = ()) -> DataFrame:
    """Per row of ``docs``: doc_id, size, shard, slot (gapless from 0 in every shard) and the
    columns of ``keep``.

    Rows with equal ``group`` (default: equal texts; null counts as empty) get one shard, and
    the shards' sums of ``size`` (default: UTF-8 bytes plus 1) are near equal.  Groups above
    total/``bundles`` are scheduled one by one, all others in bundles by hash, so no group is
    split and a hot group is summed before it is shuffled.  Slots follow a hash order that is
    cut into buckets; rows may repeat; a null doc_id is a doc_id; no rows give no rows."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    group = F.sha2(text, 256) if group is None else F.sha2(F.to_json(F.struct(group.alias("g"))), 256)
    size = byte_size(F.col("text").cast("string")) if size is None else size.cast("long")
    narrow = stage(docs.select(F.col(id_column).cast("long").alias("doc_id"), size.alias("size"), group.alias("group"), *keep), "shard")
    bundle = F.concat(F.lit("bundle "), F.pmod(F.xxhash64("group"), F.lit(bundles)).cast("string"))

    groups = narrow.groupBy("group").agg(F.sum("size").alias("size"))
    total, rows = narrow.agg(F.sum("size"), F.count(F.lit(1))).first()
    alone = F.col("size") * bundles > F.lit(total or 0)
    units = stage(groups.groupBy(F.when(alone, F.col("group")).otherwise(bundle).alias("unit")).agg(F.sum("size").alias("size")), "units")
    placed = longest_first([(r["unit"], r["size"]) for r in units.collect()], shards)

    schema = "unit string, shard int"
    spark = docs.sparkSession
    whole = spark.createDataFrame([(u, s) for u, s in placed.items() if not u.startswith("bundle ")], schema).withColumnsRenamed({"unit": "group", "shard": "own"})
    packed = spark.createDataFrame([(u, s) for u, s in placed.items() if u.startswith("bundle ")], schema)
    dealt = (narrow.join(F.broadcast(whole), "group", "left").withColumn("unit", bundle)
             .join(F.broadcast(packed), "unit", "left")
             .withColumn("shard", F.coalesce("own", "shard")).drop("own", "unit"))
    return _numbered(dealt, max(1, -(-rows // (shards * BUCKET_ROWS)))).drop("group")


def _numbered(dealt: DataFrame, buckets: int) -> DataFrame:
    """``dealt`` with slots: rows are counted by bucket of a hash order, then numbered inside."""
    cut = dealt.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "group"), F.lit(buckets)).cast("int"))
    before = (cut.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
              .withColumn("before", F.sum("n").over(Window.partitionBy("shard").orderBy("bucket")) - F.col("n")).drop("n"))
    inside = Window.partitionBy("shard", "bucket").orderBy(F.col("doc_id").asc_nulls_last(), "group")
    return (cut.withColumn("slot", F.row_number().over(inside) - 1).join(before, ["shard", "bucket"])
            .withColumn("slot", (F.col("slot") + F.col("before")).cast("long")).drop("bucket", "before"))
