"""Streamed dimensions whose cost goes by the batch, not by what came before.

A dimension is four plain folders.  ``events`` is the log of all events by bucket of their key, a folder
for each batch.  ``open`` holds one row a key, the end of its chain: the newest state, since when, and
the newest sequence seen.  ``closed`` holds versions that have ended, a folder for each batch.
``rebuilt`` names, for each batch, the keys whose chain was made anew: their older closed rows do
not count any more.

A batch reads the open rows of the buckets its keys fall into.  Keys whose events are all newer than
their chain's end go on from there.  Only keys with a late event read the log, in their buckets.
Buckets grow by linear hashing: when open rows are more than ``bucket_rows`` a bucket, the next ones
are split, one by one, and no other bucket is touched.

Every step may be stopped and sent again.  Batches own their folders of the log, of ``closed`` and of
``rebuilt``; an open row that is ahead of a batch sent again makes its events late ones, and
chains built from the log are right whatever was there.  A split copies rows to the new bucket,
then raises the count, and a row counts only in the bucket its key has by that count."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lakeloom.operators import cdc
from lakeloom.operators.changes import BUCKET, replace_partitions
from lakeloom.operators.joins import join_null_safe
from lakeloom.operators.windows import HOT_ROWS, Hot, hot_keys, latest_per_key
from lakeloom.session import delete_path, setting, stage
from lakeloom.sources.incremental import path_exists
from lakeloom.streaming.flows import each_batch

FIRST_BUCKETS = 16
BUCKET_ROWS = 1_000_000
BATCH, GONE, SINCE, SEEN = "_batch", "_gone", "_since", "_seen"


def address(keys: list[str], buckets: int, first: int = FIRST_BUCKETS) -> Column:
    """The bucket of a key among ``buckets``: by the larger power-of-two multiple of ``first``, or by half of it
    where that bucket is not there yet."""
    whole = first
    while whole < buckets:
        whole *= 2
    h = F.xxhash64(*keys)
    wide = F.pmod(h, F.lit(whole))
    return F.when(wide >= buckets, F.pmod(h, F.lit(whole // 2))).otherwise(wide).cast("int")


def parent_bucket(bucket: int, first: int = FIRST_BUCKETS) -> int | None:
    """The bucket that ``bucket`` was split from; None for the first ones."""
    if bucket < first:
        return None
    whole = first
    while whole * 2 <= bucket:
        whole *= 2
    return bucket - whole


def ancestors(buckets: list[int], first: int = FIRST_BUCKETS) -> list[int]:
    """The buckets and all that they were split from: where the log may hold their keys."""
    out, left = set(), list(buckets)
    while left:
        b = left.pop()
        if b is not None and b not in out:
            out.add(b)
            left.append(parent_bucket(b, first))
    return sorted(out)


class KeyedHistory:
    """The folders of a dimension below ``root`` and the steps on them.  ``event`` is the schema of the events;
    ``seq`` orders the events of a key (unique inside a key: doubles count once)."""

    def __init__(self, spark: SparkSession, root: str, event: T.StructType, keys: list[str], seq: list[str], delete_when: str | None = None,
                 truncate_when: str | None = None, untracked: tuple[str, ...] = (), first: int = FIRST_BUCKETS, bucket_rows: int = BUCKET_ROWS):
        self.spark, self.root, self.keys, self.seq = spark, root, keys, seq
        self.event, self.names = event, [f.name for f in event]
        self.delete_when, self.truncate_when, self.untracked = delete_when, truncate_when, untracked
        self.first, self.bucket_rows = first, bucket_rows
        seq_type = T.StructType([event[c] for c in seq])
        self.open_schema = T.StructType([*event.fields, T.StructField(GONE, T.BooleanType()), T.StructField(SEEN, seq_type), T.StructField(BUCKET, T.IntegerType())])
        self.log_schema = T.StructType([*event.fields, T.StructField(BUCKET, T.IntegerType()), T.StructField(BATCH, T.LongType())])
        start = event[seq[0]].dataType
        self.closed_schema = T.StructType([*event.fields, T.StructField(cdc.START, start), T.StructField(cdc.END, start), T.StructField(BATCH, T.LongType())])
        self.key_schema = T.StructType([*[event[k] for k in keys], T.StructField(BATCH, T.LongType())])

    def _read(self, name: str, schema: T.StructType) -> DataFrame:
        path = f"{self.root}/{name}"
        return self.spark.read.schema(schema).parquet(path) if path_exists(self.spark, path) else self.spark.createDataFrame([], schema)

    def bucket_count(self) -> int:
        """The buckets in use: the highest mark that splits have left."""
        top = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/buckets/n=*")
        marks = top.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(top) or []
        return max((int(m.getPath().getName()[2:]) for m in marks), default=self.first)

    def open_rows(self, buckets: list[int] | None = None) -> DataFrame:
        """Chain ends, of all buckets or some; a row that lies where its key has moved from is left out."""
        rows = self._read("open", self.open_schema)
        if buckets is not None:
            rows = rows.filter(F.col(BUCKET).isin(buckets))
        return rows.filter(F.col(BUCKET) == address(self.keys, self.bucket_count(), self.first))

    def log(self) -> DataFrame:
        return self._read("events", self.log_schema)

    def _cut(self, rows: DataFrame, column: Column) -> DataFrame:
        """Rows behind the newest truncate event."""
        if self.truncate_when is None or not path_exists(self.spark, f"{self.root}/cuts"):
            return rows
        newest = self.spark.read.parquet(f"{self.root}/cuts").agg(F.max("cut").alias("m")).scalar()
        return rows.withColumn("_cut", newest).filter(F.col("_cut").isNull() | (column > F.col("_cut"))).drop("_cut")

    def _gone(self) -> Column:
        return F.coalesce(F.expr(self.delete_when), F.lit(False)) if self.delete_when else F.lit(False)

    def apply(self, rows: DataFrame, batch: int) -> dict[str, int]:
        """One batch; tells the rows it read of ``open`` and of the log."""
        spark, keys, order = self.spark, self.keys, F.struct(*self.seq)
        buckets = self.bucket_count()
        if self.truncate_when is not None:
            cut = F.coalesce(F.expr(self.truncate_when), F.lit(False))
            found = rows.filter(cut).agg(F.max(order).alias("cut")).filter("cut IS NOT NULL")
            if found.head(1):
                found.write.mode("overwrite").parquet(f"{self.root}/cuts/batch={batch}")
            rows = rows.filter(~cut)
        placed = rows.select(*self.names).withColumn(BUCKET, address(keys, buckets, self.first)).withColumn(BATCH, F.lit(batch).cast("bigint"))
        placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET, BATCH).parquet(f"{self.root}/events")
        arrived = self.log().filter(F.col(BATCH) == batch)
        touched = sorted(r[0] for r in arrived.select(BUCKET).distinct().collect())  # bucket numbers
        if not touched:
            return {"open": 0, "log": 0}
        ends = stage(self.open_rows(touched), "open")
        first = arrived.groupBy(*keys).agg(F.min(order).alias("_least"))
        known = stage(join_null_safe(first, ends.select(*keys, SEEN), keys, "left"), "known")
        late = known.filter(F.col("_least") <= F.col(SEEN)).select(*keys)
        events = arrived.select(*self.names).withColumn(GONE, self._gone())
        read = {"open": ends.count(), "log": 0}
        has_late = bool(late.head(1))
        if has_late:
            where = ancestors(touched, self.first)
            old = stage(join_null_safe(self.log().filter(F.col(BUCKET).isin(where)), late, keys, "left_semi"), "log")
            read["log"] = old.count()
            usual = join_null_safe(events, late, keys, "left_anti")
            going = join_null_safe(ends, late, keys, "left_anti")
            again = old.select(*self.names).withColumn(GONE, self._gone())
            events = usual.unionByName(again)
        else:
            going = ends
        if has_late:
            late.withColumn(BATCH, F.lit(batch).cast("bigint")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(f"{self.root}/rebuilt")
        # a chain's end goes on as the event that began it; keys without events stay as they are
        active = join_null_safe(going, first.select(*keys), keys, "left_semi")
        line = stage(events.unionByName(active.select(*self.names, GONE)), "line")
        limit = setting(spark, "hotRows", HOT_ROWS)
        hot = hot_keys(line, keys) if line.count() > limit else Hot([], limit)  # a small line has no hot keys
        chains = stage(cdc.scd2(line, keys, self.seq, delete_when=GONE, untracked=(*self.untracked, GONE), hot=hot), "chains")
        closed = chains.filter(F.col(cdc.END).isNotNull()).drop(GONE).select(*self.names, cdc.START, cdc.END)
        closed.withColumn(BATCH, F.lit(batch).cast("bigint")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(f"{self.root}/closed")
        newest = latest_per_key(line, keys, self.seq).withColumn(SEEN, order)
        current = chains.filter(F.col(cdc.END).isNull()).select(*self.names, F.lit(False).alias(GONE))
        live = join_null_safe(current, newest.select(*keys, SEEN), keys)
        dead = newest.filter(F.col(GONE)).select(*self.names, GONE, SEEN)
        # what an end has seen may be newer than the event that began its version
        seen = active.select(*keys, F.col(SEEN).alias("_before"))
        fresh = join_null_safe(live.unionByName(dead), seen, keys, "left").withColumn(
            SEEN, F.greatest(F.col(SEEN), F.coalesce("_before", F.col(SEEN)))).drop("_before")
        untouched = join_null_safe(ends, first.select(*keys), keys, "left_anti").drop(BUCKET)
        both = fresh.select(*self.names, GONE, SEEN).unionByName(untouched.select(*self.names, GONE, SEEN))
        replace_partitions(both.withColumn(BUCKET, address(keys, buckets, self.first)), f"{self.root}/open", BUCKET, touched)
        self.grow((read["open"] + known.filter(F.col(SEEN).isNull()).count()) * buckets // len(touched))
        return read

    def grow(self, rows: int) -> int:
        """Splits buckets, the next ones in turn, until ``rows`` open rows fit (judged by the buckets a batch
        has met); returns the number of buckets."""
        buckets = self.bucket_count()
        wanted = max(buckets, min(2 * buckets, -(-rows // self.bucket_rows)))
        if wanted == buckets:
            return buckets
        sources = sorted({parent_bucket(b, self.first) for b in range(buckets, wanted)})
        moved = self.open_rows(sources).withColumn("_to", address(self.keys, wanted, self.first)).filter(F.col("_to") >= buckets)
        copied = stage(moved.drop(BUCKET).withColumnRenamed("_to", BUCKET), "split")
        copied.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(f"{self.root}/open")
        mark = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/buckets/n={wanted}")
        mark.getFileSystem(self.spark._jsc.hadoopConfiguration()).mkdirs(mark)
        return wanted

    def current(self) -> DataFrame:
        """Type 1: the live row of each key, as of its newest event."""
        live = self._cut(self.open_rows().filter(~F.col(GONE)), F.col(SEEN))
        return live.select(*self.names)

    def versions(self) -> DataFrame:
        """Type 2: closed versions that still count, and the open ones."""
        void = self._read("rebuilt", self.key_schema).groupBy(*self.keys).agg(F.max(BATCH).alias("_void"))
        closed = join_null_safe(self._read("closed", self.closed_schema), void, self.keys, "left")
        closed = closed.filter(F.col("_void").isNull() | (F.col(BATCH) >= F.col("_void"))).select(*self.names, cdc.START, cdc.END)
        kind = self.closed_schema[cdc.END].dataType
        live = self.open_rows().filter(~F.col(GONE)).select(*self.names, F.col(self.seq[0]).alias(cdc.START), F.lit(None).cast(kind).alias(cdc.END))
        return closed.unionByName(live)

    def drop(self) -> None:
        delete_path(self.spark, self.root)


def history_flow(stream: DataFrame, history: KeyedHistory, checkpoint: str, told: Callable[[int, dict[str, int]], None] | None = None, **kw) -> StreamingQuery:
    """Keeps ``history`` batch by batch; ``told`` hears what each batch has read."""
    def write(rows: DataFrame, batch: int) -> None:
        read = history.apply(rows, batch)
        if told:
            told(batch, read)
    return each_batch(stream, write, checkpoint, **kw)
