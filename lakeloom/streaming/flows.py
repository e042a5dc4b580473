"""File streams, flows into Parquet tables, stream enrichment and streamed CDC."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lakeloom.operators import cdc, changes
from lakeloom.sources import dirty
from lakeloom.sources.incremental import refresh_schema
from lakeloom.sources.readers import provenance

DRAIN = {"availableNow": True}


def file_stream(spark: SparkSession, path: str, fmt: str, schema, max_files: int | None = None,
                newer_than: str | None = None, archive_to: str | None = None, delete_source: bool = False,
                **options) -> DataFrame:
    """Incremental scan of a folder, each file once per checkpoint.

    ``newer_than`` skips files that were there before (by modification time);
    ``archive_to`` or ``delete_source`` removes consumed files after the next batch."""
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if fmt == "csv":
        reader = reader.option("header", True)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if archive_to:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_to)
    elif delete_source:
        reader = reader.option("cleanSource", "delete")
    df = reader.load(path)
    if newer_than:
        df = df.filter(F.col("_metadata.file_modification_time") > F.lit(newer_than).cast("timestamp"))
    return df


def table_stream(spark: SparkSession, folder: str, name: str, **options) -> DataFrame:
    """A given Parquet table as a stream, be it one file or a folder of files."""
    path = f"{folder}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if where.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(where).isDirectory():
        return file_stream(spark, path, "parquet", schema, **options)
    return file_stream(spark, folder, "parquet", schema, pathGlobFilter=f"{name}.parquet", **options)


def evolving_stream(spark: SparkSession, path: str, fmt: str, state: str, mode: str = "addNewColumns",
             infer_types: bool = True, **options) -> DataFrame:
    """File stream with a stored schema that evolves by ``mode`` before each run.

    ``rescue`` keeps the stored schema; unknown fields and values that do not fit go to
    ``_rescued_data`` (JSON Lines only)."""
    schema = refresh_schema(spark, path, fmt, f"{state}/schema", mode, infer_types)
    if mode == "rescue":
        if fmt != "json":
            raise ValueError("mode rescue reads JSON Lines")
        return dirty.rescue_json(file_stream(spark, path, "text", "value string", **options), schema)
    return file_stream(spark, path, fmt, schema, **options)


def enrich(stream: DataFrame, *extra: Column) -> DataFrame:
    """Adds source file provenance and processing time."""
    return stream.select("*", *provenance(), F.current_timestamp().alias("processing_time"), *extra)


def drain(query: StreamingQuery, timeout: int | None = None) -> StreamingQuery:
    """Waits until an ``availableNow`` query has read what there was; raises its error."""
    if not query.awaitTermination(timeout) and timeout is not None:
        query.stop()
        raise TimeoutError(f"stream did not finish in {timeout} s")
    return query


def append_flow(stream: DataFrame, target: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """One named writer into a Parquet table; several flows may share the target when each
    has its own sub-folder and checkpoint."""
    return (stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
            .option("path", target).trigger(**(trigger or DRAIN)).start())


def each_batch(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str,
               mode: str = "append", trigger: dict | None = None) -> StreamingQuery:
    return (stream.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or DRAIN)).start())


def land_batches(stream: DataFrame, target: str, checkpoint: str, **kw) -> StreamingQuery:
    """``foreachBatch`` sink: a batch owns its ``batch_id`` folder, so a replay overwrites it."""
    def write(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")
    return each_batch(stream, write, checkpoint, **kw)


def file_state(landed: DataFrame) -> DataFrame:
    """What was read per file: size, batch, times and rows."""
    return landed.groupBy("source_file_path", "source_file_size", "ingestion_ts", "batch_id").agg(
        F.min("processing_time").alias("commit_time"), F.count(F.lit(1)).alias("rows"))


def in_memory(stream: DataFrame, name: str, mode: str = "append", checkpoint: str | None = None,
              trigger: dict | None = None) -> StreamingQuery:
    writer = stream.writeStream.format("memory").queryName(name).outputMode(mode)
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or DRAIN)).start()


def to_console(stream: DataFrame, rows: int = 20, checkpoint: str | None = None) -> StreamingQuery:
    writer = stream.writeStream.format("console").option("numRows", rows)
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    return writer.trigger(**DRAIN).start()


def windowed_counts(stream: DataFrame, ts: str, width: str, late: str, *keys: str) -> DataFrame:
    """Counts per tumbling window and key on event time.  Rows older than the watermark
    are dropped and their state freed.  Counting combines before the shuffle."""
    timed = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)
    counts = timed.groupBy(F.window(ts, width), *keys).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys, "n")


def held_state(spark: SparkSession, checkpoint: str, operator: int = 0) -> DataFrame:
    """What a stateful query holds after its last batch, read from its checkpoint: the columns of the key
    and of the value, one row for each entry of the state store."""
    rows = spark.read.format("statestore").option("operatorId", operator).load(checkpoint)
    return rows.select("key.*", "value.*")


def held_windows(spark: SparkSession, checkpoint: str, *keys: str) -> DataFrame:
    """The windows of ``windowed_counts`` that wait for the watermark, with their counts so far."""
    held = held_state(spark, checkpoint)
    window = next(f.name for f in held.schema if isinstance(f.dataType, T.StructType))
    return held.select(F.col(f"{window}.start").alias("window_start"), F.col(f"{window}.end").alias("window_end"), *keys, F.col("count").alias("n"))


def rate_orders(spark: SparkSession, rows_per_batch: int, categories: list[str], regions: list[str]) -> DataFrame:
    """Deterministic live orders: lookups by the running number."""
    ticks = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", rows_per_batch).load()
    v = F.col("value")
    pick = lambda values: F.element_at(F.array(*map(F.lit, values)), (v % len(values) + 1).cast("int"))
    return ticks.select(
        F.col("timestamp").alias("event_time"), v.alias("order_id"), (v % 1000).cast("int").alias("customer_id"),
        pick(categories).alias("category"), (v % 500 + 10).cast("decimal(10,2)").alias("order_amount"),
        pick(regions).alias("store_region"))


def join_static(stream: DataFrame, read_static: Callable[[], DataFrame],
                join: Callable[[DataFrame, DataFrame], DataFrame], target: str, checkpoint: str, **kw) -> StreamingQuery:
    """Stream-static join whose static side is read again in every batch."""
    def write(rows: DataFrame, batch_id: int) -> None:
        join(rows, read_static()).write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")
    return each_batch(stream, write, checkpoint, **kw)


def fact_flow(stream: DataFrame, read_dims: Callable[[], list[DataFrame]],
              build: Callable[..., DataFrame], target: str, checkpoint: str, **kw) -> StreamingQuery:
    """Streaming fact: ``build(batch, *dims)`` with the dimensions as of each batch."""
    return join_static(stream, lambda: read_dims(), lambda rows, dims: build(rows, *dims), target, checkpoint, **kw)


def cdc_flow(stream: DataFrame, events: str, target: str, keys: list[str], build: Callable[[DataFrame], DataFrame],
             checkpoint: str, buckets: int = 16, reaches_all: str | None = None, **kw) -> StreamingQuery:
    """Dimension ``target`` that is ``build`` of all events so far, kept batch by batch.

    Events go to plain folders by bucket of their keys and by batch, then the dimension's
    folders of the touched buckets are built anew from them.  Both writes replace what an
    earlier try of the batch left, so a batch may be replayed from any point.  An event for
    which ``reaches_all`` holds (a truncate) concerns every bucket."""
    def write(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        placed = changes.with_bucket(rows, keys, buckets).withColumn("_batch", F.lit(batch_id))
        placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(changes.BUCKET, "_batch").parquet(events)
        kept = T.StructType([*rows.schema.fields, T.StructField(changes.BUCKET, T.IntegerType()), T.StructField("_batch", T.LongType())])
        log = spark.read.schema(kept).parquet(events)
        arrived = log.filter(F.col("_batch") == batch_id)
        touched = sorted(r[0] for r in arrived.select(changes.BUCKET).distinct().collect())
        if not touched:
            return
        wide = F.coalesce(F.expr(reaches_all), F.lit(False)) if reaches_all else F.lit(False)
        if reaches_all and arrived.filter(wide).limit(1).count():
            touched = list(range(buckets))
        built = build(log.filter(F.col(changes.BUCKET).isin(touched) | wide).drop(changes.BUCKET, "_batch"))
        mine = changes.with_bucket(built, keys, buckets).filter(F.col(changes.BUCKET).isin(touched))
        changes.replace_partitions(mine, target, changes.BUCKET, touched)
    return each_batch(stream, write, checkpoint, **kw)


def scd1_flow(stream: DataFrame, events: str, target: str, keys: list[str], seq: list[str], checkpoint: str,
              buckets: int = 16, truncate_when: str | None = None, **options) -> StreamingQuery:
    """Type 1 dimension with the options of ``cdc.scd1``; late events land right."""
    build = lambda rows: cdc.scd1(rows, keys, seq, truncate_when=truncate_when, **options)
    return cdc_flow(stream, events, target, keys, build, checkpoint, buckets, truncate_when)


def scd2_flow(stream: DataFrame, events: str, target: str, keys: list[str], seq: list[str], checkpoint: str,
              buckets: int = 16, **options) -> StreamingQuery:
    """Type 2 dimension with the options of ``cdc.scd2``; late events land right."""
    return cdc_flow(stream, events, target, keys, lambda rows: cdc.scd2(rows, keys, seq, **options), checkpoint, buckets)


def read_dimension(spark: SparkSession, target: str) -> DataFrame:
    """The dimension that ``scd1_flow`` or ``scd2_flow`` keeps."""
    return spark.read.parquet(target).drop(changes.BUCKET)


def change_stream(spark: SparkSession, feed: str, schema, start_version: int = 0) -> DataFrame:
    """Stream over a folder of change files, from a version on."""
    return file_stream(spark, feed, "parquet", schema).filter(F.col("_commit_version") >= start_version)
