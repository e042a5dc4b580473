"""Rerunnable ingest: the batch load with a file ledger and stored, evolving schemas."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.session import stage
from lakeloom.sources.readers import provenance

SCHEMAS = "load_id bigint, schema string"
LEDGER = "path string, modified timestamp, size bigint, load_id bigint"
MODES = ("addNewColumns", "rescue", "failOnNewColumns", "none")


def path_exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def list_files(spark: SparkSession, path, pattern: str | None = None) -> DataFrame:
    """Path, modification time and size of every file; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).select(
        "path", F.col("modificationTime").alias("modified"), F.col("length").alias("size"))


def read_ledger(spark: SparkSession, target: str) -> DataFrame:
    where = f"{target}/_ledger"
    if path_exists(spark, where):
        return spark.read.schema(LEDGER).parquet(where)
    return spark.createDataFrame([], LEDGER)


def copy_into(spark: SparkSession, target: str, source, fmt: str, select: list[str] = ("*",), schema=None,
              pattern: str | None = None, force: bool = False, **options) -> int:
    """Loads the files of ``source`` that the ledger does not know; returns the load id, or
    -1 when there was nothing to do.  ``force`` loads every file again.

    A load writes its own ``load_id`` folder, then its ledger rows.  A load that died before
    the ledger was written is invisible to ``read_loaded`` and overwritten by the next run,
    so a file counts exactly once."""
    files, known = list_files(spark, source, pattern), read_ledger(spark, target)
    new = stage(files if force else files.join(known, "path", "left_anti"), "listing")  # one listing a load
    paths = [r["path"] for r in new.select("path").collect()]  # file names, not data
    if not paths:
        return -1
    load_id = (known.agg(F.max("load_id")).first()[0] or 0) + 1
    reader = spark.read.format(fmt).options(**({"header": True} if fmt == "csv" else {}), **options)
    rows = (reader.schema(schema) if schema is not None else reader).load(paths)
    picked = rows.select(*[F.expr(e) for e in select], *provenance())
    picked.write.mode("overwrite").parquet(f"{target}/rows/load_id={load_id}")
    spark.createDataFrame([(load_id, picked.schema.json())], SCHEMAS).coalesce(1).write.mode("append").parquet(f"{target}/_schemas")
    new.withColumn("load_id", F.lit(load_id).cast("bigint")).write.mode("append").parquet(f"{target}/_ledger")
    return load_id


def _common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """A type that holds the values of both: the wider number, else text."""
    if a == b:
        return a
    numbers = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)
    if isinstance(a, numbers) and isinstance(b, numbers):
        return max(a, b, key=lambda t: numbers.index(type(t)))
    return T.StringType()


def read_loaded(spark: SparkSession, target: str) -> DataFrame:
    """Rows of the finished loads.  Columns added by later loads are null in earlier ones; where
    a column changed its type, all loads are read with the wider one.  Loads with one schema are
    one scan."""
    done = read_ledger(spark, target).select("load_id").distinct()
    stored = (spark.read.schema(SCHEMAS).parquet(f"{target}/_schemas").groupBy("load_id").agg(F.max("schema").alias("schema"))
              .join(done, "load_id", "left_semi"))
    groups = stored.groupBy("schema").agg(F.min("load_id").alias("first")).orderBy("first").collect()  # schemas, not loads
    schemas = [T.StructType.fromJson(json.loads(r["schema"])) for r in groups]
    kinds: dict[str, T.DataType] = {}
    for schema in schemas:
        for field in schema:
            kinds[field.name] = _common_type(kinds.get(field.name, field.dataType), field.dataType)
    parts = []
    for row, schema in zip(groups, schemas, strict=True):
        full = T.StructType([*schema.fields, T.StructField("load_id", T.LongType())])
        loads = stored.filter(F.col("schema") == row["schema"]).select("load_id")
        rows = spark.read.schema(full).parquet(f"{target}/rows")
        if len(groups) == 1:
            rows = rows.join(F.broadcast(loads), "load_id", "left_semi")
        else:  # files of another schema must not even be opened
            rows = rows.filter(F.col("load_id").isin([r[0] for r in loads.collect()]))
        parts.append(rows.select("load_id", *[
            (F.col(f"`{n}`").cast(kind) if n in schema.names else F.lit(None).cast(kind)).alias(n) for n, kind in kinds.items()]))
    return reduce(DataFrame.unionByName, parts)


def once(spark: SparkSession, target: str, name: str, rows: DataFrame) -> bool:
    """Backfill that runs a single time under ``name``; a rerun adds nothing."""
    done = read_ledger(spark, target)
    if done.filter(F.col("path") == name).head(1):
        return False
    load_id = (done.agg(F.max("load_id")).first()[0] or 0) + 1
    rows.write.mode("overwrite").parquet(f"{target}/rows/load_id={load_id}")
    spark.createDataFrame([(load_id, rows.schema.json())], SCHEMAS).coalesce(1).write.mode("append").parquet(f"{target}/_schemas")
    mark = spark.range(1).select(
        F.lit(name).alias("path"), F.current_timestamp().alias("modified"),
        F.lit(0).cast("bigint").alias("size"), F.lit(load_id).cast("bigint").alias("load_id"))
    mark.write.mode("append").parquet(f"{target}/_ledger")
    return True


class NewColumns(Exception):
    """Arriving files hold columns the stored schema lacks."""


def evolve(stored: T.StructType, seen: T.StructType, mode: str = "addNewColumns") -> T.StructType:
    """Schema to read with, given the stored one and the one of the arriving files."""
    if mode not in MODES:
        raise ValueError(f"mode is one of {MODES}")
    names = set(stored.names)
    added = [f for f in seen if f.name not in names]
    if not added or mode == "none":
        return stored
    if mode == "failOnNewColumns":
        raise NewColumns(", ".join(f.name for f in added))
    if mode == "rescue":
        return stored
    return T.StructType([*stored.fields, *[T.StructField(f.name, f.dataType, True) for f in added]])


def load_schema(spark: SparkSession, where: str) -> tuple[T.StructType | None, str | None]:
    """Latest stored schema and the newest file time it was inferred from."""
    if not path_exists(spark, where):
        return None, None
    rows = spark.read.schema("n bigint, seen_until string, schema string").json(where)
    last = rows.orderBy(F.desc("n")).first()
    return T.StructType.fromJson(json.loads(last["schema"])), last["seen_until"]


def refresh_schema(spark: SparkSession, source: str, fmt: str, where: str, mode: str = "addNewColumns",
                   infer_types: bool = True, **options) -> T.StructType:
    """Schema for the next run: infers it from files newer than the last run only and
    evolves the stored one by ``mode``."""
    stored, until = load_schema(spark, where)
    newest = list_files(spark, source).agg(F.max("modified").cast("string")).first()[0]
    if stored is not None and (newest is None or newest == until):
        return stored
    reader = spark.read.format(fmt).options(**options)
    if fmt == "csv":
        reader = reader.option("header", True).option("inferSchema", infer_types)
    if fmt == "json" and not infer_types:
        reader = reader.option("primitivesAsString", True)
    if until is not None:
        reader = reader.option("modifiedAfter", until[:19].replace(" ", "T"))
    seen = reader.load(source).schema
    schema = seen if stored is None else evolve(stored, seen, mode)
    count = 0 if stored is None else spark.read.schema("n bigint").json(where).count()
    spark.createDataFrame([(count, newest, schema.json())], "n bigint, seen_until string, schema string"
                          ).write.mode("append").json(where)
    return schema
