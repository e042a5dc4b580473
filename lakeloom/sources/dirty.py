"""Malformed input: parse modes, bad-record side output and the rescued-data column."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.sources.readers import as_schema

CORRUPT = "_corrupt_record"
RESCUED = "_rescued_data"


def read_with_mode(spark: SparkSession, path, fmt: str, schema: str, mode: str = "PERMISSIVE", **options) -> DataFrame:
    """PERMISSIVE keeps the text of a bad row in ``_corrupt_record``, DROPMALFORMED skips the
    row, FAILFAST raises.

    The scan converts only the columns a query needs and would judge a row by those alone.
    Here the verdict refers to all columns, so it does not depend on the query."""
    fields = as_schema(schema)
    full = T.StructType([*fields.fields, T.StructField(CORRUPT, T.StringType())])
    if fmt == "csv":
        options = {"header": True, **options}
    rows = spark.read.format(fmt).schema(full).options(columnNameOfCorruptRecord=CORRUPT, **options).load(path)
    every_column = F.xxhash64(*fields.names) != 0
    bad = F.when(every_column | F.col(CORRUPT).isNotNull(), F.col(CORRUPT))
    if mode == "PERMISSIVE":
        return rows.withColumn(CORRUPT, bad)
    if mode == "DROPMALFORMED":
        return rows.filter(bad.isNull()).drop(CORRUPT)
    if mode != "FAILFAST":
        raise ValueError("mode is PERMISSIVE, DROPMALFORMED or FAILFAST")
    report = F.raise_error(F.concat(F.lit("malformed record: "), bad)).cast("boolean")
    return rows.filter(F.when(bad.isNull(), F.lit(True)).otherwise(report)).drop(CORRUPT)


def split_bad_records(spark: SparkSession, path, fmt: str, schema: str, bad_path: str, **options) -> DataFrame:
    """Good rows, after the bad ones went to ``bad_path`` as JSON (path, record, reason)."""
    rows = read_with_mode(spark, path, fmt, schema, **options).withColumn("path", F.col("_metadata.file_path"))
    bad = rows.filter(F.col(CORRUPT).isNotNull()).select(
        "path", F.col(CORRUPT).alias("record"),
        F.lit(f"does not match {as_schema(schema).simpleString()}").alias("reason"))
    bad.write.mode("overwrite").json(bad_path)
    return rows.filter(F.col(CORRUPT).isNull()).drop(CORRUPT, "path")


def read_bad_records(spark: SparkSession, bad_path: str) -> DataFrame:
    return spark.read.schema("path string, record string, reason string").json(bad_path)


def rescue(df: DataFrame, fields: Column, schema: T.StructType | str, keep: list[str] = ()) -> DataFrame:
    """Typed columns of ``schema`` out of ``fields`` (map of text by field name), plus
    ``_rescued_data``: a JSON object of unknown fields and of values that do not fit."""
    wanted = as_schema(schema)
    src = df.withColumn("_f", fields)
    typed = {f.name: F.col("_f")[f.name].try_cast(f.dataType) for f in wanted}
    misfits = F.array_compact(F.array(*[
        F.when(F.col("_f")[n].isNotNull() & value.isNull(), F.lit(n)) for n, value in typed.items()]))
    known = F.array(*[F.lit(n) for n in typed])
    extra = F.map_filter("_f", lambda k, v: (~F.array_contains(known, k)) | F.array_contains(misfits, k))
    return src.select(
        *keep, *[value.alias(n) for n, value in typed.items()],
        F.when(F.size(extra) > 0, F.to_json(extra)).alias(RESCUED))


def rescue_json(lines: DataFrame, schema: T.StructType | str, keep: list[str] = ()) -> DataFrame:
    """``rescue`` over JSON Lines read as text (batch or stream); a line that is no object
    is rescued whole."""
    parsed = F.from_json("value", "map<string,string>")
    whole = F.create_map(F.lit(CORRUPT), F.col("value"))
    return rescue(lines, F.coalesce(F.when(F.size(parsed) > 0, parsed), whole), schema, keep)


def rescue_csv(spark: SparkSession, path, schema: T.StructType | str, **options) -> DataFrame:
    """``rescue`` over CSV files with a header."""
    text = spark.read.options(**{"header": True, **options}).csv(path)
    pairs = reduce(lambda acc, c: [*acc, F.lit(c), F.col(f"`{c}`")], text.columns, [])
    filled = F.map_filter(F.create_map(*pairs), lambda k, v: v.isNotNull())
    return rescue(text, filled, schema)
