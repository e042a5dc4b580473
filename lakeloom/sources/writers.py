"""Managed and external tables, CTAS, views and multi-format bronze ingest."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.session import scratch_path
from lakeloom.sources.readers import read_files


def create_database(spark: SparkSession, name: str | None = None, location: str | None = None) -> str:
    """A database whose managed tables lie below ``location`` (the shared folder by default)."""
    name = name or f"lake_{uuid.uuid4().hex[:10]}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{location or scratch_path(spark, name)}'")
    return name


def save_managed(df: DataFrame, name: str, mode: str = "overwrite", **options) -> None:
    """Dropping the table removes the files."""
    df.write.format("parquet").options(**options).mode(mode).saveAsTable(name)


def save_external(df: DataFrame, path: str, name: str | None = None, mode: str = "overwrite") -> None:
    """Files at ``path``; the optional table entry can be dropped without losing them."""
    df.write.mode(mode).parquet(path)
    if name:
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
        df.sparkSession.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}'")


def create_table_as(spark: SparkSession, name: str, select: str) -> None:
    """CREATE OR REPLACE TABLE AS SELECT: a rerun gives the same table, not more rows."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} USING parquet AS {select}")


def create_views(df: DataFrame, name: str, session: bool = True, shared: bool = False) -> None:
    if session:
        df.createOrReplaceTempView(name)
    if shared:
        df.createOrReplaceGlobalTempView(name)


def create_permanent_view(spark: SparkSession, name: str, select: str) -> None:
    """Stored definition over catalog tables; no data."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {select}")


def ingest_to_bronze(spark: SparkSession, sources: dict[str, tuple[str, str]], target: str) -> dict[str, DataFrame]:
    """Loads ``{table: (format, path)}`` into ``target/<table>`` with ``_source_file`` and
    ``_ingestion_timestamp``; overwrites, so a rerun gives the same tables."""
    loaded = {}
    for name, (fmt, path) in sources.items():
        raw = read_files(spark, path, fmt, metadata=False)
        raw.select("*", F.col("_metadata.file_path").alias("_source_file"),
                   F.current_timestamp().alias("_ingestion_timestamp")
                   ).write.mode("overwrite").parquet(f"{target}/{name}")
        loaded[name] = spark.read.parquet(f"{target}/{name}")
    return loaded
