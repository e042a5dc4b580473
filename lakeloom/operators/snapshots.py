"""Dated copies of a table in plain Parquet folders.

Every write of the table is a folder ``version=N/operation=X/at=seconds`` below the root, so
Spark's own partition columns tell what a copy is; readers pick a folder and nothing else is
kept.  One writer per root; a copy that was written half is overwritten by the next run."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.operators.changes import changes_between
from lakeloom.session import delete_path

RETENTION_HOURS = 168
HISTORY = "version bigint, operation string, at timestamp"


class NoSnapshot(Exception):
    """No copy of the asked version or time is kept."""


def history(spark: SparkSession, root: str) -> DataFrame:
    """The finished copies: version, operation, time."""
    jvm = spark._jvm
    top = jvm.org.apache.hadoop.fs.Path(f"{root}/version=*/operation=*/at=*/_SUCCESS")
    found = top.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(top) or []
    rows = [re.search(r"version=(\d+)/operation=([^/]+)/at=(-?\d+)/", s.getPath().toString()).groups() for s in found]
    listed = spark.createDataFrame([(int(v), o, int(t)) for v, o, t in rows], "version bigint, operation string, at bigint")
    return listed.withColumn("at", F.timestamp_seconds("at"))


def _entry(spark: SparkSession, root: str, version: int | None = None, at: str | None = None):
    kept = history(spark, root)
    if version is not None:
        kept = kept.filter(F.col("version") == version)
    if at is not None:
        kept = kept.filter(F.col("at") <= F.lit(at).cast("timestamp"))
    entry = kept.select("version", "operation", F.unix_seconds("at").alias("at")).orderBy(F.desc("version")).first()
    if entry is None:
        raise NoSnapshot(f"no copy for {version if at is None else at}")
    return entry


def folder(root: str, entry) -> str:
    return f"{root}/version={entry['version']}/operation={entry['operation']}/at={entry['at']}"


def write(df: DataFrame, root: str, operation: str, at: str | None = None) -> int:
    """The next copy; returns its version, from 0 on."""
    spark = df.sparkSession
    newest = history(spark, root).agg(F.max("version")).first()[0]
    when = F.lit(at).cast("timestamp") if at else F.current_timestamp()
    seconds = spark.range(1).select(F.unix_seconds(when)).first()[0]
    version = 0 if newest is None else newest + 1
    df.write.mode("overwrite").parquet(folder(root, {"version": version, "operation": operation, "at": seconds}))
    return version


def read(spark: SparkSession, root: str, version: int | None = None, at: str | None = None) -> DataFrame:
    """The newest copy, the one of ``version``, or the newest not after ``at``."""
    return spark.read.parquet(folder(root, _entry(spark, root, version, at)))


def restore(spark: SparkSession, root: str, version: int, at: str | None = None) -> int:
    """An old copy written again as the newest."""
    return write(read(spark, root, version), root, "RESTORE", at)


def last_before(spark: SparkSession, root: str, operation: str) -> int:
    """The newest version before the newest copy that ``operation`` made."""
    kept = history(spark, root)
    bad = kept.filter(F.col("operation") == operation).agg(F.max("version")).first()[0]
    return kept.filter(F.col("version") < bad).agg(F.max("version")).first()[0]


def changes(spark: SparkSession, root: str, start: int, end: int | None = None, key: list[str] | None = None) -> DataFrame:
    """What changed from copy to copy, with ``_commit_version`` and ``_commit_timestamp``."""
    entries = {r["version"]: r for r in history(spark, root).collect()}  # a row for each copy
    out = None
    for version in range(max(start, 1), (max(entries) if end is None else end) + 1):
        diff = changes_between(read(spark, root, version - 1), read(spark, root, version), key).withColumns(
            {"_commit_version": F.lit(version).cast("bigint"), "_commit_timestamp": F.lit(entries[version]["at"])})
        out = diff if out is None else out.unionByName(diff)
    return out


def expirable(spark: SparkSession, root: str, now: str, hours: int = RETENTION_HOURS) -> DataFrame:
    """Copies past retention (the dry run); the newest never is."""
    kept = history(spark, root)
    newest = kept.agg(F.max("version")).scalar()
    limit = F.lit(now).cast("timestamp") - F.make_dt_interval(hours=F.lit(hours))
    return kept.filter((F.col("at") < limit) & (F.col("version") < newest))


def expire(spark: SparkSession, root: str, now: str, hours: int = RETENTION_HOURS, allow_short: bool = False) -> list[int]:
    """Deletes the copies past retention; returns their versions."""
    if hours < RETENTION_HOURS and not allow_short:
        raise ValueError(f"retention below {RETENTION_HOURS} hours needs allow_short")
    gone = sorted(r["version"] for r in expirable(spark, root, now, hours).collect())
    for version in gone:
        delete_path(spark, f"{root}/version={version}")
    return gone


def detail(spark: SparkSession, root: str) -> DataFrame:
    """Files, bytes and rows of the newest copy."""
    meta = F.col("_metadata")
    files = read(spark, root).groupBy(meta["file_path"].alias("file_path"), meta["file_size"].alias("bytes")).agg(
        F.count(F.lit(1)).alias("rows"))
    return files.agg(F.count(F.lit(1)).alias("num_files"), F.sum("bytes").alias("size_in_bytes"), F.sum("rows").alias("num_rows"))
