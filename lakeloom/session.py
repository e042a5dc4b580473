"""Session profile, table access and the shared staging folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

PROFILE = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # file sizes say little about rows in memory: joins are broadcast by run-time size only
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.ui.enabled": "false",
}

T = TypeVar("T")

_local_dirs: dict[str, str] = {}
_staged: list[str] = []


def shuffle_partitions(input_bytes: int, bytes_per_task: int = 128 << 20, least: int = 200) -> int:
    """Shuffle width for an input size; adaptive execution merges what turns out small."""
    return max(least, -(-input_bytes // bytes_per_task))


def build_session(app: str = "lakeloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the profile above; ``conf`` wins (dots written as ``__``)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**PROFILE, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given Parquet tables."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local-mode session without that setting (a test) gets a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = context.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="lakeloom-")
    return _local_dirs[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, label: str = "stage", fmt: str = "parquet", **options: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: lineage is cut and later
    passes re-read columns from storage instead of recomputing the plan."""
    path = scratch_path(df.sparkSession, label)
    df.write.format(fmt).options(**options).save(path)
    _staged.append(path)
    return df.sparkSession.read.format(fmt).options(**options).schema(df.schema).load(path)


def together(*builders: Callable[[], T]) -> list[T]:
    """Results of builders that run jobs of their own, run side by side: the cluster is shared by
    jobs that would else wait for each other."""
    with ThreadPoolExecutor(max_workers=len(builders)) as pool:
        return list(pool.map(lambda build: build(), builders))


def delete_path(spark: SparkSession, path: str) -> None:
    """Removes a file or folder; one that is not there is no error."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def delete_files(spark: SparkSession, paths: list[str], at_once: int = 16) -> None:
    """Removes files, several at a time."""
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        list(pool.map(lambda path: delete_path(spark, path), paths))


def drop_staged(spark: SparkSession) -> int:
    """Deletes what ``stage`` wrote in this process; call it once results are stored."""
    for path in _staged:
        delete_path(spark, path)
    count = len(_staged)
    _staged.clear()
    return count


def setting(spark: SparkSession, name: str, default: int) -> int:
    """Integer tuning value ``spark.lakeloom.<name>`` of the session."""
    return int(spark.conf.get(f"spark.lakeloom.{name}", str(default)))


def plan_bytes(df: DataFrame) -> int:
    """Size Catalyst estimates for the optimised plan; an upper bound for scans and filters."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def spread(df: DataFrame) -> DataFrame:
    """Small scans only: a file of one row group is one task however many cores there are, so
    its rows are dealt out before heavy per-row work.  Inputs above ``spark.lakeloom.spreadBytes``
    (256 MB) have splits enough and are returned as they are, without a shuffle; the rows are
    the same either way."""
    small = setting(df.sparkSession, "spreadBytes", 256 << 20)
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if plan_bytes(df) < small else df
