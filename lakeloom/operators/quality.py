"""Expectations, quarantine, metric log, gates, schema enforcement and evolution.

A rule set is ``{name: SQL condition}``.  A condition that is null counts as failed."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from lakeloom.session import stage, table


class CheckFailed(Exception):
    """A gate or constraint was not met."""


def passes(rule: str) -> Column:
    return F.coalesce(F.expr(rule), F.lit(False))


def all_pass(rules: dict[str, str]) -> Column:
    return reduce(Column.__and__, [passes(r) for r in rules.values()], F.lit(True))


def expect(df: DataFrame, rules: dict[str, str], name: str = "expect") -> tuple[DataFrame, Observation]:
    """Keeps all rows; the observation holds the violations per rule once an action ran."""
    seen = Observation(name)
    metrics = [F.count_if(~passes(r)).alias(n) for n, r in rules.items()]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *metrics), seen


def expect_or_drop(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    return df.filter(all_pass(rules))


def expect_or_fail(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """``df``, after every row of it was found to keep all rules; else CheckFailed.

    The test is a pass of its own over the rules' columns and runs now: as a lazy filter it
    could be moved above a later filter or join, which would hide rows from it.  Streams cannot
    be read ahead; there a violating row fails its batch."""
    if df.isStreaming:
        for name, rule in rules.items():
            df = df.filter(F.when(passes(rule), F.lit(True)).otherwise(
                F.raise_error(F.lit(f"expectation {name} failed: {rule}")).cast("boolean")))
        return df
    if rules:
        found = df.agg(*[F.count_if(~passes(r)).alias(f"n{i}") for i, r in enumerate(rules.values())]).first()
        broken = {name: found[i] for i, name in enumerate(rules) if found[i]}
        if broken:
            raise CheckFailed(f"expectation {', '.join(broken)} failed: rows {broken}")
    return df


def apply_expectations(df: DataFrame, warn: dict[str, str] | None = None, drop: dict[str, str] | None = None,
                       fail: dict[str, str] | None = None) -> DataFrame:
    """Fail rules see every row, drop rules the rest; warn rules change nothing."""
    out = expect_or_fail(df, fail or {})
    out = expect_or_drop(out, drop or {})
    return expect(out, warn)[0] if warn else out


def tag_quarantine(df: DataFrame, rules: dict[str, str], flag: str = "is_quarantined") -> DataFrame:
    return df.withColumn(flag, ~all_pass(rules))


def split_quarantine(df: DataFrame, rules: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, bad rows); together they are the input."""
    tagged = tag_quarantine(df, rules)
    return (tagged.filter(~F.col("is_quarantined")).drop("is_quarantined"),
            tagged.filter("is_quarantined").drop("is_quarantined"))


def metric_log(df: DataFrame, rules: dict[str, str], run_id: str, dataset: str) -> DataFrame:
    """Rows (run_id, dataset, rule, passed, failed) from one pass over ``df``."""
    packed = df.agg(*[
        F.struct(F.lit(n).alias("rule"), F.count_if(passes(r)).alias("passed"),
                 F.count_if(~passes(r)).alias("failed")).alias(f"m{i}")
        for i, (n, r) in enumerate(rules.items())])
    return packed.select(F.inline(F.array(*packed.columns))).select(
        F.lit(run_id).alias("run_id"), F.lit(dataset).alias("dataset"), "rule", "passed", "failed")


def observe_rules(stream: DataFrame, rules: dict[str, str], dataset: str) -> DataFrame:
    """A stream that reports, with the progress of every micro-batch, its rows and those that pass each
    rule; the rows are not changed."""
    return stream.observe(dataset, F.count(F.lit(1)).alias("_rows"), *[F.count_if(passes(r)).alias(n) for n, r in rules.items()])


METRICS = "run_id string, dataset string, rule string, passed bigint, failed bigint"


class MetricListener(StreamingQueryListener):
    """Takes what ``observe_rules`` reports from the progress events of a query.

    Events come in after a batch was committed; a batch that runs again after a stop reports again
    under the same number, and the later report replaces the earlier one."""

    def __init__(self, dataset: str):
        self.dataset, self.batches, self.failed = dataset, {}, None

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        seen = event.progress.observedMetrics.get(self.dataset)
        if seen is not None:
            self.batches[event.progress.batchId] = seen.asDict()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.failed = event.exception


def drain_with_metrics(start: Callable[[], StreamingQuery], spark: SparkSession, dataset: str, run_id: str, log: str) -> int:
    """Runs the query of ``start`` to its end and writes its metrics to ``log``, a folder for each batch that a
    replay overwrites; returns how many batches reported rows."""
    listener = MetricListener(dataset)
    spark.streams.addListener(listener)
    try:
        query = start()
        query.awaitTermination()
    finally:
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        spark.streams.removeListener(listener)
    written = 0
    for batch, seen in sorted(listener.batches.items()):
        rows = seen.pop("_rows")
        if rows:
            found = [(run_id, dataset, rule, passed, rows - passed) for rule, passed in seen.items()]
            spark.createDataFrame(found, METRICS).coalesce(1).write.mode("overwrite").parquet(f"{log}/run={run_id}/batch={batch}")
            written += 1
    return written


def read_metrics(spark: SparkSession, log: str) -> DataFrame:
    """All reports with their batch."""
    return spark.read.schema(f"{METRICS}, run string, batch bigint").parquet(log).drop("run")


def require_rows(df: DataFrame, at_least: int) -> DataFrame:
    """Raises unless ``df`` has that many rows; reads no more than needed."""
    found = df.limit(at_least).count()
    if found < at_least:
        raise CheckFailed(f"{found} rows, expected at least {at_least}")
    return df


def validate_tables(tables: dict[str, DataFrame | Exception], minimum: int = 1) -> DataFrame:
    """PASS or FAIL with row count and error for every table of a run."""
    reports = []
    for name, df in tables.items():
        if isinstance(df, Exception):
            spark = next(d for d in tables.values() if isinstance(d, DataFrame)).sparkSession
            reports.append(spark.range(1).select(
                F.lit(name).alias("table_name"), F.lit("FAIL").alias("status"),
                F.lit(0).cast("bigint").alias("row_count"), F.lit(str(df)).alias("error")))
            continue
        counted = df.agg(F.count(F.lit(1)).alias("row_count"))
        ok = F.col("row_count") >= minimum
        reports.append(counted.select(
            F.lit(name).alias("table_name"), F.when(ok, "PASS").otherwise("FAIL").alias("status"), "row_count",
            F.when(~ok, F.lit(f"fewer than {minimum} rows")).alias("error")))
    return reduce(DataFrame.unionByName, reports)


def log_validation(report: DataFrame, path: str, run_id: str, raise_on_fail: bool = True) -> DataFrame:
    """Appends one event row (status, JSON details) to the event log at ``path``."""
    spark = report.sparkSession
    event = report.agg(
        F.when(F.count_if(F.col("status") == "FAIL") > 0, "FAIL").otherwise("PASS").alias("status"),
        F.to_json(F.sort_array(F.collect_list(F.struct("table_name", "status", "row_count")))).alias("details"),
    ).select(F.lit(run_id).alias("job_run_id"), F.lit("validation").alias("event_type"), "status", "details",
             F.current_timestamp().alias("event_timestamp"))
    event.write.mode("append").parquet(path)
    log = spark.read.parquet(path)
    if raise_on_fail and log.filter((F.col("job_run_id") == run_id) & (F.col("status") == "FAIL")).head(1):
        raise CheckFailed(f"run {run_id} has failing tables")
    return log


def check_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Write-time enforcement: unknown columns and other types are refused."""
    known = {f.name: f.dataType for f in schema}
    extra = [f.name for f in df.schema if f.name not in known]
    wrong = [f.name for f in df.schema if f.name in known and f.dataType != known[f.name]]
    if extra or wrong:
        raise CheckFailed(f"schema mismatch: unknown columns {extra}, other types {wrong}")
    return df


def merge_schema(table: DataFrame, rows: DataFrame) -> DataFrame:
    """Append that widens the table: columns missing on either side are null there."""
    return table.unionByName(rows, allowMissingColumns=True)


def append_checked(rows: DataFrame, path: str, constraints: dict[str, str] | None = None, widen: bool = False) -> None:
    """Appends to a Parquet folder, all or nothing: rows of another type, with unknown columns
    (unless ``widen`` adds them) or that break a constraint are refused before the write."""
    spark = rows.sparkSession
    known = spark.read.option("mergeSchema", True).parquet(path).schema if folder_exists(spark, path) else rows.schema
    if widen:
        known = T.StructType([*known.fields, *[f for f in rows.schema if f.name not in known.names]])
    check_schema(rows, known)
    checked = stage(rows, "append")
    broken = {n: checked.filter(~passes(r)).limit(1).count() for n, r in (constraints or {}).items()}
    if any(broken.values()):
        raise CheckFailed(f"constraints violated: {[n for n, found in broken.items() if found]}")
    checked.write.mode("append").parquet(path)


def folder_exists(spark, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def validate_folder(spark, folder: str, names: list[str], minimum: int = 1) -> DataFrame:
    found: dict[str, DataFrame | Exception] = {}
    for name in names:
        try:
            found[name] = table(spark, folder, name)
        except Exception as error:  # a missing table is a result, not a crash
            found[name] = RuntimeError(str(error).splitlines()[0])
    return validate_tables(found, minimum)
