"""Table changes as pure DataFrame rewrites: insert, update, delete, merge and change feed."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.operators.quality import CheckFailed
from lakeloom.session import delete_path, stage


def insert(df: DataFrame, rows: DataFrame, defaults: dict[str, object] | None = None) -> DataFrame:
    """Append; columns that ``rows`` leaves out get their default, else null."""
    fills = {c: F.lit(v).cast(df.schema[c].dataType) for c, v in (defaults or {}).items() if c not in rows.columns}
    return df.unionByName(rows.withColumns(fills) if fills else rows, allowMissingColumns=True).select(*df.columns)


def holds(condition: str | None) -> Column:
    return F.lit(True) if condition is None else F.coalesce(F.expr(condition), F.lit(False))


def update(df: DataFrame, changes: dict[str, str], where: str | None = None) -> DataFrame:
    hit = holds(where)
    return df.select(*[
        F.when(hit, F.expr(changes[f.name]).cast(f.dataType)).otherwise(F.col(f"`{f.name}`")).alias(f.name)
        if f.name in changes else F.col(f"`{f.name}`") for f in df.schema])


def delete(df: DataFrame, where: str | None = None) -> DataFrame:
    """A row whose condition is null stays."""
    return df.filter(~holds(where))


def truncate(df: DataFrame) -> DataFrame:
    return df.limit(0)


def with_generated(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Columns computed at write time."""
    return df.withColumns({name: F.expr(rule) for name, rule in columns.items()})


def with_identity(df: DataFrame, name: str, above: int = 0, step: int = 1) -> DataFrame:
    """Unique, increasing numbers greater than ``above``; gaps are allowed, no shuffle needed."""
    return df.withColumn(name, (F.monotonically_increasing_id() + 1) * step + above)


@dataclass(frozen=True)
class When:
    """One MERGE clause.  ``case`` is matched, not_matched or not_matched_by_source;
    ``action`` is update, delete or insert; ``values`` maps columns to SQL over ``t`` and
    ``s``, or is None for all source columns."""
    case: str
    action: str
    condition: str | None = None
    values: dict[str, str] | None = field(default=None)


def require_single_match(target: DataFrame, source: DataFrame, on: list[str]) -> None:
    """A target row may match one source row only."""
    twice = source.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    if twice.head(1) and target.select(*on).join(twice, on, "left_semi").head(1):
        raise CheckFailed("several source rows match one target row")


def merge(target: DataFrame, source: DataFrame, on: list[str], clauses: list[When]) -> DataFrame:
    """MERGE INTO as a left join for the target rows and an anti join for the inserts, so
    the target is only scanned once.  The first clause whose
    condition holds decides."""
    require_single_match(target, source, on)
    marked = source.withColumn("_hit", F.lit(True))
    match = reduce(Column.__and__, [F.col(f"t.`{k}`") == F.col(f"s.`{k}`") for k in on])
    joined = target.alias("t").join(marked.alias("s"), match, "left")
    by_target = [c for c in clauses if c.case != "not_matched"]
    matched = F.col("s._hit").isNotNull()
    chosen = F.lit(-1)
    for i, clause in reversed(list(enumerate(by_target))):
        side = matched if clause.case == "matched" else ~matched
        chosen = F.when(side & holds(clause.condition), F.lit(i)).otherwise(chosen)
    drops = [i for i, c in enumerate(by_target) if c.action == "delete"]
    rewritten = joined.withColumn("_do", chosen).filter(~F.col("_do").isin(drops) if drops else F.lit(True))

    def value(name: str) -> Column:
        out = F.col(f"t.`{name}`")
        for i, clause in enumerate(by_target):
            if clause.action != "update":
                continue
            if clause.values is None:
                new = F.col(f"s.`{name}`") if name in source.columns else None
            else:
                new = F.expr(clause.values[name]) if name in clause.values else None
            if new is not None:
                out = F.when(F.col("_do") == i, new.cast(target.schema[name].dataType)).otherwise(out)
        return out.alias(name)

    kept = rewritten.select(*[value(n) for n in target.columns])
    inserts = [c for c in clauses if c.case == "not_matched"]
    if not inserts:
        return kept
    # keys are looked up from the target's side, so that the source is the build side here too
    known = target.select(*on).join(source.select(*on), on, "left_semi").distinct()
    fresh = source.alias("s").join(known.alias("t"), match, "left_anti")
    taken = F.lit(False)
    parts = [kept]
    for clause in inserts:
        condition = holds(clause.condition)
        rows = fresh.filter(~taken & condition)
        taken = taken | condition
        values = clause.values or {n: f"s.`{n}`" for n in target.columns if n in source.columns}
        parts.append(rows.select(*[
            (F.expr(values[f.name]) if f.name in values else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target.schema]))
    return reduce(DataFrame.unionByName, parts)


def changes_between(old: DataFrame, new: DataFrame, key: list[str] | None = None) -> DataFrame:
    """Rows inserted, deleted or updated from ``old`` to ``new`` with ``_change_type``.

    With a unique ``key`` an update gives a pre- and a postimage.  Without one the frames
    are compared as multisets by partial counts, so equal rows never meet pairwise."""
    names = new.columns
    if not key:
        signed = (old.select(*names, F.lit(-1).alias("_d"))
                  .unionByName(new.select(*names, F.lit(1).alias("_d"))))
        net = signed.groupBy(*names).agg(F.sum("_d").alias("_d")).filter("_d <> 0")
        return (net.withColumn("_change_type", F.when(F.col("_d") > 0, "insert").otherwise("delete"))
                .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.abs("_d"))))
                .drop("_copy", "_d"))
    side = lambda df, tag: df.select(*[F.col(f"`{k}`").alias(f"{tag}{k}") for k in key],
                                     F.struct(*names).alias(f"{tag}row"))
    match = reduce(Column.__and__, [F.col(f"_o{k}").eqNullSafe(F.col(f"_n{k}")) for k in key])
    both = side(old, "_o").join(side(new, "_n"), match, "full")
    before, after = F.col("_orow"), F.col("_nrow")
    entry = lambda kind, row: F.struct(F.lit(kind).alias("_change_type"), row.alias("row"))
    events = (F.when(before.isNull(), F.array(entry("insert", after)))
              .when(after.isNull(), F.array(entry("delete", before)))
              .otherwise(F.array(entry("update_preimage", before), entry("update_postimage", after))))
    return (both.filter(~before.eqNullSafe(after)).select(F.explode(events).alias("_e"))
            .select("_e.row.*", "_e._change_type"))


def upserts(feed: DataFrame) -> DataFrame:
    """Rows a consumer of the feed should apply: inserts and new versions."""
    return feed.filter(F.col("_change_type").isin("insert", "update_postimage"))


BUCKET = "_bucket"


def with_bucket(df: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    """Adds the bucket of a row's keys; null keys have one too."""
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def write_buckets(df: DataFrame, path: str, keys: list[str], buckets: int) -> None:
    """A table as one folder for each bucket of its keys."""
    with_bucket(df, keys, buckets).hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(path)


def replace_partitions(df: DataFrame, path: str, column: str, values: list) -> None:
    """Puts the rows of ``df`` in place of the folders ``column=value`` of all ``values``, also
    of those that have no rows any more.  ``df`` must not read the folder itself."""
    spark = df.sparkSession
    kept = stage(df, "partitions")
    kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)
    left = {r[0] for r in kept.select(column).distinct().collect()}  # folder names
    for value in values:
        if value not in left:
            delete_path(spark, f"{path}/{column}={value}")


def merge_buckets(path: str, source: DataFrame, on: list[str], clauses: list[When], buckets: int) -> list[int]:
    """MERGE into a table of ``write_buckets``: only buckets that hold keys of the source are
    read and rewritten, all of them when a clause concerns rows the source does not match.
    Returns the buckets that were rewritten."""
    spark = source.sparkSession
    arriving = with_bucket(source, on, buckets)
    whole = any(c.case == "not_matched_by_source" for c in clauses)
    touched = list(range(buckets)) if whole else sorted(r[0] for r in arriving.select(BUCKET).distinct().collect())
    target = spark.read.parquet(path).filter(F.col(BUCKET).isin(touched))
    merged = with_bucket(merge(target.drop(BUCKET), source, on, clauses), on, buckets)
    replace_partitions(merged, path, BUCKET, touched)
    return touched
