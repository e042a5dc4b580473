"""Change feeds between whole copies of a table that read only what differs.

Each copy lies in folders by bucket of its key and keeps, beside them, order-free digests of every
bucket, and of every group of buckets.  Copies are compared from the top: groups whose digests agree
are not looked into, buckets whose digests agree are not read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.operators.changes import BUCKET, changes_between, write_buckets
from lakeloom.session import together

GROUP, LEVEL = "_group", "_level"
DIGEST = ["rows", "mixed", "added"]


def _row_hash(columns: list[str]) -> Column:
    """64 bits of a row; a null counts in its own column (plain hashing passes nulls over)."""
    quoted = [F.col(f"`{c}`") for c in columns]
    return F.xxhash64(*quoted, *[c.isNull() for c in quoted])


def write_copy(df: DataFrame, path: str, keys: list[str], buckets: int = 256, fan: int = 16) -> None:
    """Writes ``df`` by bucket of ``keys`` and the digests of its buckets and of each ``fan`` of them: number
    of rows, exclusive or and sum of row hashes, which do not depend on any order."""
    write_buckets(df, f"{path}/rows", keys, buckets)
    rows = df.sparkSession.read.parquet(f"{path}/rows")
    hashed = rows.select(F.col(BUCKET), _row_hash(df.columns).alias("h"))
    fine = hashed.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("rows"), F.bit_xor("h").alias("mixed"),
                                      F.sum(F.col("h").cast("decimal(38,0)")).alias("added"))
    fine = fine.select(F.lit(1).alias(LEVEL), F.floor(F.col(BUCKET) / fan).cast("int").alias(GROUP), BUCKET, *DIGEST)
    fine.write.partitionBy(LEVEL, GROUP).parquet(f"{path}/digests")
    stored = df.sparkSession.read.parquet(f"{path}/digests") if rows.head(1) else fine
    coarse = stored.groupBy(GROUP).agg(F.sum("rows").alias("rows"), F.bit_xor("mixed").alias("mixed"), F.sum("added").cast("decimal(38,0)").alias("added"))
    coarse.select(F.lit(0).alias(LEVEL), F.lit(-1).alias("_top"), GROUP, *DIGEST).write.parquet(f"{path}/tops")


def _unlike(old: DataFrame, new: DataFrame, key: str) -> list[int]:
    """Values of ``key`` whose digests differ or that only one side has."""
    sides = [df.select(F.col(key).alias(f"{tag}k"), F.struct(*DIGEST).alias(f"{tag}d")) for tag, df in (("o", old), ("n", new))]
    both = sides[0].join(sides[1], F.col("ok") == F.col("nk"), "full").filter(~F.col("od").eqNullSafe(F.col("nd")))
    return sorted(r[0] for r in both.select(F.coalesce("ok", "nk")).collect())


def changed_buckets(spark: SparkSession, old: str, new: str) -> list[int]:
    """The buckets that differ, found level by level; only digests are read."""
    groups = _unlike(*(spark.read.parquet(f"{p}/tops") for p in (old, new)), GROUP)
    if not groups:
        return []
    fine = [spark.read.schema(f"{BUCKET} int, rows bigint, mixed bigint, added decimal(38,0), {LEVEL} int, {GROUP} int").parquet(f"{p}/digests").filter(F.col(GROUP).isin(groups)) for p in (old, new)]
    return _unlike(*fine, BUCKET)


def read_copy(spark: SparkSession, path: str, schema, buckets: list[int] | None = None) -> DataFrame:
    """The rows of a copy, or of some of its buckets."""
    rows = spark.read.schema(schema).parquet(f"{path}/rows")
    return rows.drop(BUCKET) if buckets is None else rows.filter(F.col(BUCKET).isin(buckets)).drop(BUCKET)


def feed(spark: SparkSession, old: str, new: str, keys: list[str]) -> DataFrame:
    """What changed from one copy to the other, with ``_change_type``: the join of the buckets that differ."""
    schemas = together(*(lambda p=p: spark.read.parquet(f"{p}/rows").schema for p in (old, new)))
    unlike = changed_buckets(spark, old, new)
    return changes_between(*(read_copy(spark, p, s, unlike) for p, s in zip((old, new), schemas, strict=True)), keys)
