"""Equi-joins, checked broadcasts and skew-aware joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.session import plan_bytes, setting

BROADCAST_BYTES = 64 * 1024 * 1024
HEAVY_ROWS = 5_000_000


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join in which null equals null; the keys appear once, taken from ``left``."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    match = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys], F.lit(True))
    return left.join(renamed, match, how).drop(*[f"_r_{k}" for k in keys])


def measured_bytes(df: DataFrame) -> int:
    """Bytes of the rows themselves, by a pass over them: texts and nested values by their
    length, the rest 8 bytes a column."""
    def width(field: T.StructField) -> Column:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(value), F.lit(0)) + 16
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            return F.coalesce(F.octet_length(F.to_json(F.struct(value.alias("v")))), F.lit(0)) + 16
        return F.lit(8)

    row = reduce(Column.__add__, [width(f) for f in df.schema], F.lit(8))
    return df.agg(F.sum(row.cast("bigint"))).first()[0] or 0


def broadcast_if_small(df: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """Broadcast hint only when the rows were measured to be below the bound; otherwise Spark is
    left to choose.  Compressed file sizes, which the planner goes by, are no bound."""
    bound = max_bytes or setting(df.sparkSession, "broadcastBytes", BROADCAST_BYTES)
    if plan_bytes(df) > bound:
        return df
    return F.broadcast(df) if measured_bytes(df) <= bound else df


def broadcast_join(fact: DataFrame, dim: DataFrame, on: str | list[str] | Column, how: str = "inner") -> DataFrame:
    """Join with the dimension broadcast, if its rows are few enough."""
    return fact.join(broadcast_if_small(dim), on, how)


def lookup(fact: DataFrame, dim: DataFrame, on: str | list[str] | Column, how: str = "left") -> DataFrame:
    """Join a fact to a dimension.  Adaptive execution broadcasts the dimension if it turns out
    small at run time, and splits skewed keys of the fact if not."""
    return fact.join(dim, on, how)


def sort_merge_join(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """Join without broadcast, whatever the sizes."""
    return left.hint("merge").join(right, on, how)


def in_keys(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key occurs in ``keys`` (IN subquery)."""
    return df.join(keys, on, "left_semi")


def not_in_keys(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key does not occur in ``keys``; null keys count as not occurring."""
    return df.join(keys, on, "left_anti")


MOST_BINS = 1 << 22


def bins_for(df: DataFrame, rows: int) -> int:
    """Counters of ``frequent_bins``: some four for each key that could be heavy, by the planned size of
    the input (8 bytes a row at least).  The number decides about cost alone, not about results."""
    wanted = 4 * plan_bytes(df) // (8 * max(rows, 1))
    return 1 << min(MOST_BINS.bit_length() - 1, max(12, wanted.bit_length()))


def frequent_bins(df: DataFrame, keys: list[str], rows: int, bins: int) -> DataFrame:
    """The summary that heavy keys are found by: a fixed vector of counters, to which keys are hashed.

    Summaries of parts add up counter by counter, so each map task sends ``bins`` rows at most
    whatever the number of keys.  A counter is never below the count of a key hashed to it: a key
    of more than ``rows`` rows is always in one of the bins returned, of which there are fewer than
    the table has times ``rows``."""
    return (df.groupBy(F.pmod(F.xxhash64(*keys), F.lit(bins)).alias("_bin")).agg(F.count(F.lit(1)).alias("_n"))
            .filter(F.col("_n") > rows))


def frequent_keys(df: DataFrame, keys: list[str], rows: int, bins: int | None = None) -> DataFrame:
    """The keys with more than ``rows`` rows and their exact ``rows``: candidates by ``frequent_bins``,
    then counted among the rows of their bins alone.  Without candidates nothing is read again."""
    spark, bins = df.sparkSession, bins or bins_for(df, rows)
    schema = T.StructType([*df.select(*keys).schema.fields, T.StructField("rows", T.LongType(), False)])
    heavy = frequent_bins(df, keys, rows, bins).select(F.col("_bin").cast("long").alias("_bin")).collect()
    if not heavy:
        return spark.createDataFrame([], schema)
    wanted = F.broadcast(spark.createDataFrame(heavy, "_bin long"))
    candidates = df.select(*keys, F.pmod(F.xxhash64(*keys), F.lit(bins)).alias("_bin")).join(wanted, "_bin", "left_semi")
    counts = candidates.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > rows)
    return spark.createDataFrame(counts.collect(), schema)  # fewer than the table has times ``rows``


def heavy_keys(df: DataFrame, key: str, rows: int) -> DataFrame:
    """``frequent_keys`` of one column."""
    return frequent_keys(df, [key], rows)


def salts_for(rows: Column, per_task: int) -> Column:
    """Number of salts that brings a key of ``rows`` rows down to ``per_task`` rows a task."""
    return F.greatest(F.lit(1), F.ceil(rows / per_task)).cast("int")


def salted_join(big: DataFrame, small: DataFrame, key: str, spread: list[str], salts: int | None = None,
                how: str = "inner", heavy_rows: int | None = None, heavy: DataFrame | None = None) -> DataFrame:
    """Join that spreads each heavy key of ``big`` over as many tasks as its rows need (or over
    ``salts``).

    Only heavy keys are salted, so the matching rows of ``small`` are copied for those keys
    alone.  ``spread`` names columns of ``big`` that tell its rows apart.  ``how`` is inner or
    left.  Heavy keys are found by ``frequent_keys`` unless given; they are few, so the big side
    meets them in a broadcast join and is shuffled once."""
    if how not in ("inner", "left"):
        raise ValueError("a salted join is inner or left")
    limit = heavy_rows or setting(big.sparkSession, "hotRows", HEAVY_ROWS)
    count = F.lit(salts) if salts else salts_for(F.col("rows"), limit)
    found = heavy_keys(big, key, limit) if heavy is None else heavy
    heavy = found.select(F.col(key).alias("_h"), count.alias("_salts"))
    wide = F.lit(salts or 64)  # for null keys, which match nothing and may go anywhere
    parts = F.when(F.col(key).isNull(), wide).otherwise(F.coalesce("_salts", F.lit(1)))
    left = (big.join(F.broadcast(heavy), F.col(key) == F.col("_h"), "left")
            .withColumn("_salt", F.pmod(F.xxhash64(*spread), parts).cast("int")).drop("_h", "_salts"))
    copies = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    right = (small.join(F.broadcast(heavy), F.col(key) == F.col("_h"), "left")
             .withColumn("_salt", F.explode(copies)).drop("_h", "_salts"))
    return left.join(right, [key, "_salt"], how).drop("_salt")


def isolated_join(big: DataFrame, small: DataFrame, key: str, spread: list[str], heavy_rows: int | None = None) -> DataFrame:
    """Inner join that handles dominant keys apart, salted by their size, and unites both
    results."""
    limit = heavy_rows or setting(big.sparkSession, "hotRows", HEAVY_ROWS)
    found = heavy_keys(big, key, limit)
    heavy = F.broadcast(found.select(key))
    rest = big.join(heavy, key, "left_anti").join(small, key)
    part, side = big.join(heavy, key, "left_semi"), small.join(heavy, key, "left_semi")
    return rest.unionByName(salted_join(part, side, key, spread, heavy_rows=limit, heavy=found))
