"""Unions and constant rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_constant_row(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """UNION ALL with one row of constants, typed like ``df``; absent columns are null."""
    row = df.sparkSession.range(1).select(
        *[F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in df.schema])
    return df.unionByName(row)


def union_by_name(frames: list[DataFrame], fill: bool = True) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=fill), frames)


def union_sources(sources: dict[str, DataFrame], tag: str = "source_system") -> DataFrame:
    """Several sources in one table, each row tagged with its source."""
    return union_by_name([df.withColumn(tag, F.lit(name)) for name, df in sources.items()])
