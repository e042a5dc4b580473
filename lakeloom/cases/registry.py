"""Registered queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
TWINS: dict[str, str] = {}


def case(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query; ``sql`` gives the same rows from the same tables."""
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            TWINS[name] = sql
        return fn
    return register


def plain(df: DataFrame) -> DataFrame:
    """Dates and times as text and decimals as doubles, for comparison across engines."""
    def convert(field: T.StructField):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return column.cast("string").alias(field.name)
        if isinstance(field.dataType, T.DecimalType):
            return column.cast("double").alias(field.name)
        return column
    return df.select(*[convert(f) for f in df.schema])
