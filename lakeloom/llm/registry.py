"""Queries of this subpackage and their SQL twins; the entry point adds them to the others."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
TWINS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a query; ``sql`` gives the same rows from the same tables."""
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            TWINS[name] = sql
        return fn
    return register
