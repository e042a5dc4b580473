"""Higher-order array expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def discounted(prices: Column, factor: float = 0.9, digits: int = 2) -> Column:
    return F.transform(prices, lambda x: F.round(x * factor, digits))


def above(prices: Column, limit: float) -> Column:
    return F.filter(prices, lambda x: x > limit)


def any_above(prices: Column, limit: float) -> Column:
    return F.exists(prices, lambda x: x > limit)


def all_above(prices: Column, limit: float) -> Column:
    return F.forall(prices, lambda x: x > limit)


def total(prices: Column) -> Column:
    return F.aggregate(prices, F.lit(0.0), lambda acc, x: acc + x)
