"""Column masks, row filters, secured views and effective privileges as data operators."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ADMINS = "admins"
# fixed values: privilege a user needs on each level to select from a table
NEEDED = {"USE CATALOG": ("catalog",), "USE SCHEMA": ("schema", "catalog"), "SELECT": ("table", "schema", "catalog")}


def mask_keep_domain(email: Column) -> Column:
    return F.concat(F.lit("***@"), F.substring_index(email, "@", -1))


def mask_keep_prefix(email: Column) -> Column:
    return F.concat(F.left(email, F.lit(2)), F.lit("***@***.***"))


def apply_masks(df: DataFrame, masks: dict[str, Callable[[Column], Column]], groups: set[str],
                exempt: frozenset[str] = frozenset({ADMINS})) -> DataFrame:
    """Masked columns, unless the reader is in an exempt group."""
    if groups & exempt:
        return df
    return df.withColumns({name: mask(F.col(name)) for name, mask in masks.items()})


def apply_row_filter(df: DataFrame, rules: dict[str, str], groups: set[str]) -> DataFrame:
    """Rows allowed by any rule of the reader's groups; without a group there are none."""
    allowed = [F.coalesce(F.expr(rule), F.lit(False)) for group, rule in rules.items() if group in groups]
    return df.filter(reduce(Column.__or__, allowed, F.lit(False)))


def secured_view(df: DataFrame, name: str, masks, rules: dict[str, str], groups: set[str]) -> DataFrame:
    """Registers the filtered and masked table as a view; filters see the raw values."""
    out = apply_masks(apply_row_filter(df, rules, groups), masks, groups)
    out.createOrReplaceTempView(name)
    return out
