"""Header and detail sales star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.operators.joins import lookup
from lakeloom.operators.quality import expect_or_drop, expect_or_fail

# fixed values: constraints of the order header
HEADER_FAIL = {"valid_customer": "CustomerID IS NOT NULL"}
HEADER_DROP = {"valid_amount": "TotalDue > 0"}


def clean_headers(headers: DataFrame) -> DataFrame:
    return expect_or_drop(expect_or_fail(headers, HEADER_FAIL), HEADER_DROP)


def product_with_category(products: DataFrame, categories: DataFrame, on: str = "ProductCategoryID") -> DataFrame:
    """Products keep their row when the category is missing."""
    names = categories.select(on, F.col("Name").alias("CategoryName"))
    return lookup(products, names, on)


def sales_lines(details: DataFrame, headers: DataFrame, on: str = "SalesOrderID") -> DataFrame:
    return details.join(headers.select(on, "OrderDate", "CustomerID", "Status"), on)


def category_paths(spark, view: str, separator: str = " > ") -> DataFrame:
    """Depth and path of every category of a view with id, parent, name, by a recursive CTE.
    Categories are a small reference table; facts join the result afterwards."""
    return spark.sql(f"""
        WITH RECURSIVE tree AS (
            SELECT id, parent, name, 0 AS depth, CAST(name AS STRING) AS path FROM {view} WHERE parent IS NULL
            UNION ALL
            SELECT c.id, c.parent, c.name, t.depth + 1, concat(t.path, '{separator}', c.name)
            FROM {view} c JOIN tree t ON c.parent = t.id)
        SELECT id, parent, name, depth, path FROM tree""")
