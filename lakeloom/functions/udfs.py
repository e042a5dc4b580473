"""User functions.  The expression form is the one to use; the others exist for parity."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

HIGH, MEDIUM = 500.0, 100.0


def order_class(amount: Column, high: float = HIGH, medium: float = MEDIUM) -> Column:
    return (F.when(amount.isNull(), "Unknown").when(amount > high, "High Value")
            .when(amount > medium, "Medium Value").otherwise("Low Value"))


def order_class_udf(high: float = HIGH, medium: float = MEDIUM):
    @F.udf("string")
    def classify(amount):
        if amount is None:
            return "Unknown"
        return "High Value" if amount > high else "Medium Value" if amount > medium else "Low Value"
    return classify


def order_class_pandas(high: float = HIGH, medium: float = MEDIUM):
    @F.pandas_udf("string")
    def classify(amount: pd.Series) -> pd.Series:
        out = pd.Series("Low Value", index=amount.index)
        out[amount > medium] = "Medium Value"
        out[amount > high] = "High Value"
        out[amount.isna()] = "Unknown"
        return out
    return classify


def create_order_class_sql(spark: SparkSession, name: str = "order_class_sql", high: float = HIGH,
                           medium: float = MEDIUM) -> str:
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION {name}(amount DOUBLE) RETURNS STRING RETURN
        CASE WHEN amount IS NULL THEN 'Unknown' WHEN amount > {high}D THEN 'High Value'
             WHEN amount > {medium}D THEN 'Medium Value' ELSE 'Low Value' END""")
    return name
