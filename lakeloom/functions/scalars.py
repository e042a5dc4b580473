"""Column expressions shared by the pipelines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _cents(amount: Column) -> Column:
    return F.round(amount * 100).cast("bigint")


def _gross(quantity: str, price: str) -> Column:
    return _cents(F.col(price)) * F.col(quantity).cast("bigint")


def _discount(quantity: str, price: str, percent: str) -> Column:
    """In hundredths of a cent."""
    return _gross(quantity, price) * F.col(percent).cast("bigint")


def gross_amount(quantity: str, price: str) -> Column:
    """Money is computed in whole cents (and percents of cents), so sums of parts are exact
    and do not depend on the order of operations; the result is a double."""
    return _gross(quantity, price) / 100.0


def discount_amount(quantity: str, price: str, percent: str) -> Column:
    return _discount(quantity, price, percent) / 10000.0


def net_amount(quantity: str, price: str, percent: str) -> Column:
    return (_gross(quantity, price) * 100 - _discount(quantity, price, percent)) / 10000.0


def rounded_money(quantity: str, price: str, percent: str) -> dict[str, Column]:
    """total, discount and net amount, each rounded to cents (half away from zero)."""
    gross, exact = _gross(quantity, price), _discount(quantity, price, percent)
    discount = F.signum(exact).cast("bigint") * F.floor((F.abs(exact) + 50) / 100.0)
    return {"total_amount": gross / 100.0, "discount_amount": discount / 100.0,
            "net_amount": (gross - discount) / 100.0}


def flag(condition: Column) -> Column:
    """1 or 0; a null condition is 0."""
    return F.when(condition, 1).otherwise(0)


def clean_email(column: str) -> Column:
    return F.lower(F.trim(F.col(column)))


def part(column: str, separator: str, index: int) -> Column:
    """Piece of a split text; null when there are fewer pieces."""
    return F.get(F.split(F.col(column), separator), F.lit(index))


def digits(column: str) -> Column:
    """First run of digits as a number, null when there is none."""
    return F.regexp_extract(F.col(column), r"(\d+)", 1).try_cast("int")


def store_region(column: str) -> Column:
    """East up to 10, West up to 20, Central beyond or without a number."""
    return F.when(digits(column) <= 10, "East").when(digits(column) <= 20, "West").otherwise("Central")


def ratio(top: Column, bottom: Column, digits: int = 2) -> Column:
    """Rounded quotient, null when the divisor is zero."""
    return F.round(F.try_divide(top, bottom), digits)


def date_key(column: Column) -> Column:
    return F.date_format(column, "yyyyMMdd").cast("int")


def season(column: Column) -> Column:
    month = F.month(column)
    return (F.when(month.isin(12, 1, 2), "Winter").when(month.isin(3, 4, 5), "Spring")
            .when(month.isin(6, 7, 8), "Summer").otherwise("Fall"))


def order_size(amount: Column, large: float = 500, medium: float = 200) -> Column:
    return F.when(amount >= large, "Large").when(amount >= medium, "Medium").otherwise("Small")


def local_to_utc(ts: Column, zone: Column) -> Column:
    """Instant of a wall-clock time in a zone; the zone may differ by row."""
    return F.to_utc_timestamp(ts, zone)


def sum_of_cents(amount: str | Column) -> Column:
    """Sum of amounts in whole cents: the cents are summed as whole numbers, so the result does
    not depend on how rows were dealt to tasks."""
    return F.sum(_cents(F.col(amount) if isinstance(amount, str) else amount)) / 100.0


def mean_of_cents(amount: str | Column) -> Column:
    """Average of amounts in whole cents, exact up to the one division."""
    return F.try_divide(sum_of_cents(amount), F.count(amount))


def rounded_mean_of_cents(amount: str) -> Column:
    """Average of amounts not below zero, in whole cents, rounded half up."""
    total, n = F.sum(_cents(F.col(amount))), F.count(amount)
    return F.floor((2 * total + n) / (2 * n)) / 100.0
