"""Column expressions shared by the plans. All are built-in Spark expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(33,2)"
AVERAGE = "decimal(27,2)"
PERCENT = "decimal(35,2)"


def line_revenue(quantity: str = "quantity", unit_price: str = "unit_price",
                 discount_pct: str = "discount_pct") -> Column:
    """quantity x unit price x (1 - discount/100), exact.

    Written as a product by 0.01 because decimal division is the slow operation per line.
    """
    return (F.col(quantity) * F.col(unit_price) * (F.lit(100) - F.col(discount_pct))
            * F.lit("0.01").cast("decimal(2,2)"))


def margin_pct(profit: Column, revenue: Column) -> Column:
    """100 x profit / revenue, NULL where there is no revenue."""
    return F.try_divide(F.lit(100) * profit, F.nullif(revenue, F.lit(0)))


def per_unit_of(total: Column, count: Column) -> Column:
    """total / count, with types that leave the quotient 16 decimals."""
    return F.try_divide(total.cast("decimal(28,6)"), count.cast("decimal(12,0)"))


def month_of(date: Column) -> Column:
    return F.trunc(date, "MM")


def rolling_start(as_of: Column, months: int = 12) -> Column:
    """Exclusive lower bound of the rolling window; clamps to the end of short months."""
    return F.add_months(as_of, -months)


def passes(predicate: Column) -> Column:
    """A predicate that counts NULL as not met."""
    return F.coalesce(predicate, F.lit(False))


def is_one_of(column: Column, allowed: Iterable[str]) -> Column:
    return passes(column.isin(*allowed))


def contains_ignoring_case(column: Column, text: str) -> Column:
    return column.ilike(f"%{text}%")


def canonical(column: Column, allowed: Iterable[str]) -> Column:
    """Trim, and use the allowed spelling where the value matches one but for its case."""
    trimmed = F.trim(column)
    spelling = F.create_map(*[F.lit(x) for value in allowed for x in (value.lower(), value)])
    return F.coalesce(F.try_element_at(spelling, F.lower(trimmed)), trimmed)


def slug(column: Column) -> Column:
    """A lower-case identifier: runs of other characters become one underscore."""
    return F.btrim(F.regexp_replace(F.lower(column), "[^a-z0-9]+", "_"), F.lit("_"))
