"""Exact ratios and rounding on decimals."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MONEY = "decimal(18,2)"


def money(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast(MONEY)


def rows_where(condition: Column | None = None, name: str = "txn_count") -> Column:
    """``COUNT(*)``, or the number of rows where ``condition`` is true."""
    return (F.count(F.lit(1)) if condition is None else F.count_if(condition)).alias(name)


def total_where(amount: Column, condition: Column) -> Column:
    """Sum over the rows where ``condition`` is true, 0 for the other rows, NULL without rows."""
    return F.sum(F.when(condition, amount).otherwise(F.lit(0).cast(MONEY)))


def percent(part: Column, whole: Column) -> Column:
    """``part * 100 / whole`` as a decimal; NULL when ``whole`` is 0."""
    return F.try_divide(
        part.cast("decimal(20,0)") * F.lit(100), whole.cast("decimal(20,0)")
    )


def whole_part(number: Column) -> Column:
    """Drop the fraction, toward zero."""
    return number.cast("bigint")
