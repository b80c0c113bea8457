"""Reusable metric expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def rate(numerator: Column | str, denominator: Column | str) -> Column:
    """numerator / denominator, 0 unless the denominator is positive."""
    num, den = _col(numerator).cast("double"), _col(denominator).cast("double")
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def growth(current: Column | str, previous: Column | str) -> Column:
    """Relative change, 0 when the previous value is missing or not positive."""
    cur, prev = _col(current).cast("double"), _col(previous).cast("double")
    return F.when(prev > 0, (cur - prev) / prev).otherwise(F.lit(0.0))


def safe_divide(
    numerator: Column | str, denominator: Column | str, default: float = 0.0
) -> Column:
    """Division with a default for a zero or missing denominator only."""
    num, den = _col(numerator).cast("double"), _col(denominator).cast("double")
    return F.when(den.isNull() | (den == 0), F.lit(float(default))).otherwise(num / den)


def per_at_least_one(numerator: Column | str, denominator: Column | str) -> Column:
    """Division where a zero denominator counts as one."""
    den = _col(denominator).cast("double")
    return _col(numerator).cast("double") / F.when(den == 0, F.lit(1.0)).otherwise(den)


def count_type(event_type: str, column: Column | str = "event_type") -> Column:
    """Number of rows of one event type."""
    return F.count_if(_col(column) == event_type)


def count_equal(column: Column | str, value: str) -> Column:
    return F.count_if(_col(column) == value)


def revenue_where(condition: Column, revenue: Column | str = "revenue_amount") -> Column:
    """Revenue of the rows that meet a condition; the others add 0."""
    amount = _col(revenue)
    return F.sum(F.when(condition, amount).otherwise(amount * 0))
