"""Money and rate arithmetic. Amounts stay DECIMAL so sums do not depend on row order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
RATE = "decimal(10,4)"


def money(value: Column) -> Column:
    return value.cast(MONEY)


def money_sum(value: Column) -> Column:
    """Sum of amounts with an empty or all-NULL sum counted as zero."""
    return money(F.coalesce(F.sum(value), F.lit(0)))


def zero_if_null(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def guarded_ratio(numerator: Column, denominator: Column, stored_as: str = RATE) -> Column:
    """``numerator / denominator`` rounded half-up, or 0 when there is nothing to divide by."""
    nothing = denominator.isNull() | (denominator == 0)
    return F.when(nothing, F.lit(0)).otherwise(numerator / denominator).cast(stored_as)


def number_or_zero(value: Column) -> Column:
    """Numeric reading of any scalar, also of number text; missing or unreadable gives 0."""
    return F.coalesce(value.try_cast("double"), F.lit(0.0))
