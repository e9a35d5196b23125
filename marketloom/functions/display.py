"""Dashboard text: money, counts and percentages as the dashboard prints them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the dashboard.
TEN_THOUSAND_SUFFIX = " 万"
TEN_THOUSAND = 10000


def fixed_digits(value: Column, digits: int) -> Column:
    """A double printed with ``digits`` decimals, rounded on its exact binary value, ties away from zero.

    ``format_number`` rounds the exact binary value too, but ties to even. A tie is exactly
    representable only when it is an odd multiple of ``2**-(digits+1)``; those are nudged up.
    """
    size = F.abs(value)
    scaled = size * float(2 ** (digits + 1))
    exact_tie = (scaled == F.floor(scaled)) & (F.pmod(scaled, F.lit(2.0)) == 1.0)
    nudged = F.when(exact_tie, size + 10.0 ** -(digits + 2)).otherwise(size)
    text = F.call_function("format_number", nudged, F.lit("0." + "0" * digits))
    return F.concat(F.when(value < 0, F.lit("-")).otherwise(F.lit("")), text)


def money_text(value: Column) -> Column:
    number = F.coalesce(value.cast("double"), F.lit(0.0))
    large = F.concat(fixed_digits(number / float(TEN_THOUSAND), 2), F.lit(TEN_THOUSAND_SUFFIX))
    return F.when(F.abs(number) >= TEN_THOUSAND, large).otherwise(F.format_number(number, 2))


def count_text(value: Column) -> Column:
    return F.format_number(F.coalesce(value, F.lit(0)), 0)


def percent_text(value: Column) -> Column:
    number = F.coalesce(value.cast("double"), F.lit(0.0)) * 100.0
    return F.concat(fixed_digits(number, 1), F.lit("%"))
