"""Integer arithmetic that truncates, and percentages that do not."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F


def int_div(dividend: Column, divisor: Column) -> Column:
    """Quotient of two integers, truncated toward zero."""
    return F.call_function("div", dividend, divisor)


def int_avg(values: Column, window: WindowSpec | None = None) -> Column:
    """Mean of an integer column, truncated toward zero; NULL when there is no value."""
    total, count = F.sum(values), F.count(values)
    if window is not None:
        total, count = total.over(window), count.over(window)
    return int_div(total, count)


def truncated_ratio(dividend: Column, divisor: Column, decimals: int) -> Column:
    """Quotient of whole numbers cut after ``decimals`` places, as a whole number of the last place.

    The remainder is taken off first, so the division has nothing to round.
    """
    scaled = dividend.cast("decimal(20,0)") * F.lit(Decimal(10**decimals))
    return (scaled - scaled % divisor) / divisor


def growth_percentage(current: Column, previous: Column) -> Column:
    """Change in percent of ``previous``, two decimals; NULL if that is zero or NULL.

    Rounded half away from zero from the exact quotient: twice the hundredths
    of a percent, cut, tell which half a quotient is in.
    """
    base = F.nullif(previous, F.lit(0)).cast("decimal(20,0)")
    halves = truncated_ratio(2 * F.abs(current - previous), F.abs(base), 4)
    size = F.floor((halves + 1) / 2).cast("decimal(20,0)")
    hundredths = F.when((current < previous) != (base < 0), -size).otherwise(size)
    return (hundredths * F.lit(Decimal("0.01"))).cast("decimal(18,2)")
