"""Dates stored as integers, and calendar differences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import int_div

# Numbers written with eight characters; the negative ones are never dates.
EIGHT_DIGITS = (10_000_000, 99_999_999)
MINUS_AND_SEVEN_DIGITS = (-9_999_999, -1_000_000)


def decode_yyyymmdd(number: Column) -> Column:
    """Date of an integer ``yyyymmdd``; NULL for zero, another length or no such day.

    Whole-number arithmetic: parsing text costs several times as much. A day
    past the end of its month lands in another month and is dropped.
    """
    year = int_div(number, F.lit(10_000)).cast("int")
    month = int_div(number, F.lit(100)).cast("int") % 100
    day = number % 100
    first = F.when(
        number.between(*EIGHT_DIGITS) & month.between(1, 12), F.make_date(year, month, F.lit(1))
    )
    date = F.date_add(first, day - 1)
    return F.when(F.month(date) == month, date)


def is_undecodable(number: Column) -> Column:
    """True for a value that is a date by its length and none by the calendar."""
    by_length = number.between(*EIGHT_DIGITS) | number.between(*MINUS_AND_SEVEN_DIGITS)
    return F.coalesce(by_length, F.lit(False)) & decode_yyyymmdd(number).isNull()


def years_between(first: Column, last: Column) -> Column:
    """Number of year boundaries between two dates."""
    return F.year(last) - F.year(first)
