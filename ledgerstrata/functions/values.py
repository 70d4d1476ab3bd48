"""Typed casts and calendar arithmetic. Bad input gives NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(20,2)"


def money(value: Column) -> Column:
    return value.try_cast(MONEY)


def whole(value: Column) -> Column:
    """Integer part of a number in text: ``'4.0'`` is 4."""
    return value.try_cast("decimal(38,18)").try_cast("int")


def day(value: Column) -> Column:
    return value.try_cast("date")


def moment(value: Column) -> Column:
    """A wall-clock moment; without a zone, so that no hour moves when clocks change."""
    return value.try_cast("timestamp_ntz")


def years_between(birth: Column, as_of: Column) -> Column:
    """Difference of the calendar years, whatever the birthday."""
    return F.year(as_of) - F.year(birth)


def days_since(first: Column, as_of: Column) -> Column:
    return F.datediff(as_of, first)
