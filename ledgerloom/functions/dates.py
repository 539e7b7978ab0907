"""Date functions of the ledger as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_diff(later: Column, earlier: Column) -> Column:
    """Signed whole days between two dates."""
    return F.datediff(later, earlier)


def month_diff(first: Column, second: Column) -> Column:
    """Months between two dates, floored before the sign is dropped (0.2 months backwards counts as 1)."""
    return F.abs(F.floor(F.months_between(first, second, False))).cast("int")


def first_date(day: Column) -> Column:
    return F.trunc(day, "month")


def last_date(day: Column) -> Column:
    return F.last_day(day)


def day_of(day: Column) -> Column:
    return F.dayofmonth(day)


def month_of(day: Column) -> Column:
    return F.month(day)


def year_of(day: Column) -> Column:
    return F.year(day)


def week_day(day: Column) -> Column:
    """English day name, as stored in ``centers.collection_day``."""
    return F.date_format(day, "EEEE")


def same_month(day: Column, other: Column) -> Column:
    """Range form of "same month and year", so partitions and row groups can be pruned."""
    return day.between(first_date(other), last_date(other))
