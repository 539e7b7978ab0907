"""Decimal helpers: every stored amount is rounded half away from zero at a fixed scale."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
WHOLE = "decimal(18,0)"
RATE = "decimal(9,2)"


def money(value: Column) -> Column:
    return value.cast(MONEY)


def whole(value: Column) -> Column:
    return value.cast(WHOLE)


def nz(value: Column | str) -> Column:
    """The value, or zero where it is NULL."""
    return F.coalesce(F.col(value) if isinstance(value, str) else value, F.lit(0))


def zero() -> Column:
    return F.lit(0).cast(MONEY)


def ratio_whole(numerator: Column, denominator: Column) -> Column:
    """Exact quotient rounded to an integer: doubling before the integer division avoids a rounded decimal quotient."""
    numerator = numerator.cast("decimal(32,4)")
    twice = F.abs(numerator) * F.lit(2) + denominator
    return (F.signum(numerator).cast("int") * F.call_function("div", twice, denominator * F.lit(2))).cast(WHOLE)


def ratio_money(numerator: Column, denominator: Column) -> Column:
    """Exact quotient rounded to two decimals."""
    return (ratio_whole(numerator.cast("decimal(30,4)") * F.lit(100), denominator) / F.lit(100)).cast(MONEY)
