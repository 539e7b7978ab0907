"""Names, product-code prefixes and voucher numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def member_name() -> Column:
    return F.concat_ws(" ", "first_name", "middle_name", "last_name")


def joined_name(separator: str) -> Column:
    """First, middle and last name with NULL parts kept as empty text between the separators."""
    parts = [F.coalesce(F.col(c), F.lit("")) for c in ("first_name", "middle_name", "last_name")]
    return F.concat_ws(separator, *parts)


def starts_with(code: Column | str, prefix: str) -> Column:
    return F.substring(code, 1, len(prefix)) == F.lit(prefix)


def voucher_for_year(voucher_no: Column, year: Column) -> Column:
    """The number before its first dash, with the year as suffix."""
    dash = F.instr(voucher_no, "-")
    return F.concat(F.substring(voucher_no, F.lit(1), dash - 1), F.lit("-"), year.cast("string"))


def voucher_with_last_year(voucher_no: Column, year: Column) -> Column:
    """The number with its last four characters replaced by the year."""
    return F.concat(F.substring(voucher_no, F.lit(1), F.length(voucher_no) - 4), year.cast("string"))
