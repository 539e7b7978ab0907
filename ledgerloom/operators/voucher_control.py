"""Which offices have vouchers, kept as one row per office and organization.

The rules ask for it at every voucher run; the row is written when an office's first voucher enters the ledger, so
nothing has to look through the vouchers of all years. Vouchers are made inactive, never deleted, so a row stays true.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.sources.tables import Tables

KEYS = ["office_id", "organization_id"]


def _first_dates(vouchers: DataFrame) -> DataFrame:
    return vouchers.groupBy(*KEYS).agg(F.min("trx_date").alias("first_date"))


def rebuilt(t: Tables) -> DataFrame:
    """The control table from all vouchers, for a ledger that has none or whose vouchers were loaded from elsewhere."""
    return _first_dates(t.acc_trx_master)


def with_vouchers(t: Tables, masters: DataFrame) -> DataFrame:
    """The control table after new vouchers; repeating a run changes nothing."""
    new = _first_dates(masters)
    return t.voucher_control.unionByName(new).groupBy(*KEYS).agg(F.min("first_date").alias("first_date"))


def offices_with_vouchers(t: Tables) -> DataFrame:
    """Offices of the run that have any voucher."""
    return t.voucher_control.join(t.run_control.select(*KEYS), KEYS, "left_semi").select("office_id")
