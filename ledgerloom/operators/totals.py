"""Running totals of loan history, so that a day reads the days since the last month close and no more.

``totals_until`` holds for an office the first date that is not in its totals, ``loan_totals`` the sums of each loan's
history rows before that date. The month close carries the closed month over; the days after it add their slices to
what was carried. An office without totals, or with totals beyond the date asked for, is summed from all its history:
that is also how totals are rebuilt. Nothing is ever subtracted, so NULL sums and largest numbers stay exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.dates import first_date
from ledgerloom.operators.changes import LOAN_KEYS
from ledgerloom.sources.tables import Tables

AMOUNTS = ["principal_loan", "loan_due", "int_charge", "int_due"]
WIDE = "decimal(28,2)"
BEGINNING = "0001-01-01"


def _summed(rows: DataFrame) -> DataFrame:
    """One row per loan; the rows are combined before the shuffle."""
    sums = [F.sum(name).cast(WIDE).alias(name) for name in AMOUNTS]
    return rows.groupBy(*LOAN_KEYS).agg(*sums, F.max("installment_no").alias("installment_no"))


def _offices(t: Tables, last: str, usable: Column) -> DataFrame:
    """The run's offices with the last date asked for and the date their totals reach, NULL where not usable."""
    run = t.run_control.select("office_id", F.col(last).alias("last_date"))
    offices = run.join(t.totals_until, "office_id", "left")
    return offices.select("office_id", "last_date", F.when(usable, F.col("until")).alias("since"))


def _sums(t: Tables, offices: DataFrame, loans: DataFrame | None = None) -> DataFrame:
    """The sums of history up to each office's last date; of the given loans only, if any are given."""
    low = offices.agg(F.min(F.coalesce("since", F.lit(BEGINNING).cast("date")))).scalar()
    high = offices.agg(F.max("last_date")).scalar()
    rows = t.loan_trx.filter((F.col("installment_date") >= low) & (F.col("installment_date") <= high))
    rows = rows.join(offices, "office_id").filter(F.col("installment_date") <= F.col("last_date"))
    rows = rows.filter(F.col("since").isNull() | (F.col("installment_date") >= F.col("since")))
    carried = t.loan_totals.join(offices.filter("since IS NOT NULL").select("office_id"), "office_id", "left_semi")
    columns = [*LOAN_KEYS, *AMOUNTS, "installment_no"]
    both = [df.select(*columns) for df in (rows, carried)]
    if loans is not None:
        both = [df.join(loans.select(*LOAN_KEYS), LOAN_KEYS, "left_semi") for df in both]
    return _summed(both[0].unionByName(both[1]))


def history_sums(t: Tables, loans: DataFrame) -> DataFrame:
    """Sums of the loans' history up to the run date."""
    return _sums(t, _offices(t, "business_date", F.col("until") <= F.col("last_date")), loans)


def carry_month(t: Tables) -> Tables:
    """The totals with the run's offices carried to the end of the closed month."""
    offices = _offices(t, "month_end_date", F.col("until") <= first_date(F.col("last_date")))
    run = t.run_control.select("office_id")
    others = t.loan_totals.join(run, "office_id", "left_anti")
    reached = offices.select("office_id", F.date_add("last_date", 1).alias("until"))
    return t.replace(
        loan_totals=others.unionByName(_sums(t, offices)),
        totals_until=t.totals_until.join(run, "office_id", "left_anti").unionByName(reached),
    )


def rebuild(t: Tables) -> Tables:
    """Totals from all history, as far as they reached before; offices without any stay without."""
    before = t.loan_trx.join(t.totals_until, "office_id").filter(F.col("installment_date") < F.col("until"))
    return t.replace(loan_totals=_summed(before))
