"""Instalment formulas of the six interest methods, as column expressions over a whole loan DataFrame.

Amounts a ledger keeps in two-decimal (or whole-number) fields are rounded at the same points here, because the
rounding is visible in the results.

Methods: F flat, A amortization, D declining, E amortization with fixed charge, R reducing, H housing.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.dates import day_diff
from ledgerloom.functions.money import MONEY, RATE, money, ratio_whole, whole, zero

# fixed values: yearly divisors per payment frequency and the day-count base
WEEKLY_DIVISOR = 4600
OTHER_DIVISOR = 1200
DAY_COUNT_BASE = 36500


def with_terms(loans: DataFrame, business_date: Column) -> DataFrame:
    """Add the intermediate amounts every formula starts from, as columns prefixed ``f_``.

    ``loans`` holds loan and product columns under their table names.
    """
    balance = money(F.col("principal_loan") - F.col("loan_repaid"))
    staged = loans.withColumns(
        {
            "f_balance": balance,
            "f_volume": balance * F.col("interest_rate").cast(RATE),
            "f_recoverable": money(F.col("loan_installment") + F.col("int_installment")),
            "f_cumulative_paid": money(F.col("loan_repaid") + F.col("int_paid")),
        }
    )
    divisor = F.when(F.col("payment_frequency") == "W", WEEKLY_DIVISOR).otherwise(OTHER_DIVISOR)
    days = F.abs(day_diff(F.col("installment_date"), business_date))
    return staged.withColumns(
        {
            # interest of one instalment period, whole
            "f_period_interest": money(ratio_whole(F.col("f_volume"), divisor)),
            # day-count interest since the last instalment, whole
            "f_daily_interest": money(ratio_whole(F.col("f_volume") * days, F.lit(DAY_COUNT_BASE))),
            "f_reducing_interest": money(F.coalesce(F.col("f_volume") / OTHER_DIVISOR, F.lit(0))),
        }
    )


def _column(name: str):
    return field(default_factory=lambda: F.col(name))


@dataclass(frozen=True)
class LoanTerms:
    """Columns of one loan, its product and the intermediate amounts of :func:`with_terms`."""

    method: Column = _column("interest_calculation_method")
    principal: Column = _column("principal_loan")
    repaid: Column = _column("loan_repaid")
    loan_installment: Column = _column("loan_installment")
    int_installment: Column = _column("int_installment")
    charge: Column = _column("int_charge")
    paid: Column = _column("int_paid")
    installment_no: Column = _column("installment_no")
    duration: Column = _column("duration")
    balance: Column = _column("f_balance")
    recoverable: Column = _column("f_recoverable")
    cumulative_paid: Column = _column("f_cumulative_paid")
    period_interest: Column = _column("f_period_interest")
    daily_interest: Column = _column("f_daily_interest")
    reducing_interest: Column = _column("f_reducing_interest")

    def by_method(self, **branches: Column) -> Column:
        """One branch per method letter; an unknown or NULL method gives zero."""
        result = None
        for letter, value in branches.items():
            condition = self.method == letter
            result = F.when(condition, money(value)) if result is None else result.when(condition, money(value))
        return result.otherwise(zero())


def _principal_left_or(t: LoanTerms, charge_with_interest: Column, threshold: Column) -> Column:
    """A regular instalment while more than ``threshold`` is outstanding, else the whole balance."""
    outstanding = t.principal + whole(charge_with_interest) - t.cumulative_paid
    return F.when(outstanding > threshold, t.loan_installment).otherwise(t.balance)


def _flat_principal(t: LoanTerms) -> Column:
    return F.when(t.balance > t.loan_installment, t.loan_installment).otherwise(t.principal - t.repaid)


def _housing_principal(t: LoanTerms) -> Column:
    room = t.recoverable - (whole(t.charge + t.daily_interest) - t.paid)
    return (
        F.when(room < 0, zero()).when(room > t.balance, t.balance).otherwise(t.recoverable - t.daily_interest)
    )


def _principal_branches(t: LoanTerms) -> dict[str, Column]:
    after_interest = t.recoverable - t.period_interest
    return {
        "F": _flat_principal(t),
        "A": F.when(after_interest > t.balance, t.balance).otherwise(after_interest),
        "D": _principal_left_or(t, t.charge + t.daily_interest, t.recoverable),
        "E": _principal_left_or(t, t.charge + t.period_interest, t.recoverable),
        "R": _principal_left_or(t, t.charge + t.period_interest, t.loan_installment + t.reducing_interest),
        "H": _housing_principal(t),
    }


def loan_due(t: LoanTerms) -> Column:
    """Principal due on the business date."""
    return t.by_method(**_principal_branches(t))


def loan_paid(t: LoanTerms) -> Column:
    """Principal expected to be collected; equal to the principal due."""
    return loan_due(t)


def duration_over_loan_due(t: LoanTerms) -> Column:
    """Principal due past the duration: the housing method yields zero."""
    return t.by_method(**{**_principal_branches(t), "H": zero()})


def loan_due_first_edition(t: LoanTerms) -> Column:
    """Earlier edition of the principal due: A falls back to the interest, R compares with the full instalment."""
    after_interest = t.recoverable - t.period_interest
    branches = _principal_branches(t)
    branches["A"] = F.when(after_interest > t.balance, t.balance).otherwise(t.period_interest)
    branches["R"] = _principal_left_or(t, t.charge + t.period_interest, t.recoverable + t.reducing_interest)
    return t.by_method(**branches)


def int_due(t: LoanTerms) -> Column:
    """Interest due on the business date."""
    remaining = t.charge - t.paid
    flat = money(F.when(remaining < t.int_installment, t.int_installment - remaining).otherwise(zero())) + F.when(
        remaining > t.int_installment, t.int_installment
    ).otherwise(remaining)

    def settled_or(interest: Column, threshold: Column, regular: Column) -> Column:
        outstanding = t.principal + t.charge + interest - t.cumulative_paid
        return F.when(outstanding > threshold, regular).otherwise(t.charge + interest - t.paid)

    return t.by_method(
        A=t.period_interest,
        F=flat,
        D=settled_or(t.daily_interest, t.recoverable, t.int_installment),
        E=settled_or(t.period_interest, t.recoverable, t.int_installment),
        R=settled_or(t.period_interest, t.loan_installment + t.reducing_interest, t.reducing_interest),
        H=F.when(t.installment_no + 1 == t.duration, t.charge + t.daily_interest - t.paid).otherwise(
            t.daily_interest
        ),
    )


def int_paid(t: LoanTerms) -> Column:
    """Interest expected to be collected; equal to the interest due."""
    return int_due(t)


def duration_over_int_due(t: LoanTerms) -> Column:
    return int_due(t)


def int_charge(t: LoanTerms) -> Column:
    """Interest charged for the period: none for flat loans, the day count for declining and housing loans."""
    return t.by_method(
        F=zero(),
        A=t.period_interest,
        E=t.period_interest,
        R=t.period_interest,
        D=t.daily_interest,
        H=t.daily_interest,
    )


def cum_int_charge(t: LoanTerms) -> Column:
    return money(t.charge + int_charge(t))


FORMULAS = {
    "loan_due": loan_due,
    "loan_paid": loan_paid,
    "int_due": int_due,
    "int_paid": int_paid,
    "duration_over_loan_due": duration_over_loan_due,
    "duration_over_int_due": duration_over_int_due,
    "loan_due_first_edition": loan_due_first_edition,
    "int_charge": int_charge,
    "cum_int_charge": cum_int_charge,
}
