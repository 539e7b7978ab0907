"""Loan formulas at their boundaries, against plain decimal arithmetic written from the rules."""

from datetime import date, timedelta
from decimal import ROUND_HALF_UP, Decimal
from itertools import product

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import dates, formulas
from ledgerloom.functions.money import ratio_money, ratio_whole

RUN = date(2001, 7, 16)


def rounded(value: Decimal, places: str) -> Decimal:
    return value.quantize(Decimal(places), ROUND_HALF_UP)


def expected(case: dict) -> dict[str, Decimal]:
    """Due, interest and charge of one loan."""
    cents, units = "0.01", "1"
    method, weekly = case["interest_calculation_method"], case["payment_frequency"] == "W"
    principal, repaid = case["principal_loan"], case["loan_repaid"]
    inst, interest_inst = case["loan_installment"], case["int_installment"]
    charge, paid, rate = case["int_charge"], case["int_paid"], case["interest_rate"]
    balance, recoverable, cum = principal - repaid, inst + interest_inst, repaid + paid
    period = rounded(balance * rate / (4600 if weekly else 1200), units)
    days = abs((case["installment_date"] - RUN).days)
    daily = rounded(balance * rate * days / 36500, units)
    reducing = rounded(balance * rate / 1200, cents)
    due, interest = Decimal(0), Decimal(0)
    if method == "F":
        due = inst if balance > inst else balance
        left = charge - paid
        interest = (interest_inst - left if left < interest_inst else 0) + (
            interest_inst if left > interest_inst else left
        )
    elif method == "A":
        due, interest = min(recoverable - period, balance), period
    elif method in ("D", "E"):
        extra = daily if method == "D" else period
        due = inst if principal + rounded(charge + extra, units) - cum > recoverable else balance
        interest = interest_inst if principal + charge + extra - cum > recoverable else charge + extra - paid
    elif method == "R":
        due = inst if principal + rounded(charge + period, units) - cum > inst + reducing else balance
        interest = reducing if principal + charge + period - cum > inst + reducing else charge + period - paid
    elif method == "H":
        room = recoverable - (rounded(charge + daily, units) - paid)
        due = Decimal(0) if room < 0 else balance if room > balance else recoverable - daily
        last = case["installment_no"] + 1 == case["duration"]
        interest = charge + daily - paid if last else daily
    added = {"A": period, "E": period, "R": period, "D": daily, "H": daily}.get(method, Decimal(0))
    return {
        "loan_due": due,
        "int_due": interest,
        "int_charge": added,
        "duration_over_loan_due": Decimal(0) if method == "H" else due,
    }


def cases():
    amounts = product(
        ("1000.00", "1000.25"),  # principal
        ("0", "900", "950.25", "1010"),  # repaid, also overpaid
        ("100", "50.25"),  # instalment, also equal to the balance
        ("12", "11.50"),
        ("10", "23"),
        (0, 7, 45),  # days since the last instalment
        (3, 11),
    )
    for principal, repaid, inst, interest, rate, days, no in amounts:
        for method, frequency in product(("F", "A", "D", "E", "R", "H", "X"), ("W", "M")):
            yield {
                "interest_calculation_method": method,
                "payment_frequency": frequency,
                "principal_loan": Decimal(principal),
                "loan_repaid": Decimal(repaid),
                "loan_installment": Decimal(inst),
                "int_installment": Decimal(interest),
                "interest_rate": Decimal(rate),
                "int_charge": Decimal("120.50"),
                "int_paid": Decimal("108.25"),
                "installment_date": RUN - timedelta(days=days),
                "installment_no": no,
                "duration": 12,
            }


LAYOUT = (
    "interest_calculation_method string, payment_frequency string, principal_loan decimal(18,2), "
    "loan_repaid decimal(18,2), loan_installment decimal(18,2), int_installment decimal(18,2), "
    "interest_rate decimal(18,2), int_charge decimal(18,2), int_paid decimal(18,2), installment_date date, "
    "installment_no int, duration int"
)


def evaluated(spark, rows):
    df = formulas.with_terms(spark.createDataFrame(rows, LAYOUT), F.lit(RUN))
    terms = formulas.LoanTerms()
    return df.select(*[build(terms).alias(name) for name, build in formulas.FORMULAS.items()]).collect()


def test_boundaries(spark):
    rows = list(cases())
    for case, row in zip(rows, evaluated(spark, rows), strict=True):
        for name, value in expected(case).items():
            assert row[name] == rounded(Decimal(value), "0.01"), (name, case)
        assert row["loan_paid"] == row["loan_due"]
        assert row["int_paid"] == row["duration_over_int_due"] == row["int_due"]
        assert row["cum_int_charge"] == case["int_charge"] + row["int_charge"]


def test_first_edition_differs_in_two_methods(spark):
    rows = list(cases())
    for case, row in zip(rows, evaluated(spark, rows), strict=True):
        if case["interest_calculation_method"] not in ("A", "R"):
            assert row["loan_due_first_edition"] == row["loan_due"]


def test_null_rate_takes_the_else_branch(spark):
    case = {**next(cases()), "interest_rate": None, "interest_calculation_method": "D"}
    row = evaluated(spark, [case])[0]
    assert row["loan_due"] == case["principal_loan"] - case["loan_repaid"]
    assert row["int_due"] is None


@pytest.mark.parametrize(
    ("numerator", "denominator", "whole", "money"),
    [("5", 10, "1", "0.50"), ("-5", 10, "-1", "-0.50"), ("4.9999", 10, "0", "0.50"), ("0.0499", 10, "0", "0.00"),
     ("0.05", 10, "0", "0.01"), ("-0.05", 10, "0", "-0.01"), ("18249.9999", 36500, "0", "0.50")],
)
def test_ratio_rounds_half_away(spark, numerator, denominator, whole, money):
    value = F.lit(Decimal(numerator))
    row = spark.range(1).select(
        ratio_whole(value, F.lit(denominator)).alias("w"), ratio_money(value, F.lit(denominator)).alias("m")
    )
    assert tuple(row.first()) == (Decimal(whole), Decimal(money))


def test_dates(spark):
    def on(build, *days):
        return spark.range(1).select(build(*[F.lit(d) for d in days]).alias("v")).first()["v"]

    assert on(dates.day_diff, date(2020, 3, 1), date(2020, 2, 28)) == 2
    assert on(dates.month_diff, date(2020, 1, 31), date(2020, 2, 5)) == 1
    assert on(dates.month_diff, date(2020, 2, 29), date(2020, 1, 31)) == 1
    assert on(dates.month_diff, date(2020, 5, 1), date(2020, 4, 30)) == 0
    assert on(dates.last_date, date(2020, 2, 3)) == date(2020, 2, 29)
    assert on(dates.first_date, date(2020, 2, 3)) == date(2020, 2, 1)
    assert on(dates.week_day, RUN) == "Monday"
