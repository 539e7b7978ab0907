"""Month close: minimum-balance savings interest and monthly loan accrual.

The savings half and the loan half share nothing and run independently. History tables are read for one month only.
Accounts are met by shuffle: a few of their columns are little in a file, but a row each in memory of the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.dates import day_diff, first_date, last_date, same_month
from ledgerloom.functions.money import MONEY, RATE, money, ratio_money, zero
from ledgerloom.operators.changes import (
    ACCOUNT_KEYS,
    LOAN_KEYS,
    MEMBER_KEYS,
    by_shuffle,
    products_of,
    set_where,
    with_run,
    within_run,
)
from ledgerloom.sources.tables import Tables

ACCOUNT = ["saving_summary_id", *ACCOUNT_KEYS]


def _month_start() -> Column:
    return first_date(F.col("run_month_end"))


# ---------------------------------------------------------------- savings: candidates


def _month_of_savings(t: Tables) -> DataFrame:
    rows = within_run(
        t.saving_trx, t, "transaction_date", first_date(F.min("month_end_date")), last_date(F.max("month_end_date"))
    )
    return with_run(rows, t).filter(same_month(F.col("transaction_date"), F.col("run_month_end")))


def saving_transactions(t: Tables) -> DataFrame:
    """The month's transactions of open accounts (balance and date)."""
    open_accounts = t.saving_summary.filter("saving_status = 1").select(*ACCOUNT)
    rows = _month_of_savings(t).join(by_shuffle(open_accounts), ACCOUNT, "left_semi")
    return rows.select(*ACCOUNT, "organization_id", "balance", "transaction_date")


def savings_register(t: Tables) -> DataFrame:
    """Deposits with interest, withdrawals and balance per account and date.

    Transactions meet open accounts by five keys without the account id, so each counts once per matching account;
    the sums are formed first and multiplied by that number.
    """
    keys = [*ACCOUNT, "organization_id", "transaction_date"]
    sums = (
        _month_of_savings(t)
        .groupBy(*keys)
        .agg(
            (F.sum("deposit") + F.sum("monthly_interest")).alias("personal_savings"),
            F.sum("withdrawal").alias("withdrawal"),
            F.sum("balance").alias("balance"),
        )
    )
    accounts = t.saving_summary.filter("saving_status = 1").groupBy(*ACCOUNT_KEYS).agg(F.count(F.lit(1)).alias("n"))
    rows = sums.join(by_shuffle(accounts), ACCOUNT_KEYS)
    amounts = [(F.col(c) * F.col("n")).cast(MONEY).alias(c) for c in ("personal_savings", "withdrawal", "balance")]
    return rows.select(*keys, *amounts)


def increases(t: Tables) -> DataFrame:
    """Register rows after the 7th on which the balance grew, with the balance before."""
    previous = F.col("balance") - F.col("personal_savings") + F.col("withdrawal")
    rows = savings_register(t).withColumn("previous_balance", money(previous))
    return rows.filter((F.col("balance") > F.col("previous_balance")) & (F.dayofmonth("transaction_date") > 7))


def _first_increases(t: Tables) -> DataFrame:
    first = F.min(F.struct("transaction_date", "previous_balance")).alias("first")
    return increases(t).groupBy(*ACCOUNT, "organization_id").agg(first)


def first_increase(t: Tables) -> DataFrame:
    """The date of each account's first such increase."""
    rows = _first_increases(t)
    return rows.select(*ACCOUNT, "organization_id", F.col("first.transaction_date").alias("min_installment_date"))


def opening_rows(t: Tables) -> DataFrame:
    """A month-start row per account holding the balance before its first increase."""
    rows = with_run(_first_increases(t), t)
    return rows.select(
        *ACCOUNT,
        "organization_id",
        F.col("first.previous_balance").alias("balance"),
        _month_start().alias("transaction_date"),
    )


# ---------------------------------------------------------------- savings: minimum balance


def _summary(t: Tables, **columns: str) -> DataFrame:
    """Open accounts with chosen columns under new names."""
    chosen = [F.col(c).alias(name) for name, c in columns.items()]
    return t.saving_summary.filter("saving_status = 1").select(*ACCOUNT, *chosen)


def min_balance(t: Tables) -> DataFrame:
    """Minimum over candidates dated like their account, per account and date."""
    candidates = saving_transactions(t).unionByName(opening_rows(t))
    keys = [c for c in ACCOUNT if c != "no_of_account"]
    dated = t.saving_summary.filter("saving_status = 1").select(*keys, "transaction_date")
    joined = candidates.join(by_shuffle(dated), [*keys, "transaction_date"], "left_semi")
    rows = joined.groupBy(*ACCOUNT, "organization_id", "transaction_date")
    return rows.agg(F.min("balance").cast(MONEY).alias("balance"))


def static_balance(t: Tables, moved: DataFrame) -> DataFrame:
    """Open accounts not in ``moved``: deposits less withdrawals, dated month start."""
    rows = with_run(t.saving_summary.filter("saving_status = 1"), t).join(by_shuffle(moved.select(*ACCOUNT)), ACCOUNT, "left_anti")
    return rows.select(
        *ACCOUNT,
        "organization_id",
        _month_start().alias("transaction_date"),
        money(F.col("deposit") - F.col("withdrawal")).alias("balance"),
    ).distinct()


def month_balances(t: Tables) -> DataFrame:
    """Minimum balances of moved accounts and static balances of the others, in one outer join."""
    moved = min_balance(t).select(
        *ACCOUNT,
        F.col("organization_id").alias("m_organization"),
        F.col("transaction_date").alias("m_date"),
        F.col("balance").alias("m_balance"),
    )
    rows = with_run(t.saving_summary.filter("saving_status = 1"), t).select(
        *ACCOUNT,
        "organization_id",
        _month_start().alias("month_start"),
        money(F.col("deposit") - F.col("withdrawal")).alias("static"),
    )
    found = F.col("m_date").isNotNull()
    return rows.join(moved, ACCOUNT, "full").select(
        *ACCOUNT,
        F.coalesce("m_organization", "organization_id").alias("organization_id"),
        F.when(found, F.col("m_date")).otherwise(F.col("month_start")).alias("transaction_date"),
        F.when(found, F.col("m_balance")).otherwise(F.col("static")).alias("balance"),
    )


def new_after_7(t: Tables) -> DataFrame:
    """Open accounts opened this month after the 7th; they earn no interest."""
    rows = with_run(t.saving_summary.filter("saving_status = 1"), t)
    opened = same_month(F.col("opening_date"), F.col("run_month_end")) & (F.dayofmonth("opening_date") > 7)
    return rows.filter(opened).select(*ACCOUNT, "organization_id", "opening_date")


def min_age_balance(t: Tables, balances: DataFrame) -> DataFrame:
    """Balances of accounts younger than the month's days less 7 at month end become zero."""
    rows = with_run(balances, t).join(by_shuffle(_summary(t, opening_date="opening_date")), ACCOUNT, "left")
    wanted_age = F.dayofmonth(last_date(F.col("run_month_end"))) - 7
    young = F.col("opening_date").isNotNull() & (
        day_diff(F.col("run_month_end"), F.col("opening_date")) < wanted_age
    )
    return set_where(rows, young, balance=0).select(*balances.columns)


def new_in_7(t: Tables) -> DataFrame:
    """Opening-day transactions of accounts opened on days 1 to 7 and never withdrawn from."""
    opened = (
        with_run(t.saving_summary.filter("saving_status = 1 AND withdrawal = 0"), t)
        .filter(
            same_month(F.col("opening_date"), F.col("run_month_end"))
            & F.dayofmonth("opening_date").between(1, 7)
        )
        .select(*ACCOUNT, F.col("opening_date").alias("transaction_date"))
    )
    rows = _month_of_savings(t).join(by_shuffle(opened), [*ACCOUNT, "transaction_date"], "left_semi")
    return rows.select(*ACCOUNT, "organization_id", "balance", "transaction_date")


def apply_new_in_7(t: Tables, balances: DataFrame) -> DataFrame:
    """Balances and dates of those accounts overwritten by their opening transaction (the largest, if several).

    ``balances`` holds every open account, so each of those accounts has a row in it.
    """
    fresh = new_in_7(t).groupBy(*ACCOUNT_KEYS).agg(
        F.max("balance").alias("new_balance"), F.max("transaction_date").alias("new_date")
    )
    rows = balances.join(by_shuffle(fresh), ACCOUNT_KEYS, "left")
    changed = set_where(
        rows, F.col("new_date").isNotNull(), balance=F.col("new_balance"), transaction_date=F.col("new_date")
    )
    return changed.select(*balances.columns)


def final_balances(t: Tables) -> DataFrame:
    """The balances interest is paid on."""
    return apply_new_in_7(t, min_age_balance(t, month_balances(t)))


# ---------------------------------------------------------------- savings: interest


def savings_interest(t: Tables, balances: DataFrame) -> DataFrame:
    """Interest of the month per account: balance x rate x days over a 365- or 366-day year."""
    rows = with_run(balances, t).join(by_shuffle(_summary(t, interest_rate="interest_rate")), ACCOUNT)
    days = day_diff(F.col("run_month_end"), _month_start()) + 1
    year = F.year("run_month_end")
    leap = (year % 4 == 0) | (year % 100 == 0) | (year % 400 == 0)
    base = F.when(leap, 36600).otherwise(36500)
    interest = ratio_money(F.col("balance") * F.col("interest_rate").cast(RATE) * days, base)
    return rows.select(
        *ACCOUNT,
        "organization_id",
        "balance",
        interest.alias("interest"),
        F.col("run_month_end").alias("transaction_date"),
    )


def final_interest(t: Tables, interest: DataFrame) -> DataFrame:
    """Interest of accounts opened after the 7th is zero."""
    excluded = new_after_7(t).select(*ACCOUNT, F.lit(1).alias("excluded"))
    rows = interest.join(by_shuffle(excluded), ACCOUNT, "left")
    return set_where(rows, F.col("excluded") == 1, interest=0).select(*interest.columns)


def close_process(t: Tables) -> DataFrame:
    """The month-end date's process row carries the month closing."""
    today = F.col("business_date") == F.col("run_month_end")
    run = t.run_control.select("office_id", F.col("month_end_date").alias("run_month_end"))
    df = t.process_info.join(run, "office_id", "left")
    df = set_where(df, today, month_closing_status=1, month_closing_date=F.col("run_month_end"))
    return df.select(*t.process_info.columns)


# ---------------------------------------------------------------- loans


def _accruing(t: Tables) -> DataFrame:
    """All loans with the run's month and ``accrues``: running monthly loans without a transaction this month."""
    run = t.run_control.select("office_id", F.col("month_end_date").alias("run_month_end"))
    month = within_run(
        t.loan_trx, t, "installment_date", first_date(F.min("month_end_date")), F.max("month_end_date")
    )
    transacted = (
        month.join(run, "office_id")
        .filter(F.col("installment_date").between(_month_start(), F.col("run_month_end")))
        .select("office_id", "loan_summary_id")
        .distinct()
        .withColumn("transacted", F.lit(1))
    )
    loans = (
        t.loan_summary.join(run, "office_id", "left")
        .join(transacted, ["office_id", "loan_summary_id"], "left")
        .join(
            products_of(
                t,
                F.col("interest_calculation_method").alias("p_method"),
                F.col("payment_frequency").alias("p_frequency"),
            ),
            "product_id",
            "left",
        )
    )
    accrues = (
        (F.col("loan_status") == 1)
        & (F.col("disburse_date") < _month_start())
        & (F.col("p_frequency") == "M")
        & (F.col("installment_start_date") <= F.col("run_month_end"))
        & F.col("transacted").isNull()
    )
    return loans.withColumn("accrues", F.coalesce(accrues, F.lit(False)))


def _month_charge(before: Column, installment_no: Column) -> Column:
    """``before`` plus the month's charge, rounded once.

    Flat loans add nothing; A, E and R add a day-count charge past their duration and one duration-th before;
    D adds the day count; other methods give NULL.
    """
    volume = money(F.col("principal_loan") - F.col("loan_repaid")) * F.col("interest_rate").cast(RATE)
    days = day_diff(F.col("run_month_end"), F.col("installment_date"))

    def plus(amount: Column, base: Column) -> Column:
        return ratio_money(before * base + amount, base)

    by_days = plus(volume * days, F.lit(36500))
    spread = plus(volume, F.col("duration") * 100)
    return (
        F.when(F.col("p_method") == "F", money(before))
        .when(
            F.col("p_method").isin("A", "E", "R"),
            F.when(installment_no >= F.col("duration"), by_days).otherwise(spread),
        )
        .when(F.col("p_method") == "D", by_days)
    )


def loan_accrual(t: Tables) -> DataFrame:
    """Accruing loans move one instalment on and take the month's charge."""
    charge = _month_charge(F.col("int_charge"), F.col("installment_no"))
    df = set_where(
        _accruing(t), F.col("accrues"), installment_no=F.col("installment_no") + 1, int_charge=charge
    )
    return df.select(*t.loan_summary.columns)


def accrual_trx(t: Tables) -> DataFrame:
    """History rows of the accrual; the charge is evaluated on the instalment number after it moved on."""
    moved_on = F.col("installment_no") + 1
    charge = _month_charge(zero(), moved_on)
    return _accruing(t).filter("accrues").select(
        F.lit(None).cast("bigint").alias("loan_trx_id"),
        F.col("run_month_end").alias("trx_date"),
        F.col("run_month_end").alias("installment_date"),
        "loan_summary_id",
        "organization_id",
        *LOAN_KEYS[:-1],
        F.lit(None).cast(MONEY).alias("principal_loan"),
        zero().alias("loan_paid"),
        F.col("loan_installment").alias("loan_due"),
        F.col("int_installment").alias("int_due"),
        charge.alias("int_charge"),
        zero().alias("int_paid"),
        F.lit(10).alias("trx_type"),
        moved_on.cast("int").alias("installment_no"),
        "member_category_id",
        "employee_id",
        "investor_id",
    )


def _month_end_trx(t: Tables) -> DataFrame:
    run = t.run_control.select("office_id", F.col("month_end_date").alias("run_month_end"))
    rows = within_run(t.loan_trx, t, "installment_date", F.min("month_end_date"), F.max("month_end_date"))
    return rows.join(run, "office_id").filter(F.col("installment_date") == F.col("run_month_end"))


def _monthly_loans(t: Tables) -> DataFrame:
    monthly = products_of(t, "payment_frequency").filter("payment_frequency = 'M'")
    return t.loan_summary.join(monthly, "product_id", "left_semi")


def _zero_dues(t: Tables, loans: DataFrame) -> DataFrame:
    """Month-end history rows; dues of the given loans are zero."""
    rows = _month_end_trx(t).join(loans.select(*LOAN_KEYS, F.lit(1).alias("hit")), LOAN_KEYS, "left")
    return set_where(rows, F.col("hit") == 1, loan_due=0, int_due=0).select(*t.loan_trx.columns)


def zero_past_duration(t: Tables) -> DataFrame:
    """Month-end rows without dues for monthly loans past their duration."""
    return _zero_dues(t, _monthly_loans(t).filter(F.col("installment_no") > F.col("duration")))


def advance_date(t: Tables) -> DataFrame:
    """Open monthly loans with a month-end row (matched without the loan id) take the month end as instalment date."""
    keys = LOAN_KEYS[:-1]
    moved = _month_end_trx(t).select(*keys, "run_month_end").distinct()
    products = products_of(t, F.col("payment_frequency").alias("p_frequency"))
    df = t.loan_summary.join(moved, keys, "left").join(products, "product_id", "left")
    hit = (
        (F.col("p_frequency") == "M")
        & (F.col("loan_status") == 1)
        & (F.col("installment_start_date") <= F.col("run_month_end"))
    )
    return set_where(df, hit, installment_date=F.col("run_month_end")).select(*t.loan_summary.columns)


def zero_expired(t: Tables) -> DataFrame:
    """Month-end rows without dues for open monthly loans of members who died after the disbursement."""
    loans = _monthly_loans(t).filter("loan_status = 1 AND is_active = 1")
    expired = t.expire_infos.groupBy(*MEMBER_KEYS).agg(F.max("expire_date").alias("expire_date"))
    hit = loans.join(expired, MEMBER_KEYS).filter(F.col("expire_date") > F.col("disburse_date"))
    return _zero_dues(t, hit)
