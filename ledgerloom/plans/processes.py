"""The business processes: validations first, then the operators in their fixed order, for all offices in one job.

Offices that fail a rule leave the run; the others continue. Each process returns a new table set and its validation
report. Tables that later steps read several times are written once to the shared folder.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators import accounts, adjustments, keys, totals, validations, vouchers
from ledgerloom.operators import day_end as eod
from ledgerloom.operators import month_close as mon
from ledgerloom.operators import start_of_day as sod
from ledgerloom.operators.changes import drop_keys, one_per_key
from ledgerloom.sources.staging import Stage
from ledgerloom.sources.tables import Tables


@dataclass(frozen=True)
class Outcome:
    tables: Tables
    report: DataFrame


def _saved(t: Tables, stage: Stage, step: str, *names: str) -> Tables:
    """The table set with the named tables written and read back."""
    return t.replace(**{name: stage.save(f"{step}/{name}", getattr(t, name)) for name in names})


def _keyed(t: Tables, stage: Stage, step: str, name: str, rows: DataFrame) -> tuple[Tables, DataFrame]:
    """New rows of a table, written with their keys, and the table set whose control knows these."""
    keyed = stage.save(step, keys.with_keys(t, name, stage.save(f"{step}-unkeyed", rows)))
    stage.drop(f"{step}-unkeyed")
    return t.replace(key_control=stage.save(f"{step}-keys", keys.dealt(t, name, keyed))), keyed


def _stage(t: Tables, label: str) -> Stage:
    return Stage(t.run_control.sparkSession, label)


def _run_of(t: Tables, stage: Stage) -> Tables:
    """The table set of a run whose control has one row per office: a second one would double every amount."""
    return t.replace(run_control=stage.save("run", one_per_key(t.run_control, ["office_id"]).select(*t.run_control.columns)))


def start_of_day(t: Tables, enforce: bool = True) -> Outcome:
    """The day's collection sheets, corrected, and the state tables they touch.

    ``enforce=False`` runs every office whatever its report says.
    """
    stage = _stage(t, "start-of-day")
    t = _run_of(t, stage)
    report = stage.save("report", validations.start_of_day_report(t))
    if enforce:
        t = validations.passing_offices(t, report)
    savings = sod.savings_sheet(t)
    other_savings = _other_offices(t, t.daily_saving_trx)
    other_loans = _other_offices(t, t.daily_loan_trx)
    t = t.replace(
        daily_saving_trx=other_savings.unionByName(savings, allowMissingColumns=True),
        daily_loan_trx=other_loans.unionByName(sod.loan_sheet(t), allowMissingColumns=True),
    )
    t = _saved(t, stage, "sheets", "daily_saving_trx", "daily_loan_trx")
    t = t.replace(daily_loan_trx=sod.corrections_before_exclusions(t))
    t = sod.drop_holiday_rows(t)
    t = t.replace(daily_loan_trx=sod.drop_expired_loans(t))
    t = sod.drop_family_grace(t)
    t = _saved(t, stage, "excluded", "daily_saving_trx", "daily_loan_trx")
    t = t.replace(loan_summary=sod.pending_disbursement(t), auto_voucher_check=sod.voucher_flag_reset(t))
    t = _saved(t, stage, "pending", "loan_summary")
    t = t.replace(daily_loan_trx=sod.corrections_after_exclusions(t))
    t = _saved(t, stage, "corrected", "daily_loan_trx")
    long_term = sod.lts_savings(t)
    t, opened = _keyed(t, stage, "opened", "process_info", sod.new_process(t))
    t = t.replace(
        daily_saving_trx=t.daily_saving_trx.unionByName(long_term, allowMissingColumns=True),
        loan_summary=sod.reset_partial(t),
        collection_loan_savings=sod.clear_collections(t),
        process_info=t.process_info.unionByName(opened),
    )
    return Outcome(t, report)


def _other_offices(t: Tables, df: DataFrame) -> DataFrame:
    """Rows of offices outside the run."""
    return df.join(t.run_control.select("office_id", "organization_id"), ["office_id", "organization_id"], "left_anti")


def adjust(t: Tables, stage: Stage, step: str, columns: list[str] | None = None) -> tuple[Tables, DataFrame]:
    """The adjustment sequence both the voucher run and day end start with.

    Rows that it adds are written; the day tables are these and what is left of the earlier rows. ``columns``: what the
    process reads of the day's loan rows, all if not given. Those loan rows that stay when the day is cleared are
    returned too, unwritten and with all columns.
    """
    staying = adjustments.dedupe_charges(t, eod.clear_day(t).daily_loan_trx)
    staying = adjustments.without_adjustments(t.replace(daily_loan_trx=staying)).daily_loan_trx
    t = adjustments.without_adjustments(t.replace(daily_loan_trx=adjustments.dedupe_charges(t)))
    t = t.replace(daily_loan_trx=stage.save(f"{step}/deduped", t.daily_loan_trx.select(*(columns or t.daily_loan_trx.columns))))
    added = stage.save(f"{step}/shifts", adjustments.shift_rows(t, adjustments.day_sums(t)).drop("rule"))
    t = t.replace(daily_loan_trx=_with_rows(t.daily_loan_trx, added))
    t, staying = _move_excess(t, stage, step, _with_rows(staying, added))
    return t.replace(acc_trx_detail=adjustments.deactivate_details(t)), eod.clear_day(t.replace(daily_loan_trx=staying)).daily_loan_trx


def _with_rows(df: DataFrame, added: DataFrame) -> DataFrame:
    """A day table with added rows, in its columns."""
    return df.unionByName(added.select(*[c for c in added.columns if c in df.columns]), allowMissingColumns=True)


def _move_excess(t: Tables, stage: Stage, step: str, staying: DataFrame) -> tuple[Tables, DataFrame]:
    """Overpaid amounts of one organization's loans move to compulsory savings; earlier moves are replaced.

    ``staying`` are loan rows with all columns; they come back with the same changes.
    """
    offices = t.run_control.filter(F.col("organization_id") == adjustments.EXCESS_TO_SAVINGS_ORGANIZATION)
    offices = offices.select("office_id", F.lit(1).alias("moves"))

    def without_moves(df: DataFrame, kind: str) -> DataFrame:
        moved = (F.col("moves") == 1) & (F.col(kind) == adjustments.EXCESS_TO_SAVINGS)
        return df.join(offices, "office_id", "left").filter(~F.coalesce(moved, F.lit(False))).drop("moves")

    t = t.replace(
        daily_saving_trx=without_moves(t.daily_saving_trx, "trans_type"),
        daily_loan_trx=without_moves(t.daily_loan_trx, "trx_type"),
    )
    overpaid = stage.save(f"{step}/overpaid", adjustments.overpaid_loans(t))
    opened = stage.save(f"{step}/opened", adjustments.open_savings_for_overpaid(t, overpaid))
    savings = t.saving_summary.unionByName(opened)
    deposits = stage.save(f"{step}/deposits", adjustments.deposit_overpaid(t, overpaid, savings))
    contra = stage.save(f"{step}/contra", adjustments.contra_overpaid(t, overpaid))
    t = t.replace(
        saving_summary=savings,
        daily_saving_trx=_with_rows(t.daily_saving_trx, deposits),
        daily_loan_trx=_with_rows(t.daily_loan_trx, contra),
    )
    return t, _with_rows(without_moves(staying, "trx_type"), contra)


def auto_voucher(t: Tables, enforce: bool = True) -> Outcome:
    """Adjustment, voiding of earlier automatic vouchers and the day's postings as vouchers.

    The vouchers are in the ledger of the returned set, and apart as ``voucher_masters`` and ``voucher_details``.
    """
    stage = _stage(t, "vouchers")
    t = _run_of(t, stage)
    report = stage.save("report", validations.auto_voucher_report(t))
    if enforce:
        t = validations.passing_offices(t, report)
    t, _ = adjust(t, stage, "adjust")
    t = vouchers.void_previous(t)
    amounts = stage.save("amounts", vouchers.day_amounts(t))
    postings = stage.save("postings", vouchers.voucher_postings(t, amounts))
    t = t.replace(acc_trx_master=stage.save("voided", t.acc_trx_master))
    masters = stage.save("masters", vouchers.voucher_masters(t, postings))
    details = stage.save("details", vouchers.voucher_details(t, postings))
    t = vouchers.flush_to_ledger(t, masters, details)
    t = t.replace(voucher_masters=masters, voucher_details=details, auto_voucher_check=eod.raise_voucher_flag(t))
    return Outcome(t, report)


def day_end(t: Tables, enforce: bool = True) -> Outcome:
    """Posting, balance rolls and closings of the day.

    Cash vouchers are in the ledger of the returned set. New history rows and archives are also apart, as
    ``new_loan_trx``, ``new_saving_trx``, ``cash_vouchers`` and ``archived_collections``.
    """
    stage = _stage(t, "day-end")
    t = _run_of(t, stage)
    report = stage.save("report", validations.day_end_report(t))
    if enforce:
        t = validations.passing_offices(t, report)
    t, staying = adjust(t, stage, "adjust", _read_of_day(t))
    history = t.loan_trx
    posted = eod.post_loan_trx(t)
    t = t.replace(loan_summary=eod.roll_loan_summary(t))
    t = t.replace(loan_summary=eod.apply_corrections(t))
    t = _saved(t, stage, "rolled", "loan_summary")
    disbursed = eod.disbursement_trx(t)
    t = t.replace(loan_summary=eod.roll_disbursement(t))
    # new rows lose their dues before they get keys, so that they are written with both
    collected = stage.save("collected", eod.collected_this_month(t))
    earlier, today = _not_of_run_date(t, history), stage.save("today", eod.zero_repeat_due(t, collected=collected))
    posted, disbursed = (eod.zero_repeat_due(t, rows, collected) for rows in (posted, disbursed))
    t, posted = _keyed(t, stage, "posted", "loan_trx", posted.unionByName(disbursed))
    t, new_savings = _keyed(t, stage, "posted-savings", "saving_trx", eod.post_saving_trx(t))
    t = t.replace(saving_summary=eod.roll_saving_summary(t), loan_summary=eod.close_loans(t))
    t = _saved(t, stage, "closed", "saving_summary")
    today = today.unionByName(posted)
    t = t.replace(loan_trx=earlier.unionByName(today))
    t, final = _keyed(t, stage, "final", "loan_trx", eod.final_due(t))
    day_rows = eod.purge_zero_due(today.unionByName(final), t)
    cash = stage.save("cash", accounts.cash_close(t))
    t = accounts.flush_cash(t, cash)
    t = t.replace(
        loan_trx=earlier.unionByName(day_rows),
        new_loan_trx=day_rows,
        new_saving_trx=new_savings,
        saving_trx=t.saving_trx.unionByName(new_savings),
        centers=stage.save("centers", eod.next_collection_date(t)),
        cash_vouchers=cash,
        acc_trx_master=accounts.post_masters(t),
        acc_last_voucher=accounts.roll_last_voucher(t),
        process_info=eod.close_process(t),
    )
    t = t.replace(saving_summary=eod.stamp_saving_date(t))
    t = _saved(t, stage, "stamped", "saving_summary", "process_info")
    candidates = stage.save("candidates", accounts.close_candidates(t))
    closable = stage.save("closable", accounts.closable_accounts(t, candidates))
    closed = stage.save("closed-accounts", accounts.close_accounts(t, closable))
    released = accounts.release_members(t, closable, closed)
    t = t.replace(saving_summary=closed, members=released)
    t = _saved(eod.clear_day(t).replace(daily_loan_trx=staying), stage, "released", "members")
    # nothing that is returned reads these
    stage.drop("adjust/deduped", "closed", "stamped/saving_summary")
    for step in (eod.close_dropped_member_savings, eod.close_empty_savings, eod.close_no_loan_savings):
        t = t.replace(saving_summary=step(t))
    t = _saved(t, stage, "settled", "saving_summary")
    t = t.replace(
        members=eod.drop_members(t),
        auto_voucher_check=eod.raise_voucher_flag(t),
        archived_collections=eod.archive_collections(t),
        collection_loan_savings=eod.remaining_collections(t),
        loan_summary=eod.resync_month_to_date(t),
    )
    return Outcome(t, report)


def _read_of_day(t: Tables) -> list[str]:
    """The columns of the day's loan rows that a day end reads; the others leave with the day."""
    read = {*t.loan_trx.columns, *adjustments.SUM_KEYS, *adjustments.LATEST} - {"principal_loan"}
    return [c for c in t.daily_loan_trx.columns if c in read]


def _not_of_run_date(t: Tables, df: DataFrame) -> DataFrame:
    """Loan history without the run offices' rows of the run date."""
    run = t.run_control.select("office_id", F.col("business_date").alias("installment_date"))
    return df.join(run, ["office_id", "installment_date"], "left_anti")


def month_close(t: Tables, enforce: bool = True) -> Outcome:
    """Savings interest and loan accrual of the month.

    The interest is ``month_wise_saving_interest`` and the accrual rows ``new_loan_trx`` in the returned set; the closed
    month is carried into the running totals of the loans.
    """
    stage = _stage(t, "month-close")
    t = _run_of(t, stage)
    report = stage.save("report", validations.month_end_report(t))
    if enforce:
        t = validations.passing_offices(t, report)
    t = eod.clear_day(t)
    balances = mon.apply_new_in_7(t, mon.min_age_balance(t, stage.save("balances", mon.month_balances(t))))
    interest = mon.final_interest(t, mon.savings_interest(t, balances))
    t, accrued = _keyed(t, stage, "accrued", "loan_trx", mon.accrual_trx(t))
    t = t.replace(month_wise_saving_interest=interest, process_info=mon.close_process(t), loan_summary=mon.loan_accrual(t))
    t = _saved(t, stage, "loans", "loan_summary")
    earlier = _not_of_month_end(t, t.loan_trx)
    month_end = t.loan_trx.unionByName(accrued)
    t = t.replace(loan_trx=month_end)
    t = t.replace(loan_trx=mon.zero_past_duration(t), loan_summary=mon.advance_date(t))
    t = _saved(t, stage, "dated", "loan_summary", "loan_trx")
    day_rows = mon.zero_expired(t)
    t = t.replace(loan_trx=earlier.unionByName(stage.save("day-rows", day_rows)), new_loan_trx=day_rows)
    t = _saved(totals.carry_month(t), stage, "carried", "loan_totals", "totals_until")
    return Outcome(t, report)


def _not_of_month_end(t: Tables, df: DataFrame) -> DataFrame:
    run = t.run_control.select("office_id", F.col("month_end_date").alias("installment_date"))
    return drop_keys(df, run, ["office_id", "installment_date"])
