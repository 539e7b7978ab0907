"""Every query by name: its result columns and the operator behind it.

Result columns are written ``name:kind`` with kind m (money), d (date), s (text) or nothing (whole number). Queries emit
money as double and dates as ISO text, so results compare equal across engines.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import dates, formulas, text
from ledgerloom.operators import (
    accounts,
    adjustments,
    day_end,
    keys,
    month_close,
    reports,
    start_of_day,
    totals,
    validations,
    vouchers,
)
from ledgerloom.operators.changes import products_of, with_run
from ledgerloom.plans import processes
from ledgerloom.sources.fixtures import derived_tables
from ledgerloom.sources import store
from ledgerloom.sources.staging import Stage
from ledgerloom.sources.tables import Tables


@dataclass(frozen=True)
class Query:
    columns: str
    build: Callable[[Tables], DataFrame]

    @property
    def shape(self) -> list[tuple[str, str]]:
        return [(item.partition(":")[0], item.partition(":")[2]) for item in self.columns.split()]

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        df = self.build(derived_tables(spark, sf_dir))
        return df.select(*[_emitted(name, kind) for name, kind in self.shape])


def _emitted(name: str, kind: str) -> Column:
    column = F.col(name)
    if kind == "m":
        column = column.cast("decimal(18,2)").cast("double")
    elif kind == "d":
        column = F.date_format(column, "yyyy-MM-dd")
    elif kind == "s":
        column = column.cast("string")
    else:
        column = column.cast("bigint")
    return column.alias(name)


# ---------------------------------------------------------------- shared column lists

_LEDGER_LINE = (
    "office_id trx_date:d voucher_no:s voucher_type:s is_posted is_auto_voucher acc_id debit:m credit:m narration:s"
)

_SAVING_SHEET = (
    "saving_summary_id office_id center_id member_id product_id no_of_account transaction_date:d "
    "due_saving_installment:m saving_installment:m deposit:m withdrawal:m balance:m trans_type transfer_deposit:m "
    "transfer_withdrawal:m member_code:s member_name:s member_category_id product_code:s product_name:s cur_interest:m"
)
_LOAN_SHEET = (
    "loan_summary_id office_id center_id member_id product_id loan_term installment_date:d principal_loan:m "
    "loan_repaid:m loan_due:m loan_paid:m cum_int_charge:m int_charge:m int_due:m int_paid:m advance:m due_recovery:m "
    "trx_type installment_no member_code:s member_name:s product_code:s duration duration_over_loan_due:m "
    "duration_over_int_due:m"
)
_LOAN_AMOUNTS = "daily_loan_trx_id loan_due:m loan_paid:m int_due:m int_paid:m"
_ADJUSTMENT = (
    "loan_summary_id office_id center_id product_id member_id loan_term loan_paid:m int_paid:m trx_date:d "
    "installment_date:d installment_no trx_type product_code:s member_code:s member_name:s"
)
_LOAN_TRX = (
    "loan_summary_id office_id member_id product_id trx_date:d installment_date:d principal_loan:m loan_paid:m "
    "loan_due:m int_due:m int_charge:m int_paid:m trx_type installment_no"
)
_DUES = "loan_summary_id installment_date:d loan_paid:m int_paid:m int_charge:m loan_due:m int_due:m"
_ACCOUNT = "saving_summary_id office_id center_id member_id product_id no_of_account"
_SAVING_STATE = "saving_summary_id saving_status closing_date:d transaction_date:d"
_LINE = "office_id rule:s batch voucher_category:s acc_id credit:m debit:m narration:s"
_RULE_REPORT = "office_id rule:s ok detail:s"


# ---------------------------------------------------------------- scalar functions and formulas


def _date_functions(t: Tables) -> DataFrame:
    day, run = F.col("installment_date"), F.col("run_date")
    return with_run(t.loan_summary, t).select(
        "loan_summary_id",
        dates.day_diff(day, run).alias("day_diff"),
        dates.month_diff(day, run).alias("month_diff"),
        dates.first_date(day).alias("first_date"),
        dates.last_date(day).alias("last_date"),
        dates.day_of(day).alias("day"),
        dates.month_of(day).alias("month"),
        dates.year_of(day).alias("year"),
        dates.week_day(day).alias("week_day"),
    )


def _voucher_no_functions(t: Tables) -> DataFrame:
    rows = with_run(t.acc_trx_master, t)
    year = F.year("run_date") + 1
    return rows.select(
        "trx_master_id",
        text.voucher_for_year(F.col("voucher_no"), year).alias("by_dash"),
        text.voucher_with_last_year(F.col("voucher_no"), year).alias("by_length"),
    )


def _formula(name: str) -> Query:
    def build(t: Tables) -> DataFrame:
        products = products_of(t, "interest_calculation_method", "payment_frequency")
        loans = with_run(t.loan_summary, t).join(products, "product_id")
        value = formulas.FORMULAS[name](formulas.LoanTerms())
        rows = formulas.with_terms(loans, F.col("run_date"))
        return rows.select("loan_summary_id", value.alias("amount"))

    return Query("loan_summary_id amount:m", build)


# ---------------------------------------------------------------- operators that need prepared inputs


def _both_sheets(prepare: Callable[[Tables], Tables]) -> Callable[[Tables], DataFrame]:
    """Remaining rows of both day tables after an exclusion, labelled by table."""

    def build(t: Tables) -> DataFrame:
        kept = prepare(t)
        loans = kept.daily_loan_trx.select(F.lit("loan").alias("kind"), F.col("daily_loan_trx_id").alias("row_id"))
        savings = kept.daily_saving_trx.select(
            F.lit("saving").alias("kind"), F.col("daily_saving_trx_id").alias("row_id")
        )
        return loans.unionByName(savings)

    return build


def _staged(t: Tables, name: str, df: DataFrame) -> DataFrame:
    """A small result that several later branches read, written once."""
    return Stage(t.run_control.sparkSession, "query").save(name, df)


def _shift(position: int) -> Callable[[Tables], DataFrame]:
    def build(t: Tables) -> DataFrame:
        t = adjustments.without_adjustments(t)
        return adjustments.shifts(t, adjustments.day_sums(t), position)[-1]

    return build


def _excess_open(t: Tables) -> DataFrame:
    return adjustments.open_savings_for_overpaid(t, adjustments.overpaid_loans(t))


def _excess_deposit(t: Tables) -> DataFrame:
    overpaid = _staged(t, "overpaid", adjustments.overpaid_loans(t))
    opened = adjustments.open_savings_for_overpaid(t, overpaid)
    return adjustments.deposit_overpaid(t, overpaid, t.saving_summary.unionByName(opened))


def _excess_contra(t: Tables) -> DataFrame:
    return adjustments.contra_overpaid(t, adjustments.overpaid_loans(t))


def _history_keys(t: Tables) -> DataFrame:
    """What the keys of the day's new history rows come to, by table."""
    new = {
        "loan_trx": day_end.post_loan_trx(t).unionByName(day_end.disbursement_trx(t)),
        "saving_trx": day_end.post_saving_trx(t),
    }
    counted = []
    for name, rows in new.items():
        key = F.col(keys.KEY_OF[name])
        counted.append(
            keys.with_keys(t, name, _staged(t, name, rows)).select(key.alias("key")).agg(
                F.lit(name).alias("table_name"),
                F.count(F.lit(1)).alias("new_rows"),
                F.min("key").alias("first_key"),
                F.max("key").alias("last_key"),
                F.count_distinct("key").alias("different_keys"),
                F.count_if(F.col("key").isNull()).alias("missing_keys"),
            )
        )
    return counted[0].unionByName(counted[1])


def _final_due(t: Tables) -> DataFrame:
    run = t.run_control.select("office_id", F.col("business_date").alias("run_date"))
    present = t.loan_trx.filter("trx_type IN (52, 53)").join(run, "office_id")
    present = present.filter(F.col("trx_date") == F.col("run_date")).select(*t.loan_trx.columns)
    return day_end.purge_zero_due(present.unionByName(day_end.final_due(t)), t)


def _voided(t: Tables) -> DataFrame:
    after = vouchers.void_previous(t)
    masters = after.acc_trx_master.select(
        F.lit("master").alias("kind"), F.col("trx_master_id").alias("row_id"), "is_active"
    )
    details = after.acc_trx_detail.select(
        F.lit("detail").alias("kind"), F.col("trx_details_id").alias("row_id"), "is_active"
    )
    return masters.unionByName(details)


def _postings(t: Tables, only: frozenset[str] = vouchers.ALL_RULES) -> DataFrame:
    return vouchers.voucher_postings(t, _staged(t, "amounts", vouchers.day_amounts(t, only)), only)


def _one_rule(rule: str) -> Query:
    return Query(_LINE, lambda t: _postings(t, frozenset({rule})))


def _gates(t: Tables) -> DataFrame:
    return vouchers.voucher_gates(t, _staged(t, "amounts", vouchers.day_amounts(t)))


def _flushed(t: Tables) -> Tables:
    """The ledger after the day's earlier vouchers are void and its postings are vouchers."""
    postings = _postings(t)
    t = vouchers.void_previous(t)
    return vouchers.flush_to_ledger(t, vouchers.voucher_masters(t, postings), vouchers.voucher_details(t, postings))


def _control_of_new_ledger(t: Tables) -> DataFrame:
    """The control rows of a ledger that has offices without vouchers yet, after the day's vouchers."""
    young = F.col("office_id") % 3 == 0
    return _flushed(t.replace(voucher_control=t.voucher_control.filter(~young))).voucher_control


def _ledger_of_day(t: Tables) -> DataFrame:
    """Active lines of the run date with their voucher."""
    run = t.run_control.select("office_id", F.col("business_date").alias("trx_date"))
    masters = t.acc_trx_master.filter("is_active = 1").drop("is_active").join(run, ["office_id", "trx_date"], "left_semi")
    return masters.join(t.acc_trx_detail.filter("is_active = 1").drop("is_active"), ["trx_master_id", "trx_date"])


def _closable(t: Tables) -> DataFrame:
    candidates = _staged(t, "candidates", accounts.close_candidates(t))
    return _staged(t, "closable", accounts.closable_accounts(t, candidates))


def _released(t: Tables) -> DataFrame:
    closable = _closable(t)
    return accounts.release_members(t, closable, accounts.close_accounts(t, closable))


def _interest(t: Tables) -> DataFrame:
    return month_close.savings_interest(t, month_close.final_balances(t))


# ---------------------------------------------------------------- stored runs

_DAY_TABLES = (
    "offices run_control centers member_categories products product_mappings members loan_summary daily_loan_trx loan_trx "
    "saving_summary daily_saving_trx saving_trx acc_chart accounting_interface acc_trx_master acc_trx_detail holidays "
    "process_info expire_infos family_grace transfer_history miscellaneous application_settings auto_voucher_check "
    "acc_last_voucher voucher_control key_control collection_loan_savings totals_until loan_totals"
).split()


def _stored_day_end(t: Tables) -> Tables:
    """The day closed on a stored ledger, committed, and read back."""
    spark = t.run_control.sparkSession
    opened = store.create(spark, Stage(spark, "ledger").path, t, _DAY_TABLES)
    return store.store(opened, processes.day_end(opened.tables, enforce=False).tables, "day_end").tables


def _stored_interest(t: Tables) -> DataFrame:
    """The month's interest stored twice over rows of the month before and stale rows of the month."""
    spark = t.run_control.sparkSession
    final = _staged(t, "interest", month_close.final_interest(t, _interest(t)))
    earlier = final.withColumns({"interest": F.lit(0).cast("decimal(18,2)"), "transaction_date": F.add_months("transaction_date", -1)})
    stale = final.withColumn("interest", F.lit(999).cast("decimal(18,2)"))
    t = t.replace(month_wise_saving_interest=earlier.unionByName(stale))
    opened = store.create(spark, Stage(spark, "interest").path, t, ["run_control", "month_wise_saving_interest"])
    for _ in range(2):
        opened = store.store(opened, opened.tables.replace(month_wise_saving_interest=final), "month_close")
    return opened.tables.month_wise_saving_interest


_BALANCE = f"{_ACCOUNT} transaction_date:d balance:m"

QUERIES: dict[str, Query] = {
    "util_dates": Query(
        "loan_summary_id day_diff month_diff first_date:d last_date:d day month year week_day:s", _date_functions
    ),
    "util_voucher_no": Query("trx_master_id by_dash:s by_length:s", _voucher_no_functions),
    "mfi_loan_due": _formula("loan_due"),
    "mfi_loan_paid": _formula("loan_paid"),
    "mfi_int_due": _formula("int_due"),
    "mfi_int_paid": _formula("int_paid"),
    "mfi_dur_over_loan_due": _formula("duration_over_loan_due"),
    "mfi_dur_over_int_due": _formula("duration_over_int_due"),
    "mfi_loan_due_v1": _formula("loan_due_first_edition"),
    "mfi_int_charge": _formula("int_charge"),
    "mfi_cum_int_charge": _formula("cum_int_charge"),
    # start of day
    "sod_weekly_savings": Query(_SAVING_SHEET, start_of_day.weekly_savings),
    "sod_compulsory_savings": Query(_SAVING_SHEET, start_of_day.compulsory_savings),
    "sod_lts_savings": Query(_SAVING_SHEET, start_of_day.lts_savings),
    "sod_weekly_loans": Query(_LOAN_SHEET, start_of_day.weekly_loans),
    "sod_monthly_loans": Query(_LOAN_SHEET, start_of_day.monthly_loans),
    "sod_final_installment_paid": Query(_LOAN_AMOUNTS, start_of_day.final_installment_paid),
    "sod_reset_overdue": Query(_LOAN_AMOUNTS, start_of_day.reset_overdue),
    "sod_drop_holiday_rows": Query("kind:s row_id", _both_sheets(start_of_day.drop_holiday_rows)),
    "sod_drop_expired_loans": Query("daily_loan_trx_id", start_of_day.drop_expired_loans),
    "sod_drop_family_grace": Query("kind:s row_id", _both_sheets(start_of_day.drop_family_grace)),
    "sod_lift_loan_zero": Query(_LOAN_AMOUNTS, start_of_day.lift_loan_zero),
    "sod_jcf_charge": Query(
        "daily_loan_trx_id int_charge:m cum_int_charge:m",
        start_of_day.stop_charge,
    ),
    "sod_last_installment": Query(_LOAN_AMOUNTS, start_of_day.last_installment),
    "sod_reset_partial": Query(
        "loan_summary_id partial_amount:m partial_int_charge:m partial_int_paid:m", start_of_day.reset_partial
    ),
    "sod_clear_collections": Query("summary_id office_id collection_date:d", start_of_day.clear_collections),
    "sod_pending_disburse": Query(
        "loan_summary_id disburse_date:d installment_start_date:d int_charge:m is_approved",
        start_of_day.pending_disbursement,
    ),
    "sod_open_process": Query(
        "process_info_id office_id business_date:d initial_date:d closing_date:d closing_status initial_status "
        "month_closing_status",
        start_of_day.open_process,
    ),
    "sod_voucher_flag": Query("office_id check_auto_voucher", start_of_day.voucher_flag_reset),
    # adjustments
    "eod_dedupe_charges": Query("daily_loan_trx_id loan_due:m int_due:m int_charge:m", adjustments.dedupe_charges),
    "eod_excess_open_savings": Query(
        f"{_ACCOUNT} transaction_date:d deposit:m balance:m interest_rate:m opening_date:d trans_type saving_status "
        "employee_id member_category_id",
        _excess_open,
    ),
    "eod_excess_deposit": Query(
        f"{_ACCOUNT} transaction_date:d saving_installment:m trans_type presence_ind member_code:s member_name:s "
        "product_code:s",
        _excess_deposit,
    ),
    "eod_excess_contra": Query(
        "loan_summary_id office_id member_id product_id trx_date:d loan_paid:m int_paid:m trx_type installment_no "
        "member_code:s member_name:s product_code:s duration",
        _excess_contra,
    ),
    "eod_adj_principal_over": Query(_ADJUSTMENT, _shift(1)),
    "eod_adj_interest_over": Query(_ADJUSTMENT, _shift(2)),
    "eod_adj_over_loanpaid": Query(_ADJUSTMENT, _shift(3)),
    "eod_adj_excess_interest": Query(_ADJUSTMENT, _shift(4)),
    "eod_deactivate_details": Query("trx_details_id is_active", adjustments.deactivate_details),
    # day end
    "eod_post_loan_trx": Query(_LOAN_TRX, day_end.post_loan_trx),
    "eod_roll_loan_summary": Query(
        "loan_summary_id loan_repaid:m int_paid:m int_charge:m installment_no installment_date:d cum_loan_due:m "
        "cum_int_due:m cur_loan:m cur_int_paid:m cur_int_charge:m cur_loan_due:m cur_int_due:m",
        day_end.roll_loan_summary,
    ),
    "eod_loan_correction": Query(
        "loan_summary_id loan_repaid:m int_paid:m int_charge:m", day_end.apply_corrections
    ),
    "eod_history_keys": Query("table_name:s new_rows first_key last_key different_keys missing_keys", _history_keys),
    "eod_disbursement_trx": Query(_LOAN_TRX, day_end.disbursement_trx),
    "eod_disbursement_roll": Query(
        "loan_summary_id posted principal_loan:m int_charge:m int_paid:m final_disbursement disburse_date:d",
        day_end.roll_disbursement,
    ),
    "eod_post_saving_trx": Query(
        f"{_ACCOUNT} deposit:m withdrawal:m balance:m transaction_date:d trans_type monthly_interest:m penalty:m",
        day_end.post_saving_trx,
    ),
    "eod_roll_saving_summary": Query(
        "saving_summary_id deposit:m withdrawal:m penalty:m cum_interest:m cur_deposit:m cur_withdrawal:m "
        "cur_interest:m cur_penalty:m",
        day_end.roll_saving_summary,
    ),
    "eod_close_loans": Query("loan_summary_id loan_status loan_close_date:d", day_end.close_loans),
    "eod_zero_repeat_due": Query("loan_trx_id loan_due:m int_due:m", day_end.zero_repeat_due),
    "eod_final_due": Query(_LOAN_TRX, _final_due),
    "eod_archive_collections": Query(
        "summary_id office_id center_id member_id product_id loan_paid:m deposit:m withdrawal:m collection_date:d "
        "is_uploaded",
        day_end.archive_collections,
    ),
    "eod_next_collection_date": Query("center_id collection_date:d", day_end.next_collection_date),
    "eod_close_process": Query(
        "process_info_id closing_status initial_status closing_date:d", day_end.close_process
    ),
    "eod_stamp_saving_date": Query("saving_summary_id transaction_date:d", day_end.stamp_saving_date),
    "eod_close_dropped_member_savings": Query(
        "saving_summary_id saving_status closing_date:d", day_end.close_dropped_member_savings
    ),
    "eod_close_empty_savings": Query("saving_summary_id saving_status closing_date:d", day_end.close_empty_savings),
    "eod_close_no_loan_savings": Query(
        "saving_summary_id saving_status closing_date:d", day_end.close_no_loan_savings
    ),
    "eod_drop_members": Query("member_id member_status release_date:d", day_end.drop_members),
    "eod_resync_mtd": Query(
        "loan_summary_id cur_loan:m cur_int_paid:m cur_int_charge:m cur_loan_due:m cur_int_due:m",
        day_end.resync_month_to_date,
    ),
    # accounts
    "acc_day_ledger": Query(
        "trx_details_id trx_date:d voucher_no:s narration:s office_id acc_id debit:m credit:m voucher_type:s",
        accounts.day_ledger,
    ),
    "acc_cash_close": Query(
        "voucher_key:s office_id trx_date:d voucher_no:s voucher_type:s acc_id debit:m credit:m", accounts.cash_close
    ),
    "acc_cash_ledger": Query(_LEDGER_LINE, lambda t: _ledger_of_day(accounts.flush_cash(t, accounts.cash_close(t)))),
    "acc_post_masters": Query("trx_master_id is_posted", accounts.post_masters),
    "acc_roll_last_voucher": Query("office_id voucher_no:s", accounts.roll_last_voucher),
    "eod_remaining_collections": Query(
        "summary_id office_id loan_paid:m deposit:m withdrawal:m", day_end.remaining_collections
    ),
    "acc_close_candidates": Query(
        "organization_id office_id center_id member_id product_id no_of_account", accounts.close_candidates
    ),
    "acc_close_accounts": Query(_SAVING_STATE, lambda t: accounts.close_accounts(t, _closable(t))),
    "acc_release_members": Query("member_id member_status release_date:d", _released),
    # validations
    "val_start_of_day": Query(_RULE_REPORT, validations.start_of_day_report),
    "val_day_end": Query(_RULE_REPORT, validations.day_end_report),
    "val_month_end": Query(_RULE_REPORT, validations.month_end_report),
    "val_auto_voucher": Query(_RULE_REPORT, validations.auto_voucher_report),
    # vouchers
    "voucher_postings": Query(_LINE, _postings),
    **{f"vp_{n:02d}": _one_rule(f"P{n:02d}") for n in range(1, 33)},
    "voucher_void_previous": Query("kind:s row_id is_active", _voided),
    "voucher_masters": Query(
        "voucher_key:s organization_id office_id trx_date:d voucher_no:s voucher_type:s is_posted is_auto_voucher",
        lambda t: vouchers.voucher_masters(t, _postings(t)),
    ),
    "voucher_details": Query(
        "voucher_key:s rule:s acc_id credit:m debit:m narration:s",
        lambda t: vouchers.voucher_details(t, _postings(t)),
    ),
    "voucher_ledger": Query(_LEDGER_LINE, lambda t: _ledger_of_day(_flushed(t))),
    "voucher_last_number": Query("office_id voucher_no:s", lambda t: _flushed(t).acc_last_voucher),
    "voucher_control": Query("office_id organization_id first_date:d", _control_of_new_ledger),
    "voucher_numbers": Query("office_id voucher_no:s", vouchers.voucher_numbers),
    "voucher_flag_done": Query("office_id check_auto_voucher", day_end.raise_voucher_flag),
    "voucher_gates": Query(
        "office_id h01 h02 h03 h04 h05 h06 h07l h07s h08 h09 h10 h11c h11b h12 h13 h14 h15 h16 h17 h18 h19 h20 h21 "
        "h22 h23 h24 h25 h26",
        _gates,
    ),
    # month close
    "mon_saving_transactions": Query(_BALANCE, month_close.saving_transactions),
    "mon_savings_register": Query(
        f"{_ACCOUNT} transaction_date:d personal_savings:m withdrawal:m balance:m", month_close.savings_register
    ),
    "mon_increases": Query(
        f"{_ACCOUNT} transaction_date:d balance:m previous_balance:m", month_close.increases
    ),
    "mon_first_increase": Query(f"{_ACCOUNT} min_installment_date:d", month_close.first_increase),
    "mon_opening_rows": Query(_BALANCE, month_close.opening_rows),
    "mon_min_balance": Query(_BALANCE, month_close.min_balance),
    "mon_static_balance": Query(_BALANCE, lambda t: month_close.static_balance(t, month_close.min_balance(t))),
    "mon_new_after_7": Query(f"{_ACCOUNT} opening_date:d", month_close.new_after_7),
    "mon_min_age_balance": Query(
        _BALANCE, lambda t: month_close.min_age_balance(t, month_close.month_balances(t))
    ),
    "mon_new_in_7": Query(_BALANCE, month_close.new_in_7),
    "mon_apply_new_in_7": Query(_BALANCE, month_close.final_balances),
    "mon_savings_interest": Query(f"{_ACCOUNT} balance:m interest:m transaction_date:d", _interest),
    "mon_interest_final": Query(
        f"{_ACCOUNT} balance:m interest:m transaction_date:d", lambda t: month_close.final_interest(t, _interest(t))
    ),
    "mon_close_process": Query(
        "process_info_id month_closing_status month_closing_date:d", month_close.close_process
    ),
    "mon_loan_accrual": Query("loan_summary_id installment_no int_charge:m", month_close.loan_accrual),
    "mon_accrual_trx": Query(_LOAN_TRX, month_close.accrual_trx),
    "mon_zero_past_duration": Query("loan_trx_id loan_due:m int_due:m", month_close.zero_past_duration),
    "mon_advance_date": Query("loan_summary_id installment_date:d", month_close.advance_date),
    "mon_carry_totals": Query(
        "loan_summary_id office_id principal_loan:m loan_due:m int_charge:m int_due:m installment_no",
        lambda t: totals.carry_month(t).loan_totals,
    ),
    "mon_zero_expired": Query("loan_trx_id loan_due:m int_due:m", month_close.zero_expired),
    # savings report
    "dstr_report": Query(
        "product_id depositor monthly_interest non_depositor opening_balance penalty saving_deposit saving_installment "
        "saving_withdrawal transfer_deposit transfer_withdrawal withdrawer closing_balance",
        reports.savings_report,
    ),
    "dstr_products": Query("office_id product_id product:s", reports.savings_products),
    # whole processes
    "run_start_of_day": Query(
        _LOAN_SHEET.replace("duration_over_loan_due:m duration_over_int_due:m", "").strip(),
        lambda t: processes.start_of_day(t, enforce=False).tables.daily_loan_trx,
    ),
    "run_day_end": Query(
        "loan_summary_id loan_status loan_close_date:d posted principal_loan:m loan_repaid:m int_paid:m int_charge:m "
        "installment_no installment_date:d cum_loan_due:m cum_int_due:m cur_loan:m cur_int_paid:m cur_int_charge:m "
        "cur_loan_due:m cur_int_due:m",
        lambda t: processes.day_end(t, enforce=False).tables.loan_summary,
    ),
    "run_day_end_history": Query(_DUES, lambda t: processes.day_end(t, enforce=False).tables.loan_trx),
    # stored runs
    "store_day_end": Query(
        "loan_summary_id loan_status loan_close_date:d principal_loan:m loan_repaid:m int_paid:m int_charge:m cur_loan:m",
        lambda t: _stored_day_end(t).loan_summary,
    ),
    "store_day_end_history": Query(_DUES, lambda t: _stored_day_end(t).loan_trx),
    "store_day_end_archive": Query(
        "summary_id office_id center_id member_id product_id loan_paid:m deposit:m withdrawal:m collection_date:d "
        "is_uploaded",
        lambda t: _stored_day_end(t).collection_loan_savings_history,
    ),
    "mon_store_interest": Query(f"{_ACCOUNT} balance:m interest:m transaction_date:d", _stored_interest),
    "run_month_close": Query(
        f"{_ACCOUNT} balance:m interest:m transaction_date:d",
        lambda t: processes.month_close(t, enforce=False).tables.month_wise_saving_interest,
    ),
}
