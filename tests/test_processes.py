"""Whole processes: order effects, key uniqueness, offices that fail a rule stay out."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import adjustments, start_of_day, validations
from ledgerloom.plans import processes


@pytest.fixture(scope="module")
def closed_day(tables):
    return processes.day_end(tables, enforce=False).tables


def _unique(df, key):
    return df.count() == df.select(key).distinct().count()


def test_start_of_day(tables):
    after = processes.start_of_day(tables, enforce=False).tables
    assert _unique(after.daily_loan_trx, "daily_loan_trx_id")
    assert after.daily_loan_trx.filter("trx_type <> 10").count() == 0
    assert after.loan_summary.count() == tables.loan_summary.count()
    run = tables.run_control.select("office_id", "business_date")
    opened = after.process_info.join(run, ["office_id", "business_date"], "left_semi").select("office_id").distinct().count()
    assert opened == tables.run_control.count()


def test_failing_offices_stay_out(tables):
    outcome = processes.start_of_day(tables)
    failing = {r.office_id for r in outcome.report.filter("ok = 0").collect()}
    running = {r.office_id for r in outcome.tables.run_control.collect()}
    assert failing and running and not failing & running
    sheet = outcome.tables.daily_loan_trx
    kept = tables.daily_loan_trx.filter(F.col("office_id").isin(*failing)).count()
    assert sheet.filter(F.col("office_id").isin(*failing)).count() == kept


def test_day_end(tables, closed_day):
    assert closed_day.daily_loan_trx.count() == closed_day.daily_saving_trx.count() == 0
    assert _unique(closed_day.loan_summary, "loan_summary_id")
    assert closed_day.loan_summary.count() == tables.loan_summary.count()
    assert _unique(closed_day.saving_summary, "saving_summary_id")
    assert closed_day.collection_loan_savings.count() == 0
    assert closed_day.archived_collections.count() == tables.collection_loan_savings.count()
    open_loans = closed_day.loan_summary.filter("loan_status = 1 AND principal_loan = loan_repaid")
    owing = F.col("int_charge") - F.col("int_paid")
    assert open_loans.filter(owing < 0.5).count() == 0


def test_day_end_then_month_close(closed_day):
    after = processes.month_close(closed_day, enforce=False).tables
    interest = after.month_wise_saving_interest
    assert _unique(interest, "saving_summary_id")
    open_accounts = closed_day.saving_summary.filter("saving_status = 1").count()
    assert interest.count() == open_accounts
    assert after.loan_summary.count() == closed_day.loan_summary.count()


@pytest.fixture(scope="module")
def vouchered(tables):
    return processes.auto_voucher(tables, enforce=False).tables


def _active_auto(t):
    run = t.run_control.select("office_id", F.col("business_date").alias("trx_date"))
    return t.acc_trx_master.filter("is_active = 1 AND is_auto_voucher = 1 AND is_posted = 0").join(
        run, ["office_id", "trx_date"], "left_semi"
    )


def test_vouchers_are_in_the_ledger(tables, vouchered):
    assert _unique(vouchered.acc_trx_master, "trx_master_id")
    assert _unique(vouchered.acc_trx_detail, "trx_details_id")
    new = _active_auto(vouchered)
    assert sorted(r.voucher_no or "" for r in new.collect()) == sorted(
        r.voucher_no or "" for r in vouchered.voucher_masters.collect()
    )
    assert vouchered.acc_trx_detail.join(new, "trx_master_id", "left_semi").count() == vouchered.voucher_details.count()
    with_vouchers = [r.office_id for r in vouchered.voucher_masters.filter("voucher_no LIKE '%-%'").collect()]
    last = vouchered.acc_last_voucher.filter(F.col("office_id").isin(*with_vouchers)).collect()
    assert all(r.voucher_no.endswith("-2001") for r in last)


def test_day_end_sees_the_vouchers(tables, vouchered):
    def passing(t):
        report = validations.day_end_report(t).filter("rule = 'W12' AND ok = 1").collect()
        return {r.office_id for r in report}

    with_vouchers = {r.office_id for r in vouchered.voucher_masters.collect()}
    assert with_vouchers <= passing(vouchered)
    after = processes.day_end(vouchered, enforce=False).tables
    cash = after.cash_vouchers
    booked = after.acc_trx_master.filter("voucher_type IN ('Dr', 'Cr')")
    assert booked.count() == cash.count() > 0
    run = after.run_control.select("office_id", F.col("business_date").alias("trx_date"))
    assert after.acc_trx_master.join(run, ["office_id", "trx_date"], "left_semi").filter("is_posted = 0").count() == 0


def test_second_voucher_run_voids_the_first(vouchered):
    again = processes.auto_voucher(vouchered, enforce=False).tables
    assert _unique(again.acc_trx_master, "trx_master_id")
    assert _active_auto(again).count() == again.voucher_masters.count()


def test_auto_voucher(vouchered):
    after = vouchered
    masters, details = after.voucher_masters, after.voucher_details
    assert _unique(masters, "voucher_key")
    assert details.join(masters, "voucher_key", "left_anti").count() == 0
    assert masters.join(details, "voucher_key", "left_anti").count() == 0


def test_passing_offices(tables):
    report = validations.month_end_report(tables)
    left = validations.passing_offices(tables, report).run_control
    failing = report.filter("ok = 0").select("office_id").distinct().count()
    assert left.count() == tables.run_control.count() - failing


def test_offices_differ_in_date_and_organization(tables):
    run = tables.run_control.collect()
    assert len({r.business_date for r in run}) >= 3 and len({r.month_end_date for r in run}) >= 2
    assert {4, 5, 12, 54} < {r.organization_id for r in run}


def test_each_organization_branch_selects_rows(tables):
    run = tables.run_control.select("office_id", F.col("organization_id").alias("org"))

    def organizations(df):
        return {r.org for r in df.join(run, "office_id").select("org").distinct().collect()}

    assert organizations(adjustments.overpaid_loans(tables)) == {adjustments.EXCESS_TO_SAVINGS_ORGANIZATION}
    before = tables.daily_loan_trx.select("daily_loan_trx_id", F.col("int_charge").alias("was"))
    stopped = start_of_day.stop_charge(tables).join(before, "daily_loan_trx_id").filter("int_charge <> was")
    assert organizations(stopped) == {start_of_day.STOP_CHARGE_ORGANIZATION}
    t = adjustments.without_adjustments(tables)
    excess = adjustments.shifts(t, adjustments.day_sums(t), 4)[-1]
    found = organizations(excess)
    assert found and adjustments.NO_EXCESS_RULE_ORGANIZATION not in found
