"""Row changes, invariants of the adjustments and vouchers, and account closing by hand."""

from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerloom.operators import accounts, adjustments, changes, start_of_day, vouchers
from ledgerloom.sources.tables import Tables

TODAY = date(2001, 7, 16)


def test_set_where_sees_old_values(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert tuple(changes.set_where(df, F.lit(True), a=F.col("b"), b=F.col("a")).first()) == (2, 1)


def test_drop_where_keeps_unknown(spark):
    df = spark.createDataFrame([(1,), (None,), (2,)], "a int")
    assert {r.a for r in changes.drop_where(df, F.col("a") == 1).collect()} == {None, 2}


def test_shifts_conserve_money_and_settle(tables):
    t = adjustments.without_adjustments(tables)
    t = t.replace(daily_loan_trx=t.daily_loan_trx.filter("trx_type <> 32"))
    added = adjustments.shifts(t, adjustments.day_sums(t))
    for rows in added:
        assert rows.filter(F.col("loan_paid") + F.col("int_paid") != 0).count() == 0
    loans = t.daily_loan_trx
    for rows in added:
        loans = loans.unionByName(rows, allowMissingColumns=True)
    again = adjustments.without_adjustments(t.replace(daily_loan_trx=loans))
    repeated = adjustments.shifts(again, adjustments.day_sums(again))
    for first, second in zip(added, repeated):
        columns = ["loan_summary_id", "loan_paid", "int_paid", "trx_date"]
        assert first.select(*columns).exceptAll(second.select(*columns)).count() == 0
        assert first.count() == second.count()


def test_contra_vouchers_balance(tables):
    lines = vouchers.voucher_postings(tables, vouchers.day_amounts(tables))
    totals = {
        r.rule: (r.c, r.d)
        for r in lines.groupBy("rule").agg(F.sum("credit").alias("c"), F.sum("debit").alias("d")).collect()
    }
    chart = {r.acc_code for r in tables.acc_chart.filter("is_active = 1").collect()}
    assert {"BK0", "BK1"} <= chart
    assert totals["P17"][1] == totals["P18"][0]
    # one withdrawal account is inactive, so its debit lines are missing while the bank side is whole
    assert totals["P15"][1] <= totals["P16"][0]
    assert totals["P13"][0] == totals["P14"][1]


def test_single_rules_equal_the_whole(tables):
    whole = vouchers.voucher_postings(tables, vouchers.day_amounts(tables))
    for rule in ("P01", "P06", "P09", "P18", "P23", "P27", "P31", "P32"):
        only = frozenset({rule})
        alone = vouchers.voucher_postings(tables, vouchers.day_amounts(tables, only), only)
        expected = whole.filter(F.col("rule") == rule)
        assert alone.exceptAll(expected).count() == 0
        assert alone.count() == expected.count()


def test_rebates_stop_for_two_organizations(tables):
    organization = F.lit(5).cast("bigint")
    names = ("run_control", "daily_loan_trx", "daily_saving_trx", "loan_summary")
    t = tables.replace(**{n: getattr(tables, n).withColumn("organization_id", organization) for n in names})
    lines = vouchers.voucher_postings(t, vouchers.day_amounts(t))
    assert lines.filter("batch = 6").count() == 0
    assert lines.filter("rule = 'P07'").count() > 0


def _closing_tables(spark):
    """Member 1: emptied voluntary account 11 and compulsory 12. Member 2: compulsory 21 with another account open.

    Member 3: emptied compulsory 31 but a loan left. Member 4: voluntary 41 paid back more than it held.
    """
    money = Decimal

    def saving(key, member, product, deposit, withdrawal, status=1):
        return (key, 4, 1, member, product, 100, 1, TODAY, money(deposit), money(withdrawal), money(0), money(0), status, 1, None)

    savings = spark.createDataFrame(
        [
            saving(11, 1, 5, 50, 50),
            saving(12, 1, 1, 30, 30),
            saving(21, 2, 1, 40, 40),
            saving(22, 2, 5, 10, 0),
            saving(31, 3, 1, 20, 20),
            saving(41, 4, 6, 15, 15),
        ],
        "saving_summary_id bigint, organization_id bigint, office_id bigint, member_id bigint, product_id bigint, "
        "center_id bigint, no_of_account int, transaction_date date, deposit decimal(18,2), withdrawal decimal(18,2), "
        "cum_interest decimal(18,2), penalty decimal(18,2), saving_status int, is_active int, closing_date date",
    )
    day = spark.createDataFrame(
        [(k, 4, 1, 100, m, p, 1, TODAY, money(0), money(5)) for k, m, p in
         [(11, 1, 5), (12, 1, 1), (21, 2, 1), (31, 3, 1), (41, 4, 6)]],
        "saving_summary_id bigint, organization_id bigint, office_id bigint, center_id bigint, member_id bigint, "
        "product_id bigint, no_of_account int, transaction_date date, saving_installment decimal(18,2), "
        "withdrawal decimal(18,2)",
    )
    loan_layout = (
        "loan_summary_id bigint, organization_id bigint, office_id bigint, center_id bigint, member_id bigint, "
        "product_id bigint, loan_term int, is_active int, principal_loan decimal(18,2), int_charge decimal(18,2), "
        "loan_repaid decimal(18,2), int_paid decimal(18,2)"
    )
    loans = spark.createDataFrame(
        [(1, 4, 1, 100, 3, 9, 1, 1, money(100), money(10), money(50), money(0))], loan_layout
    )
    loan_day = spark.createDataFrame(
        [(1, 4, 1, 100, 3, 9, 1, money(20), money(0))],
        "loan_summary_id bigint, organization_id bigint, office_id bigint, center_id bigint, member_id bigint, "
        "product_id bigint, loan_term int, loan_paid decimal(18,2), int_paid decimal(18,2)",
    )
    products = spark.createDataFrame([(1, "2101"), (5, "2201"), (6, "2201")], "product_id bigint, main_product_code string")
    members = spark.createDataFrame(
        [(m, 4, 1, 100, 1, None) for m in (1, 2, 3, 4)],
        "member_id bigint, organization_id bigint, office_id bigint, center_id bigint, member_status int, release_date date",
    )
    process = spark.createDataFrame([(1, TODAY)], "office_id bigint, business_date date")
    run = spark.createDataFrame(
        [(1, 4, TODAY, TODAY)], "office_id bigint, organization_id bigint, business_date date, month_end_date date"
    )
    return Tables.of(
        saving_summary=savings, daily_saving_trx=day, loan_summary=loans, daily_loan_trx=loan_day, products=products,
        members=members, process_info=process, run_control=run,
    )


def test_account_closing_by_hand(spark):
    t = _closing_tables(spark)
    candidates = accounts.close_candidates(t)
    assert {r.member_id for r in candidates.collect()} == {1, 2, 3, 4}
    closable = accounts.closable_accounts(t, candidates)
    closed = accounts.close_accounts(t, closable)
    status = {r.saving_summary_id: r.saving_status for r in closed.collect()}
    # closing 11 frees 12; 22 holds 21 open; the loan's member loses 31, which is negative
    assert status == {11: 0, 12: 0, 21: 1, 22: 1, 31: 0, 41: 0}
    released = accounts.release_members(t, closable, closed)
    assert {r.member_id for r in released.filter("member_status = 2").collect()} == {1}


def test_savings_parts_make_the_sheet(tables):
    parts = start_of_day.weekly_savings(tables).unionByName(start_of_day.compulsory_savings(tables))
    sheet = start_of_day.savings_sheet(tables)
    assert sheet.exceptAll(parts).count() == 0
    assert sheet.count() == parts.count()


def test_loan_parts_make_the_sheet(tables):
    parts = start_of_day.weekly_loans(tables).unionByName(start_of_day.monthly_loans(tables))
    sheet = start_of_day.loan_sheet(tables)
    assert sheet.exceptAll(parts).count() == 0
    assert sheet.count() == parts.count()


def test_accounts_opened_on_overpayment_have_keys_of_their_day(tables):
    overpaid = adjustments.overpaid_loans(tables)
    first = adjustments.open_savings_for_overpaid(tables, overpaid)
    later = adjustments.open_savings_for_overpaid(
        tables, overpaid.withColumn("run_date", F.date_add("run_date", 30))
    )
    ids = [r.saving_summary_id for r in first.unionByName(later).select("saving_summary_id").collect()]
    assert ids and len(ids) == len(set(ids)) and max(ids) < 0
