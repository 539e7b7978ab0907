"""Stored runs: whole commits, repeated runs, runs that die, slices by date."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.catalog import _DAY_TABLES
from ledgerloom.operators import accounts
from ledgerloom.plans import processes
from ledgerloom.sources import store
from ledgerloom.sources.store import HISTORY


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    return str(tmp_path_factory.mktemp("ledger"))


@pytest.fixture(scope="module")
def first(spark, tables, folder):
    return store.create(spark, folder, tables, _DAY_TABLES)


@pytest.fixture(scope="module")
def closed(first):
    return store.store(first, processes.day_end(first.tables, enforce=False).tables, "day_end")


def _same(a, b):
    columns = sorted(a.columns)
    a, b = a.select(*columns), b.select(*columns)
    return a.count() == b.count() and a.exceptAll(b).count() == 0


def test_what_is_created_reads_back(first, tables):
    assert first.version == 0 and first.manifest.parent is None
    for name in ("loan_summary", "loan_trx", "acc_trx_detail", "collection_loan_savings", "process_info"):
        assert _same(getattr(first.tables, name), getattr(tables, name)), name


def test_a_stored_day(spark, folder, first, closed):
    assert store.open_version(spark, folder).version == closed.version == 1
    assert closed.tables.daily_loan_trx.count() == closed.tables.collection_loan_savings.count() == 0
    assert closed.tables.collection_loan_savings_history.count() == first.tables.collection_loan_savings.count()
    assert closed.tables.saving_trx.count() > first.tables.saving_trx.count()
    inactive = closed.tables.acc_trx_master.filter("is_active = 0").select("trx_master_id")
    lines = closed.tables.acc_trx_detail
    assert lines.join(inactive, "trx_master_id", "left_semi").filter("is_active = 1").count() == 0
    assert lines.count() > first.tables.acc_trx_detail.count()


def test_only_slices_of_the_run_are_written(first, closed):
    run_dates = {str(r.business_date) for r in first.tables.run_control.collect()}
    for name in ("loan_trx", "acc_trx_master"):
        before, after = first.manifest.history[name], closed.manifest.history[name]
        assert {d for d in after if after[d] != before.get(d)} <= run_dates
        assert set(before) - run_dates <= set(after)


def test_a_repeated_run_leaves_the_same_rows(spark, folder, first, closed):
    base = store.open_version(spark, folder, first.version)
    again = store.store(base, processes.day_end(base.tables, enforce=False).tables, "day_end")
    assert (again.version, again.manifest.parent) == (2, 0)
    for name in [*HISTORY, "loan_summary", "saving_summary", "members", "process_info"]:
        if name != "month_wise_saving_interest":
            assert _same(getattr(again.tables, name), getattr(closed.tables, name)), name


def test_a_run_that_dies_is_not_seen(spark, folder, closed, monkeypatch):
    newest = store.versions(spark, folder)[-1]
    opened = store.open_version(spark, folder)
    changed = opened.tables.loan_summary.withColumn("loan_status", F.lit(9))

    def killed(self, name, df, replaced):
        raise KeyboardInterrupt

    monkeypatch.setattr(store._Commit, "write_history", killed)
    after = opened.tables.replace(loan_summary=changed, loan_trx=opened.tables.loan_trx.limit(0))
    with pytest.raises(KeyboardInterrupt):
        store.store(opened, after, "day_end")
    monkeypatch.undo()
    assert store.versions(spark, folder)[-1] == newest
    again = store.open_version(spark, folder)
    assert again.tables.loan_summary.filter("loan_status = 9").count() == 0
    assert _same(again.tables.loan_trx, opened.tables.loan_trx)


def test_a_taken_number_is_an_error(spark, folder, closed, monkeypatch):
    opened = store.open_version(spark, folder)
    monkeypatch.setattr(store, "versions", lambda spark, folder: [opened.version - 1])
    with pytest.raises(Exception, match="(?i)already exists"):
        store.store(opened, opened.tables, "start_of_day")


def test_the_day_reads_its_slices_of_masters_and_lines(first):
    plan = accounts.day_ledger(first.tables)._jdf.queryExecution().executedPlan().toString()
    filters = [line.partition("PartitionFilters: ")[2] for line in plan.split("\n") if "PartitionFilters" in line]
    assert sum("trx_date#" in text and "ubquery" in text for text in filters) >= 2, filters


def test_month_rows_are_replaced_by_office_and_month(spark, tables, tmp_path):
    run = tables.run_control.orderBy("office_id").limit(2)
    ids = [r.office_id for r in run.collect()]
    t = tables.replace(run_control=run)
    rows = run.crossJoin(spark.range(3)).select(
        "organization_id", "office_id", F.lit(1).alias("center_id"), F.col("id").alias("member_id"),
        F.lit(1).alias("product_id"), F.lit(10).alias("balance"), F.col("id").alias("interest"),
        F.col("month_end_date").alias("transaction_date"), F.lit(1).alias("no_of_account"), F.col("id").alias("saving_summary_id"),
    )
    rows = rows.select(*[F.col(f.name).cast(f.dataType) for f in store._layout("month_wise_saving_interest")])
    mid_month = rows.withColumn("transaction_date", F.date_sub("transaction_date", 9)).withColumn("interest", F.lit(7).cast("decimal(18,2)"))
    others = rows.withColumn("office_id", F.lit(-1).cast("bigint"))
    before = rows.withColumn("transaction_date", F.add_months("transaction_date", -12))
    t = t.replace(month_wise_saving_interest=mid_month.unionByName(others).unionByName(before))
    opened = store.create(spark, str(tmp_path), t, ["run_control", "month_wise_saving_interest"])
    for _ in range(2):
        opened = store.store(opened, opened.tables.replace(month_wise_saving_interest=rows), "month_close")
    assert _same(opened.tables.month_wise_saving_interest, rows.unionByName(others).unionByName(before))
    assert len(ids) == 2


def test_a_repeated_cash_close_books_once(tables):
    cash = accounts.cash_close(tables)
    once = accounts.flush_cash(tables, cash)
    twice = accounts.flush_cash(once, cash)
    assert cash.count() > 0
    assert _same(once.acc_trx_master, twice.acc_trx_master) and _same(once.acc_trx_detail, twice.acc_trx_detail)
