"""Physical plans: no products of tables, no Python in the data path, pruned scans; and skewed inputs stay right."""

import re

import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from ledgerloom.catalog import QUERIES
from ledgerloom.operators import adjustments, changes, day_end, month_close, start_of_day, vouchers
from ledgerloom.sources.fixtures import derived_tables


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# one key per kind of posting rule; the others differ in constants only
RULE_KINDS = {"vp_01", "vp_02", "vp_05", "vp_07", "vp_09", "vp_12", "vp_14", "vp_23", "vp_32"}
PLANNED = sorted(k for k in QUERIES if not k.startswith(("run_", "vp_")) or k in RULE_KINDS)


@pytest.mark.parametrize("key", PLANNED)
def test_plan_shape(key, spark):
    plan = _plan(QUERIES[key].run(spark, SF_DIR))
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "MapInPandas", "BatchEvalPython"):
        assert banned not in plan, banned


def test_scan_is_pruned_and_filtered(tables):
    plan = tables.loan_summary.filter("is_active = 1").select("loan_summary_id")._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(is_active), EqualTo(is_active,1)]" in plan
    scan = _plan(day_end.close_loans(tables).select("loan_summary_id", "loan_status"))
    assert "bank_name" not in scan


def test_large_sides_are_not_broadcast(spark, tables):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(start_of_day.loan_sheet(tables))
        assert "Broadcast" not in plan
        assert start_of_day.loan_sheet(tables).count() > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


@pytest.mark.parametrize("key", ["vp_01", "vp_02", "vp_09", "vp_10", "vp_18", "voucher_gates", "voucher_ledger"])
def test_chart_and_interface_are_not_broadcast(key, spark):
    plan = _plan(QUERIES[key].run(spark, SF_DIR))
    for lookup in ("product_id", "acc_code", "product_code", "bank_name", "trx_master_id"):
        assert f"BroadcastHashJoin [{lookup}#" not in plan, lookup


@pytest.mark.parametrize(
    "key",
    [f"vp_{n:02d}" for n in range(1, 33) if n not in (1, 2, 9, 10, 18)]
    + ["voucher_postings", "voucher_masters", "voucher_details", "voucher_last_number"],
)
def test_no_voucher_broadcasts_the_chart(key, spark):
    plan = _plan(QUERIES[key].run(spark, SF_DIR))
    for lookup in ("product_id", "acc_code", "product_code", "bank_name", "trx_master_id"):
        assert f"BroadcastHashJoin [{lookup}#" not in plan, lookup


@pytest.mark.parametrize("key", ["vp_02", "vp_03", "vp_04", "vp_32", "voucher_gates", "voucher_postings"])
def test_transfers_and_deceased_members_are_not_broadcast(key, tables):
    only = frozenset({key.replace("vp_", "P")}) if key.startswith("vp_") else vouchers.ALL_RULES
    for found in re.findall(r"BroadcastHashJoin \[([^]]*)\]", _plan(vouchers.day_amounts(tables, only))):
        assert "member_id" not in found, found


def test_lookups_of_many_rows_are_not_broadcast(tables, monkeypatch):
    monkeypatch.setattr(changes, "BROADCAST_ROWS", 1)
    for build in (start_of_day.loan_sheet, start_of_day.lts_savings, start_of_day.last_installment):
        plan = _plan(build(tables))
        for key in ("product_id", "loan_summary_id", "office_id#[0-9]+L, center_id#[0-9]+L, member_id"):
            assert not re.search(rf"BroadcastHashJoin \[{key}#[0-9]+L\], .*(Inner|LeftOuter), BuildRight", plan), key


def _hot(tables, share=3):
    """A day in which a third of all rows belongs to one loan."""
    day = tables.daily_loan_trx
    one = day.orderBy("daily_loan_trx_id").limit(1)
    copies = int(day.count() / (share - 1))
    hot = one.crossJoin(one.sparkSession.range(copies)).withColumn("daily_loan_trx_id", F.col("id") + 10_000_000)
    return tables.replace(daily_loan_trx=day.unionByName(hot.drop("id"))), copies


def test_hot_loan_dedupe(tables):
    t, copies = _hot(tables)
    result = adjustments.dedupe_charges(t)
    assert result.count() == t.daily_loan_trx.count()
    loan = t.daily_loan_trx.orderBy(F.desc("daily_loan_trx_id")).first()
    rows = result.filter(F.col("loan_summary_id") == loan.loan_summary_id)
    zeroed = rows.filter(F.col("loan_due") == 0).count()
    before = t.daily_loan_trx.filter((F.col("loan_summary_id") == loan.loan_summary_id) & (F.col("loan_due") == 0))
    assert zeroed == before.count() + 1


def test_hot_loan_roll(tables):
    t, copies = _hot(tables)
    rolled = day_end.roll_loan_summary(t)
    assert rolled.count() == t.loan_summary.count()
    difference = (
        rolled.select("loan_summary_id", F.col("cum_loan_due").alias("hot"))
        .join(day_end.roll_loan_summary(tables).select("loan_summary_id", "cum_loan_due"), "loan_summary_id")
        .filter(~F.col("hot").eqNullSafe(F.col("cum_loan_due")))
        .collect()
    )
    assert len(difference) <= 1


@pytest.mark.parametrize(
    "key",
    ["mon_saving_transactions", "mon_savings_register", "mon_min_balance", "mon_static_balance", "mon_min_age_balance",
     "mon_new_in_7", "mon_apply_new_in_7", "mon_savings_interest", "mon_interest_final", "mon_store_interest"],
)
def test_month_close_broadcasts_no_accounts(key, spark):
    if key == "mon_store_interest":
        t = derived_tables(spark, SF_DIR)
        plan = _plan(month_close.final_interest(t, month_close.savings_interest(t, month_close.final_balances(t))))
    else:
        plan = _plan(QUERIES[key].run(spark, SF_DIR))
    for found in re.findall(r"BroadcastHashJoin \[([^]]*)\]", plan):
        assert "no_of_account" not in found and "saving_summary_id" not in found, found
