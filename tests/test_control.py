"""The voucher control table, the guard of merges, and rows with very many copies."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerloom.operators import accounts, changes, day_end, start_of_day, validations, voucher_control, vouchers
from ledgerloom.plans import processes
from ledgerloom.sources.staging import Stage


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _flushed(t):
    stage = Stage(t.run_control.sparkSession, "control")
    amounts = stage.save("amounts", vouchers.day_amounts(t))
    postings = stage.save("postings", vouchers.voucher_postings(t, amounts))
    return vouchers.flush_to_ledger(t, vouchers.voucher_masters(t, postings), vouchers.voucher_details(t, postings))


def test_control_is_kept_in_step(tables):
    after = _flushed(tables)
    assert _rows(after.voucher_control) == _rows(voucher_control.rebuilt(after))
    closed = accounts.flush_cash(after, accounts.cash_close(after))
    assert _rows(closed.voucher_control) == _rows(voucher_control.rebuilt(closed))
    again = accounts.flush_cash(closed, accounts.cash_close(after))
    assert _rows(again.voucher_control) == _rows(closed.voucher_control)


def test_an_office_without_vouchers_gets_its_row(tables):
    young = F.col("office_id") % 4 == 1
    t = tables.replace(
        voucher_control=tables.voucher_control.filter(~young), acc_trx_master=tables.acc_trx_master.filter(~young)
    )
    assert not {r.office_id % 4 for r in voucher_control.offices_with_vouchers(t).collect()} & {1}
    after = _flushed(t)
    assert _rows(after.voucher_control) == _rows(voucher_control.rebuilt(after))


def test_no_plan_looks_through_all_vouchers(spark, tables, tmp_path):
    """The control row answers whether there are vouchers; numbers are sought among the run dates' partitions."""
    path = str(tmp_path / "masters")
    tables.acc_trx_master.write.partitionBy("trx_date").parquet(path)
    t = tables.replace(acc_trx_master=spark.read.parquet(path).select(*tables.acc_trx_master.columns))

    def scans(df):
        plan = df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        )
        return [part for part in plan.split("\n\n") if "Scan parquet" in part and path in part]

    amounts = Stage(spark, "control").save("amounts", vouchers.day_amounts(t))
    assert not scans(vouchers.voucher_gates(t, amounts))
    for df in (vouchers.voucher_numbers(t), validations.auto_voucher_report(t)):
        found = scans(df)
        assert found and all("PartitionFilters: [isnotnull(trx_date" in part for part in found)


def test_a_doubled_delta_fails(spark):
    target = spark.createDataFrame([(1, 5), (2, 6), (3, 7)], "k int, v int")
    delta = spark.createDataFrame([(1, 10), (2, 20)], "k int, d int")
    merged = changes.merge(target, delta, ["k"])
    assert _rows(merged.na.fill(0)) == [(1, 5, 10), (2, 6, 20), (3, 7, 0)]
    with pytest.raises(PySparkException, match="several changes for one key"):
        changes.merge(target, delta.unionByName(delta.limit(1)), ["k"]).collect()
    assert changes.merge(target, delta.limit(0), ["k"]).count() == 3


def test_the_guard_adds_no_exchange(spark, tables):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        day = tables.daily_loan_trx.groupBy("loan_summary_id").agg(F.sum("loan_paid").alias("paid"))
        joined = tables.loan_summary.join(day, "loan_summary_id", "left")
        merged = changes.merge(tables.loan_summary, day, ["loan_summary_id"])
        counts = [df._jdf.queryExecution().executedPlan().toString().count("Exchange") for df in (joined, merged)]
        assert counts[0] == counts[1]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_an_office_twice_in_the_run_fails(tables):
    twice = tables.run_control.unionByName(tables.run_control.limit(1))
    with pytest.raises(PySparkException, match="several changes for one key"):
        processes.month_close(tables.replace(run_control=twice))


def test_rolls_are_unchanged_by_the_guard(tables):
    assert day_end.roll_loan_summary(tables).count() == tables.loan_summary.count()
    assert day_end.roll_saving_summary(tables).count() == tables.saving_summary.count()


def test_copies_of_one_row_come_from_several_tasks(spark):
    rows = spark.createDataFrame([(1, 1_000_000), (2, 1), (3, 0), (4, 1000), (5, 1001)], "k int, n bigint")
    copies = start_of_day.repeated(rows, "n").select("k", F.spark_partition_id().alias("task"))
    counted = {r.k: (r.copies, r.tasks) for r in copies.groupBy("k").agg(
        F.count(F.lit(1)).alias("copies"), F.countDistinct("task").alias("tasks")).collect()}
    assert {k: c for k, (c, _) in counted.items()} == {1: 1_000_000, 2: 1, 4: 1000, 5: 1001}
    assert counted[1][1] > 1
