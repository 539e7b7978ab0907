"""Running totals against the sums of all history."""

from pyspark.sql import functions as F

from ledgerloom.operators import day_end, totals
from ledgerloom.plans import processes
from ledgerloom.sources import store
from ledgerloom.catalog import _DAY_TABLES


def _full(t, last):
    run = t.run_control.select("office_id", F.col(last).alias("last_date"))
    return totals._summed(t.loan_trx.join(run, "office_id").filter(F.col("installment_date") <= F.col("last_date")))


def _same(a, b):
    columns = sorted(a.columns)
    a, b = a.select(*columns), b.select(*columns)
    return a.count() == b.count() > 0 and a.exceptAll(b).count() == 0


def test_sums_up_to_the_run_date(tables):
    assert _same(totals.history_sums(tables, tables.loan_summary), _full(tables, "business_date"))


def test_totals_beyond_the_run_date_are_not_used(tables):
    t = tables.replace(totals_until=tables.run_control.select("office_id", F.date_add("business_date", 3).alias("until")))
    t = totals.rebuild(t)
    assert _same(totals.history_sums(t, t.loan_summary), _full(t, "business_date"))
    assert _same(totals.carry_month(t).loan_totals, _full(t, "month_end_date"))


def test_null_sums_stay_null(spark, tables):
    loan = tables.loan_trx.first()
    one = tables.loan_trx.filter(F.col("loan_summary_id") == loan.loan_summary_id)
    t = tables.replace(loan_trx=one.withColumn("int_due", F.lit(None).cast("decimal(18,2)")))
    t = totals.rebuild(t)
    assert totals.history_sums(t, one).filter("int_due IS NOT NULL").count() == 0


def test_two_days_and_a_month_end(spark, tables, tmp_path):
    """Totals kept along stored runs equal the sums of the stored history."""
    opened = store.create(spark, str(tmp_path), tables, _DAY_TABLES)
    run = tables.run_control
    for day in range(2):
        t = opened.tables.replace(run_control=run.withColumn("business_date", F.date_add("business_date", day)))
        opened = store.store(opened, processes.day_end(t, enforce=False).tables, "day_end")
    t = opened.tables.replace(run_control=run)
    opened = store.store(opened, processes.month_close(t, enforce=False).tables, "month_close")
    t = opened.tables
    assert _same(t.loan_totals, _full(t, "month_end_date"))
    assert t.totals_until.join(run, "office_id").filter("until <> date_add(month_end_date, 1)").count() == 0
    assert _same(totals.rebuild(t).loan_totals, t.loan_totals)
    next_day = t.replace(run_control=run.withColumn("business_date", F.date_add("month_end_date", 1)))
    assert _same(totals.history_sums(next_day, t.loan_summary), _full(next_day, "business_date"))


def test_final_due_reads_from_the_carried_date_on(spark, tables, tmp_path):
    t = tables.replace(totals_until=tables.run_control.select("office_id", F.trunc("business_date", "MM").alias("until")))
    opened = store.create(spark, str(tmp_path), totals.rebuild(t), _DAY_TABLES)
    plan = day_end.final_due(opened.tables)._jdf.queryExecution().executedPlan().toString()
    filters = [line.partition("PartitionFilters: ")[2] for line in plan.split("\n") if "PartitionFilters" in line]
    bounded = [text for text in filters if text.startswith("[") and "installment_date#" in text.partition("]")[0]]
    assert any("ubquery" in text for text in bounded), bounded or filters[:20]
    assert day_end.final_due(opened.tables).count() == day_end.final_due(tables).count()
