"""Surrogate keys: without gaps, unique over days, the same in a repeated run, equal rows over several tasks."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import keys
from ledgerloom.plans import processes


def _rows(spark, copies):
    rows = spark.range(500).select(
        (F.col("id") % 7).alias("a"), F.when(F.col("id") % 5 > 0, F.col("id").cast("string")).alias("b"),
        F.lit(None).cast("bigint").alias("k"),
    )
    one = spark.range(copies).select(F.lit(1).cast("bigint").alias("a"), F.lit("x").alias("b"), F.lit(None).cast("bigint").alias("k"))
    return rows.unionByName(one)


def _values(df):
    return sorted(((r.k, r.a, r.b or "") for r in df.collect()))


def test_keys_have_no_gaps_and_rows_stay_whole(spark):
    rows = _rows(spark, 2_345)
    made = keys.numbered(rows, "k", 100)
    assert made.columns == rows.columns
    assert [k for k, _, _ in _values(made)] == list(range(101, 101 + 2_845))
    assert made.drop("k").exceptAll(rows.drop("k")).count() == 0


def test_keys_do_not_depend_on_the_layout(spark):
    rows = _rows(spark, 30)
    assert _values(keys.numbered(rows.repartition(7, "b"), "k", 0)) == _values(keys.numbered(rows.coalesce(1), "k", 0))


def test_rows_move_once_unless_one_has_many_copies(spark, monkeypatch):
    rows = _rows(spark, 345)

    def exchanges(made):
        return made._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")

    even = keys.numbered(rows, "k", 7)
    assert exchanges(even) == 1
    monkeypatch.setattr(keys, "LARGE_BUCKET", 100)
    uneven = keys.numbered(rows, "k", 7)
    assert exchanges(uneven) > 1
    assert _values(even) == _values(uneven)


def test_no_rows(spark):
    assert keys.numbered(_rows(spark, 0).limit(0), "k", 5).count() == 0


def test_copies_of_one_row_come_from_several_tasks(spark):
    made = keys.numbered(_rows(spark, 200_000), "k", 0).filter("b = 'x'")
    by_task = [r["count"] for r in made.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(by_task) == 200_000 and max(by_task) < 150_000


def test_the_control_is_rebuilt_where_it_has_no_row(tables):
    empty = tables.replace(key_control=tables.key_control.limit(0))
    for name in keys.KEY_OF:
        assert keys.last_key(empty, name) == keys.last_key(tables, name) > 0


def test_keys_stay_unique_over_two_days_and_a_month_end(tables):
    t = processes.day_end(tables, enforce=False).tables
    later = t.run_control.withColumn("business_date", F.date_add("business_date", 1))
    t = t.replace(run_control=later, daily_loan_trx=tables.daily_loan_trx, daily_saving_trx=tables.daily_saving_trx)
    t = processes.start_of_day(t, enforce=False).tables
    t = processes.day_end(t, enforce=False).tables
    t = processes.month_close(t, enforce=False).tables
    for name, column in keys.KEY_OF.items():
        found = getattr(t, name).agg(
            F.count(F.lit(1)).alias("rows"), F.count_distinct(column).alias("keys"), F.max(column).alias("last")
        ).first()
        assert found.rows == found.keys, name
        assert found.last <= keys.last_key(t, name)
        assert found.rows > getattr(tables, name).count(), name
