"""What a day end moves and leaves on disk: wide rows move once, and intermediate files go when nothing reads them."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import adjustments, day_end, keys
from ledgerloom.plans import processes
from ledgerloom.sources.staging import SHUFFLE_CLEANUP, Stage, shuffles_removed


@pytest.fixture
def shuffled(spark, tables):
    """The tables, none broadcast but the offices of the run, as if all others were large."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield tables.replace(run_control=F.broadcast(tables.run_control))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def _moves(df, *columns):
    """What rows with all these columns are shuffled by, each time."""
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plan = df._jdf.queryExecution().explainString(mode)
    parts = re.findall(r"\(\d+\) Exchange.*?\nInput \[\d+\]: \[([^\n]*)\]\nArguments: hashpartitioning\(([^\n]*)", plan)
    return [by for held, by in parts if all(f"{c}#" in held for c in columns)]


def test_loans_move_once_for_the_rolls(shuffled):
    t = shuffled.replace(loan_summary=day_end.roll_loan_summary(shuffled))
    assert len(_moves(day_end.apply_corrections(t), "bank_name", "approved_amount")) == 1


def test_new_history_rows_move_once_before_their_keys(shuffled):
    rows = day_end.zero_repeat_due(shuffled, day_end.post_loan_trx(shuffled))
    assert len(_moves(rows, "employee_id", "investor_id", "int_paid", "trx_date")) == 1


def test_day_rows_meet_their_repeats_by_loan(shuffled):
    moves = _moves(adjustments.dedupe_charges(shuffled), "product_name", "member_name")
    assert len(moves) == 1 and "daily_loan_trx_id" not in moves[0]


def _files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return set(re.findall(r"shuffle_\d+_\d+_\d+\.data", disk.getAllFiles().mkString(" ")))


def test_a_written_table_leaves_no_shuffle_files(spark):
    before = _files(spark)
    saved = Stage(spark, "volume").save("rows", spark.range(10_000).groupBy(F.col("id") % 1000).count())
    assert _files(spark) - before == set()
    assert len(saved.collect()) == 1000


def test_the_setting_is_put_back(spark):
    was = spark.conf.get(SHUFFLE_CLEANUP, None)
    with pytest.raises(KeyError), shuffles_removed(spark):
        assert spark.conf.get(SHUFFLE_CLEANUP) == "true"
        raise KeyError
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == was


def test_a_day_end_keeps_no_rows_twice(tables, monkeypatch):
    stages = []
    monkeypatch.setattr(processes, "_stage", lambda t, label: stages.append(Stage(t.run_control.sparkSession, label)) or stages[-1])
    after = processes.day_end(tables, enforce=False).tables
    left = {p.name for p in Path(stages[0].path).iterdir()} | {p.name for p in (Path(stages[0].path) / "adjust").iterdir()}
    assert not {n for n in left if n.endswith("-unkeyed")} and not left & {"deduped", "adjusted", "day-rows", "closed"}
    # what is returned is read in full from what is left
    for name in (*tables._given, "new_loan_trx", "archived_collections"):
        if name not in ("nation", "customer") and not name.startswith("base_"):
            getattr(after, name).foreach(lambda row: None)


def test_rows_of_other_offices_keep_all_columns(tables):
    run = tables.run_control.filter("office_id % 2 = 0")
    after = processes.day_end(tables.replace(run_control=run), enforce=False).tables
    for name in ("daily_loan_trx", "daily_saving_trx"):
        left = getattr(tables, name).join(run, ["office_id", "organization_id"], "left_anti")
        got = getattr(after, name).select(*left.columns)
        assert got.count() == left.count() > 0 and got.exceptAll(left).count() == 0


def test_rows_without_a_loan_are_posted(tables):
    loan = F.when(F.col("daily_loan_trx_id") % 5 > 0, F.col("loan_summary_id"))
    t = tables.replace(daily_loan_trx=tables.daily_loan_trx.withColumn("loan_summary_id", loan))
    posted = day_end.zero_repeat_due(t, day_end.post_loan_trx(t))
    assert posted.count() == tables.daily_loan_trx.count() and posted.filter("loan_summary_id IS NULL").count() > 0


def test_keys_by_loan_fall_back_for_a_hot_loan(spark, monkeypatch):
    rows = spark.range(3000).select(
        F.when(F.col("id") < 1000, 1).otherwise(F.col("id")).alias("a"), F.col("id").alias("b"), F.lit(None).cast("bigint").alias("k")
    )
    even = keys.numbered(rows, "k", 9, "a")
    assert sorted(r.k for r in even.collect()) == list(range(10, 3010))
    monkeypatch.setattr(keys, "LARGE_BUCKET", 100)
    uneven = keys.numbered(rows, "k", 9, "a")
    assert sorted(map(tuple, uneven.collect())) == sorted(map(tuple, keys.numbered(rows, "k", 9).collect()))


def test_rows_that_stay_are_not_moved_with_the_day(tables, shuffled, monkeypatch):
    """A store writes the day's loan rows that are left, which are those of other offices, without dealing the whole day."""
    plans = []

    def planned(t, *rest):
        t, staying = adjust(t, *rest)
        plans.append(staying)
        raise KeyboardInterrupt

    adjust = processes.adjust
    monkeypatch.setattr(processes, "adjust", planned)
    with pytest.raises(KeyboardInterrupt):
        processes.day_end(tables, enforce=False)
    plan = plans[0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("LeftOuter, (_group#") < plan.index("LeftAnti", plan.index("LeftOuter, (_group#"))
    assert plans[0].count() == 0


def test_rows_of_another_organization_stay_with_their_changes(tables):
    strange = F.col("daily_loan_trx_id") % 7 == 0
    day = tables.daily_loan_trx.withColumn("organization_id", F.when(strange, F.lit(99)).otherwise(F.col("organization_id")))
    t = tables.replace(daily_loan_trx=day)
    after = processes.day_end(t, enforce=False).tables.daily_loan_trx
    expected = adjustments.without_adjustments(t.replace(daily_loan_trx=adjustments.dedupe_charges(t))).daily_loan_trx
    expected = expected.filter("organization_id = 99 AND NOT trx_type <=> 32").select(*day.columns)
    got = after.filter("organization_id = 99 AND daily_loan_trx_id IS NOT NULL").select(*day.columns)
    moved = tables.run_control.filter("organization_id = 4").select("office_id")
    got, expected = (df.join(moved, "office_id", "left_semi") for df in (got, expected))
    assert got.count() == expected.count() > 0 and got.exceptAll(expected).count() == 0
