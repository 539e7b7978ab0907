"""Reading and writing tables: layouts, partition overwrite, pruning by the run's dates."""

from pyspark.sql import functions as F

from ledgerloom.operators import day_end
from ledgerloom.sources import tables as sources
from ledgerloom.sources.staging import Stage, shared_folder


def test_snapshot_round_trip(spark, tables, tmp_path):
    sources.write_snapshot(tables.centers, str(tmp_path), "centers")
    again = sources.open_tables(spark, str(tmp_path)).centers
    assert again.schema == tables.centers.schema
    assert again.exceptAll(tables.centers).count() == 0


def test_partition_replacement_is_idempotent(spark, tmp_path):
    folder = str(tmp_path)
    first = spark.createDataFrame([(1, "a"), (2, "b")], "v int, month string")
    sources.append_history(first, folder, "h", ["month"])
    for _ in range(2):
        sources.replace_partitions(spark.createDataFrame([(9, "b")], "v int, month string"), folder, "h", ["month"])
    rows = spark.read.parquet(f"{folder}/h").collect()
    assert {(r.v, r.month) for r in rows} == {(1, "a"), (9, "b")}
    assert len(rows) == 2


def test_history_is_pruned_to_the_run_month(spark, tables, tmp_path):
    folder = str(tmp_path)
    dated = tables.loan_trx.withColumn("day", F.col("installment_date"))
    sources.append_history(dated, folder, "loan_trx", ["day"])
    history = spark.read.parquet(f"{folder}/loan_trx").drop("installment_date").withColumnRenamed("day", "installment_date")
    t = tables.replace(loan_trx=history.select(*tables.loan_trx.columns))
    result = day_end.resync_month_to_date(t)
    plan = result._jdf.queryExecution().executedPlan().toString()
    filters = [line.partition("PartitionFilters: ")[2] for line in plan.split("\n") if "PartitionFilters" in line]
    assert any("day#" in text and "ubquery" in text for text in filters), filters
    assert result.exceptAll(day_end.resync_month_to_date(tables)).count() == 0


def test_stage_uses_the_named_folder(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    stage = Stage(spark, "unit")
    assert stage.path.startswith(shared_folder(spark))
    assert stage.save("t", spark.range(3)).count() == 3
