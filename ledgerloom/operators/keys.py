"""Surrogate keys of new rows: without gaps, dealt without a global sort, the same whenever a run is repeated.

Rows are hashed to a fixed number of buckets. A bucket's first number follows from the row counts of the buckets before
it, which are a table of ``BUCKETS`` rows, and the order within a bucket is that of the row's own values. Where a bucket
is much larger than others, equal rows are counted before they are dealt and written out again in blocks, so a row that
fills a third of a day is no large group; elsewhere the rows move once. Both ways deal the same keys.
"""

from __future__ import annotations

from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.sources.tables import Tables

#: A bucket holds a share of this many of the new rows of one run. Other numbers give other keys.
BUCKETS = 4096
#: Copies of one row that come from one task.
COPIES = 1000
#: A bucket of more rows, and of more than ``UNEVEN`` times the mean, is taken to hold copies of one row.
LARGE_BUCKET = 50_000
UNEVEN = 4

#: Rows of one loan or account are dealt together, unless one holds so many that they are dealt by all their values:
#: neighbours that are alike take up less on their way.
TOGETHER = {"loan_trx": "loan_summary_id", "saving_trx": "saving_summary_id"}

KEY_OF = {"loan_trx": "loan_trx_id", "saving_trx": "saving_trx_id", "process_info": "process_info_id"}


def numbered(rows: DataFrame, column: str, last: int, together: str | None = None) -> DataFrame:
    """The rows with ``column`` running from ``last + 1`` without gaps.

    Rows alike in ``together`` lie in one bucket where no bucket is much larger than others. The rows are read twice, so
    they should be a written table.
    """
    values = [c for c in rows.columns if c != column]
    if together:
        values = [together, *[c for c in values if c != together]]
    bucket = F.pmod(F.xxhash64(*(values[:1] if together else values)), F.lit(BUCKETS))
    # as many rows as there are buckets
    sizes = sorted(tuple(row) for row in rows.groupBy(bucket.alias("_bucket")).count().collect())
    before = [0, *accumulate(count for _, count in sizes)]
    starts = rows.sparkSession.createDataFrame(
        pa.table({
            "_bucket": pa.array([number for number, _ in sizes], pa.int64()),
            "_first": pa.array(before[:-1], pa.int64()),
        })
    )
    if max((count for _, count in sizes), default=0) > max(LARGE_BUCKET, UNEVEN * before[-1] // BUCKETS):
        if together:
            return numbered(rows, column, last)
        return _numbered_copies(rows, column, values, bucket, starts, last)
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy(*values))
    placed = rows.withColumn("_bucket", bucket).join(starts, "_bucket").withColumn("_place", place)
    return placed.withColumn(column, F.lit(last).cast("bigint") + F.col("_first") + F.col("_place")).select(*rows.columns)


def _numbered_copies(
    rows: DataFrame, column: str, values: list[str], bucket: Column, starts: DataFrame, last: int
) -> DataFrame:
    """The same for rows with many copies: equal rows are one until they have their first number."""
    counted = rows.groupBy(*values).agg(F.count(F.lit(1)).alias("_copies")).withColumn("_bucket", bucket)
    within = Window.partitionBy("_bucket").orderBy(*values).rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.coalesce(F.sum("_copies").over(within), F.lit(0))
    placed = counted.join(starts, "_bucket").withColumn("_before", F.lit(last) + F.col("_first") + earlier)
    few = placed.filter(F.col("_copies") <= COPIES).withColumn("_block", F.lit(0).cast("bigint"))
    many = placed.filter(F.col("_copies") > COPIES)
    many = many.withColumn("_block", _numbers(0, F.ceil(F.col("_copies") / COPIES) - 1))
    # a stated number of tasks, as blocks are too few bytes to be left apart otherwise
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    many = many.repartition(tasks, F.xxhash64("_before", "_block"))
    blocks = few.unionByName(many.select(*few.columns))
    size = F.least(F.lit(COPIES), F.col("_copies") - F.col("_block") * COPIES)
    copies = blocks.withColumn("_copy", _numbers(1, size))
    key = (F.col("_before") + F.col("_block") * COPIES + F.col("_copy")).cast("bigint")
    return copies.withColumn(column, key).select(*rows.columns)


def _numbers(first: int, last: Column) -> Column:
    return F.explode(F.sequence(F.lit(first).cast("bigint"), last.cast("bigint")))


def last_key(t: Tables, name: str) -> int:
    """The last key dealt in a table: its row of ``key_control``, or the greatest key where it has none."""
    kept = t.key_control.filter(F.col("table_name") == name).agg(F.max("last_key")).first()[0]
    if kept is None:
        kept = getattr(t, name).agg(F.max(KEY_OF[name])).first()[0]
    return kept or 0


def with_keys(t: Tables, name: str, rows: DataFrame) -> DataFrame:
    """New rows of a table with their keys."""
    return numbered(rows, KEY_OF[name], last_key(t, name), TOGETHER.get(name))


def dealt(t: Tables, name: str, keyed: DataFrame) -> DataFrame:
    """The control table after the rows of :func:`with_keys`; none leave it as it is."""
    new = keyed.agg(F.max(KEY_OF[name]).alias("last_key")).filter("last_key IS NOT NULL")
    new = new.select(F.lit(name).alias("table_name"), "last_key")
    return t.key_control.unionByName(new).groupBy("table_name").agg(F.max("last_key").alias("last_key"))
