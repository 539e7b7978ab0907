"""A stored ledger: every run is one commit over all its tables.

Below the ledger's folder each commit writes what it changes to folders of its own and then one manifest, which names
for every table the folders that make it up. A reader takes the newest manifest and nothing else, so a run that dies
before its manifest leaves the earlier state readable, whatever files it wrote; archive and clear of a table, which
are two tables of one commit, become visible together.

- ``tables/<table>/<commit>``: a current-state table, whole
- ``tables/<table>/run=<commit>/<date column>=<date>``: a history table by date, so that a run reads and writes the slices
  of its dates only
- ``manifests/<number>``: one line of JSON, made visible by Spark's own commit of that one file

History of a date is replaced as a whole (rows of offices outside the run are in the new slice too) or appended to;
dates a run doesn't touch keep their folders. A manifest holds a table's dates, some thousands, never its rows. A run
is repeated by opening the version it was first computed from: its new commit has the same rows, and the first one's
are not reached from it. One ledger has one writer at a time; a number that is already taken is an error.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerloom.schemas import SCHEMAS
from ledgerloom.sources.staging import shuffles_removed
from ledgerloom.sources.tables import Tables

# history tables and the date by which they are laid out
HISTORY = {
    "loan_trx": "installment_date",
    "saving_trx": "transaction_date",
    "acc_trx_master": "trx_date",
    "acc_trx_detail": "trx_date",
    "collection_loan_savings_history": "collection_date",
    "month_wise_saving_interest": "transaction_date",
}
#: where the dates of a table's folders can't be known, among them null
NO_DATE = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Manifest:
    """The folders of a version: one for a state table, some for each date of a history table."""

    version: int
    parent: int | None
    process: str
    state: dict[str, str] = field(default_factory=dict)
    history: dict[str, dict[str, list[str]]] = field(default_factory=dict)


@dataclass(frozen=True)
class Stored:
    """An opened version: its manifest and its tables."""

    folder: str
    manifest: Manifest
    tables: Tables

    @property
    def version(self) -> int:
        return self.manifest.version


def _layout(name: str) -> StructType:
    return StructType.fromDDL(SCHEMAS[name])


def versions(spark: SparkSession, folder: str) -> list[int]:
    """The numbers of all complete commits. Files are listed, not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{folder}/manifests")
    number = F.regexp_extract("path", r"/manifests/(\d+)/[^/]+$", 1)
    return sorted({int(r.number) for r in found.select(number.alias("number")).collect()})


def open_version(spark: SparkSession, folder: str, version: int | None = None) -> Stored:
    """The newest version of a stored ledger, or a given one."""
    folder = folder.rstrip("/")
    version = max(versions(spark, folder)) if version is None else version
    manifest = Manifest(**json.loads(spark.read.text(f"{folder}/manifests/{version}").first()["value"]))

    held: dict[str, DataFrame] = {}

    def opener(name: str) -> DataFrame:
        if name not in held:
            held[name] = read(name)
        return held[name]

    def read(name: str) -> DataFrame:
        root = f"{folder}/tables/{name}"
        if name in manifest.state:
            return spark.read.schema(_layout(name)).parquet(f"{root}/{manifest.state[name]}")
        column, dates = HISTORY.get(name), manifest.history.get(name, {})
        paths = [f"{root}/run={commit}/{column}={day}" for day, commits in sorted(dates.items()) for commit in commits]
        if not paths:
            return spark.createDataFrame([], _layout(name))
        return spark.read.option("basePath", root).schema(_layout(name)).parquet(*paths).select(*_layout(name).names)

    return Stored(folder, manifest, Tables(opener))


class _Commit:
    """The tables written so far for a version to come."""

    def __init__(self, spark: SparkSession, folder: str, process: str, base: Manifest | None):
        self.spark, self.folder, self.process, self.base = spark, folder.rstrip("/"), process, base
        self.name = uuid.uuid4().hex
        self.state = dict(base.state) if base else {}
        self.history = {k: dict(v) for k, v in base.history.items()} if base else {}

    def write_state(self, name: str, df: DataFrame) -> None:
        with shuffles_removed(self.spark):
            df.select(*_layout(name).names).write.option("compression", "zstd").parquet(f"{self.folder}/tables/{name}/{self.name}")
        self.state[name] = self.name

    def write_history(self, name: str, df: DataFrame, replaced: Iterable[str] | None) -> None:
        """New rows of a history table; ``replaced``: the dates of which they are all rows, none if they are added."""
        column, path = HISTORY[name], f"{self.folder}/tables/{name}/run={self.name}"
        rows = df.select(*_layout(name).names)
        # a date's rows come from few tasks, so that it has few files
        with shuffles_removed(self.spark):
            rows = rows.repartition(column, F.pmod(F.xxhash64(*rows.columns), F.lit(self._files())))
            rows.write.option("compression", "zstd").partitionBy(column).parquet(path)
        held = self.history.setdefault(name, {})
        for day in replaced or ():
            held.pop(day, None)
        written = self.spark.read.schema(_layout(name)).parquet(path)
        for row in written.select(F.col(column).cast("string").alias("day")).distinct().collect():
            day = row["day"] or NO_DATE
            held[day] = [*held.get(day, []), self.name]

    def _files(self) -> int:
        return max(1, int(self.spark.conf.get("spark.sql.shuffle.partitions")) // 8)

    def finish(self) -> Manifest:
        """Write the manifest; from here on the version is there."""
        number = max(versions(self.spark, self.folder)) + 1 if self.base else 0
        parent = self.base.version if self.base else None
        done = Manifest(number, parent, self.process, self.state, self.history)
        line = self.spark.createDataFrame([(json.dumps(done.__dict__),)], "value string")
        line.coalesce(1).write.mode("error").text(f"{self.folder}/manifests/{number}")
        return done


def create(spark: SparkSession, folder: str, t: Tables, names: Iterable[str]) -> Stored:
    """Store the named tables as the first version of a ledger."""
    commit = _Commit(spark, folder, "create", None)
    for name in names:
        if name in HISTORY:
            commit.write_history(name, getattr(t, name), None)
        else:
            commit.write_state(name, getattr(t, name))
    return open_version(spark, folder, commit.finish().version)


def _dates(t: Tables, *columns: str) -> list[str]:
    """The different dates of the run control, as many as a run has."""
    found = t.run_control.select(F.explode(F.array(*columns)).alias("date")).distinct()
    return [str(r["date"]) for r in found.collect() if r["date"] is not None]


def _on(df: DataFrame, column: str, dates: list[str]) -> DataFrame:
    return df.filter(F.col(column).isin([date.fromisoformat(d) for d in dates]))


def _interest_slices(opened: Stored, after: Tables, dates: list[str]) -> DataFrame:
    """The slices with each office's rows of its month deleted and the run's rows put in their place."""
    name = "month_wise_saving_interest"
    rows = _on(getattr(opened.tables, name), HISTORY[name], dates).withColumn("month", F.trunc(HISTORY[name], "MM"))
    closed = after.run_control.select("office_id", "organization_id", F.trunc("month_end_date", "MM").alias("month"))
    kept = rows.join(closed.distinct(), ["office_id", "organization_id", "month"], "left_anti")
    columns = _layout(name).names
    return kept.select(*columns).unionByName(getattr(after, name).select(*columns))


def _dates_to_void(opened: Stored) -> list[str]:
    """Dates with active lines of inactive vouchers, which a run makes inactive."""
    void = opened.tables.acc_trx_master.filter("is_active = 0").select("trx_master_id", "trx_date")
    lines = opened.tables.acc_trx_detail.filter("is_active = 1").join(void, ["trx_master_id", "trx_date"], "left_semi")
    return [str(r["trx_date"]) for r in lines.select("trx_date").distinct().collect()]


def store(opened: Stored, after: Tables, process: str) -> Stored:
    """Commit what a run made of an opened version: state whole, history in the slices of its run dates.

    process: ``start_of_day``, ``auto_voucher``, ``day_end`` or ``month_close``. Tables that are still those of the
    opened version are not written again.
    """
    spark = opened.tables.run_control.sparkSession
    commit = _Commit(spark, opened.folder, process, opened.manifest)

    def changed(name: str) -> bool:
        return getattr(after, name) is not getattr(opened.tables, name)

    for name in opened.manifest.state:
        # offices that failed a rule left the run, not the ledger
        if name != "run_control" and changed(name):
            commit.write_state(name, getattr(after, name))
    run_column = "month_end_date" if process == "month_close" else "business_date"
    dates = _dates(after, run_column)
    for name in ("loan_trx", "acc_trx_master", "acc_trx_detail"):
        if name in opened.manifest.history and changed(name):
            wanted = dates if name != "acc_trx_detail" else sorted({*dates, *_dates_to_void(opened)})
            commit.write_history(name, _on(getattr(after, name), HISTORY[name], wanted), wanted)
    if process == "day_end":
        commit.write_history("saving_trx", after.new_saving_trx, None)
        commit.write_history("collection_loan_savings_history", after.archived_collections, None)
    if process == "month_close":
        name = "month_wise_saving_interest"
        months = {day[:7] for day in dates}
        wanted = sorted({*dates, *(d for d in opened.manifest.history.get(name, {}) if d[:7] in months)})
        commit.write_history(name, _interest_slices(opened, after, wanted), wanted)
    return open_version(spark, opened.folder, commit.finish().version)
