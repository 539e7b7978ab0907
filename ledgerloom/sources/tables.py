"""The table set an operator works on, and its Parquet source and sink."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.schemas import SCHEMAS


class Tables:
    """Immutable set of named DataFrames, each opened on first use: ``t.loan_summary``."""

    def __init__(self, opener: Callable[[str], DataFrame], given: Mapping[str, DataFrame] | None = None):
        self._opener = opener
        self._given = dict(given or {})

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._given:
            self._given[name] = self._opener(name)
        return self._given[name]

    def replace(self, **tables: DataFrame) -> Tables:
        return Tables(self._opener, {**self._given, **tables})

    @staticmethod
    def of(**tables: DataFrame) -> Tables:
        def missing(name: str) -> DataFrame:
            raise KeyError(f"no table {name}")

        return Tables(missing, tables)


def open_tables(spark: SparkSession, folder: str) -> Tables:
    """Tables stored as ``<folder>/<table>`` Parquet, read with their declared layout."""
    return Tables(lambda name: spark.read.schema(SCHEMAS[name]).parquet(f"{folder.rstrip('/')}/{name}"))


def write_snapshot(df: DataFrame, folder: str, name: str) -> None:
    """Store a full new version of a current-state table."""
    df.write.mode("overwrite").parquet(f"{folder.rstrip('/')}/{name}")


def append_history(df: DataFrame, folder: str, name: str, partition_by: Iterable[str] = ()) -> None:
    """Append rows to a history table, usually partitioned by year and month."""
    df.write.mode("append").partitionBy(*partition_by).parquet(f"{folder.rstrip('/')}/{name}")


def replace_partitions(df: DataFrame, folder: str, name: str, partition_by: Iterable[str]) -> None:
    """Rewrite only the partitions present in ``df``, so a re-run of a day or month is idempotent."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    writer.parquet(f"{folder.rstrip('/')}/{name}")
