"""Small helpers shared by the text operators: words, staged tables, Arrow columns, interval arithmetic."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.sources.staging import Stage

# A-Z to a-z, all else unchanged; bytes.lower() does the same inside tasks
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def ascii_lower(column):
    return F.translate(column, UPPER, LOWER)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package to the executors of an application, once; they need not share the driver's import path."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    packed = Path(tempfile.mkdtemp(prefix="ledgerloom-package-")) / "ledgerloom.zip"  # the driver serves it from here
    with zipfile.ZipFile(packed, "w") as out:
        for path in root.rglob("*.py"):
            out.write(path, path.relative_to(root.parent))
    context.addPyFile(str(packed))
    _shipped.add(context.applicationId)


def stage(spark: SparkSession, label: str) -> Stage:
    """A new folder for one run below the cluster's shared folder."""
    ship(spark)
    return Stage(spark, label)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Only the two columns an operator reads, so that no further column can clash."""
    return docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].cast("string").alias("text"))


def as_bytes(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column; bytes.split() splits them at ASCII white space alone."""
    if pa.types.is_string(column.type):
        column = column.cast(pa.binary())
    elif pa.types.is_large_string(column.type):
        column = column.cast(pa.large_binary())
    return column.to_pylist()


def small_batches(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows in slices, so that what is made from one batch stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Half-open intervals, joined where they touch or overlap."""
    if len(starts) == 0:
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    first = np.r_[True, starts[1:] > reach[:-1]]
    return starts[first], reach[np.r_[np.flatnonzero(first)[1:] - 1, len(starts) - 1]]


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit values (the finaliser of MurmurHash3)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))
