"""Statistics of whole texts, and the labelled rows that quality models are fitted on.

A word is a run of characters other than space and \\t to \\r. A null text has no words and no lines; every count of it
is 0. Counts are exact for texts of any length. A text's own words are held in memory, nothing across texts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import as_bytes, texts

SYMBOLS = b"#*$%&|<>"
COUNTS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_distinct",
    "n_upper",
    "n_digits",
    "n_marks",
    "n_stops",
    "n_bytes",
)
SCHEMA = "doc_id long, " + ", ".join(f"{name} long" for name in COUNTS)
FEATURES = (
    "log_words",
    "word_length",
    "symbol_share",
    "dup_line_share",
    "repeat_share",
    "distinct_share",
    "upper_share",
    "digit_share",
    "mark_share",
    "stop_share",
    "words_per_line",
    "wide_share",
)
#: Labelled rows that a model is fitted on at most: those with the smallest hash of doc_id.
SAMPLE_ROWS = 20_000

_CONTINUED = bytes(range(0x80, 0xC0))
_UPPER = bytes(range(65, 91))
_DIGITS = b"0123456789"


def _count(text: bytes, of: bytes) -> int:
    return len(text) - len(text.translate(None, of))


def repeat_words(words: list[bytes]) -> int:
    """Words that lie in a window of three words found twice or more."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    times = Counter(windows)
    covered = np.zeros(len(words), bool)
    at = np.flatnonzero(np.fromiter((times[w] > 1 for w in windows), bool, len(windows)))
    for k in range(3):
        covered[at + k] = True
    return int(covered.sum())


def count_text(text: bytes | None) -> tuple[int, ...]:
    """The numbers named in COUNTS."""
    if not text:
        return (0,) * len(COUNTS)
    words = text.split()
    joined = b"".join(words)
    lines = [line for line in text.split(b"\n") if line and not line.isspace()]
    return (
        len(words),
        len(joined.translate(None, _CONTINUED)),
        _count(text, SYMBOLS),
        len(lines) - len(set(lines)),
        repeat_words(words),
        len(lines),
        len(set(words)),
        _count(joined, _UPPER),
        _count(joined, _DIGITS),
        _count(joined, b"!?"),
        _count(joined, b".,;:"),
        len(joined),
    )


def document_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the counts of each row's whole text; repeated rows and null ids stay."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array([count_text(text) for text in as_bytes(batch.column("text"))], np.int64)
            rows = rows.reshape(-1, len(COUNTS))
            columns = [pa.array(np.ascontiguousarray(rows[:, k])) for k in range(len(COUNTS))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", *COUNTS])

    return texts(docs).mapInArrow(count, SCHEMA)


def features(batch: pa.RecordBatch) -> np.ndarray:
    """Ratios of the counts, in the order of FEATURES. A text without words has zeros."""
    c = {name: batch.column(name).to_numpy(zero_copy_only=False).astype(float) for name in COUNTS}
    words, chars, lines = (np.maximum(c[name], 1) for name in ("n_words", "word_chars", "n_lines"))
    return np.stack(
        [
            np.log1p(c["n_words"]),
            c["word_chars"] / words,
            c["n_symbols"] / chars,
            c["n_dup_lines"] / lines,
            c["n_repeat_words"] / words,
            c["n_distinct"] / words,
            c["n_upper"] / chars,
            c["n_digits"] / chars,
            c["n_marks"] / chars,
            c["n_stops"] / words,
            np.log1p(c["n_words"] / lines),
            (c["n_bytes"] - c["word_chars"]) / chars,
        ],
        axis=1,
    )


def labelled(statistics: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """Statistics of rows that have a label 0 or 1, as column ``label``; a document labelled more than once counts once."""
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
        .groupBy(F.col("doc_id").alias("of_doc"))
        .agg(F.max(label).cast("int").alias("label"))
    )
    return statistics.join(known, statistics.doc_id == known.of_doc).drop("of_doc")


def sample_rows(rows: DataFrame, n: int = SAMPLE_ROWS) -> DataFrame:
    """A bounded sample: the rows with the smallest hash of doc_id."""
    return rows.orderBy(F.xxhash64("doc_id")).limit(n)


def to_matrix(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of a bounded number of rows."""
    table = rows.select(*COUNTS, "label").toArrow().combine_chunks()
    if not table.num_rows:
        return np.zeros((0, len(FEATURES))), np.zeros(0)
    batch = table.to_batches()[0]
    return features(batch), batch.column("label").to_numpy(zero_copy_only=False).astype(float)
