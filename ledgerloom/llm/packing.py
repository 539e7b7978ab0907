"""Packing documents into sequences of a fixed length by minimum bin slack.

Documents are encoded, longer ones cut, and the pieces counted by length: at most ``capacity`` different lengths,
however many pieces there are. Bins are planned over these counts alone. For each bin the longest piece left is taken
and a bitset subset-sum over the lengths left finds the fullest combination that fits with it, which is then removed.
The same combination stays the fullest until one of its lengths runs out, so it is used that many times at once: a
plan has about as many combinations as there are lengths. Pieces then get numbers within their length, from counts of
(length, bucket), and look up their place; a length that a third of all pieces have is spread over all buckets.

A null text counts as empty. Every row is packed, repeated rows and rows with null doc_id too. An empty table gives
an empty result. Columns other than the two read are ignored. A long text's ids are in one task's memory at once.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import small_batches, stage, texts
from ledgerloom.llm.tokens import encoder

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECES + ", sequence_id long, offset long"


def pieces(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = 2048) -> DataFrame:
    """The pieces of each document; only a document's first piece may be shorter than the capacity if it is cut."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer).encode, int(end_id).to_bytes(4, "little")
        for batch in small_batches(batches):
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = encode(text) + end
                n = len(ids) // 4
                start, stop = 0, n - (n - 1) // capacity * capacity
                for piece in range((n - 1) // capacity + 1):
                    rows.append((doc_id, piece, start, stop - start, zlib.crc32(ids[start * 4 : stop * 4])))
                    start, stop = stop, stop + capacity
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return texts(docs).mapInArrow(cut, PIECES)


def fullest(lengths: list[int], counts: dict[int, int], room: int) -> dict[int, int]:
    """How many of each length fill ``room`` best. lengths: those left, longest first."""
    reach, before, mask = 1, [], (1 << (room + 1)) - 1
    for length in lengths:
        if length > room or not counts[length]:
            continue
        before.append((length, reach))
        left, step = min(counts[length], room // length), 1
        while left:  # 1, 2, 4, ... copies, then the rest: every number of copies up to all
            take = min(step, left)
            reach |= (reach << (take * length)) & mask
            left, step = left - take, step * 2
        if reach >> room & 1:
            break
    target, chosen = reach.bit_length() - 1, {}
    for length, without in reversed(before):
        copies = 0
        while not without >> target & 1:
            target, copies = target - length, copies + 1
        if copies:
            chosen[length] = copies
    return chosen


def plan_bins(histogram: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """(combination, times used) until no piece is left."""
    counts = {length: n for length, n in histogram.items() if n}
    lengths = sorted(counts, reverse=True)
    out = []
    while lengths:
        seed = lengths[0]
        counts[seed] -= 1
        chosen = fullest(lengths, counts, capacity - seed)
        counts[seed] += 1
        chosen[seed] = chosen.get(seed, 0) + 1
        times = min(counts[length] // n for length, n in chosen.items())
        for length, n in chosen.items():
            counts[length] -= n * times
        lengths = [length for length in lengths if counts[length]]
        out.append((chosen, times))
    return out


def places(plan: list[tuple[dict[int, int], int]]) -> np.ndarray:
    """Rows (length, first number, first bin, pieces of this length in a bin, offset) by length and first number."""
    used: dict[int, int] = {}
    rows, bins = [], 0
    for chosen, times in plan:
        offset = 0
        for length, n in sorted(chosen.items(), reverse=True):
            rows.append((length, used.get(length, 0), bins, n, offset))
            used[length] = used.get(length, 0) + n * times
            offset += length * n
        bins += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def numbered(found: DataFrame, buckets: int) -> DataFrame:
    """A number from 0 within each length, without bringing a length's pieces to one task."""
    dealt = found.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32"), F.lit(buckets)))
    counts = dealt.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(
        F.col("length").alias("of_length"),
        F.col("bucket").alias("of_bucket"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"),
    )
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = dealt.withColumn("rank", F.row_number().over(within) - 1)
    joined = ranked.join(bases, (F.col("length") == F.col("of_length")) & (F.col("bucket") == F.col("of_bucket")))
    return joined.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("rank")).alias("nr"))


def pack(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = 2048) -> DataFrame:
    """Each piece with its sequence and offset."""
    spark = docs.sparkSession
    found = stage(spark, "packing").save("pieces", pieces(docs, tokenizer, end_id, capacity))
    histogram = {row["length"]: row["n"] for row in found.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    table = places(plan_bins(histogram, capacity))  # its size follows from the capacity, not from the data
    buckets = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = table[:, 0] << 44 | table[:, 1]
        for batch in batches:
            length, nr = (batch.column(name).to_numpy() for name in ("length", "nr"))
            row = table[np.searchsorted(keys, length << 44 | nr, side="right") - 1] if len(nr) else table[:0]
            in_bin, slot = np.divmod(nr - row[:, 1], np.maximum(row[:, 3], 1))
            kept = [batch.column(name) for name in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(row[:, 2] + in_bin), pa.array(row[:, 4] + slot * length)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return numbered(found, buckets).mapInArrow(put, PACKED)
