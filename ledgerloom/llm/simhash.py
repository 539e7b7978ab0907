"""SimHash near-duplicates by anchor points of covering codes.

Fingerprints have 64 bits and link at MAX_BITS (4) or fewer differing bits. The bits are three blocks of 23, 23 and 18.
Two linked fingerprints differ in at most 2 bits outside the block in which they differ most, so anchors are chosen
for each pair of blocks, with threshold 2. The anchors of a pair are the words of a covering code: the perfect Golay
code [23, 12] (covering radius 3) on a block of 23 bits; on the block of 18, the perfect Hamming code [15, 11]
(covering radius 1) and all values of the other 3 bits (radius 0). Halfway between two fingerprints at distance 2 lies
a point that has an anchor within the covering radii and is 1 from either. So both sides go to every anchor within
the radii plus half the threshold, that is 1 in one of the codes, and meet at one of them: some 10 to 15 anchors of
2^24 to 2^26 for each pair of blocks, where one-sided replication with the whole threshold would need 60.

Only different fingerprints are replicated, so copies of a text cost one. Rows meet by anchor in sorted partitions; an
anchor's fingerprints are linked by search from one to the next among those not yet reached, and each group leaves one
edge per fingerprint. An anchor with more than LARGE fingerprints is first cut by five blocks of bits, one of which
two linked fingerprints share. Components then come from these edges.

A text without words (null, empty, blank) has fingerprint zero and links like any other. A null doc_id links, but
names no component; a group of such rows alone has a null component_id. Repeated rows link to each other. An empty
table gives an empty result. Columns other than the two read are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import as_bytes, stage, texts
from ledgerloom.llm.components import components

SHINGLE, SEED, MAX_BITS = 4, 42, 4
LARGE = 4096
#: Generator polynomials: x^11+x^9+x^7+x^6+x^5+x+1 and x^4+x+1.
GOLAY, HAMMING = (23, 0b101011100011), (15, 0b10011)


def fingerprint(text: bytes | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    words = text.lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, seed)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - shingle + 1].tolist()
    ends = ends[shingle - 1 :].tolist()
    n, ones, digest = len(starts), np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, n, 65_536):
        hashes = [digest(joined[a:b], seed) for a, b in zip(starts[at : at + 65_536], ends[at : at + 65_536], strict=True)]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """doc_id and the fingerprint as a signed long, for each row."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(text, shingle, seed) for text in as_bytes(batch.column("text"))]
            signed = np.array(found, np.uint64).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(signed)], ["doc_id", "fp"])

    return texts(docs).mapInArrow(make, "doc_id long, fp long")


@cache
def code(bits: int, generator: int, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """A cyclic perfect code: the syndrome of each bit, and by syndrome the errors of up to radius + 1 bits.

    Of the errors, those of at most ``radius`` bits come first: there is one for each syndrome, as the code is perfect.
    """
    degree = generator.bit_length() - 1
    of_bit, x = [], 1
    for _ in range(bits):
        of_bit.append(x)
        x <<= 1
        if x >> degree:
            x ^= generator
    near: list[list[int]] = [[] for _ in range(1 << degree)]
    for weight in range(radius + 2):
        for places in combinations(range(bits), weight):
            syndrome = 0
            for place in places:
                syndrome ^= of_bit[place]
            near[syndrome].append(sum(1 << place for place in places))
    counts = np.array([len(own) for own in near])
    errors = np.array([error for own in near for error in own], np.int64)
    return np.array(of_bit, np.int64), errors, np.r_[0, np.cumsum(counts)], degree


def anchors(values: np.ndarray, which: tuple[int, int], radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, anchor, extra): each value's anchors within the radius (extra 0) and one further (extra 1)."""
    of_bit, errors, starts, degree = code(*which, radius)
    syndrome = np.zeros(len(values), np.int64)
    for k, own in enumerate(of_bit):
        syndrome ^= np.where(values >> k & 1, own, 0)
    first, counts = starts[syndrome], starts[syndrome + 1] - starts[syndrome]
    row = np.repeat(np.arange(len(values)), counts)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    error = errors[np.repeat(first, counts) + nth]
    return row, (values[row] ^ error) >> degree, (nth > 0).astype(np.int64)


def _block_anchors(fps: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, anchor, extra) of the three blocks."""
    out = [anchors((fps >> np.uint64(at) & np.uint64((1 << 23) - 1)).astype(np.int64), GOLAY, 3) for at in (0, 23)]
    last = (fps >> np.uint64(46)).astype(np.int64)
    row, anchor, extra = anchors(last & 0x7FFF, HAMMING, 1)
    free = last[row] >> 15
    rows, names, extras = [row], [anchor << 3 | free], [extra]
    home = extra == 0
    for bit in range(3):
        rows.append(row[home])
        names.append(anchor[home] << 3 | free[home] ^ 1 << bit)
        extras.append(np.ones(home.sum(), np.int64))
    out.append((np.concatenate(rows), np.concatenate(names), np.concatenate(extras)))
    return out


def replicas(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key): every anchor of every pair of blocks that a fingerprint goes to."""
    blocks = _block_anchors(fps)
    rows, keys = [], []
    for tag, (a, b) in enumerate(((0, 1), (0, 2), (1, 2))):
        own = blocks[a], blocks[b]
        homes = [np.empty(len(fps), np.int64) for _ in own]
        for home, (row, anchor, extra) in zip(homes, own, strict=True):
            home[row[extra == 0]] = anchor[extra == 0]
        row, anchor, extra = own[0]
        rows.append(row)
        keys.append(tag << 40 | anchor << 20 | homes[1][row])
        row, anchor, extra = own[1]
        row, anchor = row[extra == 1], anchor[extra == 1]
        rows.append(row)
        keys.append(tag << 40 | homes[0][row] << 20 | anchor)
    return np.concatenate(rows), np.concatenate(keys)


def link(fps: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Positions (first of a group, other): one edge for each fingerprint reached from an earlier one."""
    edges, left = [], np.arange(len(fps))
    while len(left) > 1:
        seed, left = left[0], left[1:]
        frontier = [seed]
        while frontier and len(left):
            near = np.bitwise_count(fps[left] ^ fps[frontier.pop()]) <= most
            if near.any():
                reached, left = left[near].tolist(), left[~near]
                frontier += reached
                edges += [(seed, other) for other in reached]
    return edges


def link_large(fps: np.ndarray, most: int) -> list[tuple[int, int]]:
    """The same groups, with only fingerprints compared that share one of most + 1 blocks of bits."""
    edges, bounds = [], np.linspace(0, 64, most + 2).astype(int)
    for low, high in zip(bounds, bounds[1:], strict=False):
        part = fps >> np.uint64(low) & np.uint64((1 << int(high - low)) - 1)
        order = np.argsort(part, kind="stable")
        cuts = np.flatnonzero(np.diff(part[order])) + 1
        for own in np.split(order, cuts):
            if len(own) > 1:
                edges += [(own[a], own[b]) for a, b in link(fps[own], most)]
    return edges


def _edges_by_anchor(most: int):
    """From rows (key, fp) sorted by key to edges (a, b); a key's rows may span batches."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps = np.zeros(0, np.int64), np.zeros(0, np.int64)
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def finish(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
            starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
            sizes = np.diff(np.r_[starts, len(keys)])
            two = starts[sizes == 2]
            own = fps.view(np.uint64)
            two = two[np.bitwise_count(own[two] ^ own[two + 1]) <= most]
            a, b = [fps[two]], [fps[two + 1]]
            for start, size in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
                some = own[start : start + size]
                edges = (link if size <= LARGE else link_large)(some, most)
                if edges:
                    left, right = np.array(edges).T
                    a.append(fps[start + left])
                    b.append(fps[start + right])
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append((batch.column("key").to_numpy(), batch.column("fp").to_numpy()))
            if held[0][0][0] == held[-1][0][-1]:  # one key so far: wait for its end
                continue
            keys, fps = (np.concatenate(part) for part in zip(*held, strict=True))
            last = np.searchsorted(keys, keys[-1])
            held = [(keys[last:], fps[last:])]
            yield finish(keys[:last], fps[:last])
        if held:
            yield finish(*(np.concatenate(part) for part in zip(*held, strict=True)))

    return find


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, most: int = MAX_BITS) -> DataFrame:
    """doc_id, fp and component_id for every row."""
    if most != MAX_BITS:
        raise ValueError(f"the anchors are chosen for {MAX_BITS} differing bits")
    held = stage(docs.sparkSession, "simhash")
    marked = held.save("fingerprints", fingerprints(docs, shingle))
    distinct = held.save("distinct", marked.groupBy("fp").agg(F.min("doc_id").alias("least_doc")))

    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column("fp").to_numpy()
            for at in range(0, len(fps), 4096):
                some = fps[at : at + 4096]
                row, key = replicas(some.view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(some[row])], ["key", "fp"])

    dealt = distinct.select("fp").mapInArrow(replicate, "key long, fp long")
    dealt = dealt.repartition("key").sortWithinPartitions("key")
    edges = held.save("edges", dealt.mapInArrow(_edges_by_anchor(most), "a long, b long").distinct())
    roots = components(edges)
    named = distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "least_doc", F.coalesce("root", "fp").alias("root")
    )
    named = held.save("roots", named)
    least = named.groupBy(F.col("root").alias("of_root")).agg(F.min("least_doc").alias("component_id"))
    by_fp = named.join(least, named.root == least.of_root).select(F.col("fp").alias("of_fp"), "component_id")
    return marked.join(by_fp, marked.fp == by_fp.of_fp).select("doc_id", "fp", "component_id")


def as_hex(fp):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, most: int = MAX_BITS) -> DataFrame:
    """The row with the smallest doc_id of each group, with all its columns.

    Of repeated rows with that doc_id one stays. Rows with a null doc_id can't be named by a result; they all stay.
    """
    found = near_duplicates(docs, shingle, most)
    kept = found.where(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias("of_doc")).distinct()
    rows = docs.join(kept, docs["doc_id"] == kept.of_doc, "left_semi")
    nr = "".join(docs.columns) + "_nr"  # a name that no column has
    ranked = rows.withColumn(nr, F.row_number().over(Window.partitionBy("doc_id").orderBy("text")))
    return ranked.where(F.col(nr) == 1).drop(nr).unionByName(docs.where(docs["doc_id"].isNull()))
