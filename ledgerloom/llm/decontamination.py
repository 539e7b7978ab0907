"""Benchmark passages in documents, found in a positional inverted index that Spark builds and keeps as a table.

``build_index`` cuts the documents into segments of some SEGMENT_WORDS words, inside the tasks that read them, and
writes for every term of a segment the sorted places of its occurrences, and for every document its place in the
segment. Nothing is shuffled for it, and a hot term is split over segments. ``search`` takes benchmark items in blocks
of at most BLOCK_WORDS words, so what it broadcasts is bounded, and handles any number of blocks. A block's terms
select postings; their counts over all segments order the terms of each window; within a segment, the lists are
intersected from the rarest term on, each shifted by the term's place in the window. An exact match has the window's
words side by side; a proximity match has them in order with at most ``slop`` other words between.

Words: A-Z lower-cased, then runs of 0-9, a-z and characters beyond ASCII. A window is 10 consecutive words of an item;
an item of fewer words, but not none, is one window; an item without words has none. Null texts have no words. A null
item_id counts as the empty string, and items with the same id as one. Rows of documents are judged apart, repeated
rows and null ids too. Empty tables give no matches, or an empty result. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import as_bytes, merged, stage, texts

WINDOW = 10
SLOP = 2
SEGMENT_WORDS = 1_000_000
BLOCK_WORDS = 200_000
GAP = 64

_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or 48 <= c <= 57 or c > 127 else 32 for c in range(256)
)

INDEX = "segment long, term binary, n long, places binary, doc_id long, text_crc long, base long, n_words long"
RESULT = (
    "doc_id long, text_crc long, n_words long, n_hit long, n_items long, items_sha256 string, "
    "contaminated boolean, n_near_items long"
)
_INDEX_ARROW = pa.schema(
    [
        ("segment", pa.int64()),
        ("term", pa.binary()),
        ("n", pa.int64()),
        ("places", pa.binary()),
        ("doc_id", pa.int64()),
        ("text_crc", pa.int64()),
        ("base", pa.int64()),
        ("n_words", pa.int64()),
    ]
)


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_WORDS).split() if text else []


def _segment(number: int, docs: list[tuple], words: list[list[bytes]]) -> Iterator[pa.RecordBatch]:
    """A segment's documents and postings as rows of the index."""
    n = len(docs)
    counts = np.array([len(own) for own in words], np.int64)
    bases = np.cumsum(counts + GAP) - counts - GAP
    empty = pa.nulls(n, pa.binary())
    ids, crcs = zip(*docs, strict=True)
    columns = [pa.array([number] * n), empty, pa.nulls(n, pa.int64()), empty, pa.array(ids, pa.int64())]
    columns += [pa.array(crcs, pa.int64()), pa.array(bases), pa.array(counts)]
    yield pa.RecordBatch.from_arrays(columns, schema=_INDEX_ARROW)
    known: dict[bytes, int] = {}
    flat = [word for own in words for word in own]
    terms = np.fromiter((known.setdefault(word, len(known)) for word in flat), np.int32, len(flat))
    places = (np.arange(len(flat)) + np.repeat(np.arange(n) * GAP, counts)).astype("<i4")
    order = np.argsort(terms, kind="stable")
    often = np.bincount(terms, minlength=len(known))
    data = places[order].tobytes()
    ends = np.cumsum(often)
    names = list(known)
    for at in range(0, len(names), 50_000):
        upto = min(len(names), at + 50_000)
        begin = int(ends[at] - often[at])
        stops = (np.r_[begin, ends[at:upto]] - begin) * 4
        own = data[begin * 4 : int(ends[upto - 1]) * 4]
        lists = pa.Array.from_buffers(
            pa.binary(), upto - at, [None, pa.py_buffer(stops.astype(np.int32)), pa.py_buffer(own)]
        )
        columns = [pa.array([number] * (upto - at)), pa.array(names[at:upto], pa.binary()), pa.array(often[at:upto])]
        columns += [lists, *(pa.nulls(upto - at, pa.int64()) for _ in range(4))]
        yield pa.RecordBatch.from_arrays(columns, schema=_INDEX_ARROW)


def build_index(docs: DataFrame) -> DataFrame:
    """The index as one written table: rows with a term are postings, rows without one are documents."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        own: list[tuple] = []
        words: list[list[bytes]] = []
        held = 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), as_bytes(batch.column("text")), strict=True):
                own.append((doc_id, zlib.crc32(text or b"")))
                words.append(words_of(text))
                held += len(words[-1]) + GAP
                if held >= SEGMENT_WORDS:
                    yield from _segment(number, own, words)
                    number, own, words, held = number + 1, [], [], 0
        if own:
            yield from _segment(number, own, words)

    index = texts(docs).mapInArrow(build, INDEX)
    return stage(docs.sparkSession, "inverted-index").save("postings", index)


def exact_matches(postings: dict[bytes, np.ndarray], window: list[bytes], order: list[int]) -> np.ndarray:
    """Starts of the window, from the rarest term's places on."""
    starts = None
    for k in order:
        places = postings.get(window[k])
        if places is None:
            return np.zeros(0, np.int64)
        if starts is None:
            starts = places - k
            continue
        at = np.searchsorted(places, starts + k)
        starts = starts[places[np.minimum(at, len(places) - 1)] == starts + k]
        if not len(starts):
            break
    return starts


def near_matches(postings: dict[bytes, np.ndarray], window: list[bytes], order: list[int], slop: int):
    """Starts and ends (exclusive) of the shortest runs that hold the window's words in order, with at most slop more."""
    none = np.zeros(0, np.int64)
    if any(word not in postings for word in window):
        return none, none
    first, rare = postings[window[0]], postings[window[order[0]]]
    at = np.searchsorted(rare, first + order[0])
    first = first[(at < len(rare)) & (rare[np.minimum(at, len(rare) - 1)] <= first + order[0] + slop)]
    last = first
    for k, word in enumerate(window[1:], start=1):
        places = postings[word]
        at = np.searchsorted(places, last, side="right")
        fits = at < len(places)
        first, last = first[fits], places[at[fits]]
        fits = last <= first + k + slop
        first, last = first[fits], last[fits]
        if not len(first):
            return none, none
    return first, last + 1


def _blocks(benchmark: DataFrame, item_id: str, text: str) -> Iterator[list[tuple[str, list[bytes]]]]:
    """Items in blocks of at most BLOCK_WORDS words; longer items in pieces that overlap by a window less a word."""
    block, held = [], 0
    rows = benchmark.select(
        F.coalesce(benchmark[item_id].cast("string"), F.lit("")).alias("item"), benchmark[text].alias("text")
    )
    for row in rows.toLocalIterator():
        words = words_of(row["text"].encode()) if row["text"] else []
        for at in range(0, max(1, len(words) - WINDOW + 1), BLOCK_WORDS // 2):
            piece = words[at : at + BLOCK_WORDS // 2 + WINDOW - 1]
            if not piece:
                continue
            if held + len(piece) > BLOCK_WORDS and block:
                yield block
                block, held = [], 0
            block.append((row["item"], piece))
            held += len(piece)
    if block:
        yield block


MATCHES = "segment long, item string, near boolean, start long, stop long"


def search(index: DataFrame, benchmark: DataFrame, item_id: str = "item_id", text: str = "text", slop: int = SLOP):
    """(segment, item, near, start, stop): runs of words in a segment covered by matches of an item's windows."""
    spark = index.sparkSession
    found = spark.createDataFrame([], MATCHES)
    for items in _blocks(benchmark, item_id, text):
        terms = sorted({word for _, words in items for word in words})
        names = spark.createDataFrame([(term,) for term in terms], "of_term binary")
        postings = index.where(F.col("term").isNotNull()).join(F.broadcast(names), F.col("term") == F.col("of_term"))
        often = {bytes(row.term): row.n for row in postings.groupBy("term").agg(F.sum("n").alias("n")).collect()}
        own = postings.select("segment", "term", "places").groupBy("segment").applyInArrow(_finder(items, often, slop), MATCHES)
        found = found.unionByName(own)
    return found


def _finder(items: list[tuple[str, list[bytes]]], often: dict[bytes, int], slop: int):
    """A function from one segment's postings to its matches."""
    windows = []
    for item, words in items:
        size = min(WINDOW, len(words))
        for at in range(len(words) - size + 1):
            window = words[at : at + size]
            order = sorted(range(size), key=lambda k: often.get(window[k], 0))
            if often.get(window[order[0]], 0):
                windows.append((item, window, order))

    def find(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        postings = {
            term: np.frombuffer(places, "<i4").astype(np.int64)
            for term, places in zip(
                table.column("term").to_pylist(), table.column("places").to_pylist(), strict=True
            )
        }
        runs: dict[tuple[str, bool], list[tuple[np.ndarray, np.ndarray]]] = {}
        for item, window, order in windows:
            if window[order[0]] not in postings:
                continue
            starts = exact_matches(postings, window, order)
            if len(starts):
                runs.setdefault((item, False), []).append((starts, starts + len(window)))
            if slop:
                starts, stops = near_matches(postings, window, order, slop)
                if len(starts):
                    runs.setdefault((item, True), []).append((starts, stops))
        rows: dict[str, list] = {name: [] for name in ("item", "near", "start", "stop")}
        for (item, near), parts in runs.items():
            starts, stops = merged(*(np.concatenate(part) for part in zip(*parts, strict=True)))
            rows["item"] += [item] * len(starts)
            rows["near"] += [near] * len(starts)
            rows["start"] += starts.tolist()
            rows["stop"] += stops.tolist()
        segment = table.column("segment")[0].as_py() if table.num_rows else 0
        kinds = (pa.string(), pa.bool_(), pa.int64(), pa.int64())
        columns = [pa.array(values, kind) for values, kind in zip(rows.values(), kinds, strict=True)]
        return pa.Table.from_arrays(
            [pa.array([segment] * len(rows["item"]), pa.int64()), *columns], ["segment", *rows]
        )

    return find


def judge(index: DataFrame, matches: DataFrame) -> DataFrame:
    """Every document with its hit words and the items that occur in it; documents and matches meet by segment."""

    def one(docs: pa.Table, found: pa.Table) -> pa.Table:
        order = np.argsort(docs.column("base").to_numpy(), kind="stable")
        docs = docs.take(pa.array(order)).combine_chunks()
        bases = docs.column("base").to_numpy()
        near, starts, stops = (found.column(name).to_numpy() for name in ("near", "start", "stop"))
        near = near.astype(bool)
        place = np.searchsorted(bases, starts, side="right") - 1
        hits = np.zeros(len(bases), np.int64)
        begin, end = merged(starts[~near], stops[~near])  # documents stand apart, so no run spans two
        np.add.at(hits, np.searchsorted(bases, begin, side="right") - 1, end - begin)
        items: list[set[str]] = [set() for _ in bases]
        close: list[set[str]] = [set() for _ in bases]
        for doc, item, is_near in zip(place.tolist(), found.column("item").to_pylist(), near.tolist(), strict=True):
            (close if is_near else items)[doc].add(item)
        return pa.table(
            {
                "doc_id": docs.column("doc_id"),
                "text_crc": docs.column("text_crc"),
                "n_words": docs.column("n_words"),
                "n_hit": pa.array(hits),
                "n_items": pa.array([len(own) for own in items], pa.int64()),
                "items_sha256": pa.array(
                    [hashlib.sha256(",".join(sorted(own)).encode()).hexdigest() for own in items], pa.string()
                ),
                "contaminated": pa.array(hits > 0),
                "n_near_items": pa.array([len(own) for own in close], pa.int64()),
            }
        )

    docs = index.where(F.col("term").isNull()).select("segment", "doc_id", "text_crc", "base", "n_words")
    return docs.groupBy("segment").cogroup(matches.groupBy("segment")).applyInArrow(one, RESULT)


def decontaminate(docs: DataFrame, benchmark: DataFrame, slop: int = SLOP) -> DataFrame:
    index = build_index(docs)
    return judge(index, search(index, benchmark, slop=slop))


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows without an exact match, with all their columns. Rows are told by id and checksum of the text."""
    bad = decontaminate(docs, benchmark, slop=0).where("contaminated").select("doc_id", "text_crc").distinct()
    bad = bad.select(F.col("doc_id").alias("of_doc"), F.col("text_crc").alias("of_crc"))
    crc = F.crc32(F.coalesce(docs["text"].cast("binary"), F.lit(b"")))
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad.of_doc) & (crc == bad.of_crc), "left_anti")
