"""Removal of repeated passages, found through recompression.

Recompression renames a document's word sequence in rounds. A round first names each maximal run of one symbol, then
parts the symbols in two halves by their name and names each pair of a left symbol and a right one after it. Names are
64-bit hashes of what they stand for, so every task gives equal parts equal names without asking others. For each
symbol the words that its making depended on are known; where those words stand, in whatever document, the symbol
stands. A window of 20 words is put down under a symbol of the highest level at which one depends on no word outside it (of
those the one with most words, then the least name), so equal windows are put down under the same name. Neighbouring windows under one symbol make a stretch.

1. Tasks parse their documents and send one row for each stretch: symbol, hash of the stretch's words, place. Of equal
   stretches in one task only the first needs comparing; the others are repeats already.
2. Rows meet by symbol, sorted. A stretch equal to an earlier one is a repeat throughout. Different stretches under a
   shared symbol may still have some windows in common (the ends of longer repeats): these are looked at singly.
3. The windows of such stretches meet by a 128-bit hash of their 20 words; all but the first are repeats.
4. The repeats' words are removed from the documents.

A symbol that stands alone, as most do, costs one row in step 1. Partitions are read in sorted order with one row kept
back, so a symbol, stretch or window that a third of all rows share needs no memory, and step 1 has cut it to a row
for each task. Places are (doc_id, start), null ids first; windows of rows with the same doc_id and start count as one
place, so repeated rows don't remove each other's words. Documents of fewer than 20 words, empty or null keep all
their words. An empty table gives an empty result. Columns other than those read are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import as_bytes, merged, mix, stage, texts

WINDOW = 20
ROUNDS = 2
CHUNK_WORDS = 200_000
CACHE_WORDS = 400_000
NULL_ID = -(2**63)
REPEAT = -(2**63)  # stands for the hash of a stretch that is a repeat already

_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_RUN, _PAIR, _SIDE = (np.uint64(x) for x in (0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3))
STRETCHES = "symbol long, stretch long, doc long, place long"
FOUND = "repeat boolean, doc long, place long"


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHE_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word, 7)
        return value


_hashes = _Hashes()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))


def _round(name, size, low, high, stop):
    """One round over symbols: names, words, first and last place they depend on, and which are ends of documents."""
    # runs: whether a run ends is known from the symbols on either side
    first = np.flatnonzero(np.r_[True, (name[1:] != name[:-1]) | stop[1:] | stop[:-1]])
    last = np.r_[first[1:], len(name)] - 1
    times = (last - first + 1).astype(np.uint64)
    run, run_size = name[first], np.add.reduceat(size, first)
    run = np.where(times > 1, mix(run ^ (times * _RUN)), run)
    ends = stop[first]
    run_low = np.where(ends, low[first], low[np.maximum(first - 1, 0)])
    run_high = np.where(ends, high[last], high[np.minimum(last + 1, len(name) - 1)])
    # pairs: a left symbol and a right symbol always join, whatever stands around them
    left = (mix(run ^ _SIDE) & np.uint64(1)).astype(bool)
    joins = np.r_[left[:-1] & ~left[1:] & ~ends[:-1] & ~ends[1:], False]
    second = np.r_[False, joins[:-1]]
    after, before = np.r_[run_high[1:], run_high[-1]], np.r_[run_low[0], run_low[:-1]]
    new_low = np.where(joins | left | ends, run_low, before)
    new_high = np.where(joins | (left & ~ends), after, run_high)
    following = np.r_[run[1:], run[-1]]
    new_name = np.where(joins, mix(mix(run + _PAIR) + following), run)
    new_size = run_size + np.where(joins, np.r_[run_size[1:], 0], 0)
    kept = ~second
    return new_name[kept], new_size[kept], new_low[kept], new_high[kept], ends[kept]


def least_in(keys: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Position of the least key in each [start, stop), the first of equal ones; the ranges are short and not empty."""
    places, tables = np.arange(len(keys)), []
    wide = int((stop - start).max(initial=1))
    tables.append(places)
    step = 1
    while 2 * step <= wide:
        held = tables[-1]
        other = held[np.minimum(places + step, len(keys) - 1)]
        tables.append(np.where(keys[other] < keys[held], other, held))
        step *= 2
    power = np.frexp((stop - start).astype(float))[1] - 1
    out = np.zeros(len(start), np.int64)
    for k, table in enumerate(tables):
        own = power == k
        a, b = table[start[own]], table[stop[own] - (1 << k)]
        out[own] = np.where(keys[b] < keys[a], b, a)
    return out


class Parsed:
    """The words of some documents, one after another, with an empty place before, between and after them."""

    def __init__(self, words: list[list[bytes]]):
        self.counts = np.array([len(own) for own in words], np.int64)
        self.begins = np.cumsum(self.counts + 1) - self.counts
        n = int(self.counts.sum()) + len(words) + 1
        self.words = np.zeros(n, np.uint64)
        self.empty = np.ones(n, bool)
        flat = word_hashes([word for own in words for word in own])
        inner = np.arange(len(flat)) + np.repeat(np.arange(len(words)) + 1, self.counts)
        self.words[inner], self.empty[inner] = flat, False
        self._sums: list[tuple[np.ndarray, np.ndarray]] = []
        for base in _BASES:
            powers = np.full(n, base | 1, np.uint64)
            inverse = np.full(n, pow(base | 1, -1, 1 << 64), np.uint64)
            powers[0] = inverse[0] = 1
            powers, inverse = np.multiply.accumulate(powers), np.multiply.accumulate(inverse)
            own = mix(self.words + np.uint64(base >> 1))
            self._sums.append((np.r_[np.uint64(0), np.cumsum(own * powers, dtype=np.uint64)], inverse))

    def hash_of(self, start: np.ndarray, stop: np.ndarray, which: int = 0) -> np.ndarray:
        """A hash of the words in [start, stop), which depends on nothing else."""
        sums, inverse = self._sums[which]
        return mix((sums[stop] - sums[start]) * inverse[start] + (stop - start).astype(np.uint64))

    def levels(self) -> list[tuple[np.ndarray, ...]]:
        """(name, words, first place, last place) of the symbols of each level."""
        name, stop = mix(self.words), self.empty
        low = high = np.arange(len(name))
        size = np.ones(len(name), np.int64)
        out = [(name, size, low, high)]
        for _ in range(ROUNDS):
            name, size, low, high, stop = _round(name, size, low, high, stop)
            out.append((name, size, low, high))
        return out

    def stretches(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(symbol, first window, number of windows) of each stretch."""
        n = len(self.words)
        ends = np.cumsum(self.empty)
        start = np.flatnonzero((ends[WINDOW - 1 :] - np.r_[0, ends[: n - WINDOW]] == 0) if n >= WINDOW else [])
        if not len(start):
            return np.zeros(0, np.uint64), start, start
        symbol, which = np.zeros(len(start), np.uint64), np.full(len(start), -1)
        open_ = np.arange(len(start))
        offset = 0
        for level, (name, size, low, high) in reversed(list(enumerate(self.levels()))):
            begin = start[open_]
            # symbols are in order of their first and of their last places
            at = np.r_[0, np.cumsum(np.bincount(low, minlength=n))][begin]
            past = np.cumsum(np.bincount(high, minlength=n))[begin + WINDOW - 1]
            inside = past > at
            name = mix(name + np.uint64(level))
            keys = name >> np.uint64(3) | (7 - np.minimum(size, 7)).astype(np.uint64) << np.uint64(61)
            best = least_in(keys, at[inside], past[inside])
            own = open_[inside]
            symbol[own], which[own] = name[best], offset + best
            open_, offset = open_[~inside], offset + len(name)
            if not len(open_):
                break
        new = np.r_[True, (which[1:] != which[:-1]) | (start[1:] != start[:-1] + 1)]
        first = np.flatnonzero(new)
        return symbol[first], start[first], np.diff(np.r_[first, len(start)])


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[dict], list[list[bytes]]]]:
    """Rows in parts of about CHUNK_WORDS words; one text may be longer."""
    for batch in batches:
        rows, words, held = [], [], 0
        others = batch.drop_columns(["text"]).to_pylist()
        for row, text in zip(others, as_bytes(batch.column("text")), strict=True):
            row["crc"] = zlib.crc32(text or b"")
            row["doc"] = NULL_ID if row["doc_id"] is None else row["doc_id"]
            rows.append(row)
            words.append(text.split() if text else [])
            held += len(words[-1])
            if held >= CHUNK_WORDS:
                yield rows, words
                rows, words, held = [], [], 0
        if rows:
            yield rows, words


def _places(parsed: Parsed, rows: list[dict], start: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """doc, and start, text's checksum and number of windows in one long (sorted by it: by start)."""
    of = np.searchsorted(parsed.begins, start, side="right") - 1
    docs = np.array([row["doc"] for row in rows], np.int64)
    crcs = np.array([row["crc"] >> 5 for row in rows], np.int64)
    return docs[of], (start - parsed.begins[of]) << 32 | crcs[of] << 5 | count


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def find_stretches(docs: DataFrame) -> DataFrame:
    """Step 1. Of equal stretches of a chunk, all but the first go out under a name of their own, marked REPEAT."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, words in _chunks(batches):
            parsed = Parsed(words)
            symbol, start, count = parsed.stretches()
            stretch = parsed.hash_of(start, start + count + WINDOW - 1).view(np.int64)
            stretch = np.where(stretch == REPEAT, 0, stretch)
            doc, place = _places(parsed, rows, start, count)
            order = np.lexsort((place, doc, stretch, symbol))
            symbol, stretch, doc, place = symbol[order], stretch[order], doc[order], place[order]
            again = np.r_[False, (symbol[1:] == symbol[:-1]) & (stretch[1:] == stretch[:-1])] if len(doc) else []
            again = np.array(again, bool)
            first = np.maximum.accumulate(np.where(again, 0, np.arange(len(doc)))) if len(doc) else order
            again &= (doc != doc[first]) | (place >> 32 != place[first] >> 32)  # the same place is no repeat
            symbol = np.where(again, mix(doc.view(np.uint64) ^ mix(place.view(np.uint64))), symbol)
            stretch = np.where(again, REPEAT, stretch)
            yield pa.RecordBatch.from_arrays(
                [_signed(symbol), pa.array(stretch), pa.array(doc), pa.array(place)],
                ["symbol", "stretch", "doc", "place"],
            )

    return texts(docs).mapInArrow(find, STRETCHES)


def compare_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 2, over rows sorted by symbol, stretch, doc and place: repeats, and stretches to be looked at singly."""
    held: np.ndarray | None = None  # rows (symbol, stretch, doc, place, done) of the symbol that the last batch ended with
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.stack([batch.column(k).to_numpy() for k in range(4)] + [np.zeros(batch.num_rows, np.int64)], axis=1)
        if held is not None:
            rows = np.r_[held, rows]
        symbol, stretch, doc, place, done = rows.T
        new_symbol = np.r_[True, symbol[1:] != symbol[:-1]]
        new_stretch = new_symbol | np.r_[True, stretch[1:] != stretch[:-1]]
        first = np.maximum.accumulate(np.where(new_stretch, np.arange(len(rows)), 0))
        repeat = (doc > doc[first]) | ((doc == doc[first]) & (place >> 32 > place[first] >> 32))
        repeat |= stretch == REPEAT
        group = np.cumsum(new_symbol) - 1
        several = (np.bincount(group, new_stretch) > 1)[group]
        out = (done == 0) & (repeat | several)
        yield pa.RecordBatch.from_arrays(
            [pa.array(repeat[out]), pa.array(doc[out]), pa.array(place[out])], ["repeat", "doc", "place"]
        )
        tail = np.flatnonzero(group == group[-1])
        kept = tail[(first[tail] == first[-1]) & ~repeat[tail]]
        if several[-1]:  # one row of another stretch keeps it known that there are several
            kept = np.r_[tail[:1], kept] if first[tail[0]] != first[-1] else kept
        held = rows[kept].copy()
        held[:, 4] |= several[-1]


def find_windows(docs: DataFrame) -> DataFrame:
    """Step 3: single windows of the stretches in column ``places``, by two hashes of their words."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, words in _chunks(batches):
            parsed = Parsed(words)
            starts = []
            for begin, row in zip(parsed.begins, rows, strict=True):
                for place in row["places"]:
                    at = int(begin) + (place >> 32)
                    starts.append(np.arange(at, at + (place & 31)))
            start = np.unique(np.concatenate(starts)) if starts else np.zeros(0, np.int64)
            doc, place = _places(parsed, rows, start, np.ones(len(start), np.int64))
            hashes = [_signed(parsed.hash_of(start, start + WINDOW, k)) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                [*hashes, pa.array(doc), pa.array(place)], ["symbol", "stretch", "doc", "place"]
            )

    return docs.mapInArrow(find, STRETCHES)


def _by_document(found: DataFrame) -> DataFrame:
    """Places of each document (told by id and checksum, as ids may repeat)."""
    crc = F.shiftright(F.col("place").bitwiseAND(F.lit(0xFFFFFFFF)), 5)
    named = found.select(F.col("doc").alias("of_doc"), crc.alias("of_crc"), "place")
    return named.groupBy("of_doc", "of_crc").agg(F.collect_list("place").alias("places"))


def _with_places(docs: DataFrame, found: DataFrame, how: str) -> DataFrame:
    own = texts(docs)
    doc = F.coalesce("doc_id", F.lit(NULL_ID))
    crc = F.shiftright(F.crc32(F.coalesce(own.text.cast("binary"), F.lit(b""))), 5)
    places = _by_document(found)
    joined = own.join(places, (doc == places.of_doc) & (crc == places.of_crc), how)
    return joined.select("doc_id", "text", "places")


def repeats(docs: DataFrame) -> DataFrame:
    """(repeat, doc, place): the stretches and windows whose words also start earlier."""
    held = stage(docs.sparkSession, "substrings")
    keys = ("symbol", "stretch", "doc", "place")
    dealt = find_stretches(docs).repartition("symbol").sortWithinPartitions(*keys)
    found = held.save("stretches", dealt.mapInArrow(compare_sorted, FOUND))
    windows = find_windows(_with_places(docs, found.where("NOT repeat"), "inner"))
    dealt = windows.repartition("symbol", "stretch").sortWithinPartitions(*keys)
    again = held.save("windows", dealt.mapInArrow(compare_sorted, FOUND).where("repeat"))
    return found.where("repeat").unionByName(again)


def covered(places: list[int], n: int) -> np.ndarray:
    """Which of a document's n words lie in the windows at these places."""
    at = np.array(places, np.int64)
    starts, stops = merged(at >> 32, (at >> 32) + (at & 31) + WINDOW - 1)
    gone = np.zeros(n + 1, np.int64)
    gone[starts] += 1
    gone[stops] -= 1
    return np.cumsum(gone[:-1]).astype(bool)


RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string, text_crc long"


def remove_repeats(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """Each row's words without the repeats; kept_text is null where nothing is removed (or texts aren't asked for)."""

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: dict[str, list] = {name: [] for name in ("n_words", "n_removed", "sha", "kept", "crc")}
            for text, places in zip(as_bytes(batch.column("text")), batch.column("places").to_pylist(), strict=True):
                words = text.split() if text else []
                n, kept = len(words), None
                if places:
                    gone = covered(places, n)
                    words = [word for word, out in zip(words, gone.tolist(), strict=True) if not out]
                joined = b" ".join(words)
                if len(words) < n and with_text:
                    kept = joined.decode()
                rows["n_words"].append(n)
                rows["n_removed"].append(n - len(words))
                rows["sha"].append(hashlib.sha256(joined).hexdigest())
                rows["kept"].append(kept)
                rows["crc"].append(zlib.crc32(text or b""))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            columns = [pa.array(values, kind) for values, kind in zip(rows.values(), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *columns],
                ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text", "text_crc"],
            )

    return _with_places(docs, repeats(docs), "left").mapInArrow(remove, RESULT)


def cut_column(text, places):
    """A text without the words at these places, joined by single spaces; unchanged where there are none."""

    @F.arrow_udf("string")
    def cut(texts: pa.Array, places: pa.Array) -> pa.Array:
        out = []
        for text, own in zip(as_bytes(texts), places.to_pylist(), strict=True):
            if own and text:
                words = text.split()
                gone = covered(own, len(words)).tolist()
                text = b" ".join([word for word, out_ in zip(words, gone, strict=True) if not out_])
            out.append(None if text is None else text.decode())
        return pa.array(out, pa.string())

    return cut(text.cast("string"), places)


def cut_repeats(docs: DataFrame) -> DataFrame:
    """All rows and columns, with the repeats' words out of ``text`` and ``n_chars`` (where there is one) put right.

    A text that loses no word stays as it is, white space included; one that loses all of them becomes empty.
    """
    places = _by_document(repeats(docs))
    doc = F.coalesce(docs["doc_id"], F.lit(NULL_ID))
    crc = F.shiftright(F.crc32(F.coalesce(docs["text"].cast("binary"), F.lit(b""))), 5)
    joined = docs.join(places, (doc == places.of_doc) & (crc == places.of_crc), "left")
    columns = [
        cut_column(docs["text"], places.places).alias("text") if name == "text" else docs[name]
        for name in docs.columns
    ]
    out = joined.select(*columns)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(kind))
    return out
