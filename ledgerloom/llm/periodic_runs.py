"""Periodic stretches of words: block convolution at dyadic scales.

A run is a stretch of consecutive words with smallest period q, long enough (``min_length`` words and ``min_periods``
periods, three at least) and not to be extended by a neighbouring word. Texts become numbers, one for each different
word of a text, and the texts of a batch stand one after the other. At scale B all positions are cut in blocks of B
words; a run whose period lies in [B, 2B) holds a whole block and, one period later, its copy. For each block the
sums of squared differences to the words at every distance in [B, 2B) come from one exact integer convolution, by a
number-theoretic transform over as many primes as the largest possible sum needs. A zero is an occurrence without
mismatch; its distance seeds an extension word by word, which gives the maximal stretch and decides its smallest
period. The smallest scale, 8, also takes the distances below 8. Seeds inside a stretch that is already known to have
a divisor of their distance as period are part of that stretch.

Null and empty texts have no words and no runs. Each row is judged alone, repeated rows and rows with null doc_id too.
Texts are read whole; a task holds the words of some BATCH_WORDS words of texts, or one longer text, and transforms
BLOCK_VALUES numbers at a time. An empty table gives an empty result. Columns other than the two read are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerloom.llm.common import as_bytes, texts

BATCH_WORDS = 60_000
BLOCK_VALUES = 1 << 18
SMALLEST = 8
# (prime, generator): each prime is below 2^30 and one more than a multiple of 2^25 or 2^23
PRIMES = ((998244353, 3), (469762049, 3), (167772161, 3))

RESULT = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs array<struct<start: long, length: long, period: long>>, runs_sha256 string, collapsed_sha256 string"
)
STRETCH = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

_roots: dict[tuple[int, int], tuple[list[np.ndarray], list[np.ndarray]]] = {}


def blank_words(doc_id: int | None, text: bytes | None) -> list[bytes]:
    """The words of a text: all between ASCII white space."""
    return text.split() if text else []


def _mod(x: np.ndarray, prime: int) -> np.ndarray:
    """x mod prime; division by a constant is faster in numpy than the remainder."""
    p = np.uint64(prime)
    return x - x // p * p


def _powers(root: int, count: int, prime: int) -> np.ndarray:
    out = np.ones(count, dtype=np.uint64)
    done, step = 1, root
    while done < count:
        take = min(done, count - done)
        out[done : done + take] = out[:take] * np.uint64(step) % np.uint64(prime)
        done, step = done + take, step * step % prime
    return out


def _twiddles(size: int, prime: int, generator: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Powers of the roots of unity of size, size/2, ... and of their inverses."""
    if (size, prime) not in _roots:
        there, back, n = [], [], size
        while n > 1:
            root = pow(generator, (prime - 1) // n, prime)
            there.append(_powers(root, n // 2, prime))
            back.append(_powers(pow(root, prime - 2, prime), n // 2, prime))
            n //= 2
        _roots[size, prime] = there, back
    return _roots[size, prime]


def transform(x: np.ndarray, prime: int, generator: int) -> np.ndarray:
    """The transform along the first axis, in bit-reversed order. Values below the prime, as unsigned 64-bit numbers."""
    size, columns = x.shape
    p = np.uint64(prime)
    for roots in _twiddles(size, prime, generator)[0]:
        h = len(roots)
        pairs = x.reshape(-1, 2, h, columns)
        total = _mod(pairs[:, 0] + pairs[:, 1], prime)
        other = _mod((pairs[:, 0] + (p - pairs[:, 1])) * roots[:, None], prime)
        x = np.stack([total, other], axis=1).reshape(size, columns)
    return x


def inverse(x: np.ndarray, prime: int, generator: int) -> np.ndarray:
    """What ``transform`` was given, from its bit-reversed result."""
    size, columns = x.shape
    p = np.uint64(prime)
    for roots in reversed(_twiddles(size, prime, generator)[1]):
        h = len(roots)
        pairs = x.reshape(-1, 2, h, columns)
        other = _mod(pairs[:, 1] * roots[:, None], prime)
        x = np.stack([pairs[:, 0] + other, pairs[:, 0] + (p - other)], axis=1).reshape(size, columns)
        x = _mod(x, prime)
    return _mod(x * np.uint64(pow(size, prime - 2, prime)), prime)


def correlation(blocks: np.ndarray, windows: np.ndarray, largest: int) -> np.ndarray:
    """sum over i of blocks[i] * windows[i + j], cyclic in the first axis, exact while it doesn't exceed ``largest``."""
    turned = np.roll(blocks[::-1], 1, axis=0)  # index i at place -i
    out, covers = None, 1
    for prime, generator in PRIMES:
        a, b = transform(_mod(turned, prime), prime, generator), transform(_mod(windows, prime), prime, generator)
        rest = inverse(_mod(a * b, prime), prime, generator)
        if out is None:
            out, covers = rest, prime
        else:  # the number below covers * prime with both remainders
            lift = pow(covers % prime, prime - 2, prime)
            step = _mod(_mod(rest + np.uint64(prime) - _mod(out, prime), prime) * np.uint64(lift), prime)
            out, covers = out + step * np.uint64(covers), covers * prime
        if covers > largest:
            return out
        if covers * PRIMES[-1][0] > 1 << 63:
            break
    raise ValueError(f"a text has too many different words for exact sums up to {largest}")


def _seeds(codes: np.ndarray, ends: np.ndarray, starts: np.ndarray, size: int, distances: range) -> tuple:
    """(block start, distance) of all occurrences of the blocks without mismatch. ends: of the text at each start."""
    n, width = len(codes), size + distances[-1] - distances[0]
    length = 1 << (width - 1).bit_length()
    found_s, found_d = [], []
    squares = np.r_[0, np.cumsum(codes.astype(np.int64) ** 2)]
    per = max(1, BLOCK_VALUES // length)
    for at in range(0, len(starts), per):
        s, end = starts[at : at + per], ends[at : at + per]
        blocks = np.zeros((length, len(s)), dtype=np.uint64)
        blocks[:size] = codes[s + np.arange(size)[:, None]]
        windows = np.zeros((length, len(s)), dtype=np.uint64)
        places = s + distances[0] + np.arange(width)[:, None]
        windows[:width] = codes[np.minimum(places, n - 1)]
        most = int(max(blocks.max(), windows.max())) ** 2 * size
        products = correlation(blocks, windows, most)[: len(distances)].astype(np.int64)
        first = s + distances[0] + np.arange(len(distances))[:, None]
        inside = first + size <= end
        first = np.where(inside, first, 0)
        sums = squares[s + size] - squares[s] + squares[first + size] - squares[first] - 2 * products
        d, k = np.nonzero(inside & (sums == 0))
        found_s.append(s[k])
        found_d.append(d + distances[0])
    return np.concatenate(found_s), np.concatenate(found_d)


def _agree(codes: np.ndarray, a: int, b: int, limit: int, step: int) -> int:
    """How many words from a on (step 1) or back from a (step -1) equal those from b on, limit at most."""
    done, take = 0, 64
    while done < limit:
        take = min(take * 2, limit - done)
        if step > 0:
            differ = codes[a + done : a + done + take] != codes[b + done : b + done + take]
        else:
            differ = (codes[a - done - take + 1 : a - done + 1] != codes[b - done - take + 1 : b - done + 1])[::-1]
        first = int(differ.argmax())
        if differ[first]:
            return done + first
        done += take
    return done


def _smallest(codes: np.ndarray, start: int, end: int, period: int) -> bool:
    """Whether no divisor of the period is one; three periods and more have no other smaller period."""
    rest, factor = period, 2
    while rest > 1:
        if factor * factor > rest:
            factor = rest
        if rest % factor == 0:
            q = period // factor
            if np.array_equal(codes[start : end - q], codes[start + q : end]):
                return False
            while rest % factor == 0:
                rest //= factor
        factor += 1
    return True


class _Text:
    """The stretches found so far in one text, which lies at [begin, end) of the batch."""

    def __init__(self, begin: int, end: int):
        self.begin, self.end = begin, end
        self.known: list[tuple[int, int, int]] = []

    def extend(self, codes: np.ndarray, starts: np.ndarray, distance: int, size: int) -> None:
        """Follow the seeds of one distance; both the stretches that count and those inside longer ones are kept."""
        if self.known:
            known = np.array([k for k in self.known if distance % k[2] == 0]).reshape(-1, 3)
            for a, e, _ in known:
                starts = starts[(starts < a) | (starts + size + distance > e)]
        while len(starts):
            s = int(starts[0])
            after = _agree(codes, s + size, s + size + distance, self.end - s - size - distance, 1)
            before = _agree(codes, s - 1, s - 1 + distance, s - self.begin, -1)
            a, e = s - before, s + size + after + distance
            if e - a >= 3 * distance and _smallest(codes, a, e, distance):
                self.known.append((a, e, distance))
            starts = starts[starts + size > e - distance]


def find_runs(codes: np.ndarray, bounds: np.ndarray, min_length: int, min_periods: int) -> list[list[tuple]]:
    """The (start, length, period) runs of each text, by start and period. bounds: where texts begin, and the end."""
    found = [_Text(int(b), int(e)) for b, e in zip(bounds[:-1], bounds[1:], strict=True)]
    sizes = np.diff(bounds)
    size, longest = SMALLEST, int(sizes.max(initial=0))
    while 3 * (size if size > SMALLEST else 1) <= longest and min_length <= longest:
        distances = range(1, 2 * size) if size == SMALLEST else range(size, 2 * size)
        texts_in = np.flatnonzero(sizes >= max(min_length, 3 * distances[0]))
        # the grid of blocks begins anew in each text
        per = (sizes[texts_in] - distances[0]) // size
        owner = np.repeat(texts_in, per)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(per) - per, per)
        starts = bounds[owner] + nth * size
        s = starts
        if len(starts):
            s, d = _seeds(codes, bounds[owner + 1], starts, size, distances)
        if len(s):
            of = np.searchsorted(bounds, s, side="right") - 1
            order = np.lexsort((s, d, of))
            s, d, of = s[order], d[order], of[order]
            cuts = np.flatnonzero(np.r_[True, (of[1:] != of[:-1]) | (d[1:] != d[:-1])])
            for begin, end in zip(cuts, [*cuts[1:], len(s)], strict=True):
                found[of[begin]].extend(codes, s[begin:end], int(d[begin]), size)
        size *= 2
    out = []
    for text in found:
        runs = {(a - text.begin, e - a, q) for a, e, q in text.known}
        runs = [r for r in runs if r[1] >= max(min_length, min_periods * r[2])]
        out.append(sorted(runs, key=lambda r: (r[0], r[2])))
    return out


def _row(words: list[bytes], runs: list[tuple]) -> tuple:
    """A document's result; of equal exponents the first run counts."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    if runs:
        kept = np.ones(len(words), dtype=bool)
        for start, length, period in runs:
            kept[start + period : start + length] = False
        words = [words[i] for i in np.flatnonzero(kept)]
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (
        len(runs),
        *(best or (None, None, None)),
        1000 * best[1] // best[2] if best else None,
        [dict(zip(("start", "length", "period"), r, strict=True)) for r in runs],
        hashlib.sha256(listed.encode()).hexdigest(),
        hashlib.sha256(b" ".join(words)).hexdigest(),
    )


def periodic_runs(
    docs: DataFrame,
    min_length: int = 24,
    min_periods: int = 3,
    words_of: Callable[[int | None, bytes | None], list[bytes]] = blank_words,
) -> DataFrame:
    """Each document's runs, the one with the greatest length / period, and digests.

    ``runs_sha256`` is over all runs, ``collapsed_sha256`` over the words that stay when each run keeps its first
    period only. ``words_of`` makes the words of a document from its id and UTF-8 text.
    """
    if min_periods < 3 or min_length < 3 * SMALLEST:
        raise ValueError("runs of three periods and 24 words at least can be found")

    def results(held: list[tuple[int | None, list[bytes]]]) -> pa.RecordBatch:
        codes, bounds = [], [0]
        for _, words in held:
            of_word: dict[bytes, int] = {}
            codes.append(np.array([of_word.setdefault(w, len(of_word)) for w in words], dtype=np.int64))
            bounds.append(bounds[-1] + len(words))
        runs = find_runs(np.concatenate(codes), np.array(bounds), min_length, min_periods)
        rows = [(doc_id, *_row(words, r)) for (doc_id, words), r in zip(held, runs, strict=True)]
        kinds = [pa.int64()] * 6 + [pa.list_(STRETCH), pa.string(), pa.string()]
        names = [part.split()[0] for part in RESULT.split("runs array")[0].rstrip(", ").split(", ")]
        names += ["runs", "runs_sha256", "collapsed_sha256"]
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int | None, list[bytes]]] = []
        n = 0
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for at, doc_id in enumerate(ids):
                words = words_of(doc_id, as_bytes(batch.column("text").slice(at, 1))[0])
                held.append((doc_id, words))
                n += len(words)
                if n >= BATCH_WORDS:
                    yield results(held)
                    held, n = [], 0
        if held:
            yield results(held)

    return texts(docs).mapInArrow(run, RESULT)
