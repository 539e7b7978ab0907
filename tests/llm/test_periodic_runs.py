"""Runs against all periods tried one by one."""

import hashlib
import zlib

import numpy as np
import pytest
from conftest import SF_DIR
from helpers import awkward_rows, blank_words, documents
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm import periodic_runs, queries


def plain_runs(x, min_length=24, min_periods=3):
    out, n = set(), len(x)
    for q in range(1, n // min_periods + 1):
        i = 0
        while i < n - q:
            if x[i] != x[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and x[j] == x[j + q]:
                j += 1
            length = j + q - i
            smaller = any(all(x[k] == x[k + p] for k in range(i, j + q - p)) for p in range(1, q))
            if length >= max(min_length, min_periods * q) and not smaller:
                out.add((i, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_result(words):
    runs = plain_runs(words)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    return (
        len(runs),
        *(best or (None,) * 3),
        1000 * best[1] // best[2] if best else None,
        hashlib.sha256(listed.encode()).hexdigest(),
        hashlib.sha256(kept.encode()).hexdigest(),
    )


@st.composite
def sequences(draw):
    x = draw(st.lists(st.integers(0, draw(st.sampled_from([0, 1, 2, 40]))), max_size=220))
    for _ in range(draw(st.integers(0, 3))):
        if len(x) > 8:
            a = draw(st.integers(0, len(x) - 4))
            p = draw(st.integers(1, max(1, (len(x) - a) // 3)))
            for i in range(a + p, draw(st.integers(a, len(x)))):
                x[i] = x[i - p]
    return x


@settings(max_examples=200, deadline=None)
@given(st.lists(sequences(), min_size=1, max_size=4))
def test_all_runs_of_a_batch(texts):
    codes = np.array(sum(texts, []), dtype=np.int64)
    bounds = np.cumsum([0] + [len(t) for t in texts])
    assert periodic_runs.find_runs(codes, bounds, 24, 3) == [plain_runs(t) for t in texts]


@pytest.mark.parametrize("largest", [40, 200_000, 900_000_000])
def test_convolution_is_exact(largest):
    """Numbers whose sums need one, two and three primes."""
    rng = np.random.default_rng(largest)
    blocks, windows = np.zeros((32, 2), dtype=np.uint64), np.zeros((32, 2), dtype=np.uint64)
    blocks[:8], windows[:23] = rng.integers(0, largest, (8, 2)), rng.integers(0, largest, (23, 2))
    if largest == 900_000_000:
        with pytest.raises(ValueError):
            periodic_runs.correlation(blocks, windows, 1 << 70)
        return
    got = periodic_runs.correlation(blocks, windows, largest**2 * 8)
    for j in range(16):
        for k in range(2):
            assert got[j, k] == sum(int(blocks[i, k]) * int(windows[i + j, k]) for i in range(8))


def test_long_text():
    """Scales far above the smallest: a long period, one repetition of a repetition, and a constant tail."""
    rng = np.random.default_rng(3)
    part = rng.integers(0, 900, 1500)
    inner = np.tile(rng.integers(0, 900, 40), 30)
    x = np.concatenate([part, part, part, part[:700], inner, np.zeros(5000, dtype=np.int64), inner])
    _, codes = np.unique(x, return_inverse=True)
    runs = periodic_runs.find_runs(codes.astype(np.int64), np.array([0, len(codes)]), 24, 3)[0]
    assert [(n, q) for _, n, q in runs] == [(5200, 1500), (1200, 40), (5000, 1), (1200, 40)]


def test_query_against_every_period(spark, duck):
    got = {r.doc_id: tuple(r)[1:] for r in queries.op11_periodic_runs(spark, SF_DIR).collect()}
    rows = duck.execute("SELECT doc_id, text FROM documents WHERE length(text) < 20000").fetchall()
    for doc_id, text in rows:
        words, h = blank_words(text), zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and words:
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        assert got[doc_id] == plain_result(words), doc_id
    assert sum(r[0] > 0 for r in got.values()) > 5


def test_awkward_rows(spark):
    rows = [*awkward_rows(), (8, "la " * 50), (None, "x y z " * 20), (9, " ".join("ab") + " " + "c " * 23)]
    got = periodic_runs.periodic_runs(documents(spark, rows)).drop("runs").collect()
    want = [(i, *plain_result(blank_words(t))) for i, t in rows]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_empty_table(spark):
    assert periodic_runs.periodic_runs(documents(spark, [(1, "a")]).limit(0)).collect() == []


def test_ties_take_the_first_run(spark):
    row = periodic_runs.periodic_runs(documents(spark, [(1, "a " * 30 + "m n o " + "b " * 30)])).first()
    assert (row["n_runs"], row["start"], row["length"], row["period"]) == (2, 0, 30, 1)


def test_weaker_runs_are_refused(spark):
    with pytest.raises(ValueError):
        periodic_runs.periodic_runs(documents(spark, [(1, "a")]), min_periods=2)
