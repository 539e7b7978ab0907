import random

import numpy as np
import xxhash
from helpers import UPPER_TO_LOWER, awkward_rows, blank_words, documents

from ledgerloom.llm import simhash
from ledgerloom.llm.components import components


def plain_fingerprint(text):
    words = blank_words((text or "").translate(UPPER_TO_LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))]
    ones = [0] * 64
    for shingle in shingles:
        h = xxhash.xxh64_intdigest(shingle.encode(), 42)
        for bit in range(64):
            ones[bit] += h >> bit & 1
    return sum(1 << bit for bit in range(64) if 2 * ones[bit] > len(shingles))


def plain_components(rows):
    fps = [plain_fingerprint(text) for _, text in rows]
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= 4 and group[a] != group[b]:
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    out = []
    for k, (doc_id, _) in enumerate(rows):
        ids = [i for (i, _), g in zip(rows, group, strict=True) if g == group[k] and i is not None]
        out.append((doc_id, f"{fps[k]:016x}", min(ids, default=None)))
    return sorted(out, key=str)


def found(spark, rows):
    got = simhash.near_duplicates(documents(spark, rows))
    got = got.select("doc_id", simhash.as_hex(got.fp).alias("fp"), "component_id")
    return sorted(map(tuple, got.collect()), key=str)


def test_awkward_rows(spark):
    rows = [*awkward_rows(), (None, "only rows without an id"), (9, "one two three"), (8, "ONE  two\nthree")]
    assert found(spark, rows) == plain_components(rows)
    assert found(spark, []) == []


def test_near_copies(spark):
    rng = random.Random(7)
    rows = []
    for k in range(12):
        base = [f"w{rng.randrange(10_000)}" for _ in range(300)]
        for j in range(10):
            own = list(base)
            for _ in range(j % 4):
                own[rng.randrange(300)] = "changed"
            rows.append((rng.randrange(10**9) if (k + j) % 9 else 100 + k, " ".join(own)))
    assert found(spark, rows) == plain_components(rows)


def test_linked_fingerprints_share_an_anchor():
    rng = np.random.default_rng(5)
    one = rng.integers(0, 2**64, 4000, dtype=np.uint64)
    two = one.copy()
    for k in range(len(two)):
        for bit in rng.choice(64, rng.integers(0, 5), replace=False):
            two[k] ^= np.uint64(1) << np.uint64(bit)
    anchors = []
    for fps in (one, two):
        row, key = simhash.replicas(fps)
        assert len(set(zip(row.tolist(), key.tolist(), strict=True))) == len(row)
        own = [set() for _ in fps]
        for r, k in zip(row.tolist(), key.tolist(), strict=True):
            own[r].add(k)
        anchors.append(own)
    assert all(a & b for a, b in zip(*anchors, strict=True))


def test_codes_are_perfect():
    for which, radius in ((simhash.GOLAY, 3), (simhash.HAMMING, 1)):
        _, errors, starts, degree = simhash.code(*which, radius)
        first = errors[starts[:-1]]
        assert len(first) == 1 << degree
        assert max(int(e).bit_count() for e in first) == radius


def test_links_in_a_large_anchor():
    rng = np.random.default_rng(6)
    base = rng.integers(0, 2**64, 40, dtype=np.uint64)
    fps = np.unique(np.concatenate([base, base ^ np.uint64(3), base ^ np.uint64(0x10101)]))

    def groups(edges):
        root = list(range(len(fps)))
        for a, b in edges:
            old, new = root[b], root[a]
            root = [new if x == old else x for x in root]
        return sorted(tuple(k for k in range(len(fps)) if root[k] == r) for r in set(root))

    assert groups(simhash.link(fps, 4)) == groups(simhash.link_large(fps, 4))


def test_keys_that_span_batches(spark):
    import pyarrow as pa

    base = np.array([5, 5 ^ 1, 5 ^ 3, 0x7FF << 40], np.int64)
    rows = [(1, 7), *((2, int(x)) for x in base), (3, 7), (3, 6)]
    batches = [pa.RecordBatch.from_pylist([{"key": k, "fp": f}]) for k, f in rows]
    edges = [e for b in simhash._edges_by_anchor(4)(iter(batches)) for e in zip(*b.to_pydict().values(), strict=True)]
    assert sorted(edges) == [(5, 4), (5, 6), (7, 6)]


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 101), (7, 7)], "a long, b long")
    roots = dict(map(tuple, components(edges).collect()))
    assert {k: roots.get(k) for k in range(1, 61)} == dict.fromkeys(range(1, 61), 0)
    assert roots[101] == 100
    assert components(edges.limit(0)).count() == 0


def test_components_of_stars(spark):
    # one centre in the middle of its leaves, one above and one below them, and the last two joined
    edges = [(500, k) for k in range(1000) if k != 500] + [(3000, k) for k in range(2000, 2900)]
    edges += [(4000, k) for k in range(4001, 4900)] + [(4899, 3000), (4899, 3000)]
    roots = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    expected = {k: 0 for k in range(1, 1000)} | {k: 2000 for k in [*range(2001, 2900), 3000, *range(4000, 4900)]}
    assert {k: v for k, v in roots.items() if k != v} == expected


def test_one_of_each(spark):
    rows = awkward_rows()
    kept = simhash.one_of_each(documents(spark, rows))
    assert kept.columns == documents(spark, rows).columns
    ids = sorted((row.doc_id for row in kept.collect()), key=str)
    expected = {i for i, _, c in plain_components(rows) if i == c and i is not None}
    assert ids == sorted([*expected, None], key=str)
