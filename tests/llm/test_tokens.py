import random
import zlib

import numpy as np
import pytest
from helpers import awkward_rows, documents
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm import packing, token_counts, token_files
from ledgerloom.llm.common import stage
from ledgerloom.llm.tokens import default_path, encoder

PATH = default_path()


def plain_ids(text):
    return encoder(PATH).tokenizer.encode(text or "", add_special_tokens=False).ids


@given(st.text(alphabet=" \n\ta'sßé.,!1\xa0\x1c\x85中<|_Z", max_size=30))
@settings(max_examples=300, deadline=None)
def test_ids_equal_the_library_s(text):
    assert np.frombuffer(encoder(PATH).encode(text), "<u4").tolist() == plain_ids(text)


def test_ids_of_long_parts():
    text = "\xa0 ".join("word " * 1500 for _ in range(3))
    assert np.frombuffer(encoder(PATH).encode(text), "<u4").tolist() == plain_ids(text)


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_files_round_trip(spark):
    rows = awkward_rows()
    folder = stage(spark, "token-files").path
    manifest = token_files.write_token_files(documents(spark, rows), folder, PATH)
    got = [tuple(r) for r in token_files.read_documents(spark, folder, manifest).collect()]
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    expected, start = [], 0
    for doc_id, text in ordered:
        ids = [*plain_ids(text), 2]
        expected.append((doc_id, start, len(ids), crc(ids)))
        start += len(ids)
    assert sorted(got, key=lambda r: r[1]) == expected
    assert sum(n for _, n, _ in manifest) == start
    part = token_files.TokenFile(folder, manifest[0][0])
    ids, mask = part.sequence(0)
    assert len(ids) == len(mask) == 2048
    assert not ids.flags.owndata  # a view of the mapped file
    assert mask.sum() == min(2048, manifest[0][1])


def test_token_files_of_no_documents(spark):
    folder = stage(spark, "token-files").path
    manifest = token_files.write_token_files(documents(spark, []), folder, PATH)
    assert manifest == []
    assert token_files.read_documents(spark, folder, manifest).count() == 0


def check_packed(rows, packed, capacity=2048):
    expected = []
    for doc_id, text in rows:
        ids = [*plain_ids(text), 0]
        cuts = [0, *range(len(ids) - (len(ids) - 1) // capacity * capacity, len(ids) + 1, capacity)]
        expected += [
            (doc_id, k, a, b - a, crc(ids[a:b])) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))
        ]
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted((tuple(r)[:5] for r in packed), key=key) == sorted(expected, key=key)
    ends = {}
    for row in sorted(packed, key=lambda r: (r.sequence_id, r.offset)):
        assert row.offset == ends.get(row.sequence_id, 0)
        ends[row.sequence_id] = row.offset + row.length
    assert all(end <= capacity for end in ends.values())
    return ends


def test_packing(spark):
    rows = awkward_rows()
    check_packed(rows, packing.pack(documents(spark, rows), PATH).collect())
    assert packing.pack(documents(spark, []), PATH).collect() == []


def test_packing_small_capacity_is_nearly_full(spark):
    rng = random.Random(1)
    rows = [(k, " ".join("word" for _ in range(rng.randint(0, 150)))) for k in range(400)]
    ends = check_packed(rows, packing.pack(documents(spark, rows), PATH, capacity=64).collect(), 64)
    total = sum(ends.values())
    assert len(ends) <= -(-total // 64) + 2


@given(st.lists(st.integers(1, 40), max_size=8), st.integers(0, 60))
@settings(max_examples=200, deadline=None)
def test_fullest_is_the_fullest(lengths, room):
    counts = {x: lengths.count(x) for x in lengths}
    sums = {0}
    for x in lengths:
        sums |= {s + x for s in sums}
    chosen = packing.fullest(sorted(counts, reverse=True), counts, room)
    assert all(n <= counts[x] for x, n in chosen.items())
    assert sum(x * n for x, n in chosen.items()) == max(s for s in sums if s <= room)


def test_plan_uses_every_piece_once():
    rng = random.Random(2)
    histogram = {length: rng.randint(1, 1000) for length in rng.sample(range(1, 2049), 300)}
    used = {}
    for chosen, times in packing.plan_bins(histogram, 2048):
        assert sum(length * n for length, n in chosen.items()) <= 2048
        for length, n in chosen.items():
            used[length] = used.get(length, 0) + n * times
    assert used == histogram


def test_trees_follow_edits(spark):
    from pyspark.sql import functions as F

    rows = awkward_rows()
    trees = token_counts.build_trees(documents(spark, rows), PATH)
    marked = trees.withColumn("edits", token_counts.find_edits(F.col("text"), r"\S+@\S+|\d{3,}|fox|the", "[x]"))
    found = token_counts.apply_edits(marked, PATH).collect()
    assert len(found) == len(rows)
    for row in found:
        assert row.n_tokens_edited == row.tree[1] == len(plain_ids(row.text))
    assert sorted(row.n_tokens for row in found) == sorted(len(plain_ids(text)) for _, text in rows)


def test_edits_of_any_place_and_again():
    rng = random.Random(4)
    encode = encoder(PATH)
    for _ in range(60):
        text = "".join(rng.choice(["ab", " ", " ", "\n", "c.", "'s", "7"]) for _ in range(rng.randint(0, 60)))
        cuts = token_counts.leaf_cuts(text, words=2)
        counts = [token_counts.count_of(text[a:b], encode) for a, b in zip(cuts, cuts[1:], strict=False)]
        tree = token_counts.build_tree(counts)
        for _ in range(3):
            places = sorted(rng.randint(0, len(text)) for _ in range(4))
            edits = [(a, b, rng.choice(["", " ", "x", "\n y"])) for a, b in (places[:2], places[2:])]
            if edits[0][1] == edits[1][0]:
                edits = edits[:1]
            expected = text
            for a, b, new in reversed(edits):
                expected = expected[:a] + new + expected[b:]
            text, cuts, tree, _ = token_counts.edited(text, cuts, tree, edits, encode)
            assert text == expected
            assert tree[1] == len(plain_ids(text))
            assert cuts[-1] == len(text)


def test_no_edits_change_nothing(spark):
    from pyspark.sql import functions as F

    trees = token_counts.build_trees(documents(spark, awkward_rows()), PATH)
    none = trees.withColumn("edits", F.lit(None).cast(token_counts.EDITS))
    assert all(
        row.n_tokens == row.n_tokens_edited and row.n_leaves_encoded == 0
        for row in token_counts.apply_edits(none, PATH).collect()
    )


@pytest.mark.parametrize("text", ["", " ", "a", " a b", "a  b c"])
def test_leaf_cuts_end_at_the_text(text):
    cuts = token_counts.leaf_cuts(text, words=1)
    assert cuts[0] == 0 and cuts[-1] == len(text)
