import hashlib
import random

from helpers import awkward_rows, blank_words, documents

from ledgerloom.llm import substrings


def plain(rows):
    """Per row: words, removed words, checksum. Rows of one id and start count as one place."""
    first = {}
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        words = blank_words(text)
        for k in range(len(words) - 19):
            place = (doc_id is not None, doc_id or 0, k)
            window = tuple(words[k : k + 20])
            first[window] = min(first.get(window, place), place)
    out = []
    for doc_id, text in rows:
        words, gone = blank_words(text), set()
        for k in range(len(words) - 19):
            if first[tuple(words[k : k + 20])] < (doc_id is not None, doc_id or 0, k):
                gone |= set(range(k, k + 20))
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((doc_id, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def random_rows(n, seed):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    pick = lambda n, k=400: [rng.choice(words[:k]) for _ in range(n)]
    passages = [pick(rng.randint(15, 60)) for _ in range(8)]
    rows = []
    for k in range(n):
        own = []
        for _ in range(rng.randint(0, 6)):
            own += rng.choice(
                [
                    rng.choice(passages),
                    rng.choice(passages)[: rng.randint(1, 40)],
                    ["a"] * rng.randint(1, 70),
                    ["a", "b"] * rng.randint(1, 40),
                    pick(rng.randint(1, 60), 3),
                    pick(rng.randint(1, 60)),
                ]
            )
        rows.append((k, " ".join(own)))
    return rows


def found(spark, rows):
    got = substrings.remove_repeats(documents(spark, rows))
    return sorted((tuple(row)[:4] for row in got.collect()), key=str)


def test_random_texts(spark):
    rows = random_rows(150, 3)
    assert found(spark, rows) == plain(rows)


def test_awkward_rows(spark):
    rows = awkward_rows()
    assert found(spark, rows) == plain(rows)
    assert found(spark, []) == []


def test_cut_keeps_rows_and_columns(spark):
    rows = awkward_rows()
    docs = documents(spark, rows)
    got = substrings.cut_repeats(docs)
    assert got.columns == docs.columns
    assert got.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
    hashes = {(i, n): h for i, n, _, h in plain(rows)}
    texts = {(i, len(blank_words(t))): t for i, t in rows}
    out = got.collect()
    assert len(out) == len(rows)
    for row in out:
        assert row.n_chars == len(row.text or "")
        kept = " ".join(blank_words(row.text))
        assert hashlib.sha256(kept.encode()).hexdigest() in hashes.values()
        assert row.text in texts.values() or row.text == kept


def test_equal_windows_share_their_symbol():
    """Wherever a passage stands, each of its windows is put down under the same symbol."""
    rng = random.Random(1)
    for _ in range(40):
        few = rng.choice([2, 3, 50])
        passage = [b"w%d" % rng.randrange(few) for _ in range(30)]
        seen = []
        for _ in range(3):
            before = [b"w%d" % rng.randrange(few) for _ in range(rng.randint(0, 9))]
            after = [b"w%d" % rng.randrange(few) for _ in range(rng.randint(0, 9))]
            parsed = substrings.Parsed([before + passage + after])
            symbols = {}
            for symbol, start, count in zip(*parsed.stretches(), strict=True):
                symbols.update({int(start) + k - 1 - len(before): int(symbol) for k in range(count)})
            seen.append([symbols[k] for k in range(11)])
        assert seen[0] == seen[1] == seen[2]


def test_sorted_rows_in_any_batches():
    import pyarrow as pa

    rng = random.Random(2)
    rows = sorted(
        (rng.randrange(4), rng.randrange(3), rng.randrange(4), rng.randrange(3) << 32 | 1) for _ in range(60)
    )

    def run(size):
        batches = [
            pa.RecordBatch.from_pylist(
                [dict(zip(("symbol", "stretch", "doc", "place"), row, strict=True)) for row in rows[at : at + size]]
            )
            for at in range(0, len(rows), size)
        ]
        out = []
        for batch in substrings.compare_sorted(iter(batches)):
            out += [tuple(row.values()) for row in batch.to_pylist()]
        return sorted(out)

    whole = run(len(rows))
    assert all(run(size) == whole for size in (1, 2, 3, 7))
    first = {}
    for row in rows:
        first.setdefault(row[:2], row[2:])
    assert sum(x[0] for x in whole) == sum(row[2:] != first[row[:2]] for row in rows)
