import hashlib
import random

import pytest
from helpers import awkward_rows, documents, plain_words

from ledgerloom.llm import decontamination


def plain(rows, items):
    windows = {}
    for item, text in items:
        words = plain_words(text)
        if words:
            for k in range(max(1, len(words) - 9)):
                windows.setdefault(tuple(words[k : k + 10]), set()).add("" if item is None else str(item))
    out = []
    for doc_id, text in rows:
        words, hit, names = plain_words(text), set(), set()
        for size in {len(w) for w in windows}:
            for k in range(len(words) - size + 1):
                own = windows.get(tuple(words[k : k + size]))
                if own:
                    names |= own
                    hit |= set(range(k, k + size))
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((doc_id, len(words), len(hit), len(names), digest, bool(hit)))
    return sorted(out, key=str)


def bench(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def fixture(seed=1):
    rng = random.Random(seed)
    say = lambda n: " ".join(f"t{rng.randrange(60)}" for _ in range(n))
    items = [(k, say(rng.randint(1, 40))) for k in range(30)]
    items += [(40, None), (41, ""), (42, "..."), (None, "a single short item"), (7, "the lazy dog"), (7, "Woods")]
    rows = [(k, say(rng.randint(0, 200))) for k in range(60)]
    rows += [(100 + k, f"{say(30)} {items[k][1].upper()}! {say(30)}") for k in range(20)]
    return rows + [(i + 1000 if i else None, t) for i, t in awkward_rows()], items


def result(found):
    return sorted((tuple(r)[:1] + tuple(r)[2:7] for r in found.collect()), key=str)


def test_like_the_plain_version(spark):
    rows, items = fixture()
    docs = documents(spark, rows)
    assert result(decontamination.decontaminate(docs, bench(spark, items))) == plain(rows, items)


def test_blocks_and_segments_change_nothing(spark, monkeypatch):
    rows, items = fixture(2)
    items.append((50, " ".join(f"t{k % 60}" for k in range(200))))
    monkeypatch.setattr(decontamination, "BLOCK_WORDS", 120)
    docs = documents(spark, rows)
    assert result(decontamination.decontaminate(docs, bench(spark, items))) == plain(rows, items)


def test_empty_tables(spark):
    rows, items = fixture()
    docs = documents(spark, rows[:5])
    assert result(decontamination.decontaminate(docs, bench(spark, []))) == plain(rows[:5], [])
    assert decontamination.decontaminate(documents(spark, []), bench(spark, items)).count() == 0


def test_proximity(spark):
    item = "one two three four five six seven eight nine ten"
    texts = {
        1: item,
        2: item.replace("five", "five and"),
        3: item.replace("five", "five and and and"),
        4: item.replace("five six", "six five"),
    }
    found = decontamination.decontaminate(documents(spark, list(texts.items())), bench(spark, [(1, item)])).collect()
    assert {row.doc_id: (row.contaminated, row.n_near_items) for row in found} == {
        1: (True, 1),
        2: (False, 1),
        3: (False, 0),
        4: (False, 0),
    }


@pytest.mark.parametrize("seed", [3])
def test_filter_keeps_clean_rows_and_columns(spark, seed):
    rows, items = fixture(seed)
    docs = documents(spark, rows)
    kept = decontamination.without_contaminated(docs, bench(spark, items))
    assert kept.columns == docs.columns
    clean = [row for row in plain(rows, items) if not row[5]]
    assert sorted((row.doc_id for row in kept.collect()), key=str) == sorted((row[0] for row in clean), key=str)
