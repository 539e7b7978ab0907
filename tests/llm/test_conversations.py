"""The trie and the formatted conversations against plain versions."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from conftest import SF_DIR
from helpers import blank_words
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm import chat_format, conversation_trie, queries
from ledgerloom.llm.common import stage
from ledgerloom.llm.oracle import ORACLE_SQL
from ledgerloom.llm.tokens import default_path, encoder

TRIE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def by_turn(rows):
    """Conversations as lists of (role, text)."""
    held = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            held[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in held.items()}


def plain_trie(conversations):
    nodes, children = defaultdict(list), defaultdict(list)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            nodes[tuple(turns[:d])].append(c)
    for path in nodes:
        if path:
            children[path[:-1]].append(path)
    leaves, saved = {}, {}
    for path in sorted(nodes, key=len, reverse=True):
        leaves[path] = sum(leaves[c] for c in children[path]) or 1
        own = (len(nodes[path]) - 1) * len(blank_words(path[-1][1])) if path else 0
        saved[path] = own + sum(saved[c] for c in children[path])
    out = []
    for path, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(conversations[c]) == len(path))
        parent = min(nodes[path[:-1]]) if path else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        counts = (len(members), len(children[path]), leaves[path], saved[path], digest)
        out.append((min(members), len(path), parent, *counts))
    return sorted(out, key=lambda r: r[:2])


def plain_summary(turns):
    said = "".join(f"{r}\n{x}\n" for r, x in turns)
    learned = "".join(x for r, x in turns if r == "assistant")
    chars = sum(len("".join(chat_format.format_turn(r, x))) for r, x in turns)
    digests = [hashlib.sha256(t.encode()).hexdigest() for t in (said, learned)]
    return len(turns), digests[0], len(learned), digests[1], chars


def table(spark, rows):
    """With further columns that clash with names the operators use."""
    clash = [(*row, 1.5, "k", 3, "w") for row in rows]
    schema = "conv_id long, turn long, role string, text string, key double, owner string, depth int, words string"
    return spark.createDataFrame(clash, schema).repartition(3)


def awkward():
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"turn {t}") for c in range(12) for t in range(c % 7 + 3)]
    rows += [(20, t, "user", f"turn {t}" if t < 9 else f"other {t}") for t in range(14)]
    rows += [(21, t, "user", f"turn {t}" if t < 9 else f"more {t}") for t in range(13)]
    rows += [(30, None, "user", "first"), (30, 4, None, "turn"), (30, 5, "user", None), (30, 5, "assistant", "")]
    rows += [(31, 0, "user", "same"), (31, 0, "user", "same"), (None, 0, "user", "nobody's"), (32, 0, "", "")]
    rows += [(33, 0, "assistant", "  été\r\n\x1c </turn>\n<turn>user<says>\\ \\<turn> <|endoftext|>"), (-5, 0, "us<says>er\\", "x\\")]
    rows += [(40 + k, t, "user", f"s{min(t, k)}") for k in range(6) for t in range(6)]
    return rows


def trie_rows(df):
    return sorted((tuple(r[name] for name in TRIE) for r in df.collect()), key=lambda r: r[:2])


@pytest.mark.parametrize("block_turns", [1, 3, 4])
def test_trie_of_awkward_rows(spark, block_turns):
    turns = conversation_trie.turn_digests(table(spark, awkward()))
    got = trie_rows(conversation_trie.prefix_trie(turns, block_turns=block_turns))
    assert got == plain_trie(by_turn(awkward()))


def test_trie_with_turnless_conversations(spark):
    turns = conversation_trie.turn_digests(table(spark, [(5, 0, "user", "a b"), (7, 0, "user", "a b")]))
    ids = spark.createDataFrame([(3,), (5,), (7,)], "conv_id long")
    want = plain_trie({3: [], 5: [("user", "a b")], 7: [("user", "a b")]})
    assert trie_rows(conversation_trie.prefix_trie(turns, ids)) == want
    alone = conversation_trie.prefix_trie(turns.limit(0), ids)
    assert trie_rows(alone) == plain_trie({3: [], 5: [], 7: []})


def test_trie_of_many_copies(spark):
    """Copies over several ranges of ids, and a beginning that all conversations share."""
    rows = [(c, t, "user", f"turn {t}" if t < 2 or c % 3 else f"own {c}") for c in range(0, 30000, 3) for t in range(3)]
    rows += [(c, t, "user", f"turn {t}") for c in range(1, 30000, 3) for t in range(3)]
    turns = conversation_trie.turn_digests(table(spark, rows))
    assert trie_rows(conversation_trie.prefix_trie(turns)) == plain_trie(by_turn(rows))


def test_trie_query_against_plain_and_sql(spark, duck):
    given_turns = by_turn(duck.execute("SELECT conv_id, turn, role, text FROM conversations").fetchall())
    rebuilt = {}
    for c, turns in given_turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = given_turns.get(c - c % 20, [])[:h] + turns[h:]
    got = trie_rows(queries.op12_conversation_prefix_trie(spark, SF_DIR))
    assert got == plain_trie(rebuilt)
    assert got == sorted(duck.execute(ORACLE_SQL["op12_conversation_prefix_trie"]).fetchall(), key=lambda r: r[:2])


def test_families_rebuild(spark):
    """A lost head, a head shorter than what is taken, and a conversation that loses all its turns."""
    rows = [(c, t, "user", f"{c} says {t}") for c in range(20, 45) for t in range(c % 3 + 1)] + [(65, 0, "user", "alone")]
    rows += [(66, 0, "user", "alone")]
    turns, ids = queries.in_families(conversation_trie.turn_digests(table(spark, rows)))
    conversations = by_turn(rows)
    rebuilt = {}
    for c, own in conversations.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = conversations.get(c - c % 20, [])[:h] + own[h:]
    assert any(not t for t in rebuilt.values())
    assert trie_rows(conversation_trie.prefix_trie(turns, ids)) == plain_trie(rebuilt)


def test_empty_tables(spark):
    none = table(spark, [(1, 0, "user", "a")]).limit(0)
    assert conversation_trie.prefix_trie(conversation_trie.turn_digests(none)).collect() == []
    folder = stage(spark, "none").path
    written = chat_format.write_conversations(none, folder, default_path())
    assert chat_format.summaries(chat_format.read_turns(written, folder, default_path())).collect() == []
    assert written.chains.count() == written.paths.count() == written.tokens.count() == 0


MARKS = st.lists(st.sampled_from([*"<>/\\turnsays\n", "</turn>", "<turn>", "<says>"])).map("".join)


@given(st.text(), MARKS)
def test_turns_read_back(role, text):
    for r, t in ((role, text), (text, role), (text, text)):
        formatted = "".join(chat_format.format_turn(r, t))
        assert chat_format.parse_turn(formatted) == (r, t)
        assert formatted.index("<says>") > 0 and formatted.count("</turn>\n") >= 1


@settings(deadline=None)
@given(st.text())
def test_ids_decode(text):
    tokens = encoder(default_path())
    assert tokens.decode(np.frombuffer(tokens.encode(text), dtype="<u4").tolist()) == text


def written_awkward(spark):
    folder = stage(spark, "chat-test").path
    chat_format.write_conversations(table(spark, awkward()), folder, default_path())
    return folder, chat_format.open_conversations(spark, folder)


def test_conversations_read_back(spark):
    folder, written = written_awkward(spark)
    turns = chat_format.read_turns(written, folder, default_path())
    got = {r["conv_id"]: tuple(r)[1:] for r in chat_format.summaries(turns).collect()}
    assert got == {c: plain_summary(t) for c, t in by_turn(awkward()).items()}


def test_shared_turns_stand_once_and_in_depth_first_order(spark):
    _, written = written_awkward(spark)
    conversations = by_turn(awkward())
    paths = {tuple(t[:d]): None for _, t in sorted(conversations.items()) for d in range(1, len(t) + 1)}
    tokens = sorted(written.tokens.collect(), key=lambda r: r["start"])
    assert len(tokens) == len(paths)
    # siblings by their smallest conversation, each node before what hangs below it
    members = defaultdict(list)
    for c, turns in conversations.items():
        for d in range(1, len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    order = sorted(paths, key=lambda p: [min(members[p[: d + 1]]) for d in range(len(p))])
    assert [(r["chain"], r["depth"]) for r in tokens] == [(min(members[p]), len(p)) for p in order]
    at = 0
    for row, path in zip(tokens, order, strict=True):
        assert row["start"] == at and row["n_tokens"] == len(row["ids"])
        learned = encoder(default_path()).decode(row["ids"][row["loss_start"] : row["loss_end"]])
        assert learned == (chat_format.escape(path[-1][1]) if path[-1][0] == "assistant" else "")
        at += row["n_tokens"]


def test_positions_and_ancestors(spark):
    """What a chain's tokens attend to, followed by the chain, is the whole conversation."""
    _, written = written_awkward(spark)
    conversations, decode = by_turn(awkward()), encoder(default_path()).decode
    stream = [i for r in sorted(written.tokens.collect(), key=lambda r: r["start"]) for i in r["ids"]]
    chains = written.chains.collect()
    assert len({r["chain"] for r in chains}) == len(chains) > 15
    for row in chains:
        seen = [i for span in row["ancestors"] for i in stream[span["start"] : span["end"]]]
        assert len(seen) == row["first_position"]
        whole = decode(seen + stream[row["start"] : row["start"] + row["n_tokens"]])
        assert whole == "".join("".join(chat_format.format_turn(*t)) for t in conversations[row["chain"]])
    assert max(len(r["ancestors"]) for r in chains) >= 3


def test_chat_query_against_plain_and_sql(spark, duck):
    rows = duck.execute("SELECT conv_id, turn, role, text FROM conversations").fetchall()
    rows += [(-7, 0, "user", queries.MARKED), (-7, 1, "assistant", queries.MARKED)]
    got = {r["conv_id"]: tuple(r)[1:] for r in queries.op13_chat_formatting(spark, SF_DIR).collect()}
    assert got == {c: plain_summary(t) for c, t in by_turn(rows).items()}
    assert got == {r[0]: r[1:] for r in duck.execute(ORACLE_SQL["op13_chat_formatting"]).fetchall()}


def test_turns_are_shuffled_without_texts(spark):
    df = conversation_trie.turn_digests(table(spark, awkward()))
    plan = conversation_trie._blocks(df, 4)._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in plan
    assert set(df.columns) == {"conv_id", "turn", "digest", "words"}
