"""Conversations that begin alike, as a trie of their turns.

A node is a distinct sequence of first turns (role and text). Each conversation is cut in blocks of ``block_turns``
turns. A block's key is the SHA-256 of the key of the block before it and the digests of its turns, so grouping by
keys groups conversations by successive blocks: first by the first block, within that by the second, and so on, for
all levels in one aggregation. Where all conversations that share the blocks so far also share the next one, its turns
are nodes as they stand. Only where siblings diverge are turn boundaries refined: each distinct sibling block gives
the digests of its beginnings, and equal beginnings are one node. What is shuffled are digests, never texts.

Sums over subtrees need no walk over the trie. Each node's value belongs to its smallest member, a conversation's
values are summed from its end backwards, and a node's sum is that of its members. Every group is pre-aggregated
before its shuffle, so a beginning that a third of all conversations share costs one row a task. Siblings meet their parent
over SALTS copies of it.
The turns of one conversation, as digests, are one sorted stream through a task, held a block at a time; the ids of
the conversations that end at one node are hashed as a stream of texts of ID_RANGE ids at most.

Null role and null text count as empty; a null turn comes first; turns of equal number are put in the order of their
digests, repeated rows counted each. Rows with null conv_id belong to no conversation. Without conversations the
result is empty. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import stage

ID_RANGE = 4096
SALTS = 16
WORD = r"[^\x20\x09-\x0D]+"
BLOCKS = (
    "conv_id long, level long, parent binary, key binary, turns array<struct<digest: binary, words: long>>, last boolean"
)
TURN = pa.struct([("digest", pa.binary()), ("words", pa.int64())])
NO_ENDS = hashlib.sha256(b"").hexdigest()
ROOT = b""


def turn_digests(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, digest, words) of each turn: all that the trie reads of its text."""
    role = F.coalesce(conversations["role"].cast("string"), F.lit(""))
    text = F.coalesce(conversations["text"].cast("string"), F.lit(""))
    return conversations.where(conversations["conv_id"].isNotNull()).select(
        conversations["conv_id"].cast("long").alias("conv_id"),
        conversations["turn"].cast("long").alias("turn"),
        F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )


def _blocks(turns: DataFrame, size: int) -> DataFrame:
    """The blocks of each conversation with their keys."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, level, parent, held = None, 1, ROOT, []

        def block(last: bool) -> tuple:
            key = hashlib.sha256(parent + b"".join(d for d, _ in held)).digest()
            return now, level, parent, key, [{"digest": d, "words": w} for d, w in held], last

        for batch in batches:
            rows = []
            columns = (batch.column(name).to_pylist() for name in ("conv_id", "digest", "words"))
            for conv_id, digest, words in zip(*columns, strict=True):
                if conv_id != now:
                    if held:
                        rows.append(block(True))
                    now, level, parent, held = conv_id, 1, ROOT, []
                elif len(held) == size:
                    rows.append(block(False))
                    level, parent, held = level + 1, rows[-1][3], []
                held.append((digest, words))
            yield _block_batch(rows)
        if held:
            yield _block_batch([block(True)])

    dealt = turns.repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "digest")
    return dealt.select("conv_id", "digest", "words").mapInArrow(cut, BLOCKS)


def _block_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(TURN), pa.bool_())
    columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
        ["conv_id", "level", "parent", "key", "turns", "last"],
    )


def _distinct_blocks(blocks: DataFrame) -> DataFrame:
    """Each distinct block once, as its smallest member has it, and the number of its members."""
    groups = blocks.groupBy(F.col("key").alias("of_key")).agg(
        F.count(F.lit(1)).alias("members"), F.min("conv_id").alias("first")
    )
    same = (F.col("key") == F.col("of_key")) & (F.col("conv_id") == F.col("first"))
    return blocks.join(groups, same).select("conv_id", "level", "parent", "key", "turns", "members")


def _refined(distinct: DataFrame, size: int) -> DataFrame:
    """The turns of distinct blocks as rows; beginnings are named by their digests only where siblings diverge."""
    siblings = distinct.groupBy(F.col("parent").alias("of_parent")).agg(F.count(F.lit(1)).alias("siblings"))
    # a parent may have a third of all blocks as children: they are dealt over SALTS copies of it
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("of_salt")
    diverging = siblings.where("siblings > 1").select("of_parent", F.lit(True).alias("diverges"), salts)
    salt = F.pmod(F.xxhash64("key"), F.lit(SALTS)) == F.col("of_salt")
    marked = distinct.join(diverging, (F.col("parent") == F.col("of_parent")) & salt, "left")
    rows = marked.select("*", F.posexplode("turns").alias("pos", "at"))

    def beginning(turns: Column) -> Column:
        """The node after so many turns of the block, fewer than all."""
        joined = F.aggregate(F.slice("turns", F.lit(1), turns), F.col("parent"), lambda a, t: F.concat(a, t["digest"]))
        alone = F.concat(F.col("key"), F.encode(turns.cast("string"), "utf-8"))
        return F.when(F.col("diverges"), F.unhex(F.sha2(joined, 256))).otherwise(alone)

    after = F.when(F.col("pos") + 1 == F.size("turns"), F.col("key")).otherwise(beginning(F.col("pos") + 1))
    return rows.select(
        after.alias("node"),
        F.when(F.col("pos") == 0, F.col("parent")).otherwise(beginning(F.col("pos"))).alias("parent_node"),
        ((F.col("level") - 1) * size + F.col("pos") + 1).alias("depth"),
        F.col("at.words").alias("words"),
        "conv_id", "key", "pos", "members",
    )


def _end_digests(blocks: DataFrame, ids: DataFrame) -> DataFrame:
    """(node, ends_sha256) of the nodes at which conversations end."""
    ended = blocks.where("last").select("conv_id", "key")
    turnless = ids.join(ended.select(F.col("conv_id").alias("ended")), F.col("conv_id") == F.col("ended"), "left_anti")
    ends = ended.union(turnless.select("conv_id", F.lit(ROOT).alias("key")))
    dealt = ends.groupBy("key", F.floor(F.col("conv_id") / ID_RANGE).alias("part")).agg(
        F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("listed")
    )

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            done = []
            for key, listed in zip(batch.column("key").to_pylist(), batch.column("listed").to_pylist(), strict=True):
                if key != now:
                    if state:
                        done.append((now, state.hexdigest()))
                    now, state = key, hashlib.sha256(listed.encode())
                else:
                    state.update(b"," + listed.encode())
            yield _digest_batch(done)
        if state:
            yield _digest_batch([(now, state.hexdigest())])

    streams = dealt.repartition("key").sortWithinPartitions("key", "part").select("key", "listed")
    return streams.mapInArrow(digests, "of_node binary, ends_sha256 string")


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    keys, digests = list(zip(*rows, strict=True)) or ((), ())
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(digests, pa.string())], ["of_node", "ends_sha256"])


def prefix_trie(turns: DataFrame, ids: DataFrame | None = None, block_turns: int = 4) -> DataFrame:
    """The nodes of the trie of turns (conv_id, turn, digest, words), see ``turn_digests``.

    ids: the conv_id of all conversations, once each, if some may have no turns.
    """
    spark, size = turns.sparkSession, block_turns
    held = stage(spark, "trie")
    blocks = held.save("blocks", _blocks(turns, size))
    ids = blocks.where("level = 1").select("conv_id") if ids is None else ids.select(F.col("conv_id").cast("long"))
    distinct = held.save("distinct", _distinct_blocks(blocks))
    rows = held.save("rows", _refined(distinct, size))

    nodes = rows.groupBy("node", "parent_node", "depth", "words").agg(
        F.sum("members").alias("n_convs"), F.min("conv_id").alias("conv_id")
    )
    root = ids.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id")).where("n_convs > 0")
    none = F.lit(None).cast("binary")
    root = root.select(
        F.lit(ROOT).alias("node"), none.alias("parent_node"), F.lit(0).cast("long").alias("depth"),
        F.lit(0).cast("long").alias("words"), "n_convs", "conv_id",
    )
    plain = held.save("plain", nodes.unionByName(root))
    children = plain.where("depth > 0").groupBy(F.col("parent_node").alias("of_node"))
    children = children.agg(F.count(F.lit(1)).alias("n_children"))
    nodes = plain.join(children, F.col("node") == F.col("of_node"), "left").drop("of_node")
    nodes = nodes.withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    nodes = held.save("nodes", nodes.withColumn("value", (F.col("n_convs") - 1) * F.col("words")))

    # what the smallest member of a node holds for it; a conversation has one node at each depth
    owned = nodes.select(
        F.col("conv_id").alias("owner"),
        F.col("depth").alias("at_depth"),
        F.when(F.col("depth") > 0, F.floor((F.col("depth") - 1) / size) + 1).alias("at_level"),
        "value",
        (F.col("n_children") == 0).cast("long").alias("leaf"),
    )
    by_block = owned.where("at_depth > 0").groupBy("owner", "at_level")
    by_block = by_block.agg(F.sum("value").alias("value"), F.sum("leaf").alias("leaf"))
    whole = Window.partitionBy("conv_id")
    later = whole.orderBy(F.desc("level")).rowsBetween(Window.unboundedPreceding, -1)
    along = blocks.select("conv_id", "level", "key").join(
        by_block, (F.col("conv_id") == F.col("owner")) & (F.col("level") == F.col("at_level")), "left"
    )
    along = along.select("key", F.sum("value").over(later).alias("later"), F.sum("leaf").over(whole).alias("leaf"))
    by_key = along.groupBy(F.col("key").alias("of_key")).agg(F.sum("later").alias("later"), F.sum("leaf").alias("leaves"))

    own = (F.col("conv_id") == F.col("owner")) & (F.col("depth") == F.col("at_depth"))
    to_end = Window.partitionBy("key").orderBy(F.desc("pos")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    valued = rows.join(owned, own, "left").select("node", "key", F.sum("value").over(to_end).alias("own"))
    zero = F.lit(0).cast("long")
    sums = valued.join(by_key, F.col("key") == F.col("of_key")).groupBy(F.col("node").alias("sum_node"))
    sums = sums.agg(
        F.sum(F.coalesce("own", zero) + F.coalesce("later", zero)).alias("saved_tokens"),
        F.sum(F.coalesce("leaves", zero)).alias("n_leaves"),
    )
    total = owned.agg(F.sum("value").alias("saved_tokens"), F.sum("leaf").alias("n_leaves"))
    sums = sums.union(total.select(F.lit(ROOT), "saved_tokens", "n_leaves"))
    sums = held.save("sums", sums)

    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("of_salt")
    parents = nodes.where("n_children > 0").select(
        F.col("node").alias("above"), F.col("conv_id").alias("parent_conv_id"), salts
    )
    salt = F.pmod(F.xxhash64("node"), F.lit(SALTS)) == F.col("of_salt")
    full = nodes.join(parents, (F.col("parent_node") == F.col("above")) & salt, "left")
    full = full.join(sums, F.col("node") == F.col("sum_node"))
    full = full.join(_end_digests(blocks, ids), F.col("node") == F.col("of_node"), "left")
    return full.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
    )
