"""Conversations as token sequences in which shared beginnings stand once.

Template: ``<turn>`` role ``<says>`` text ``</turn>`` and a line feed. Inside roles and texts a backslash is doubled
and each of the three control strings gets a backslash before it, so a formatted turn can be read back.

Conversations with equal first turns are merged. A node of the prefix tree belongs to the smallest conv_id that goes
through it; the nodes of one owner are one chain from the turn where it leaves a smaller conversation to its end.
Depth-first order, with the smallest conversation first among siblings, is the order of the chains' labels: where the
path to a chain changed its owner, deeper changes first. Sorting by label therefore lays out the whole tree, in as
many range partitions as there are, and each node's start is the tokens before it in its partition and in earlier
partitions. Each turn is encoded once. The tables written to ``folder``:

- ``tokens``: for each emitted turn its chain, depth, start, token ids and the bounds of its loss mask within them
- ``chains``: for each chain its start, length, first position id and the intervals of its ancestors. The position id
  of a token is the chain's first one and its distance from the chain's start; it attends to the ancestors' intervals
  and to what stands before it in its own chain
- ``paths``: for each conversation the stretches of tokens, in order, that make it up

A turn under the loss mask is one of role ``assistant``, without the template around it.

What grows with a conversation passes tasks as sorted streams, a turn at a time; labels are as long as the number of
times a path leaves a smaller conversation. Joins on a chain that many conversations share are between written tables,
so that Spark can split them where they are skewed. Null role and null text count as empty, a null turn comes first,
turns of equal number are put in the order of role and text, repeated rows are turns of their own. Rows with null
conv_id belong to no conversation. Empty tables give empty tables. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import ship, small_batches
from ledgerloom.llm.tokens import encoder

OPEN, SAYS, CLOSE = "<turn>", "<says>", "</turn>"
LEARNED = "assistant"
CONTROL = re.compile(r"\\|<(?=turn>|says>|/turn>)")
ESCAPED = re.compile(r"\\(.)", re.DOTALL)
TURN = re.compile(r"<turn>((?:\\.|[^\\<]|<(?!says>))*)<says>((?:\\.|[^\\<]|<(?!/turn>))*)</turn>\n", re.DOTALL)

TURNS = "conv_id long, depth long, key binary, role string, text string"
TOKENS = (
    "part int, chain long, depth long, offset long, n_tokens long, ids array<int>, loss_start long, loss_end long"
)


def escape(text: str) -> str:
    return CONTROL.sub(lambda found: "\\" + found.group(), text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def format_turn(role: str, text: str) -> tuple[str, str, str]:
    """What stands before the text, the text, what stands after it."""
    return OPEN + escape(role) + SAYS, escape(text), CLOSE + "\n"


def parse_turn(formatted: str) -> tuple[str, str]:
    """Role and text of a formatted turn."""
    found = TURN.fullmatch(formatted)
    if found is None:
        raise ValueError("not a formatted turn")
    return unescape(found[1]), unescape(found[2])


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _with_keys(conversations: DataFrame) -> DataFrame:
    """The turns of each conversation by depth, each with the digest of the conversation up to it."""

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, depth, key = None, 0, b""
        for batch in small_batches(batches):
            depths, keys = [], []
            columns = (batch.column(name).to_pylist() for name in ("conv_id", "role", "text"))
            for conv_id, role, text in zip(*columns, strict=True):
                if conv_id != now:
                    now, depth, key = conv_id, 0, b""
                depth += 1
                said = role.encode()
                key = hashlib.sha256(key + b"%d:" % len(said) + said + text.encode()).digest()
                depths.append(depth)
                keys.append(key)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("conv_id"),
                    pa.array(depths, pa.int64()),
                    pa.array(keys, pa.binary()),
                    batch.column("role"),
                    batch.column("text"),
                ],
                ["conv_id", "depth", "key", "role", "text"],
            )

    plain = conversations.where(conversations["conv_id"].isNotNull()).select(
        conversations["conv_id"].cast("long").alias("conv_id"),
        conversations["turn"].cast("long").alias("turn"),
        F.coalesce(conversations["role"].cast("string"), F.lit("")).alias("role"),
        F.coalesce(conversations["text"].cast("string"), F.lit("")).alias("text"),
    )
    dealt = plain.repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text")
    return dealt.select("conv_id", "role", "text").mapInArrow(follow, TURNS)


def _emit(nodes: DataFrame, tokenizer: str) -> DataFrame:
    """The tokens of each node and their place in its partition. nodes: in order within each partition."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, part, offset = encoder(tokenizer).encode, TaskContext.get().partitionId(), 0
        for batch in small_batches(batches, 128):
            rows = []
            columns = (batch.column(name).to_pylist() for name in ("conv_id", "depth", "role", "text"))
            for chain, depth, role, text in zip(*columns, strict=True):
                before, said, after = (np.frombuffer(ids_of(t), dtype="<i4") for t in format_turn(role, text))
                ids = np.concatenate([before, said, after])
                ends = len(before) + len(said) if role == LEARNED else len(before)
                rows.append((part, chain, depth, offset, len(ids), ids, len(before), ends))
                offset += len(ids)
            names = ["part", "chain", "depth", "offset", "n_tokens", "ids", "loss_start", "loss_end"]
            kinds = [pa.int32(), *[pa.int64()] * 4, pa.list_(pa.int32()), pa.int64(), pa.int64()]
            yield _batch(rows, names, kinds)

    return nodes.select("conv_id", "depth", "role", "text").mapInArrow(encode, TOKENS)


@dataclass(frozen=True)
class Formatted:
    """Written conversations, see the module's text."""

    tokens: DataFrame
    chains: DataFrame
    paths: DataFrame


def _save(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def write_conversations(conversations: DataFrame, folder: str, tokenizer: str) -> Formatted:
    """Format (conv_id, turn, role, text) and write the three tables below ``folder``."""
    spark = conversations.sparkSession
    ship(spark)
    turns = _save(spark, _with_keys(conversations), f"{folder}/work/turns")
    owners = turns.groupBy(F.col("key").alias("of_key")).agg(F.min("conv_id").alias("owner"))
    owned = turns.select("conv_id", "depth", "key").join(owners, F.col("key") == F.col("of_key"))
    legs = owned.groupBy("conv_id", "owner")
    legs = legs.agg(F.min("depth").alias("first_depth"), F.max("depth").alias("last_depth"))
    legs = _save(spark, legs, f"{folder}/work/legs")  # owners only grow along a path: a leg is a stretch of it

    # a chain's first depth and label
    label = F.sort_array(F.collect_list(F.struct("first_depth", "owner")))
    labels = legs.groupBy("conv_id").agg(
        F.transform(label, lambda leg: F.struct((-leg["first_depth"]).alias("back"), leg["owner"].alias("owner"))).alias("label"),
        F.max(F.when(F.col("owner") == F.col("conv_id"), F.col("first_depth"))).alias("from_depth"),
    )
    labels = labels.where(F.col("from_depth").isNotNull()).withColumnRenamed("conv_id", "of_conv")
    nodes = turns.join(labels, (F.col("conv_id") == F.col("of_conv")) & (F.col("depth") >= F.col("from_depth")))
    nodes = _save(spark, nodes.select("conv_id", "depth", "role", "text", "label"), f"{folder}/work/nodes")
    wide = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    laid = nodes.repartitionByRange(wide, "label", "depth").sortWithinPartitions("label", "depth")
    emitted = _save(spark, _emit(laid, tokenizer), f"{folder}/work/emitted")

    parts = emitted.groupBy(F.col("part").alias("of_part")).agg(F.sum("n_tokens").alias("n"))  # a row a partition
    before = Window.orderBy("of_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("of_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    placed = emitted.join(parts, F.col("part") == F.col("of_part"))
    placed = placed.withColumn("start", F.col("base") + F.col("offset"))
    tokens = placed.select("chain", "depth", "start", "n_tokens", "ids", "loss_start", "loss_end")
    tokens = _save(spark, tokens, f"{folder}/tokens")

    place = tokens.select("chain", "depth", "start", (F.col("start") + F.col("n_tokens")).alias("end"))
    first = place.select(F.col("chain").alias("a_chain"), F.col("depth").alias("a_depth"), "start")
    last = place.select(F.col("chain").alias("z_chain"), F.col("depth").alias("z_depth"), "end")
    legs = legs.join(first, (F.col("owner") == F.col("a_chain")) & (F.col("first_depth") == F.col("a_depth")))
    legs = _save(spark, legs.select("conv_id", "owner", "first_depth", "last_depth", "start"), f"{folder}/work/started")
    legs = legs.join(last, (F.col("owner") == F.col("z_chain")) & (F.col("last_depth") == F.col("z_depth")))
    stretch = F.struct("first_depth", "last_depth", F.col("owner").alias("chain"), "start", "end")
    paths = legs.groupBy("conv_id").agg(F.sort_array(F.collect_list(stretch)).alias("stretches"))
    paths = _save(spark, paths, f"{folder}/paths")

    own = F.element_at("stretches", -1)
    above = F.slice("stretches", F.lit(1), F.size("stretches") - 1)
    chains = paths.where(own["chain"] == F.col("conv_id")).select(
        F.col("conv_id").alias("chain"),
        own["first_depth"].alias("depth"),
        own["start"].alias("start"),
        (own["end"] - own["start"]).alias("n_tokens"),
        F.aggregate(above, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]).alias("first_position"),
        F.transform(above, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))).alias("ancestors"),
    )
    return Formatted(tokens, _save(spark, chains, f"{folder}/chains"), paths)


def open_conversations(spark: SparkSession, folder: str) -> Formatted:
    """What ``write_conversations`` has written to ``folder``."""
    return Formatted(*(spark.read.parquet(f"{folder}/{name}") for name in ("tokens", "chains", "paths")))


def _decoded(tokens: DataFrame, tokenizer: str) -> DataFrame:
    """Each emitted turn as role and text, with the text under its loss mask."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text_of = encoder(tokenizer).decode
        for batch in small_batches(batches, 128):
            rows = []
            columns = (batch.column(name).to_pylist() for name in ("chain", "depth", "ids", "loss_start", "loss_end"))
            for chain, depth, ids, a, e in zip(*columns, strict=True):
                formatted = text_of(ids)
                role, text = parse_turn(formatted)
                rows.append((chain, depth, role, text, unescape(text_of(ids[a:e])), len(formatted)))
            names = ["chain", "depth", "role", "text", "loss", "n_chars"]
            yield _batch(rows, names, [pa.int64(), pa.int64(), *[pa.string()] * 3, pa.int64()])

    wanted = tokens.select("chain", "depth", "ids", "loss_start", "loss_end")
    return wanted.mapInArrow(decode, "chain long, depth long, role string, text string, loss string, n_chars long")


def read_turns(written: Formatted, folder: str, tokenizer: str) -> DataFrame:
    """(conv_id, depth, role, text, loss, n_chars) of all conversations, from the token ids."""
    spark = written.tokens.sparkSession
    read = _save(spark, _decoded(written.tokens, tokenizer), f"{folder}/work/decoded")
    legs = written.paths.select("conv_id", F.explode("stretches").alias("s"))
    legs = legs.select("conv_id", F.col("s.chain").alias("of"), "s.first_depth", "s.last_depth")
    legs = _save(spark, legs, f"{folder}/work/wanted")
    inside = F.col("depth").between(F.col("first_depth"), F.col("last_depth"))
    joined = legs.join(read, (F.col("of") == F.col("chain")) & inside)
    return joined.select("conv_id", "depth", "role", "text", "loss", "n_chars")


def summaries(turns: DataFrame) -> DataFrame:
    """Counts and digests of each conversation, from ``read_turns``."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for batch in small_batches(batches):
            rows = []
            columns = (batch.column(name).to_pylist() for name in ("conv_id", "role", "text", "loss", "n_chars"))
            for conv_id, role, text, loss, n_chars in zip(*columns, strict=True):
                if now is None or conv_id != now[0]:
                    if now:
                        rows.append((now[0], now[1], now[2].hexdigest(), now[3], now[4].hexdigest(), now[5]))
                    now = [conv_id, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                now[1] += 1
                now[2].update(f"{role}\n{text}\n".encode())
                now[3] += len(loss)
                now[4].update(loss.encode())
                now[5] += n_chars
            yield _batch(rows, names, kinds)
        if now:
            yield _batch([(now[0], now[1], now[2].hexdigest(), now[3], now[4].hexdigest(), now[5])], names, kinds)

    dealt = turns.repartition("conv_id").sortWithinPartitions("conv_id", "depth")
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return dealt.select("conv_id", "role", "text", "loss", "n_chars").mapInArrow(digest, schema)
