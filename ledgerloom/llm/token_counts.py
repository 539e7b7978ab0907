"""Token counts that follow edits: a segment tree of counts for each document.

A leaf is LEAF_WORDS words; it begins at a place where a cut changes no pre-token (see tokens.py). ``cuts`` holds the
leaves' character offsets and the text's end, ``tree`` the sums in heap order: node 1 is the root, node i has children
2i and 2i+1, and the leaves stand last. An edit (start, stop, replacement, by characters of the text before the edits)
re-encodes only the leaves it touches, with one character of context on either side; the changed leaves' sums then go
up to the root. The leaves an edit has touched become one; the others of them stay with no characters.

A null text counts as empty; null or no edits change nothing; edits of a document must not overlap. Rows are
independent, so repeated rows and null doc_id need no rule. Columns other than those read are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import small_batches, texts
from ledgerloom.llm.tokens import Encoder, encoder

LEAF_WORDS = 64
EDITS = "array<struct<start:int,stop:int,replacement:string>>"
TREES = "doc_id long, text string, cuts array<int>, tree array<int>"
APPLIED = (
    "doc_id long, text string, cuts array<int>, tree array<int>, n_tokens long, n_edits int, "
    "n_tokens_edited long, n_leaves int, n_leaves_encoded int"
)


def leaf_cuts(text: str, words: int = LEAF_WORDS) -> list[int]:
    """Offsets 0, ..., len(text), each inner one at a blank after a character that isn't white space."""
    cuts, at, seen = [0], 0, 0
    while (at := text.find(" ", at + 1)) > 0:
        seen += 1
        if seen >= words and not text[at - 1].isspace():
            cuts.append(at)
            seen = 0
    return [*cuts, len(text)]


def build_tree(counts: list[int]) -> list[int]:
    size = 1 << max(0, len(counts) - 1).bit_length()
    tree = [0] * size + counts + [0] * (size - len(counts))
    for node in range(size - 1, 0, -1):
        tree[node] = tree[2 * node] + tree[2 * node + 1]
    return tree


def set_leaf(tree: list[int], leaf: int, count: int) -> None:
    """A leaf's new count, and the sums above it."""
    node = len(tree) // 2 + leaf
    change = count - tree[node]
    while change and node:
        tree[node] += change
        node //= 2


def count_of(text: str, encode: Encoder) -> int:
    return len(encode.encode(text)) // 4


def edited(text: str, cuts: list[int], tree: list[int], edits: list, encode: Encoder):
    """Text, cuts and tree after the edits, and how many leaves were encoded again."""
    leaves = len(cuts) - 1
    groups: list[list] = []  # [first leaf, last leaf, edits]
    leaf = 0
    for start, stop, new in sorted(edits):
        while leaf < leaves - 1 and cuts[leaf + 1] < start:  # a cut at start or just after it is context
            leaf += 1
        last = leaf
        while last < leaves - 1 and cuts[last + 1] <= stop:
            last += 1
        if groups and groups[-1][1] >= leaf:
            groups[-1][1] = max(last, groups[-1][1])
            groups[-1][2].append((start, stop, new))
        else:
            groups.append([leaf, last, [(start, stop, new)]])
    tree, out, new_cuts, at, done, shift, encoded = list(tree), [], list(cuts), 0, 0, 0, 0
    for first, last, own in groups:
        region, place = [], cuts[first]
        for start, stop, new in own:
            region += [text[place:start], new or ""]
            place = stop
        region.append(text[place : cuts[last + 1]])
        fresh = "".join(region)
        out += [text[at : cuts[first]], fresh]
        at = cuts[last + 1]
        for k in range(done + 1, first + 1):
            new_cuts[k] = cuts[k] + shift
        shift += len(fresh) - (cuts[last + 1] - cuts[first])
        for k in range(first + 1, last + 2):
            new_cuts[k] = cuts[last + 1] + shift
        done = last + 1
        set_leaf(tree, first, count_of(fresh, encode))
        for k in range(first + 1, last + 1):
            set_leaf(tree, k, 0)
        encoded += last - first + 1
    for k in range(done + 1, leaves + 1):
        new_cuts[k] = cuts[k] + shift
    out.append(text[at:])
    return "".join(out), new_cuts, tree, encoded


def build_trees(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Each document's text with its leaves and sums."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in small_batches(batches):
            cuts, trees = [], []
            for text in batch.column("text").to_pylist():
                text = text or ""
                cuts.append(leaf_cuts(text))
                counts = [count_of(text[a:b], encode) for a, b in zip(cuts[-1], cuts[-1][1:], strict=False)]
                trees.append(build_tree(counts))
            kind = pa.list_(pa.int32())
            columns = [batch.column("doc_id"), batch.column("text"), pa.array(cuts, kind), pa.array(trees, kind)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text", "cuts", "tree"])

    return texts(docs).mapInArrow(build, TREES)


def apply_edits(trees: DataFrame, tokenizer: str) -> DataFrame:
    """Apply the column ``edits`` (see EDITS) to the text and the tree beside it."""

    def update(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in small_batches(batches):
            rows = []
            for row in batch.to_pylist():
                text, edits = row["text"] or "", row["edits"] or []
                own = [(e["start"], e["stop"], e["replacement"] or "") for e in edits]
                after, cuts, tree, encoded = edited(text, row["cuts"], row["tree"], own, encode)
                rows.append(
                    {
                        "doc_id": row["doc_id"],
                        "text": after,
                        "cuts": cuts,
                        "tree": tree,
                        "n_tokens": row["tree"][1],
                        "n_edits": len(own),
                        "n_tokens_edited": tree[1],
                        "n_leaves": len(cuts) - 1,
                        "n_leaves_encoded": encoded,
                    }
                )
            yield pa.RecordBatch.from_pylist(rows, schema=APPLIED_ARROW)

    columns = [F.col(name) for name in ("doc_id", "text", "cuts", "tree", "edits")]
    return trees.select(*columns).mapInArrow(update, APPLIED)


APPLIED_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("text", pa.string()),
        ("cuts", pa.list_(pa.int32())),
        ("tree", pa.list_(pa.int32())),
        ("n_tokens", pa.int64()),
        ("n_edits", pa.int32()),
        ("n_tokens_edited", pa.int64()),
        ("n_leaves", pa.int32()),
        ("n_leaves_encoded", pa.int32()),
    ]
)


def find_edits(text, pattern: str, replacement: str):
    """A column of edits that replace every match of a regular expression."""
    import re

    find = re.compile(pattern)

    @F.udf(EDITS, useArrow=True)
    def edits(value: str | None):
        return [(m.start(), m.end(), replacement) for m in find.finditer(value or "")]

    return edits(text)
