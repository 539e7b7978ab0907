"""Plain versions of the operators' rules, and a table with awkward rows."""

from __future__ import annotations

import re

UPPER_TO_LOWER = {c: c + 32 for c in range(65, 91)}


def blank_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER_TO_LOWER))


def awkward_rows():
    """Nulls, empty and blank texts, white space of all kinds, a long text, repeated rows and ids."""
    sentence = "the quick brown fox jumps over the lazy dog and runs away from all of the hunters in those woods"
    return [
        (1, sentence),
        (2, None),
        (3, ""),
        (4, " \t\n "),
        (5, sentence.upper() + "\n\n" + sentence + "\n"),
        (5, "another text under the same id"),
        (6, "été  中文 don't <|endoftext|> x \x1c y 123456789 mail me@example.org now "),
        (7, " ".join(f"word{k % 997}" for k in range(6000))),
        (None, sentence + " once more"),
        (1, sentence),
    ]


def documents(spark, rows):
    """A table of documents with further columns that clash with names the operators use."""
    return spark.createDataFrame(
        [(i, t, "en", "s", len(t or ""), 0.5, "k", 7) for i, t in rows],
        "doc_id long, text string, lang string, source string, n_chars long, score double, key string, n_words int",
    ).repartition(3)
