"""Toxicity by a linear classifier that identity terms must not move.

Features of a text are its words (A-Z lower-cased, runs of letters, digits and characters beyond ASCII) and their first
4, 5 and 6 bytes, each present or not. Training uses labelled rows outside the held-out fold, at most SAMPLE_ROWS of
them (those with the smallest hash of doc_id), and of their features the FEATURES_KEPT that tell the labels apart best.
Each labelled text that holds identity terms has two counterparts: in one every identity term of its sentences is
swapped for the next of the list, in the other for no word at all. The loss is logistic, with a ridge and
``swap_penalty`` times the squared change of the score under either swap: a term that only happens to stand in toxic
texts gets no weight, and neither does the term it is swapped for.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import as_bytes, sigmoid, stage, texts
from ledgerloom.llm.discriminant import held_out

FOLDS, HELD_OUT = 4, 2
PREDICT_AT = 0.3
SAMPLE_ROWS = 20_000
FEATURES_KEPT = 4096
FEATURES_LEAST, ROWS_A_FEATURE = 256, 4
LEAST_ROWS = 4
PREFIXES = (4, 5, 6)
#: Neutral mentions of groups by language, of one word or more. A swap takes each for the next of its language, and the
#: last for the first.
LEXICON = {
    "en": "women, men, girls, boys, muslims, christians, jews, hindus, buddhists, atheists, gay people, straight people, "
    "lesbian, transgender, black people, white people, asian, latino, african, european, immigrants, refugees, "
    "foreigners, people with disabilities, deaf, blind, old people, young people",
    "de": "frauen, männer, mädchen, jungen, muslime, christen, juden, hindus, schwule, lesben, schwarze menschen, "
    "weiße menschen, einwanderer, geflüchtete, ausländer, menschen mit behinderung, alte menschen, junge menschen",
    "fr": "femmes, hommes, filles, garçons, musulmans, chrétiens, juifs, hindous, gays, lesbiennes, personnes noires, "
    "personnes blanches, immigrés, réfugiés, étrangers, personnes handicapées, personnes âgées, jeunes",
    "es": "mujeres, hombres, niñas, niños, musulmanes, cristianos, judíos, hindúes, gais, lesbianas, personas negras, "
    "personas blancas, inmigrantes, refugiados, extranjeros, personas con discapacidad, personas mayores, jóvenes",
}
SENTENCE_ENDS = re.compile(rb"[.!?\n]+")

_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or 48 <= c <= 57 or c > 127 else 32 for c in range(256)
)
CACHE_WORDS = 200_000


def words_of(text: bytes | None) -> set[bytes]:
    return set(text.translate(_WORDS).split(b" ")) - {b""} if text else set()


def features_of(word: bytes) -> list[bytes]:
    """A word, and its beginnings; these are marked apart from words."""
    return [word, *(word[:k] + b"*" for k in PREFIXES if len(word) >= k)]


class Swaps:
    """Identity terms of several languages and what each is swapped for."""

    def __init__(self, lexicon: dict[str, str]):
        self.after: dict[bytes, bytes] = {}
        for listed in lexicon.values():
            terms = [term.strip().encode() for term in listed.split(",") if term.strip()]
            for term, other in zip(terms, terms[1:] + terms[:1], strict=True):
                self.after.setdefault(term, other)
        longest_first = sorted(self.after, key=lambda term: (-len(term), term))
        self.found = re.compile(rb"(?<![^ ])(?:" + b"|".join(map(re.escape, longest_first)) + rb")(?![^ ])")

    def words(self) -> list[bytes]:
        return sorted({word for term in self.after for word in term.split()})

    def __call__(self, text: bytes | None) -> list[set[bytes]]:
        """The words of the text with the terms of each sentence swapped, and without them; nothing if there is none."""
        if not text or not self.after:
            return []
        sentences = [s.translate(_WORDS) for s in SENTENCE_ENDS.split(text)]
        if not any(map(self.found.search, sentences)):
            return []
        changed = [self.found.sub(lambda m: self.after[m.group()], s) for s in sentences]
        without = [self.found.sub(b"", s) for s in sentences]
        return [set(b" ".join(some).split()) for some in (changed, without)]


@dataclass
class Linear:
    """Weights by feature."""

    index: dict[bytes, int]
    weights: np.ndarray
    shift: float

    def __post_init__(self):
        self._known: dict[bytes, tuple[int, ...]] = {}

    def rows(self, words: set[bytes]) -> set[int]:
        known, out = self._known, set()
        if len(known) > CACHE_WORDS:
            known.clear()
        for word in words:
            own = known.get(word)
            if own is None:
                own = known[word] = tuple(self.index[f] for f in features_of(word) if f in self.index)
            if own:
                out.update(own)
        return out

    def score(self, found: list[bytes | None]) -> np.ndarray:
        raw = [self.shift + self.weights[sorted(self.rows(words_of(text)))].sum() for text in found]
        return sigmoid(np.array(raw, float))


def _gather(sets: list[set[int]], width: int):
    """Functions x -> Ax and r -> A'r of the 0/1 matrix with these rows."""
    columns = np.array([k for one in sets for k in sorted(one)], np.int64)
    rows = np.repeat(np.arange(len(sets)), [len(one) for one in sets])
    return (
        lambda w: np.bincount(rows, w[columns], len(sets)),
        lambda r: np.bincount(columns, r[rows], width),
    )


def fit(
    sets: list[set[int]],
    labels: np.ndarray,
    pairs: list[tuple[set[int], set[int]]],
    width: int,
    swap_penalty: float = 10.0,
    ridge: float = 1e-3,
    rounds: int = 300,
) -> tuple[np.ndarray, float]:
    """Weights and shift by gradient steps with momentum. pairs: features of a text and of its counterpart."""
    times, back = _gather(sets, width)
    one, one_back = _gather([a for a, _ in pairs], width)
    other, other_back = _gather([b for _, b in pairs], width)
    n, m = max(len(sets), 1), max(len(pairs), 1)
    w, shift = np.zeros(width), 0.0
    v, v_shift = np.zeros(width), 0.0
    # squared gradients scale the steps of rare and frequent features
    s, s_shift = np.zeros(width), 0.0
    for step in range(1, rounds + 1):
        residual = (sigmoid(times(w) + shift) - labels) / n
        change = (one(w) - other(w)) / m
        g = back(residual) + ridge * w + 2 * swap_penalty * (one_back(change) - other_back(change))
        g_shift = residual.sum()
        v, v_shift = 0.9 * v + 0.1 * g, 0.9 * v_shift + 0.1 * g_shift
        s, s_shift = 0.999 * s + 0.001 * g * g, 0.999 * s_shift + 0.001 * g_shift**2
        fix, fix2 = 1 - 0.9**step, 1 - 0.999**step
        rate = 0.05 if step < rounds // 2 else 0.02
        w -= rate * (v / fix) / (np.sqrt(s / fix2) + 1e-8)
        shift -= rate * (v_shift / fix) / (np.sqrt(s_shift / fix2) + 1e-8)
    return w, shift


def training_rows(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """text and label of the bounded sample, ``sample`` rows at most however many rows share an id.

    Ids are chosen from the labels first, by hash, as long as their rows fit. There are ``sample`` of them at most, so
    they are broadcast and the texts of all other documents go no further than their scan. An id with more rows than
    the whole sample is not learnt from.
    """
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("label"))
        .where(~held_out(FOLDS, HELD_OUT))
    )
    own = texts(docs)
    present = own.groupBy(F.col("doc_id").alias("of_doc")).agg(F.count(F.lit(1)).alias("n_rows"))
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    chosen = known.join(present, known.doc_id == present.of_doc).where(F.col("n_rows") <= sample)
    chosen = chosen.orderBy(*order).limit(sample)
    taken = F.sum("n_rows").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    chosen = chosen.withColumn("taken", taken).where(F.col("taken") <= sample).select("of_doc", "label")
    return own.join(F.broadcast(chosen), own.doc_id == chosen.of_doc).select("text", "label")


def train(
    docs: DataFrame,
    labels: DataFrame,
    sample: int = SAMPLE_ROWS,
    lexicon: dict[str, str] | None = None,
    swap_penalty: float = 10.0,
) -> Linear:
    """A model from the labelled rows outside the held-out fold; without any, one that scores every text low."""
    spark = docs.sparkSession
    swaps = Swaps(LEXICON if lexicon is None else lexicon)
    rows = stage(spark, "toxicity").save("training", training_rows(docs, labels, sample))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for text, label in zip(as_bytes(batch.column("text")), batch.column("label").to_pylist(), strict=True):
                totals[label].update({f for word in words_of(text) for f in features_of(word)})
        for label, total in enumerate(totals):
            keys = [k for k, n in total.items()]
            for at in range(0, len(keys), 50_000):
                some = keys[at : at + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some, pa.binary()), pa.array([label] * len(some)), pa.array([total[k] for k in some])],
                    ["feature", "label", "n"],
                )

    counts = rows.mapInArrow(count, "feature binary, label long, n long").groupBy("feature")
    counts = counts.agg(
        F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("n1"),
        F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("n0"),
    )
    sizes = {row.label: row["count"] for row in rows.groupBy("label").count().collect()}
    all1, all0 = sizes.get(1, 0), sizes.get(0, 0)
    if not all1 or not all0:
        return Linear({}, np.zeros(0), -2.0 if not all1 else 2.0)
    p1, p0 = (F.col("n1") + 0.5) / (all1 + 1), (F.col("n0") + 0.5) / (all0 + 1)
    tells = F.abs(F.log(p1 / p0)) * F.abs(p1 - p0)
    best = counts.where(F.col("n1") + F.col("n0") >= LEAST_ROWS).orderBy(tells.desc(), "feature").limit(min(FEATURES_KEPT, max(FEATURES_LEAST, (all1 + all0) // ROWS_A_FEATURE)))
    chosen = [bytes(row.feature) for row in best.select("feature").collect()]
    chosen = list(dict.fromkeys([*chosen, *(f for word in swaps.words() for f in features_of(word))]))
    model = Linear({f: k for k, f in enumerate(chosen)}, np.zeros(len(chosen)), 0.0)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, other = [], []
            for text in as_bytes(batch.column("text")):
                own.append(sorted(model.rows(words_of(text))))
                other.append([sorted(model.rows(after)) for after in swaps(text)])
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(own, kind), pa.array(other, pa.list_(kind)), batch.column("label")],
                ["own", "other", "label"],
            )

    table = rows.mapInArrow(encode, "own array<int>, other array<array<int>>, label int").collect()  # SAMPLE_ROWS rows
    sets = [set(row.own) for row in table]
    pairs = [(set(row.own), set(after)) for row in table for after in row.other]
    model.weights, model.shift = fit(
        sets, np.array([row.label for row in table], float), pairs, len(chosen), swap_penalty
    )
    return model


def score_column(model: Linear, text):
    """The score of a text column; null and empty texts have the score of a text without features."""
    parts = (model.index, model.weights, model.shift)

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = Linear(*parts)
        for column in batches:
            yield pa.array(own.score(as_bytes(column)))

    return score(text.cast("string"))


def toxicity_scores(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """doc_id, held_out, score and predicted of every row; repeated rows and null ids are rows like others.

    Labels other than 0 and 1, and of unknown documents, have no effect. An empty table gives an empty result.
    """
    model = train(docs, labels, **settings)
    own = texts(docs)
    scored = own.select("doc_id", held_out(FOLDS, HELD_OUT).alias("held_out"), score_column(model, own.text).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= PREDICT_AT).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """The rows whose text is not predicted toxic, with all their columns."""
    model = train(docs, labels, **settings)
    return docs.where(score_column(model, docs["text"]) < PREDICT_AT)
