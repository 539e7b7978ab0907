"""Gradient-boosted trees over document statistics, as flat arrays, with monotonic constraints.

Trees of a fixed depth are grown level by level on binned features. A feature named in MONOTONE may only lower the
score as it grows: a split against that is not taken, and the bounds of a split's two sides hold below it. All trees
lie in three arrays (feature, threshold, value), and a batch is scored by walking every row down a tree at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import statistics
from ledgerloom.llm.common import sigmoid, stage

#: Features that may only lower the quality score as they grow.
MONOTONE = {"symbol_share": -1, "dup_line_share": -1, "repeat_share": -1, "upper_share": -1}
KEEP_AT = 0.3
BASE_WORDS = 50

RESULT = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, score double, kept boolean"
)


@dataclass
class Forest:
    """feature and threshold: a row per tree, nodes in heap order; value: a row per tree, leaves from the left."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        out, depth, rows = np.full(len(x), self.base), int(np.log2(self.value.shape[1])), np.arange(len(x))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            out += value[node - (len(value) - 1)]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.raw(x))


def fit(
    x: np.ndarray,
    y: np.ndarray,
    monotone: list[int],
    trees: int = 60,
    depth: int = 3,
    rate: float = 0.2,
    bins: int = 64,
    least: float = 5.0,
    l2: float = 1.0,
) -> Forest:
    """Logistic loss. Without rows of both labels, no tree: the score is then 1 - KEEP_AT at least, so nothing goes."""
    n, width = x.shape
    if n == 0 or y.min() == y.max():
        return Forest(2.0, np.zeros((0, 1), np.int64), np.zeros((0, 1)), np.zeros((0, 2)))
    edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, bins + 1)[1:-1])) for k in range(width)]
    binned = np.stack([np.searchsorted(edge, x[:, k], side="left") for k, edge in enumerate(edges)], axis=1)
    sign = np.array(monotone)
    base = float(np.log(y.mean() / (1 - y.mean())))
    raw, features, thresholds, values = np.full(n, base), [], [], []
    for _ in range(trees):
        p = sigmoid(raw)
        gradient, hessian = y - p, p * (1 - p)
        feature, threshold = np.zeros(2**depth - 1, np.int64), np.full(2**depth - 1, np.inf)
        low, high = np.full(2 ** (depth + 1) - 1, -np.inf), np.full(2 ** (depth + 1) - 1, np.inf)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            flat = (((node - first) * width)[:, None] + np.arange(width)) * bins + binned
            shape = (count, width, bins)
            g = np.bincount(flat.ravel(), np.repeat(gradient, width), np.prod(shape)).reshape(shape).cumsum(2)
            h = np.bincount(flat.ravel(), np.repeat(hessian, width), np.prod(shape)).reshape(shape).cumsum(2)
            g_all, h_all = g[:, :1, -1:], h[:, :1, -1:]
            own = slice(first, first + count)
            lo, hi = low[own, None, None], high[own, None, None]
            left = np.clip(g / (h + l2), lo, hi)
            right = np.clip((g_all - g) / (h_all - h + l2), lo, hi)
            gain = _gain(g, h, left, l2) + _gain(g_all - g, h_all - h, right, l2)
            gain -= _gain(g_all, h_all, np.clip(g_all / (h_all + l2), lo, hi), l2)
            bad = (h < least) | (h_all - h < least) | (sign[:, None] * (right - left) < 0)
            gain = np.where(bad, 0, gain).reshape(count, -1)
            best = gain.argmax(1)
            for k in range(count):
                at, (f, b) = first + k, divmod(int(best[k]), bins)
                low[2 * at + 1 : 2 * at + 3], high[2 * at + 1 : 2 * at + 3] = low[at], high[at]
                if gain[k, best[k]] <= 1e-9 or b >= len(edges[f]):
                    continue
                feature[at], threshold[at] = f, edges[f][b]
                if sign[f]:
                    middle = (left[k, f, b] + right[k, f, b]) / 2
                    (high if sign[f] > 0 else low)[2 * at + 1] = middle
                    (low if sign[f] > 0 else high)[2 * at + 2] = middle
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > threshold[node])
        leaf, leaves = node - (2**depth - 1), 2**depth
        value = np.bincount(leaf, gradient, leaves) / (np.bincount(leaf, hessian, leaves) + l2)
        value = rate * np.clip(value, low[-leaves:], high[-leaves:])
        raw += value[leaf]
        features.append(feature)
        thresholds.append(threshold)
        values.append(value)
    return Forest(base, np.array(features), np.array(thresholds), np.array(values))


def _gain(g, h, w, l2):
    return g * w - 0.5 * (h + l2) * w * w


def quality_rules(docs: DataFrame, labels: DataFrame, sample: int = statistics.SAMPLE_ROWS, keep_at: float = KEEP_AT):
    """Counts, the base rule and the verdict for every row.

    base_failed: fewer than 50 words, or more than half of the words in repeated windows. kept: not base_failed and a
    score of ``keep_at`` or more. Without labels every document that passes the base rule is kept. An empty table
    gives an empty result; see statistics.py for null and empty texts. Labels of unknown documents have no effect.
    """
    spark = docs.sparkSession
    counted = stage(spark, "quality-rules").save("statistics", statistics.document_statistics(docs))
    rows = statistics.sample_rows(statistics.labelled(counted, labels, "quality"), sample)
    forest = fit(*statistics.to_matrix(rows), [MONOTONE.get(name, 0) for name in statistics.FEATURES])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, repeats = (batch.column(name).to_numpy() for name in ("n_words", "n_repeat_words"))
            failed = (n_words < BASE_WORDS) | (100 * repeats > 50 * n_words)
            score = forest.score(statistics.features(batch))
            kept = [batch.column(name) for name in ("doc_id", *statistics.COUNTS[:5])]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(failed), pa.array(score), pa.array(~failed & (score >= keep_at))],
                ["doc_id", *statistics.COUNTS[:5], "base_failed", "score", "kept"],
            )

    return counted.select(*[F.col(name) for name in ("doc_id", *statistics.COUNTS)]).mapInArrow(judge, RESULT)
