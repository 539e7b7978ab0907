"""Regularised quadratic discriminant over transformed document statistics.

Class means and covariances come from sums over all labelled training rows, added up by Spark. Each class covariance
is shrunk towards the pooled one and then towards a multiple of the identity; its Cholesky factor is inverted once and
kept with the model. The score is the difference of the classes' log densities (half the squared Mahalanobis distance
and the log determinant), turned into a probability by a logistic fit on a bounded sample of training rows.
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

#: Weight of the pooled covariance, and of the identity.
POOLED, IDENTITY = 0.2, 0.02
PREDICT_AT = 0.3
FOLDS, HELD_OUT = 5, 0

RESULT = "doc_id long, score double, predicted int"


def transformed(batch: pa.RecordBatch) -> np.ndarray:
    """Square roots of shares, which are skewed; the other statistics as they are."""
    x = statistics.features(batch)
    shares = [k for k, name in enumerate(statistics.FEATURES) if name.endswith("_share")]
    x[:, shares] = np.sqrt(np.maximum(x[:, shares], 0))
    return x


@dataclass
class Discriminant:
    scale: np.ndarray
    means: list[np.ndarray]
    factors: list[np.ndarray]
    log_dets: list[float]
    priors: list[float]
    slope: float = 1.0
    shift: float = 0.0

    def difference(self, x: np.ndarray) -> np.ndarray:
        """Log density of class 1 less that of class 0."""
        out = np.zeros(len(x))
        for sign, mean, factor, log_det, prior in zip(
            (-1, 1), self.means, self.factors, self.log_dets, self.priors, strict=True
        ):
            z = (x / self.scale - mean) @ factor.T
            out += sign * (prior - 0.5 * (z * z).sum(1) - log_det)
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * self.difference(x) + self.shift)


def class_sums(rows: DataFrame) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Per label: rows, sums and sums of products. Each task sends one number per label and entry."""
    d = len(statistics.FEATURES)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 + d + d * d))
        for batch in batches:
            x, y = transformed(batch), batch.column("label").to_numpy()
            for label in (0, 1):
                own = x[y == label]
                total[label] += np.r_[len(own), own.sum(0), (own.T @ own).ravel()]
        label, entry = np.divmod(np.arange(total.size), total.shape[1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(label), pa.array(entry), pa.array(total.ravel())], ["label", "entry", "value"]
        )

    parts = rows.select(*statistics.COUNTS, F.col("label").cast("long")).mapInArrow(
        add, "label long, entry long, value double"
    )
    total = np.zeros((2, 1 + d + d * d))
    for row in parts.groupBy("label", "entry").agg(F.sum("value").alias("value")).collect():  # 2 (1 + d + d^2) rows
        total[row.label, row.entry] = row.value
    return {k: (total[k, 0], total[k, 1 : 1 + d], total[k, 1 + d :].reshape(d, d)) for k in (0, 1)}


def fit(sums: dict[int, tuple[float, np.ndarray, np.ndarray]], pooled: float = POOLED, identity: float = IDENTITY):
    """None if a class has fewer than two rows."""
    if min(n for n, _, _ in sums.values()) < 2:
        return None
    n_all = sum(n for n, _, _ in sums.values())
    mean_all = sum(s for _, s, _ in sums.values()) / n_all
    spread = np.diag(sum(q for _, _, q in sums.values())) / n_all - mean_all**2
    scale = np.sqrt(np.where(spread > 1e-12, spread, 1.0))
    means = [sums[k][1] / sums[k][0] / scale for k in (0, 1)]
    scatter = [sums[k][2] / np.outer(scale, scale) - sums[k][0] * np.outer(means[k], means[k]) for k in (0, 1)]
    together = sum(scatter) / n_all
    factors, log_dets, priors = [], [], []
    for k in (0, 1):
        own = (1 - pooled) * scatter[k] / sums[k][0] + pooled * together
        own = (1 - identity) * own + identity * np.eye(len(own))
        lower = np.linalg.cholesky((own + own.T) / 2)
        factors.append(np.linalg.inv(lower))
        log_dets.append(float(np.log(np.diag(lower)).sum()))
        priors.append(float(np.log(sums[k][0] / n_all)))
    return Discriminant(scale, means, factors, log_dets, priors)


def calibrate(model: Discriminant, x: np.ndarray, y: np.ndarray, rounds: int = 50) -> Discriminant:
    """Slope and shift of the difference that fit the labels, by Newton steps with a small ridge."""
    if not len(x) or y.min() == y.max():
        return model
    t = np.clip(model.difference(x), -200, 200)
    design, w = np.stack([t, np.ones(len(t))], 1), np.array([0.1, 0.0])
    for _ in range(rounds):
        p = sigmoid(design @ w)
        h = (design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        w += np.clip(np.linalg.solve(h, design.T @ (y - p) - 1e-3 * w), -1, 1)
    model.slope, model.shift = max(float(w[0]), 1e-3), float(w[1])
    return model


def held_out(folds: int, fold: int):
    """Whether crc32 of doc_id as text falls in the fold; a null id does not."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == fold, F.lit(False))


def quality_scores(docs: DataFrame, labels: DataFrame, sample: int = statistics.SAMPLE_ROWS):
    """doc_id, held_out, score and predicted of every row.

    Only labels of rows outside the held-out fold are used. With fewer than two training rows of a class every score is
    0.5. Empty and null texts are scored like others, from zeros. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    counted = stage(spark, "quality").save("statistics", statistics.document_statistics(docs))
    rows = statistics.labelled(counted, labels, "quality").where(~held_out(FOLDS, HELD_OUT))
    model = fit(class_sums(rows))
    if model:
        table = statistics.sample_rows(rows, sample).select(*statistics.COUNTS, "label").toArrow().combine_chunks()
        for batch in table.to_batches():
            calibrate(model, transformed(batch), batch.column("label").to_numpy().astype(float))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = model.score(transformed(batch)) if model else np.full(batch.num_rows, 0.5)
            predicted = (score >= PREDICT_AT).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(score), pa.array(predicted)], ["doc_id", "score", "predicted"]
            )

    scored = counted.select("doc_id", *statistics.COUNTS).mapInArrow(judge, RESULT)
    return scored.select("doc_id", held_out(FOLDS, HELD_OUT).alias("held_out"), "score", "predicted")
