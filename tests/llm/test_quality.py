import collections
import re
import zlib

import numpy as np
import pytest
from helpers import awkward_rows, blank_words, documents

from ledgerloom.llm import boosted_trees, discriminant, statistics
from ledgerloom.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


def counts(text):
    words = blank_words(text)
    lines = [x for x in (text or "").split("\n") if blank_words(x)]
    times = collections.Counter(zip(words, words[1:], words[2:], strict=False))
    repeated = {
        k + j for k in range(len(words) - 2) if times[tuple(words[k : k + 3])] > 1 for j in range(3)
    }
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeated)


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def noisy_rows(n=300):
    """Good texts of plain words, bad ones with symbols."""
    rng = np.random.default_rng(3)
    rows, marks = [], []
    for k in range(n):
        words = [f"w{x}" for x in rng.integers(0, 5000, rng.integers(60, 120))]
        if k % 3 == 0:
            words = [w + rng.choice(["%%%", "###", "$$$"]) if rng.random() < 0.5 else w for w in words]
        rows.append((k, " ".join(words)))
        marks.append((k, int(k % 3 != 0), None))
    return rows, marks


def test_rules_count_like_the_plain_version(spark):
    rows, marks = noisy_rows()
    rows = rows + [(i + 1000 if i else None, t) for i, t in awkward_rows()]
    rows.append((2000, "a b c a b c\nx\n \nx\na b c"))
    marks += [(1001, None, 1), (None, 1, 0), (77777, 0, 0), (3, 1, 0), (3, 0, 0)]
    found = boosted_trees.quality_rules(documents(spark, rows), labels(spark, marks)).collect()
    got = sorted((tuple(r)[:7] for r in found), key=str)
    expected = []
    for doc_id, text in rows:
        own = counts(text)
        expected.append((doc_id, *own, own[0] < 50 or 100 * own[4] > 50 * own[0]))
    assert got == sorted(expected, key=str)
    assert not any(row.kept and row.base_failed for row in found)
    verdict = {row.doc_id: row.kept for row in found}
    assert sum(verdict[k] == (k % 3 != 0) for k in range(300)) >= 290


def test_rules_without_labels_or_rows(spark):
    docs = documents(spark, awkward_rows())
    found = boosted_trees.quality_rules(docs, labels(spark, [])).collect()
    assert all(row.kept != row.base_failed for row in found)
    assert boosted_trees.quality_rules(documents(spark, []), labels(spark, [])).count() == 0


def test_forest_is_monotonic_and_flat():
    rng = np.random.default_rng(1)
    x = rng.random((3000, 3))
    y = (x[:, 0] + 0.3 * np.sin(20 * x[:, 0]) + 0.5 * x[:, 1] + 0.3 * rng.random(3000) < 0.9).astype(float)
    forest = boosted_trees.fit(x, y, [-1, 0, 0])
    grid = np.linspace(0, 1, 200)
    for other in rng.random((20, 2)):
        points = np.c_[grid, np.tile(other, (200, 1))]
        assert (np.diff(forest.raw(points)) <= 1e-9).all()
    assert ((forest.score(x) > 0.5) == y).mean() > 0.85
    row = x[5]
    raw = forest.base
    for feature, threshold, value in zip(forest.feature, forest.threshold, forest.value, strict=True):
        node = 0
        while node < len(feature):
            node = 2 * node + 1 + int(row[feature[node]] > threshold[node])
        raw += value[node - len(feature)]
    assert raw == pytest.approx(forest.raw(x[5:6])[0])


def test_discriminant_equals_the_densities():
    rng = np.random.default_rng(2)
    x = {k: rng.normal(k, 1 + k, (500, len(statistics.FEATURES))) for k in (0, 1)}
    sums = {k: (float(len(v)), v.sum(0), v.T @ v) for k, v in x.items()}
    model = discriminant.fit(sums, pooled=0, identity=0)
    point = rng.normal(0.5, 1, (4, len(statistics.FEATURES)))
    logs = []
    for k in (0, 1):
        cov = np.cov(x[k].T, bias=True)
        away = point - x[k].mean(0)
        logs.append(-0.5 * np.einsum("ij,jk,ik->i", away, np.linalg.inv(cov), away) - 0.5 * np.linalg.slogdet(cov)[1])
    assert model.difference(point) == pytest.approx(logs[1] - logs[0], rel=1e-6)


def test_quality_scores_on_held_out_rows(spark):
    found = QUERIES["op5_quality_classifier"](spark, SF_DIR).toPandas()
    assert len(found) == 1000
    folds = [zlib.crc32(str(k).encode()) % 5 == 0 for k in found.doc_id]
    assert found.held_out.tolist() == folds
    marks = spark.read.parquet(f"{SF_DIR}/labels.parquet").toPandas().merge(found, on="doc_id")
    held = marks[marks.held_out]
    assert ((held.predicted == held.quality).mean()) > 0.95
    assert found.score.between(0, 1).all()


def test_quality_scores_of_awkward_rows(spark):
    rows, marks = noisy_rows(60)
    docs = documents(spark, rows + [(i + 1000 if i else None, t) for i, t in awkward_rows()])
    found = discriminant.quality_scores(docs, labels(spark, marks)).collect()
    assert len(found) == 70
    assert all(0 <= row.score <= 1 and row.predicted == int(row.score >= 0.3) for row in found)
    alone = discriminant.quality_scores(docs, labels(spark, [])).collect()
    assert {row.score for row in alone} == {0.5}
    assert discriminant.quality_scores(documents(spark, []), labels(spark, marks)).count() == 0


def test_quality_rules_on_all_documents(spark):
    found = QUERIES["op4_quality_rules"](spark, SF_DIR).toPandas()
    marks = spark.read.parquet(f"{SF_DIR}/labels.parquet").toPandas().merge(found, on="doc_id")
    sound = marks[~marks.base_failed]
    assert (sound.kept.astype(int) == sound.quality).mean() > 0.97
