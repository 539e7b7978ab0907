import zlib

import numpy as np
from helpers import awkward_rows, documents
from pyspark.sql import functions as F

from ledgerloom.llm import toxicity
from ledgerloom.llm.queries import QUERIES


def fixture(n=400):
    """Toxic texts hold an insult and mostly 'women'; others rarely do."""
    rng = np.random.default_rng(5)
    rows, marks = [], []
    for k in range(n):
        words = [f"w{x}" for x in rng.integers(0, 300, 30)]
        toxic = int(k % 4 == 0)
        if toxic and rng.random() < 0.7:
            words[3] = rng.choice(["idiot", "scum"])
        if rng.random() < (0.9 if toxic else 0.05):
            words[7] = "women"
        rows.append((k, " ".join(words) + "."))
        marks.append((k, 1, toxic))
    return rows, marks


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_swaps_take_the_weight_from_identity_terms(spark):
    rows, marks = fixture()
    docs, known = documents(spark, rows), labels(spark, marks)
    plain = toxicity.train(docs, known, swap_penalty=0.0)
    fair = toxicity.train(docs, known, swap_penalty=10.0)
    text = [b"w1 w2 women w3.", b"w1 w2 men w3.", b"w1 idiot w3."]
    before, after = plain.score(text), fair.score(text)
    assert before[0] - before[1] > 0.2
    assert abs(after[0] - after[1]) < 0.1
    assert after[0] < before[0] - 0.2
    assert after[0] < after[2] - 0.2


def test_swapped_words():
    swaps = toxicity.Swaps({"x": "a, b", "y": "old people, deaf, young old people"})
    assert swaps(b"A x") == [{b"b", b"x"}, {b"x"}]
    assert swaps(b"b") == [{b"a"}, set()]
    assert swaps(b"x aa") == [] and swaps(None) == [] and swaps(b"") == []
    assert swaps(b"Young old people!") == [{b"old", b"people"}, set()]
    assert swaps(b"we are old. People b") == [{b"we", b"are", b"old", b"people", b"a"}, {b"we", b"are", b"old", b"people"}]
    assert toxicity.Swaps({})(b"a") == []


def test_an_id_of_many_rows_stays_within_the_sample(spark):
    docs = documents(spark, [(1, f"text {k}") for k in range(300)] + [(k, "other") for k in range(2, 20)])
    known = labels(spark, [(k, 1, k % 2) for k in range(20)])
    outside = sum(zlib.crc32(str(k).encode()) % 4 != 2 for k in range(2, 20))
    assert toxicity.training_rows(docs, known, 50).count() == outside
    assert toxicity.training_rows(docs, known, 5).count() == 5
    assert toxicity.training_rows(docs, known, 1000).count() == outside + 300 * (zlib.crc32(b"1") % 4 != 2)


def test_penalty_removes_false_positives_on_neutral_mentions(spark):
    """Mentions planted in toxic training texts, and in clean texts that are then scored."""
    sf_dir = "/root/testdata/sf0.1"
    known = spark.read.parquet(f"{sf_dir}/labels.parquet")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").join(known.select("doc_id", "toxic"), "doc_id")
    group = F.element_at(F.array(*map(F.lit, ["Frauen", "gay people", "immigrés", "niñas"])), (F.col("doc_id") % 4 + 1).cast("int"))
    biased = docs.withColumn("text", F.when(F.col("toxic") == 1, F.concat("text", F.lit(" So are "), group, F.lit("."))).otherwise(F.col("text")))
    neutral = docs.where("toxic = 0").withColumn("text", F.concat(F.substring("text", 1, 200), F.lit(". We met "), group, F.lit(".")))
    texts = [row.text.encode() for row in neutral.select("text").collect()]
    rates = [
        float((toxicity.train(biased, known, swap_penalty=penalty).score(texts) >= toxicity.PREDICT_AT).mean())
        for penalty in (0.0, 10.0)
    ]
    assert rates[0] > 0.1 and rates[1] < rates[0] / 4, rates


def test_few_rows(spark):
    sf_dir = "/root/testdata/sf0.01"
    found = QUERIES["op6_toxicity"](spark, sf_dir).toPandas()
    marks = spark.read.parquet(f"{sf_dir}/labels.parquet").toPandas().merge(found, on="doc_id")
    held = marks[marks.held_out]
    print(held[held.toxic == 1].predicted.mean(), held[held.toxic == 0].predicted.mean())
    assert held[held.toxic == 1].predicted.mean() > 0.4


def test_awkward_rows_and_filter(spark):
    rows, marks = fixture(120)
    rows += [(i + 1000 if i else None, t) for i, t in awkward_rows()]
    marks += [(None, 1, 1), (88888, 1, 1), (1001, 1, None), (0, 1, 1)]
    docs, known = documents(spark, rows), labels(spark, marks)
    found = toxicity.toxicity_scores(docs, known).collect()
    assert len(found) == len(rows)
    assert all(0 <= row.score <= 1 and row.predicted == int(row.score >= 0.3) for row in found)
    assert {row.doc_id for row in found if row.held_out} == {
        i for i, _ in rows if i is not None and zlib.crc32(str(i).encode()) % 4 == 2
    }
    kept = toxicity.without_toxic(docs, known)
    assert kept.columns == docs.columns
    assert kept.count() == sum(row.predicted == 0 for row in found)
    none = toxicity.toxicity_scores(docs, labels(spark, []))
    assert none.where(F.col("predicted") == 1).count() == 0
    assert toxicity.toxicity_scores(documents(spark, []), known).count() == 0


def test_labels_of_the_held_out_fold_are_not_learnt(spark):
    rows, marks = fixture(200)
    held = {k for k, _ in rows if zlib.crc32(str(k).encode()) % 4 == 2}
    other = [(k, q, 1 - t if k in held else t) for k, q, t in marks]
    docs = documents(spark, rows)
    one, two = (toxicity.train(docs, labels(spark, own)) for own in (marks, other))
    assert one.index == two.index and np.allclose(one.weights, two.weights)


def test_scores_on_all_documents(spark):
    sf_dir = "/root/testdata/sf0.1"
    found = QUERIES["op6_toxicity"](spark, sf_dir).toPandas()
    marks = spark.read.parquet(f"{sf_dir}/labels.parquet").toPandas().merge(found, on="doc_id")
    held = marks[marks.held_out]
    assert (held.predicted == held.toxic).mean() > 0.97
    assert held[held.toxic == 1].predicted.mean() > 0.8
    assert held[held.toxic == 0].predicted.mean() < 0.02
