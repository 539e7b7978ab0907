import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from ledgerloom.llm import decontamination, packing, simhash, substrings, toxicity
from ledgerloom.llm.oracle import ORACLE_SQL, PARTIAL_SQL
from ledgerloom.llm.queries import QUERIES
from ledgerloom.llm.tokens import default_path

SF_DIR = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    names = entry_points.queries()
    assert [len([n for n in names if n.startswith(f"op{k}_")]) for k in range(1, 11)] == [1] * 10
    assert "pipeline" in names
    assert set(ORACLE_SQL) <= set(entry_points.oracle_sql()) <= set(names)


def test_stages_follow_each_other(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    bench = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    for name, function in corpus_pipeline.STAGES:
        before, ids = docs, {row.doc_id for row in docs.select("doc_id").collect()}
        out = function(spark, docs, SF_DIR)
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        after = {row.doc_id for row in docs.select("doc_id").collect()}
        if name == "toxicity":
            scored = toxicity.toxicity_scores(before, labels)
            assert after == {r.doc_id for r in scored.collect() if not r.predicted}
        elif name == "simhash_near_dedup":
            assert after == {r.component_id for r in simhash.near_duplicates(before).collect()}
        elif name == "substring_dedup":
            assert after == ids
            removed = {r.doc_id: r.n_removed for r in substrings.remove_repeats(before).collect()}
            lengths = {r.doc_id: len(r.text.encode().split()) for r in before.collect()}
            assert all(len(r.text.encode().split()) == lengths[r.doc_id] - removed[r.doc_id] for r in docs.collect())
        elif name == "benchmark_decontamination":
            bad = {r.doc_id for r in decontamination.decontaminate(before, bench).collect() if r.contaminated}
            assert after == ids - bad
        else:
            assert after == ids
            assert docs.count() == packing.pieces(before, default_path()).count()
            continue
        assert docs.columns == columns


def test_run_gives_the_last_stage(spark):
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert rows and {"doc_id", "sequence_id", "offset"} <= set(rows[0].asDict())


@pytest.mark.parametrize("name", sorted({**ORACLE_SQL, **PARTIAL_SQL}))
def test_sql(spark, duck, name):
    got = QUERIES[name](spark, SF_DIR)
    expected = duck.execute(ORACLE_SQL.get(name) or PARTIAL_SQL[name])
    names = [column[0] for column in expected.description]
    assert sorted(got.columns) == sorted(names) or (name in PARTIAL_SQL and set(names) < set(got.columns))
    assert sorted(map(str, (tuple(r) for r in got.select(*names).collect()))) == sorted(map(str, expected.fetchall()))
