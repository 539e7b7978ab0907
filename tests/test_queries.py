"""Every query against its SQL on the same inputs."""

import pytest
from conftest import SF_DIR, sort_rows

import __spark_entry__ as entry_points
from ledgerloom.catalog import QUERIES
from oracle import oracle_texts

TEXTS = oracle_texts()


@pytest.mark.parametrize("key", sorted(TEXTS))
def test_matches_sql(key, spark, duck):
    df = QUERIES[key].run(spark, SF_DIR)
    names = [name for name, _ in QUERIES[key].shape]
    assert df.columns == names
    result = duck.execute(TEXTS[key])
    assert [column[0] for column in result.description] == names
    assert sort_rows(tuple(row) for row in df.collect()) == sort_rows(result.fetchall())


def test_every_sql_names_a_query():
    assert set(TEXTS) == set(QUERIES) <= set(entry_points.queries())


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
