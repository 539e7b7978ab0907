"""The domain tables derived by Spark from the supplied parquet tables, staged once per session and folder."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.operators import changes
from ledgerloom.schemas import SCHEMAS
from ledgerloom.sources.fixture_sql import FIXTURE_SQL, SUPPLIED, sources_of, with_placeholders
from ledgerloom.sources.staging import Stage
from ledgerloom.sources.tables import Tables

_opened: dict[tuple[str, str], Tables] = {}

#: Tables whose rows do not follow those of the supplied ones; all others may be too large to broadcast.
BOUNDED = {"nation", "offices", "run_control", "member_categories", "product_counts", "totals_until"}

# day and history rows JOIN their loan or account JOIN what that is looked up in
_ROWS_FIRST = re.compile(
    r"FROM\s+(\(SELECT l_orderkey[^()]*(?:\([^()]*(?:\([^()]*\)[^()]*)*\)[^()]*)*\)\s+k|\{orders\} o)\s+"
    r"JOIN (\{\w+\} [ls]) ON (\S+)\s+(JOIN .*)",
    re.DOTALL,
)


def lookups_first(sql: str) -> str:
    """The same inner joins in another order: loans or accounts meet members and products before they meet their rows.

    There are several rows to each, so the lookups move the fewer and narrower rows.
    """
    return _ROWS_FIRST.sub(r"FROM \2 \4 JOIN \1 ON \3", sql)


def conform(df: DataFrame, name: str) -> DataFrame:
    """Columns and types of the declared layout."""
    layout = [item.strip().split(" ", 1) for item in SCHEMAS[name.removeprefix("base_")].replace("\n", " ").split(", ")]
    return df.select(*[df[column].cast(kind) for column, kind in (" ".join(i).split() for i in layout)])


def derived_tables(spark: SparkSession, sf_dir: str) -> Tables:
    """Domain tables over ``sf_dir``; a table is derived and staged the first time it is used."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key in _opened:
        return _opened[key]
    stage = Stage(spark, "tables")
    staged: dict[str, DataFrame] = {}
    sizes = (spark.read.parquet(f"{sf_dir}/{name}.parquet").count() for name in ("customer", "part", "orders"))
    # file sizes say too little of keys that run on and of names, see changes.by_shuffle
    large = any(rows > changes.BROADCAST_ROWS for rows in sizes)

    def source_of(name: str) -> DataFrame:
        return changes.by_shuffle(open_one(name)) if large and name not in BOUNDED else open_one(name)

    def open_one(name: str) -> DataFrame:
        if name in SUPPLIED:
            return spark.read.parquet(f"{sf_dir}/{name}.parquet")
        if name not in staged:
            text = FIXTURE_SQL[name]
            inputs = {source: source_of(source) for source in sources_of(text)}
            rows = conform(spark.sql(lookups_first(with_placeholders(text)), **inputs), name)
            staged[name] = rows if name.startswith("base_") else stage.save(name, rows)
        return staged[name]

    tables = Tables(open_one)
    _opened[key] = tables
    return tables
