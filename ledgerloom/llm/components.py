"""Connected components of an edge table, by alternating large and small stars, each round written to a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import stage


def _least_neighbour(edges: DataFrame) -> DataFrame:
    """Each edge (u, v) with the least of u and all its neighbours; the least is combined before the shuffle."""
    least = edges.groupBy(F.col("u").alias("of")).agg(F.min("v").alias("least"))
    joined = edges.join(least, edges.u == least.of)
    return joined.select("u", "v", F.least("u", "least").alias("least"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _least_neighbour(both).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("least").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    starred = _least_neighbour(edges)  # v < u throughout
    kept = starred.where(F.col("v") != F.col("least")).select(F.col("v").alias("u"), F.col("least").alias("v"))
    return kept.union(starred.select("u", F.col("least").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the least node of its component for each node that has an edge (a, b). Loops end when no edge changes."""
    held = stage(edges.sparkSession, "components")
    plain = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now, was, turn = held.save("edges-0", plain), None, 0
    while True:
        mark = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if mark == was or mark[0] == 0:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        was, turn = mark, turn + 1
        now = held.save(f"edges-{turn}", _small_star(_large_star(now)).distinct())
