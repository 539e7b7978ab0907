"""URL rules by host suffix and path prefix, joined on short hash prefixes.

Each different (host, path) is expanded into expressions ``host suffix + path prefix``, only of the shapes (number of
host labels, path characters) that occur among the rules. Expressions and rules are equi-joined on the first 8 hex
digits of their SHA-256, and the full digests then decide. Of the rules that fit, the longest expression wins; of
equally long ones ``block`` wins. The rules' size decides how Spark joins them; none is broadcast by
hint. Work is done once for each different (host, path), so a page that fills a third of the table costs one row.

Host: what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: from there up to
``?``, ``#`` or the end. A null url, or one without ``://``, has an empty host and path, which no rule fits. Rows
without a fitting rule get a null rule and the default verdict. Every row gives one row, repeated rows and null ids
too; an empty table gives an empty result. Columns other than the two read are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import ascii_lower

HEX_DIGITS = 8


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """(verdict, host, path) as a relation whose size Spark knows."""
    if not rules:
        return spark.range(0).selectExpr("'' AS verdict", "'' AS host", "'' AS path")
    rows = ", ".join(f"(:v{i}, :h{i}, :p{i})" for i in range(len(rules)))
    named = {f"{key}{i}": value for i, rule in enumerate(rules) for key, value in zip("vhp", rule, strict=True)}
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(verdict, host, path)", named)


def with_host_and_path(pages: DataFrame) -> DataFrame:
    """page_id, url and the two parts of the url."""
    rest = F.coalesce(F.expr("CASE WHEN instr(url, '://') > 0 THEN substring(url, instr(url, '://') + 3) END"), F.lit(""))
    split = pages.withColumn("rest", rest)
    host = F.regexp_extract("rest", r"^([^/?#]*)", 1)
    path = F.regexp_extract("rest", r"^[^/?#]*(/[^?#]*)?", 1)
    return split.select("page_id", ascii_lower(host).alias("host"), path.alias("path"))


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", page_id: str = "page_id", url: str = "url"):
    """page_id, host, path, rule and verdict of every row."""
    own = pages.select(pages[page_id].alias("page_id"), pages[url].cast("string").alias("url"))
    own = with_host_and_path(own)
    known = (
        rules.select(
            F.concat("host", "path").alias("rule"),
            F.size(F.split("host", r"\.")).alias("labels"),
            F.length("path").alias("chars"),
            "verdict",
        )
        .groupBy("rule", "labels", "chars")
        .agg(F.max("verdict").alias("verdict"))  # block sorts after allow
        .withColumn("digest", F.sha2("rule", 256))
    )
    # shapes: at most (labels of a host) x (characters of a path), whatever the number of rules
    shapes = known.agg(F.collect_set(F.struct("labels", "chars")).alias("shapes"))
    places = own.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    expressions = (
        places.join(shapes)  # one row, of a size bounded by the shapes
        .withColumn("shape", F.explode("shapes"))
        .where((F.size(labels) >= F.col("shape.labels")) & (F.length("path") >= F.col("shape.chars")))
        .select(
            "host",
            "path",
            F.concat(
                F.expr("substring_index(host, '.', -shape.labels)"),
                F.expr("substring(path, 1, shape.chars)"),
            ).alias("expression"),
        )
        .withColumn("full", F.sha2("expression", 256))
    )
    short = F.substring("full", 1, HEX_DIGITS) == F.substring("digest", 1, HEX_DIGITS)
    fits = expressions.join(known, short).where(F.col("full") == F.col("digest"))
    best = fits.groupBy("host", "path").agg(
        F.max(F.struct(F.length("rule").alias("n"), "verdict", "rule")).alias("best")
    )
    best = best.select(F.col("host").alias("of_host"), F.col("path").alias("of_path"), "best")
    joined = own.join(best, (own.host == best.of_host) & (own.path == best.of_path), "left")
    return joined.select(
        "page_id",
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
