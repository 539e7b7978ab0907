"""The operators applied to their whole tables, by query name, with production parameters."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.llm import (
    boosted_trees,
    chat_format,
    conversation_trie,
    decontamination,
    discriminant,
    packing,
    periodic_runs,
    simhash,
    substrings,
    token_counts,
    token_files,
    toxicity,
    url_filters,
)
from ledgerloom.llm.common import load, stage
from ledgerloom.llm.tokens import default_path

# e-mail addresses and long numbers
PERSONAL = r"[\w.+-]+@[\w-]+(?:\.[\w-]+)+|\d{6,}"
# (verdict, host, path)
URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(load(spark, sf_dir, "documents"), default_path())


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts before and after personal data is replaced, from the trees."""
    trees = token_counts.build_trees(load(spark, sf_dir, "documents"), default_path())
    marked = trees.withColumn("edits", token_counts.find_edits(F.col("text"), PERSONAL, "[removed]"))
    return token_counts.apply_edits(marked, default_path()).drop("text", "cuts", "tree")


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge(load(spark, sf_dir, "pages"), url_filters.rule_table(spark, URL_RULES))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boosted_trees.quality_rules(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discriminant.quality_scores(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(load(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.decontaminate(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
    return found.drop("text_crc")


def op9_token_id_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = stage(spark, "token-files").path
    manifest = token_files.write_token_files(load(spark, sf_dir, "documents"), folder, default_path())
    return token_files.read_documents(spark, folder, manifest)


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.remove_repeats(load(spark, sf_dir, "documents"), with_text=False)
    return found.drop("kept_text", "text_crc")


def with_periods(doc_id: int | None, text: bytes | None) -> list[bytes]:
    """A document's words; in a tenth of the documents a stretch to the end is made periodic."""
    words = periodic_runs.blank_words(doc_id, text)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(load(spark, sf_dir, "documents"), words_of=with_periods)
    return found.drop("runs")


# a conversation begins with up to FAMILY_TURNS - 1 turns of the first conversation of its family
FAMILY, FAMILY_TURNS = 20, 4


def in_families(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations' turns, and all conv_ids: conversations may have lost their last turn."""
    held = stage(turns.sparkSession, "families")
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "digest")
    ranked = held.save("ranked", turns.withColumn("turn", F.row_number().over(order).cast("long")))
    taken = F.crc32(F.col("conv_id").cast("string")) % FAMILY_TURNS
    ids = ranked.where("turn = 1").select("conv_id")
    heads = ranked.where((F.col("conv_id") % FAMILY == 0) & (F.col("turn") < FAMILY_TURNS))
    heads = heads.withColumnRenamed("conv_id", "head")
    first = ids.join(heads, F.col("conv_id") - F.col("conv_id") % FAMILY == F.col("head")).where(F.col("turn") <= taken)
    own = ranked.where(F.col("turn") > taken)
    return first.select(*ranked.columns).union(own), ids


def op12_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns, ids = in_families(conversation_trie.turn_digests(load(spark, sf_dir, "conversations")))
    return conversation_trie.prefix_trie(turns, ids)


# a conversation whose texts look like the marks of common templates
MARKED = r"\### Assistant: </turn> ok"


def op13_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = load(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marked = spark.createDataFrame([(-7, 0, "user", MARKED), (-7, 1, "assistant", MARKED)], given.schema)
    folder = stage(spark, "chat").path
    written = chat_format.write_conversations(given.union(marked), folder, default_path())
    return chat_format.summaries(chat_format.read_turns(written, folder, default_path()))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_token_counts": op2_token_counts,
    "op3_url_filters": op3_url_filters,
    "op4_quality_rules": op4_quality_rules,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_toxicity": op6_toxicity,
    "op7_simhash_near_dedup": op7_simhash_near_dedup,
    "op8_benchmark_decontamination": op8_benchmark_decontamination,
    "op9_token_id_output": op9_token_id_output,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_conversation_prefix_trie": op12_conversation_prefix_trie,
    "op13_chat_formatting": op13_chat_formatting,
}
