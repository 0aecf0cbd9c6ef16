"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import (
    decontaminate,
    exact_dedup,
    hash_search,
    hmm,
    language,
    licenses,
    near_dedup,
    periodic_runs,
    pieces,
    pii,
    prefix_trie,
    quality,
    suffix_dedup,
)
from ledgerloom.llm.common import id_crc32, id_remainder

Query = Callable[[SparkSession, str], DataFrame]

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_pii(spark, folder):
    return pii.find_personal_data(table(spark, folder, "documents"))


def op2_lm_score(spark, folder):
    return hmm.score_documents(table(spark, folder, "documents"))


def op3_sentencepiece(spark, folder):
    out = pieces.encode_pieces(table(spark, folder, "documents"), MODEL_PATH)
    ids = F.concat_ws(",", F.col("piece_ids").cast("array<string>"))
    return out.select(
        "doc_id", "n_pieces", "n_byte_pieces", F.sha2(ids, 256).alias("ids_sha256"), "decoded_sha256", "round_trip"
    )


def op4_suffix_dedup(spark, folder):
    out = suffix_dedup.remove_repeats(table(spark, folder, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op5_decontaminate(spark, folder):
    return decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op6_license_scan(spark, folder):
    return licenses.license_matches(table(spark, folder, "documents"), licenses.default_templates(spark))


def op7_exact_dedup(spark, folder):
    return exact_dedup.exact_duplicates(table(spark, folder, "documents"))


def op8_quality(spark, folder):
    return quality.quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op9_language_id(spark, folder):
    return language.identify_languages(table(spark, folder, "documents"))


def op10_near_dedup(spark, folder):
    return near_dedup.near_duplicates(table(spark, folder, "documents"))


def with_periods(docs: DataFrame) -> DataFrame:
    """Doc_id and text; the texts of a tenth of the documents repeat a stretch of their own words.

    With h the crc32 of the id, g = h // 10 and h % 10 = 0, the words from a = g % n on are those of
    the p = 1 + (n - a) // (3 + g % 8) words at a, over and over.
    """
    h = id_crc32(F.col("doc_id"))
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), 0)
    split = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("words"))
    n, a = F.size("words"), F.expr("cast(g % size(words) AS int)")
    placed = split.withColumns({"n": n, "a": F.when(n > 0, a)})
    period = F.expr("cast(1 + floor((n - a) / (3 + g % 8)) AS int)")
    head, unit = F.slice("words", F.lit(1), F.col("a")), F.slice("words", F.col("a") + 1, period)
    rest = F.col("n") - F.col("a")
    tail = F.slice(F.flatten(F.array_repeat(unit, F.ceil(rest / period).cast("int"))), F.lit(1), rest)
    return placed.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(F.concat(head, tail), " ")).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark, folder):
    found = periodic_runs.periodic_runs(with_periods(table(spark, folder, "documents")))
    lines = F.transform("runs", lambda run: F.concat(F.concat_ws(",", run.start, run.length, run.period), F.lit("\n")))
    return found.select(
        "doc_id",
        "n_runs",
        "start",
        "length",
        "period",
        "exponent_milli",
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def with_shared_heads(paths: DataFrame) -> DataFrame:
    """The conversations' turns rebuilt: the first h are those of conversation c - c % 100, h = crc32(c) % 6."""
    c, h = F.col("conv_id"), id_remainder(F.col("conv_id"), 6).cast("int")
    heads = paths.filter(c % 100 == 0).select(
        c.alias("base"), F.slice("path", 1, 5).alias("head"), F.slice("chars", 1, 5).alias("head_chars")
    )
    both = paths.withColumn("base", c - c % 100).join(heads, "base", "left")

    def rebuilt(head: str, own: str) -> Column:
        first = F.coalesce(F.slice(head, F.lit(1), h), F.expr("array()").cast("array<long>"))
        return F.concat(first, F.slice(own, h + 1, F.size(own))).alias(own)

    return both.select("conv_id", rebuilt("head", "path"), rebuilt("head_chars", "chars"))


def op12_prefix_trie(spark, folder):
    conversations = table(spark, folder, "conversations")
    paths = prefix_trie.conversation_paths(conversations, prefix_trie.turn_dictionary(conversations))
    return prefix_trie.path_trie(with_shared_heads(paths)).drop("turn_id")


def op13_hash_search(spark, folder):
    return hash_search.nearest_neighbours(table(spark, folder, "embeddings"), "vec_id % 100 = 0")


def llm_queries() -> dict[str, Query]:
    from corpus_pipeline import run

    found = {name: query for name, query in globals().items() if name.startswith("op") and name[2].isdigit()}
    return found | {"pipeline": run}
