"""The corpus pipeline: documents through five operators, each stage written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import decontaminate, exact_dedup, near_dedup, pieces, quality
from ledgerloom.llm.common import scratch_folder
from ledgerloom.llm.queries import MODEL_PATH, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier rejects go."""
    return quality.without_low_quality(docs, table(spark, sf_dir, "labels"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts the one with the largest doc_id stays."""
    return exact_dedup.without_exact_duplicates(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that near-duplicate links join the one with the least doc_id stays."""
    return near_dedup.without_near_duplicates(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with ten words in a row (or all) of a benchmark item go."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The piece ids of what is left, and whether they decode to the text."""
    return pieces.encode_pieces(docs, MODEL_PATH)


STAGES = [
    ("quality", quality_stage),
    ("exact dedup", exact_stage),
    ("near dedup", near_stage),
    ("decontaminate", decontaminate_stage),
    ("encode", encode_stage),
]
# The stages learn a model and search by sketches, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STAGES applied to the documents of ``sf_dir``, each result written as Parquet and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_folder(spark, "pipeline-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
