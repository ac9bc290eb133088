"""From raw documents to token segmentations: language ID, line dedup, near dedup, decontamination, SentencePiece."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sonoloom.llm.common import table
from sonoloom.llm.decontaminate import without_leaks
from sonoloom.llm.language_id import fit, in_learned_language
from sonoloom.llm.line_dedup import without_repeated_lines
from sonoloom.llm.near_dup import without_near_duplicates
from sonoloom.llm.sentencepiece_lattice import segmentations
from sonoloom.session import work_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents in none of the languages that the named ones among them teach."""
    return in_learned_language(docs, fit(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop lines found in at least 10 documents."""
    return without_repeated_lines(docs, min_docs=10)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group whose five-word shingles agree to 0.8."""
    return without_near_duplicates(docs, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that contain at least 0.8 of a benchmark item's five-word shingles."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best and sampled segmentations with inclusion scores, and the text got back, beside counts and checksums."""
    return segmentations(docs, digest=True)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("sentencepiece", tokenize),
]

# training, sketches and sampled segmentations are not expressible in SQL; tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``; each stage's result is written to the shared folder and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            path = work_path(spark, f"pipeline-{name}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
