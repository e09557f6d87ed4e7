"""Corpus cleaning pipeline over the training-data operators.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written
as Parquet and read again as the next stage's ``docs``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from capstan.llm import bbit_minhash, cgk, piece_bpe, quality_llr, superkmer
from capstan.llm.common import stored, table
from capstan.llm.queries import public_model

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents that they reject go."""
    model = quality_llr.fit(docs, table(spark, sf_dir, "labels"))
    return quality_llr.quality_filter(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near duplicates (five-word shingles, similarity 0.8 or more): the smallest doc_id of a group stays."""
    return bbit_minhash.near_duplicate_filter(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Substring dedup: passages that a document with a smaller doc_id has are cut out of the text."""
    return superkmer.remove_repeats(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return cgk.drop_contaminated(docs, table(spark, sf_dir, "benchmark"), cgk.Settings(shortest=1))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as SentencePiece ids, with the text that they decode to."""
    return piece_bpe.encode_documents(docs, public_model())


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("decontamination", decontaminate),
    ("sentencepiece", tokens),
]

#: Byte n-gram models, sampled signatures and a tokenizer have no DuckDB form: tested against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
