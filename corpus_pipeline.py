"""The corpus pipeline: documents to packed training sequences.

Each stage is ``(spark, docs, sf_dir) -> DataFrame`` and works on all rows its
predecessor kept: documents that the quality classifier rejects go, repeated lines
go, one document of each near-duplicate group stays, sources are mixed to their
target weights (a document taken twice comes twice), and what is left is packed.
All but the last return the columns of ``documents``; the last returns a row per
piece with its token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodgeflow.llm import line_dedup, mixing, near_dedup, packing, quality
from lodgeflow.llm.common import stored, table
from lodgeflow.llm.registry import tokenizer_json


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.drop_duplicate_lines(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, tokenizer_json())


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

#: The classifier and the minima have no SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is stored before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
