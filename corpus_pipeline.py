"""From raw documents to token ids: five stages, each written and read again by the caller."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tillstream import session
from tillstream.llm import bpe, contamination, langid, lines, neardup


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; learned from the rows with a known language."""
    return langid.accepted(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that are spread over many sites."""
    return lines.remove(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 80 per cent of its five-word shingles."""
    return neardup.keep_one(docs, size=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of ten words of a benchmark item."""
    return contamination.remove_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their token ids and the text that these decode to."""
    return bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json"), decoded="decoded")


def _configured(stage):
    return lambda spark, docs, sf_dir: stage(session.configure(spark), docs, sf_dir)


STAGES = [(name, _configured(stage)) for name, stage in (
    ("language_id", language), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
    ("decontamination", decontaminate), ("bpe", encode))]

# Mixtures, near-duplicates and merges are beyond SQL: tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each settled as Parquet."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = session.settle(stage(spark, docs, sf_dir), name)
    return docs
