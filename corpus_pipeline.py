"""The training-data pipeline: filter, deduplicate, decontaminate, encode."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.data import ready, stored, table
from tidemark.llm.decontaminate import drop_contaminated
from tidemark.llm.neardup import drop_near_duplicates
from tidemark.llm.quality import filter_quality
from tidemark.llm.queries import read_model
from tidemark.llm.sentencepiece import encode_decode
from tidemark.llm.toxicity import filter_toxic


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return filter_quality(docs, table(spark, sf_dir, "labels"))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not flag."""
    return filter_toxic(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id.

    Rows without an id stay; of repeated rows of one id all stay.
    """
    ready(spark)
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item occurs."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of each document and the hash of what they decode to."""
    ready(spark)
    return encode_decode(docs, read_model(), with_text=False)


STAGES = [
    ("quality", quality),
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("encoding", encoding),
]

#: The classifiers and the embedding cannot be put in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order, each written and read again, over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs)
    return docs
