"""The corpus pipeline: each stage works on all that the one before it kept.

All stages but the last return the columns of documents; the last returns what BPE makes of each document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from caremill.llm import bpe, decontamination, exact_dedup, language_id, near_dedup
from caremill.llm.common import settled, table


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known go on."""
    return language_id.keep_known(docs, language_id.train(docs))


def no_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id goes on."""
    return exact_dedup.drop_copies(docs)


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies the row with the smallest doc_id goes on."""
    return near_dedup.drop_near_copies(docs)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark passage contaminates go on."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, encoded and decoded again."""
    path = bpe.tokenizer_path()
    return bpe.coded(docs, path, bpe.build_lexicon(docs, path))


STAGES = [("language_id", known_language), ("exact_dedup", no_copies), ("near_dedup", no_near_copies), ("decontamination", no_benchmark), ("bpe", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = settled(stage(spark, docs, sf_dir))
    return docs


#: SQL can't express the stages; tests/llm compares them with plain Python.
ORACLE_SQL = None
