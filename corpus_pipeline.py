"""The corpus pipeline: documents -> good -> distinct -> clean -> mixed -> token files.

``STAGES`` lists the stages; each takes ``(spark, docs, sf_dir)`` and its
result is written as Parquet and read again as the next stage's ``docs``. All
but the last return the columns of ``documents``; the last returns a row for
each document that was tokenized.

Every stage keeps whole rows, extra columns included, whatever their names. Null
and empty texts are scored like any other by the classifier; those that it keeps
are near duplicates of each other (fingerprint zero), hold no benchmark words,
are in no quota of the mix (they go with their hash) and give a document of the end
token alone. Rows that repeat, or share an id, are scored each and are one group only if
their fingerprints link; of a group's rows with the smallest id one stays. Rows
without an id stand for a group only where no row of it has one. Very long texts are read whole. Without labels
of both kinds nothing is learned, and every document gets the same score. An empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kiln.llm import decontam, mixing, quality, simhash, tokens
from kiln.llm.common import saved, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier (2) accepts; it learns from the stage's own documents."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates by SimHash (1): that of the smallest doc_id."""
    return simhash.drop_near_duplicates(docs)


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that benchmark decontamination (9) finds free of benchmark passages."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix (10) takes it."""
    return mixing.take(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Seekable token files (5) of all that is left, read back."""
    return tokens.tokenize(spark, docs)


STAGES = [
    ("quality", good_quality),
    ("near-duplicates", distinct_documents),
    ("decontamination", clean_of_benchmark),
    ("mixing", mixed_sources),
    ("tokens", token_files),
]

#: Learned scores, XXH64 fingerprints and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = saved(docs, f"pipeline-{name}")
    return docs
