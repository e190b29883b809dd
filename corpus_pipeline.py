"""The corpus pipeline: documents that are good, one of each group of near-duplicates, free of benchmark passages and of
personal data, packed into sequences. Each stage reads what its predecessor kept and calls one operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from genoweave.llm import decontamination, packing, pii, quality, simhash
from genoweave.llm.common import cut, drop_cut
from genoweave.llm.queries import table, tokenizer


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it is fitted on labelled rows among them (all stay, if there are none of both labels).

    Null and empty texts are scored as such, repeated rows alike; other columns stay, whatever their names."""
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group at a similarity of 0.8 of five-word shingles.

    Null and empty texts and rows without doc_id stay; so do repeated rows of the document that stays."""
    return simhash.keep_one(docs, threshold=0.8)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window that is nearly a benchmark item. Null and empty texts stay; repeated rows go or stay together."""
    return decontamination.keep_clean(docs, table(spark, sf_dir, "benchmark"), threshold=0.8)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind. Null and empty texts stay as they are."""
    return pii.redacted(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of each document's pieces in sequences of 4096 tokens. Null and empty texts are one end token; repeated rows are packed each."""
    return packing.pack(docs, tokenizer(), capacity=4096, end=1)


STAGES = [("quality", good), ("near_duplicates", distinct), ("decontamination", clean), ("personal_data", private), ("packing", packed)]

#: Classifiers, fingerprints and tokens cannot be told in SQL; tests/llm/test_queries.py holds each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. What a stage returns is written once, and deleted when the next one's is."""
    docs = table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
        if before is not None:
            drop_cut(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
