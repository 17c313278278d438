"""Corpus preparation as a chain of the operators, each stage written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stratavox.llm import packing, pii, quality, simhash, toxicity
from stratavox.llm.common import read, spill


# Every stage keeps rows as they are but for what it decides: columns of any name pass through (packing alone has its
# own), ids may be null or repeat, null texts count as empty, and an empty table gives an empty table.


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep.

    Null, empty and very short texts fail and go; rows that repeat stay or go together; without labels all that pass the
    base rules stay.
    """
    return quality.keep_good(docs, quality.trusted_ids(spark, sf_dir))


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't predicted toxic; the model learns from the labels of what came in.

    Null and empty texts have a score like any; rows that repeat stay or go together; without toxic labels all stay.
    """
    return toxicity.keep_clean(docs, read(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: that of the least doc_id, whatever ids repeat or lack.

    Rows without a word are one group; of rows that repeat whole one stays; null ids come last in a group.
    """
    return simhash.keep_survivors(docs)


def pii_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in text replaced by its kind in brackets; n_chars, if there, follows.

    A null text stays null; rows that repeat stay and are changed alike; an empty table stays empty.
    """
    return pii.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents with their places in sequences.

    A null or empty text is one piece of the end id; rows that repeat are packed each.
    """
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("toxicity", toxicity_filter),
    ("near_dedup", near_dedup),
    ("pii", pii_redaction),
    ("packing", pack_sequences),
]
#: The stages score, cluster and pack by means that SQL can't express; a test compares the rows with plain loops.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result but the last is a table in the shared folder."""
    docs = read(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = spill(docs)
    return docs
