"""Training corpus from ``documents``: quality, exact copies, near copies, repeated passages, packing.

Every stage works on all that the stage before has kept, and its decisions take effect.  All stages but the last return
the columns of ``documents``, whatever further columns there are; the last one returns the pieces of the packed sequences.

Null and empty texts get the classifier's score of a text without words; if they stay, they are one group of exact copies,
are near duplicates of nothing, lose nothing and are packed as their end token.  A null id counts as an id of its own kind:
the last one where ties go to the smaller id.  Rows that repeat an id and a text are one document after the second stage.
Texts of any length are taken whole.  An empty table gives an empty result.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rooftree.llm import classifier, exact_dedup, minhash, packing, suffix_dedup
from rooftree.llm.common import read, staged

PASSAGE_BYTES = 240  # a passage of 51 words has 271 bytes or more in ``benchmark``; 400 bytes would miss most of them


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject; it learns from the labels of the documents it is given."""
    return classifier.keep_good(docs, read(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.keep_one(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return minhash.keep_one(docs)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the byte strings of ``PASSAGE_BYTES`` that stand more than once in them."""
    return suffix_dedup.remove_repeats(docs, PASSAGE_BYTES)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences with the sources' token shares."""
    return packing.pack(docs)


STAGES = [("quality classifier", quality), ("exact dedup", exact), ("near dedup", near), ("repeated passages", passages), ("packing", packed)]
ORACLE_SQL = None  # a trained model, confirmed links and suffix arrays are not SQL; tests/llm/test_pipeline.py has brute force for each stage


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
