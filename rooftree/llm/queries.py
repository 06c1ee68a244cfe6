"""Registered queries of the training-data operators, with SQL where SQL can express them."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rooftree.llm import (bpe, classifier, divergence, exact_dedup, hard_negatives, html_text, minhash, packing, preference, quality_rules,
                          simhash, suffix_dedup, url_filter)
from rooftree.llm.common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, folder) -> DataFrame``."""
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return add


@query("op1_suffix_dedup")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.report(read(spark, folder, "documents"))


@query("op3_url_filter", url_filter.SQL)
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge(read(spark, folder, "pages"))


@query("op6_exact_dedup", exact_dedup.SQL)
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.report(read(spark, folder, "documents"))


@query("op10_preference_format", preference.SQL)
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return preference.format_pairs(read(spark, folder, "conversations"))


@query("op7_mixture_packing")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(read(spark, folder, "documents"))


@query("op2_bpe_chunks")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.report(read(spark, folder, "documents"))


@query("op9_quality_classifier")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return classifier.report(read(spark, folder, "documents"), read(spark, folder, "labels"))


@query("op4_quality_rules")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.report(read(spark, folder, "documents"))


@query("op5_html_text")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(read(spark, folder, "pages"))


@query("op8_minhash_dedup")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, folder, "documents"))


@query("op11_hard_negatives", hard_negatives.SQL)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return hard_negatives.mine(read(spark, folder, "embeddings"))


@query("op12_source_divergence", divergence.SQL)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(read(spark, folder, "documents"))


@query("op13_simhash_dedup")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, folder, "documents"))
