"""Registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from ramparts.llm import (
    bpe, chat, decontaminate, infill, pii, quality, runs, simhash, substrings, token_store, toxicity, urls, warc,
)
from ramparts.llm.shared import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Whoever runs the operator on real data passes a secret key of their own; this one makes results repeatable.
PSEUDONYM_KEY = b"key of the registered queries"


def registered(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[query.__name__] = query
    return query


@registered
def op1_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@registered
def op3_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.round_trip(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


@registered
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(table(spark, sf_dir, "documents"))


@registered
def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = decontaminate.contamination(docs, benchmark, F.col("doc_id"))
    return found.select(F.col("key").cast("long").alias("doc_id"), *[c for c in found.columns if c != "key"])


@registered
def op9_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.stored_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@registered
def op10_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.repeated_passages(table(spark, sf_dir, "documents"))


@registered
def op7_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.private_documents(table(spark, sf_dir, "documents"), PSEUDONYM_KEY)


@registered
def op2_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.verdicts(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


@registered
def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.conversation_digests(table(spark, sf_dir, "conversations"), chat.probe_conversation(spark))


@registered
def op8_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived_pages(table(spark, sf_dir, "pages"))


@registered
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.run_report(table(spark, sf_dir, "documents"))


@registered
def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@registered
def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.infill_report(table(spark, sf_dir, "documents"))
