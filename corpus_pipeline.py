"""From raw documents to token ids: quality rules, near duplicates, benchmark passages, personal data, encoding."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ramparts.llm import bpe, decontaminate, pii, quality, simhash
from ramparts.llm.queries import PSEUDONYM_KEY
from ramparts.llm.shared import Kept, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that fail a rule go, then documents that fail the base rules or lose too much.

    Null and empty texts fail the base rules and go. Repeated rows are judged alike and both stay.
    """
    return quality.clean_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose fingerprints link (shingles of three words, two bits or fewer), that with the smallest id stays.

    Rows without an id stay only where their group has no other; of rows alike in id and text one stays.
    """
    return simhash.one_of_each_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more is benchmark text go. An empty benchmark lets all stay."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def private_values(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data become pseudonyms of the same format; a null text stays null."""
    return pii.with_length(pii.pseudonymised(docs, PSEUDONYM_KEY))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds the token ids, their number, and whether they decode to the text. A null text has no ids."""
    return bpe.encoded(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("private_values", private_values),
    ("encoding", encoding),
]

# Fingerprints, pseudonyms and token ids are beyond SQL; tests/llm holds run() against a plain Python version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet in the shared folder and read by the next.

    A stage's table is dropped once the next one is written. Columns beside text stay as they are; an empty table gives an
    empty one.
    """
    docs, kept = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        following = Kept(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if kept:
            kept.drop()
        docs, kept = following.rows, following
    return docs
