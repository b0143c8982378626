"""One query for each training-data operator, over its whole table, and the SQL twins where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from corvane.llm import byte_bpe, chat, decontaminate, html_text, pii, quality, repair, rules, runs, simhash, suffixes, token_files, warc
from corvane.session import table


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.digest(table(spark, sf_dir, "documents"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digest(table(spark, sf_dir, "documents"))


def vocabulary(spark: SparkSession) -> byte_bpe.Vocabulary:
    return byte_bpe.Vocabulary(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digest(table(spark, sf_dir, "documents"), vocabulary(spark))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.digest(table(spark, sf_dir, "pages"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(table(spark, sf_dir, "documents"))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.digest(table(spark, sf_dir, "conversations"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.digest(table(spark, sf_dir, "documents"))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.digest(table(spark, sf_dir, "pages"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of words in every document, the most repeated one, and digests of all runs and of the text without their repeats."""
    return runs.digest(table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged and repaired: faults, cheapest edits and a digest of the repaired turns."""
    return repair.digest(table(spark, sf_dir, "conversations"))


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids as read back from compressed files: place, number and CRC-32."""
    library = token_files.Library(spark, public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.digest(table(spark, sf_dir, "documents"), library, end_id=2)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_decontaminate": op2_decontaminate,
    "op3_quality": op3_quality,
    "op4_simhash_near_dedup": op4_simhash_near_dedup,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_warc": op6_warc,
    "op7_pii": op7_pii,
    "op8_chat_format": op8_chat_format,
    "op9_quality_rules": op9_quality_rules,
    "op10_html_text": op10_html_text,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_token_files": op13_token_files,
}

ORACLE_SQL: dict[str, str] = {
    "op9_quality_rules": rules.ORACLE_SQL,
}
