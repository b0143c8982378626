"""The corpus pipeline: five stages over the documents, each written as Parquet and read again by the next."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from corvane.llm import byte_bpe, decontaminate, pii, quality, queries, simhash
from corvane.llm.common import shared_dir
from corvane.session import table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality score accepts."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return simhash.keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that copy no benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with personal data replaced; n_chars stays that of the source text."""
    return pii.redact(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, decoded."""
    return byte_bpe.encode(docs, queries.vocabulary(spark))


STAGES = [
    ("quality classifier", keep_good),
    ("SimHash near-dedup", keep_one),
    ("benchmark decontamination", drop_leaks),
    ("PII", redact),
    ("byte-level BPE", tokenise),
]

#: The learnt score and the token merges have no SQL twin; tests/llm holds the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            path = f"{shared_dir(spark)}/stage-{i}-{uuid.uuid4().hex}"
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
