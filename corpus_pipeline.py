"""A training corpus from raw documents: language, quality, near copies, personal data, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from millrace.llm.base import prepare
from millrace.llm.jaccard import keep_one
from millrace.llm.language import keep_known
from millrace.llm.packing import pack
from millrace.llm.pii import mask
from millrace.llm.rules import keep_good
from millrace.session import scratch_path


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in a language that is known with confidence."""
    prepare(spark)
    return keep_known(docs)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that pass the quality rules and their host's."""
    prepare(spark)
    return keep_good(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose five-word shingles are four fifths the same."""
    prepare(spark)
    return keep_one(docs, words=5, least=80)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    prepare(spark)
    return mask(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every piece of every document goes in sequences of 2,048 tokens."""
    prepare(spark)
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language ID", languages),
    ("quality rules", quality),
    ("n-gram Jaccard join", near_copies),
    ("PII", personal_data),
    ("packing", packing),
]

# Near copies and learned models are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each stage's rows are written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        path = scratch_path(spark, "stage")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
