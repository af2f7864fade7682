"""Corpus pipeline: good documents, each once, without near copies and personal data, packed into training sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from studyflow.llm import exact_dedup, minhash, packing, pii, quality
from studyflow.session import staged


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted to the labelled ones, does not reject."""
    return quality.accepted(docs, quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the greatest id."""
    return exact_dedup.without_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents tied by near-copies (five-word shingles, 0.8 or more), the one with the least id."""
    return minhash.without_near_copies(docs, words=5, percent=80)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with their personal data replaced by its kind, and their new lengths."""
    return pii.redacted(docs, pii.train(docs))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 tokens."""
    return packing.pack(docs, packing.public_tokenizer())


STAGES = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_copies),
    ("minhash_near_dedup", near_copies),
    ("pii", personal_data),
    ("best_fit_packing", best_fit_packing),
]

# The classifier and the packing have no SQL form; tests hold the whole run against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
