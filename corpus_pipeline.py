"""A corpus pipeline: documents pass through the text operators one after another."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.llm import bpe, decontaminate, jaccard, pii, quality
from orderflow.llm.common import read_table, saved
from orderflow.llm.queries import BYTE_BPE, quality_model


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: documents that the classifier rejects go."""
    return quality.keep(docs, quality_model(spark, sf_dir))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: of documents connected by similar shingles of five words, the one with the
    smallest doc_id stays."""
    return jaccard.one_of_each(docs, size=5, percent=80)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: documents that hold a benchmark item go."""
    return decontaminate.clean(docs, read_table(spark, sf_dir, "benchmark"), short=True)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: personal data is replaced by its kind; n_chars follows."""
    clean = pii.redact(docs)
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: the token ids of what is left."""
    return bpe.encode(docs, BYTE_BPE, public_tokenizers.PATTERN)


STAGES = [
    ("quality", good),
    ("near_duplicates", distinct),
    ("decontamination", decontaminated),
    ("personal_data", private),
    ("encoding", encoded),
]

# The stages are beyond SQL; tests hold each against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name)
    return docs
