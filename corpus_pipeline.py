"""A corpus pipeline of five operators: quality rules, toxicity, near-dedup, secret scans, packing.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as Parquet and
reread as the next stage's ``docs``; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from platter.llm import nearcopies, packing, quality, secrets, toxicity
from platter.llm.common import delete_folder, small_batches
from platter.operators.steps import shared_folder

#: SQL can't express fingerprints, segments, automata and tokenizers.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules and their host's verdict."""
    return quality.keep_good(docs)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5; the model is fitted on labelled documents among ``docs``."""
    small_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.drop_toxic(docs, toxicity.fit_toxicity(docs, labels))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: SimHash fingerprints within 2 bits, or five-word shingles with Jaccard 0.8 or more."""
    small_batches(spark)
    return nearcopies.keep_one_of_each(docs, radius=2)


def secret_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets cut out of their texts."""
    small_batches(spark)
    return secrets.redact_secrets(docs)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of all documents and their places in training sequences."""
    import public_tokenizers

    small_batches(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


STAGES = [
    ("quality rules", quality_rules),
    ("toxicity", toxicity_filter),
    ("near-dedup", near_dedup),
    ("secret scans", secret_redaction),
    ("best-fit packing", sequence_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; intermediate tables go to the shared checkpoint folder."""
    base = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n < len(STAGES) - 1:
            docs.write.parquet(f"{base}/{n}")
            docs = spark.read.parquet(f"{base}/{n}")
            if n:
                delete_folder(spark, f"{base}/{n - 1}")  # its successor is written: nothing reads it again
    return docs
