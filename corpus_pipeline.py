"""From raw documents to packed training sequences.

Five stages over ``documents``, in this order: the quality classifier's rejects
go, one document of each near-duplicate group stays, documents that hold
benchmark passages go, secrets are masked, and what is left is packed. Each
stage is written as Parquet to the shared folder and read again by the next, so
a lost executor never costs more than the stage at work.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from turnmeter.llm import decontam, packing, quality_ftrl, secrets, simhash
from turnmeter.session import shared_table

#: Documents that score less are rejected.
MIN_QUALITY = 0.7
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones, does not reject."""
    weights = quality_ftrl.fit(docs, _table(spark, sf_dir, "labels"))
    return docs.where(quality_ftrl.score_column(docs, weights) >= MIN_QUALITY)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that SimHash links: the one with the smallest id."""
    return simhash.deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return decontam.decontaminated(docs, _table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked; ``n_chars`` follows the text where it changed."""
    return secrets.masked(docs, length_col="n_chars")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 4096 tokens."""
    return packing.pack_documents(docs, VOCABULARY)


STAGES = [("quality classifier", quality), ("simhash near-dedup", near_duplicates),
          ("benchmark decontamination", decontamination), ("secret scans", secret_scan), ("packing", packed)]

#: The model of the first stage, the fingerprints and the tokenizer are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after another, over ``documents``."""
    docs = _table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = shared_table(docs, f"stage-{i}")
    return docs
