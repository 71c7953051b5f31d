"""The corpus pipeline: each stage reads what the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gleaner.llm import exact_dedup, near_dedup, packing, secrets, toxicity
from gleaner.llm.common import bounded_batches, pinned, table
from gleaner.llm.queries import TOKENIZERS


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain calls toxic go."""
    bounded_batches(spark)
    return toxicity.drop_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest doc_id stays."""
    bounded_batches(spark)
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays."""
    bounded_batches(spark)
    return near_dedup.drop_near(docs)


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; its secrets are replaced by a mark."""
    return secrets.redact(docs, *secrets.trained(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 4096 tokens."""
    bounded_batches(spark)
    return packing.pack(docs, f"{TOKENIZERS}/word_bpe_49k.json", remembered=150_000)


STAGES = [
    ("toxicity", toxic), ("exact dedup", exact), ("near dedup", near), ("secrets", redacted), ("packing", packed),
]
#: Trained weights, probabilistic candidates and a tokenizer can't be written in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written to the shared folder before the next."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = pinned(stage(spark, docs, sf_dir), f"stage{k}")
    return docs
