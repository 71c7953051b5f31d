"""The registered queries of the operators in this package, and the SQL of those that SQL can express."""

from __future__ import annotations

import os

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from gleaner.llm import (
    ann, exact_dedup, gray_index, html_text, licenses, near_dedup, packing, periodic_runs, sampled_pieces, secrets, token_alignment,
    token_counts, toxicity,
)
from gleaner.llm.common import table

#: Folder of the tokenizer files; a parameter, as they are never part of the repository.
TOKENIZERS = os.path.dirname(public_tokenizers.path("word_bpe_49k.json"))


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_text.extract(pages, html_text.train(pages))


def op3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secrets.digest(secrets.find_secrets(docs, *secrets.trained(docs)))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.toxic_scores(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_counts.count_tokens(docs, f"{TOKENIZERS}/byte_bpe_50k.tiktoken", public_tokenizers.PATTERN)


def op7_sampled_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampled_pieces.sample_pieces(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/piece_bpe_32k.model")


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_classes(table(spark, sf_dir, "documents"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/word_bpe_49k.json")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.find_runs(table(spark, sf_dir, "documents"))


def op12_gray_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gray_index.near_components(table(spark, sf_dir, "documents"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_alignment.align(docs, f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model")


QUERIES = {f.__name__: f for f in (
    op1_licenses, op2_html_text, op3_nearest, op4_secrets, op5_toxicity, op6_token_counts, op7_sampled_pieces, op8_near_dedup,
    op9_exact_dedup, op10_packing, op11_periodic_runs, op12_gray_index, op13_token_alignment,
)}
ORACLES = {"op9_exact_dedup": exact_dedup.ORACLE}
