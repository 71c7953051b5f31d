"""Shared helpers: the cluster's shared folder, and tables written there to cut lineage."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from gleaner.session import checkpoint_dir


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder under spark.checkpoint.dir; only a local session without the setting (tests) gets one of its own."""
    root = spark.conf.get("spark.checkpoint.dir", None) or checkpoint_dir(spark)
    return f"{root.rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def pinned(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read back: a lost executor re-reads files, not lineage."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bytes of rows that reach a Python worker at once.
BATCH_BYTES = 8 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches by bytes, for this session: 10,000 long texts at once are hundreds of MB as Python strings."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[i], first[i] + 1, ... (count[i] of them), for every i in turn."""
    before = np.cumsum(count) - count
    return np.arange(int(count.sum())) + np.repeat(first - before, count)
