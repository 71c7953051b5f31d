"""Session settings, the shared scratch area and lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Runtime SQL settings the operators rely on.
#  * UTC: every timestamp rule of the data model is in UTC.
#  * skew join: one-to-many lookups keep hot keys in one shuffle partition,
#    which AQE then splits, also where that costs one more shuffle.
#  * co-partition on a subset of the join keys: clean_articles ships text once
#    per block and joins inside the block without another shuffle.
#  * Arrow batches by bytes: 10,000 long texts at once are hundreds of MB in each Python worker.
#  * state store: streams keep their state on disk, and checkpoint changes only.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to an existing session."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(app: str = "gleaner", cores: str | int = 8, memory: str = "12g") -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A cluster must name one that all executors reach.  Only a local session
    may fall back to a machine-local folder.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="gleaner-")
    context.setCheckpointDir(folder)
    return context.getCheckpointDir() or folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unused path in the shared folder."""
    return os.path.join(checkpoint_dir(spark), "gleaner", f"{label}-{uuid.uuid4().hex}")


class Scratch:
    """The intermediate tables written while it is open; they are deleted when it closes.

    Results that are read lazily must be used before that::

        with Scratch(spark):
            plans.clean_text(store, 5, now)
    """

    _open: list[Scratch] = []

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.paths = spark, []

    def __enter__(self) -> Scratch:
        Scratch._open.append(self)
        return self

    def __exit__(self, *_) -> None:
        Scratch._open.remove(self)
        for path in self.paths:
            hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(hadoop, True)

    @classmethod
    def note(cls, path: str) -> None:
        if cls._open:
            cls._open[-1].paths.append(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a table's folder is there, on whatever file system the path names."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage, so lost executors never recompute what came before, and
    pins values that depend on the physical layout.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    Scratch.note(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def pinned(df: DataFrame) -> DataFrame:
    """Reliable checkpoint, for small tables used by several branches."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shuffle_width(spark: SparkSession) -> int:
    """The session's number of shuffle partitions, for shuffles that feed CPU-heavy steps.

    AQE sizes partitions by bytes and would merge small but costly ones; an
    explicit number keeps them apart.
    """
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def widened(df: DataFrame) -> DataFrame:
    """Spread a narrow scan over all cores before CPU-heavy row work.

    A scan of fewer splits than cores is dealt out evenly; a wider one, or
    rows that come out of a shuffle, stay as they are.
    """
    plan = df._jdf.queryExecution().executedPlan()
    if "Exchange" in plan.toString():
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df._jdf.rdd().getNumPartitions() < cores else df
