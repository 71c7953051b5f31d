"""Streams: post queue, delayed release, link dedup, new bars, capped lists, log counts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gleaner.operators import articles, bars, logs, queues
from gleaner.session import scratch_path, written
from gleaner.streaming import state

def landed(spark: SparkSession, path: str, schema, files_per_trigger: int | None = None) -> DataFrame:
    """A stream over parquet files as they land."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def run_available(writer, checkpoint: str) -> None:
    """Run a stream writer over all landed data and stop."""
    query: StreamingQuery = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def to_table(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append a stream to a parquet table, exactly once per file."""
    run_available(stream.writeStream.format("parquet").option("path", path).outputMode("append"), checkpoint)


def each_batch(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    run_available(stream.writeStream.foreachBatch(handle), checkpoint)


# -- posts -------------------------------------------------------------------

def post_stream(posts: DataFrame, channels: DataFrame) -> DataFrame:
    """Posts of the listed channels as queue JSON (value); a stream-static join."""
    wanted = channels.select(F.col("name").alias("channel")).distinct()
    return posts.join(wanted, "channel", "left_semi").select(
        queues.queue_json(F.col("created_time"), F.col("permalink")).alias("value"))


def stream_delayed_release(queue: DataFrame, lookback_hours: float, path: str, checkpoint: str) -> None:
    """Release posts (permalink, created_time, arrived) once older than the lookback; each leaves once and none is late.

    Waiting posts are state with a timer, so a batch touches what arrives and what falls due, and nothing else is kept.  Unlike the
    batch twin, an old post behind a younger one does not wait.  Posts without a time go to ``rejected``.
    """
    to_table(state.released(queue, lookback_hours), f"{path}/released", f"{checkpoint}/released")
    to_table(state.without_time(queue), f"{path}/rejected", f"{checkpoint}/rejected")


def _previous(spark: SparkSession, path: str, batch_id: int) -> DataFrame | None:
    """What the batch before this one left; each batch leaves a full state."""
    return spark.read.parquet(f"{path}/batch={batch_id - 1}") if batch_id else None


# -- links --------------------------------------------------------------------

def stream_dedup_links(links: DataFrame) -> DataFrame:
    """Each link once, ever; the state holds every link seen."""
    return links.dropDuplicates(["link"])


def stream_dedup_links_within(links: DataFrame, time_column: str, delay: str) -> DataFrame:
    """Each link once within the delay, with bounded state."""
    return links.withWatermark(time_column, delay).dropDuplicatesWithinWatermark(["link"])


CLAIM = "link STRING"


def stream_dedup_articles(stream: DataFrame, path: str, checkpoint: str, key: str = "item_no") -> None:
    """Append articles whose link and canonical link are both new, one by one in batch order.

    Links of accepted articles are keyed state, so stored articles are never read.  A batch asks for its links; rows with a known one go,
    the rest is decided among itself (``articles.dedup_batch``), and the links of what is accepted are landed as claims.  The
    claims are part of the same stream's input, so the next batch's questions meet them.  Both folders are replaced by a batch
    that runs again, before any later batch can have read them.
    """
    spark = stream.sparkSession
    accepted, claims = f"{path}/accepted", f"{path}/claims"
    spark.createDataFrame([], CLAIM).write.mode("ignore").parquet(f"{claims}/batch=-1")
    landed_claims = landed(spark, f"{claims}/*", CLAIM)
    row = F.to_json(F.struct(*stream.columns)).alias("row_key")
    links = F.filter(F.array_distinct(F.array("link", "canonical_link")), lambda x: F.coalesce(x, F.lit("")) != "")
    # A row without links asks under a null link, which nobody claims.
    asked = F.explode(F.when(F.size(links) > 0, links).otherwise(F.array(F.lit(None).cast("string")))).alias("link")
    questions = stream.select(row, asked)

    def handle(batch: DataFrame, batch_id: int) -> None:
        answers = batch.groupBy("row_key").agg(F.max("is_known").alias("is_known")).where("NOT is_known")
        rows = written(answers.select(F.from_json("row_key", stream.schema).alias("r")).select("r.*"), "unknown")
        kept = written(articles.dedup_batch(rows, key), "accepted")
        kept.write.mode("overwrite").parquet(f"{accepted}/batch={batch_id}")
        if not kept.isEmpty():  # an empty file would be input again, and the stream would never be done
            articles.known_links(kept).write.mode("overwrite").parquet(f"{claims}/batch={batch_id}")

    query = state.known_keys(questions, landed_claims).writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).start()
    # Claims land while the stream runs, so it runs until nothing is left rather than over what is there at the start.
    try:
        query.processAllAvailable()
    finally:
        query.stop()


# -- bars ---------------------------------------------------------------------

def stream_new_bars(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Per listing keep positive bars newer than the newest one of earlier batches.

    Each batch leaves the maxima of all bars so far, one row per listing, so
    the next one reads that small table and not the bars.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        maxima = _previous(spark, f"{path}/latest", batch_id)
        rows = bars.positive_bars(batch)
        if maxima is not None:
            rows = bars.new_bars(batch, maxima.withColumnRenamed("last_time", "data_time"))
        rows.write.mode("overwrite").parquet(f"{path}/bars/batch={batch_id}")
        latest = bars.latest_bar(spark.read.parquet(f"{path}/bars/batch={batch_id}"))
        if maxima is not None:
            both = latest.unionByName(maxima)
            latest = both.groupBy("listing_id").agg(F.max("last_time").alias("last_time"))
        latest.write.mode("overwrite").parquet(f"{path}/latest/batch={batch_id}")

    each_batch(stream, handle, checkpoint)


# -- capped lists ----------------------------------------------------------------

def stream_capped_list(stream: DataFrame, key: str, order: list[str], n: int, path: str, checkpoint: str) -> None:
    """The newest ``n`` rows per key; a batch writes the lists of the keys it touches.

    A list is read from the last batch that wrote it; see ``read_capped_lists``.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    lists = state.capped_lists(stream, key, order, n)
    run_available(lists.writeStream.outputMode("update").foreachBatch(handle), checkpoint)


def read_capped_lists(spark: SparkSession, path: str, key: str) -> DataFrame:
    """The lists as the newest batch of each key left them."""
    rows = spark.read.parquet(path)
    newest = rows.groupBy(key).agg(F.max("batch").alias("__newest")).withColumnRenamed(key, "__key")
    mine = F.col(key).eqNullSafe(F.col("__key")) & (F.col("batch") == F.col("__newest"))
    return rows.join(newest, mine).drop("batch", "__key", "__newest")


def compact_capped_lists(spark: SparkSession, path: str, key: str, compacted: str) -> None:
    """The newest lists as one batch at a new path; the old folder can go, as the state holds the lists."""
    read_capped_lists(spark, path, key).write.mode("error").parquet(f"{compacted}/batch=-1")


# -- logs -------------------------------------------------------------------------

def stream_log_counts(lines: DataFrame) -> DataFrame:
    """Running level counts per app."""
    return logs.log_level_counts(logs.parse_log_lines(lines))


def complete_to_table(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Write the whole result of a running aggregate with every batch; its size is one row per app."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/result-{batch_id}")

    run_available(stream.writeStream.outputMode("complete").foreachBatch(handle), checkpoint)


def last_result(spark: SparkSession, path: str) -> DataFrame:
    """The newest result folder left by ``complete_to_table``."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(hadoop)
    names = [f.getPath().toString() for f in files]
    return spark.read.parquet(max(names, key=lambda name: int(name.rsplit("-", 1)[1])))


def stream_paths(spark: SparkSession, label: str) -> tuple[str, str]:
    """A table path and a checkpoint path in the shared folder."""
    return scratch_path(spark, label), scratch_path(spark, f"{label}-checkpoint")
