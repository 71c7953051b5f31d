"""Streams run over everything that has landed, compared with their batch twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner.catalog.logging import COUNTS
from gleaner.catalog.news import DEDUP
from gleaner.catalog.registry import query
from gleaner.session import scratch_path
from gleaner.streaming import jobs


def _slices(t, df, by: str, n: int = 3):
    """Land the whole table in ``n`` batches, each with every n-th value of ``by``, and stream them one by one."""
    return _batches(t, df, F.pmod(F.col(by), F.lit(n)), n)


# Rows of a landed file, about.
FILE_ROWS = 250_000


def _batches(t, df, number, n: int):
    """Land the rows in ``n`` batches by their number; each batch has the same number of files, which grows with the rows."""
    path, sizes = scratch_path(t.spark, "landed"), dict.fromkeys(range(n), 0)
    sizes |= {int(r["b"]): r["n"] for r in df.groupBy(number.alias("b")).agg(F.count("*").alias("n")).collect() if r["b"] in sizes}
    # A file without rows would not be written, so the smallest batch must fill them all.
    files = max(4, min(-(-max(sizes.values()) // FILE_ROWS), min(sizes.values()) // 1000))
    for i in range(n):
        df.where(number == i).repartition(files).write.option("maxRecordsPerFile", 0).mode("append").parquet(path)
    return jobs.landed(t.spark, path, df.schema, files)


@query("post_stream", """
SELECT concat('{"CreatedTime":"', strftime(CAST(ts AS TIMESTAMP), '%Y-%m-%dT%H:%M:%S.%f'), 'Z","Permalink":"/r/', event_type, '/',
              CAST(event_id AS VARCHAR), '"}') AS value
FROM events WHERE event_type IN ('click', 'view', 'signup')""")
def _(t):
    """Events as posts of channels; two channels are not listed."""
    posts = t("events").select(
        "event_id", F.col("event_type").alias("channel"), F.col("ts").cast("timestamp").alias("created_time"),
        F.concat(F.lit("/r/"), "event_type", F.lit("/"), "event_id").alias("permalink"))
    channels = t.spark.createDataFrame([("click",), ("view",), ("signup",), ("click",)], "name STRING")
    out, checkpoint = jobs.stream_paths(t.spark, "posts")
    jobs.to_table(jobs.post_stream(_slices(t, posts, "event_id"), channels), out, checkpoint)
    return t.spark.read.parquet(out)


@query("delayed_release", """
SELECT permalink, created_time FROM fx_queue
WHERE created_time <= (SELECT max(CAST(ts AS TIMESTAMP)) FROM events) - INTERVAL '36' HOUR""")
def _(t):
    """Posts that arrive at their event time in five batches, out of order, some dated later; released after 36 hours."""
    arrival = t("events").select(F.col("event_id").alias("pos"), F.col("ts").cast("timestamp").alias("arrived"))
    queue = t("fx_queue").join(arrival, "pos")
    out, checkpoint = jobs.stream_paths(t.spark, "released")
    jobs.stream_delayed_release(_slices(t, queue, "pos", 5), 36.0, out, checkpoint)
    return t.spark.read.parquet(f"{out}/released").select("permalink", "created_time")


@query("stream_dedup_links", "SELECT DISTINCT url AS link FROM pages")
def _(t):
    """Page links replayed in three files with overlaps."""
    links = t("pages").select("page_id", F.col("url").alias("link"))
    twice = links.unionByName(links.withColumn("page_id", F.col("page_id") + 1))
    out, checkpoint = jobs.stream_paths(t.spark, "links")
    jobs.to_table(jobs.stream_dedup_links(_slices(t, twice, "page_id")).select("link"), out, checkpoint)
    return t.spark.read.parquet(out)


@query("stream_dedup_articles", "WITH a0 AS (SELECT item_no, link, nullif(canonical, '') AS canonical_link, "
       "CAST(published AS TIMESTAMP) AS source_published_time FROM fx_raw JOIN (SELECT item_no, published FROM fx_feed) "
       "USING (item_no)) " + DEDUP.format(rows="a0"))
def _(t):
    """Articles in three batches by time, with links that recur across batches; accepted as if one by one."""
    rows = t("fx_raw").select("item_no", "link", F.nullif("canonical", F.lit("")).alias("canonical_link")).join(
        t("fx_feed").select("item_no", F.col("published").alias("source_published_time")), "item_no")
    out, checkpoint = jobs.stream_paths(t.spark, "articles")
    # Times run over 4000 steps of ten minutes.
    step = (F.unix_timestamp("source_published_time") - F.unix_timestamp(F.lit("2024-01-01 00:00:00").cast("timestamp"))) / 600
    jobs.stream_dedup_articles(_batches(t, rows, F.least(F.floor(step / 1334), F.lit(2)), 3), out, checkpoint)
    return t.spark.read.parquet(f"{out}/accepted").drop("batch")


@query("stream_new_bars", f"""
WITH first_batch AS (SELECT * EXCLUDE (is_new) FROM fx_bars WHERE NOT is_new
                     AND num_trades > 0 AND volume > 0 AND open > 0 AND close > 0),
second_batch AS (
  SELECT i.* FROM (SELECT * EXCLUDE (is_new) FROM fx_bars WHERE is_new) i
  WHERE i.num_trades > 0 AND i.volume > 0 AND i.open > 0 AND i.close > 0
    AND i.data_time > coalesce((SELECT max(s.data_time) FROM first_batch s WHERE s.listing_id = i.listing_id), TIMESTAMP '1900-01-01'))
SELECT * FROM first_batch UNION ALL SELECT * FROM second_batch""")
def _(t):
    """Stored bars as the first micro-batch, incoming ones as the second."""
    rows = t("fx_bars").withColumn("part", F.col("is_new").cast("int")).drop("is_new")
    out, checkpoint = jobs.stream_paths(t.spark, "bars")
    stream = _slices(t, rows, "part", 2)
    jobs.stream_new_bars(stream.drop("part"), out, checkpoint)
    return t.spark.read.parquet(f"{out}/bars").drop("batch")


@query("stream_capped_list", """
SELECT user_id, event_id, CAST(rn AS INTEGER) AS rank FROM (
  SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn <= 15""")
def _(t):
    events = t("events").select("user_id", "event_id", F.col("ts").cast("timestamp").alias("ts"))
    out, checkpoint = jobs.stream_paths(t.spark, "lists")
    jobs.stream_capped_list(_slices(t, events, "event_id"), "user_id", ["ts", "event_id"], 15, out, checkpoint)
    return jobs.read_capped_lists(t.spark, out, "user_id").select("user_id", "event_id", "rank")


@query("stream_log_counts", COUNTS)
def _(t):
    out, checkpoint = jobs.stream_paths(t.spark, "counts")
    jobs.complete_to_table(jobs.stream_log_counts(_slices(t, t("fx_log_lines"), "line_no")), out, checkpoint)
    return jobs.last_result(t.spark, out)
