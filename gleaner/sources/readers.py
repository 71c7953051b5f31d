"""Readers of landed files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner import schemas
from gleaner.functions.fields import trimmed

MIN_FEED_LINK = 5
# Layouts of feed dates after an optional day name, tried in order.
FEED_DATES = ["d MMM yyyy HH:mm:ss Z", "d MMM yyyy HH:mm:ss z", "yyyy-MM-dd'T'HH:mm:ssXXX"]


def scan_table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A stored parquet table; a declared schema saves reading footers."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def scan_listings(listings: DataFrame) -> DataFrame:
    """All listings by id."""
    return listings.orderBy("listing_id")


def read_membership(spark: SparkSession, path: str) -> DataFrame:
    """(symbol): the Symbol column of an index membership file, found by its header name."""
    return spark.read.csv(path, header=True).select(F.col("Symbol").alias("symbol"))


def read_feed_list(spark: SparkSession, path: str) -> DataFrame:
    """(name, link, rss, category, is_short) of the feed list; short feed links are flagged, not dropped."""
    rows = spark.read.csv(path, header=True, schema=schemas.FEED_LIST, enforceSchema=False)
    return rows.select(
        F.col("Name").alias("name"), F.col("Link").alias("link"), trimmed(F.col("RSS")).alias("rss"),
        F.col("Category").alias("category"),
        (F.coalesce(F.octet_length("RSS"), F.lit(0)) < MIN_FEED_LINK).alias("is_short"),
    )


def read_blocklist(spark: SparkSession, path: str) -> DataFrame:
    """(host): the first column of a file without header, each host once."""
    return spark.read.csv(path, header=False).select(F.col("_c0").alias("host")).distinct()


def read_channel_list(spark: SparkSession, path: str) -> DataFrame:
    """(name): the first column of a file without header, repeats kept."""
    return spark.read.csv(path, header=False).select(F.col("_c0").alias("name"))


def feed_items(spark: SparkSession, path: str) -> DataFrame:
    """(feed, title, link, published): one row per item of the feed documents at ``path``.

    A feed without a title or without items gives no rows.
    """
    channels = spark.read.format("xml").option("rowTag", "channel").schema(schemas.FEED_CHANNEL).load(path)
    items = channels.where(
        (F.coalesce(F.octet_length("title"), F.lit(0)) > 0) & (F.coalesce(F.size("item"), F.lit(0)) > 0)
    ).select(F.col("title").alias("feed"), F.inline("item"))
    date = F.regexp_replace("pubDate", r"^\s*[A-Za-z]+,\s*", "")
    published = F.coalesce(*[F.try_to_timestamp(date, F.lit(f)) for f in FEED_DATES])
    return items.select("feed", "title", "link", published.alias("published"))


def scan_logs(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, line) of text logs, plain or gzip; numbers ascend in file order."""
    return spark.read.text(path).select(
        F.monotonically_increasing_id().alias("line_no"), F.col("value").alias("line"))


def scan_log_history(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Flat (app, log_date, run_time_s, counters) of the nested history.

    One document per line as ``write_log_history`` leaves it, or with
    ``multi_line`` one indented document per file.
    """
    nested = spark.read.schema(schemas.LOG_HISTORY).json(path, multiLine=multi_line)
    apps = nested.select(F.inline("AppLogs"))
    return apps.select(F.col("AppName").alias("app"), F.inline("InnerAppLogs"))


def data_sources(spark: SparkSession) -> DataFrame:
    """The data source table."""
    return spark.createDataFrame(schemas.DATA_SOURCES, schemas.DATA_SOURCE)
