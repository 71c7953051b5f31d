"""Writers: appends with ids and entry times, snapshots and exports.

A table is a parquet folder.  Spark's output committer publishes the files of
an append when the job commits, so a failed append adds no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.operators.ids import assign_ids
from gleaner.operators.listings import audit_rows, insertable


#: Stands between the rows and the write; a job counts there what it writes (see plans/counts.py).
Watch = Callable[[DataFrame], DataFrame]


def _unwatched(rows: DataFrame) -> DataFrame:
    return rows


def append(
    df: DataFrame, path: str, partition_by: list[str] | None = None, sort_by: list[str] | None = None, watch: Watch = _unwatched,
) -> None:
    """Append rows.

    With partition columns, a rebalance brings rows of one partition value
    together: small values share a task, a large one is split over several.
    """
    if not partition_by:
        watch(df).write.mode("append").parquet(path)
        return
    rows = df.hint("rebalance", *partition_by).sortWithinPartitions(*partition_by, *(sort_by or []))
    watch(rows).write.mode("append").partitionBy(*partition_by).parquet(path)


def max_id(stored: DataFrame, name: str) -> int:
    """The largest id of a stored table, 0 when it is empty."""
    return stored.agg(F.max(name).alias("m")).first()["m"] or 0


def append_articles(articles: DataFrame, path: str, now: Column, highest: int = 0, watch: Watch = _unwatched) -> DataFrame:
    """Give articles ids and the entry time, append them and return them as stored."""
    rows = assign_ids(articles, ["source_published_time", "link"], "article_id", highest)
    return _appended(rows.withColumn("data_entry_time", now), path, watch)


def append_submissions(posts: DataFrame, path: str, now: Column, highest: int = 0, watch: Watch = _unwatched) -> DataFrame:
    rows = assign_ids(posts, ["created_time", "permalink"], "submission_id", highest)
    return _appended(rows.withColumn("data_entry_time", now), path, watch)


def append_comments(comments: DataFrame, path: str, now: Column, highest: int = 0, watch: Watch = _unwatched) -> DataFrame:
    """Comments of stored submissions, with ids in submission and list order.

    The list order is ``pos`` if there is such a column (it is not stored), or the time.
    """
    places = [c for c in ("pos",) if c in comments.columns]
    rows = assign_ids(comments, ["submission_id", *places, "created_time", "reddit_id"], "comment_id", highest)
    return _appended(rows.drop("pos").withColumn("data_entry_time", now), path, watch)


def append_links(
    links: DataFrame, path: str, now: Column, stored: DataFrame | None = None, watch: Watch = _unwatched,
) -> DataFrame:
    """(article_id, submission_id) pairs not stored yet, each once."""
    pair = ["article_id", "submission_id"]
    rows = links.select(*pair).distinct()
    if stored is not None:
        rows = rows.join(stored.select(*pair), pair, "left_anti")
    return _appended(rows.withColumn("data_entry_time", now), path, watch)


def append_intraday(bars: DataFrame, path: str, now: Column, highest: int = 0, watch: Watch = _unwatched) -> bool:
    """Append bars by trade month, sorted by listing and time; nothing is written for an empty batch.

    Months keep the number of files low in a back-fill; the sort lets row
    groups be skipped by listing.  The batch is computed once, when ids are
    given; whether it is empty is read from what that wrote.
    """
    rows = assign_ids(bars, ["listing_id", "data_time"], "intraday_id", highest)
    if rows.isEmpty():
        return False
    rows = rows.withColumn("update_time", now).withColumn("trade_month", F.date_format("data_time", "yyyy-MM"))
    append(rows, path, ["trade_month"], ["listing_id", "data_time"], watch)
    return True


def numbered_listings(new: DataFrame, now: Column, highest: int = 0) -> DataFrame:
    """New listings as they are stored, with ids."""
    rows = assign_ids(insertable(new, now), ["iex_id"], "listing_id", highest)
    return rows.withColumn("listing_id", F.col("listing_id").cast("int"))


def insert_new_listings(new: DataFrame, path: str, now: Column, highest: int = 0, watch: Watch = _unwatched) -> DataFrame:
    return _appended(numbered_listings(new, now, highest), path, watch)


def numbered_audits(changes: DataFrame, highest: int = 0) -> DataFrame:
    """The superseded versions with their old update time and an id."""
    rows = assign_ids(audit_rows(changes), ["listing_id", "update_time"], "audit_id", highest, first_id=1)
    return rows.withColumn("audit_id", F.col("audit_id").cast("int"))


def audit_listings(changes: DataFrame, path: str, highest: int = 0, watch: Watch = _unwatched) -> DataFrame:
    """Store the superseded versions with their old update time."""
    return _appended(numbered_audits(changes, highest), path, watch)


def _appended(rows: DataFrame, path: str, watch: Watch) -> DataFrame:
    append(rows, path, watch=watch)
    return rows


def write_snapshot(df: DataFrame, path: str, again: bool = False, watch: Watch = _unwatched) -> None:
    """A new version of a table at a new path; an existing path is an error, or with ``again`` what a failed run left."""
    watch(df).write.mode("overwrite" if again else "error").parquet(path)


def write_log_history(history: DataFrame, path: str) -> None:
    """The nested history: one document with all apps; at most seven rows per app."""
    logs = history.groupBy("app").agg(
        F.sort_array(F.collect_list(F.struct("log_date", *[c for c in history.columns if c not in ("app", "log_date")])))
        .alias("InnerAppLogs"))
    # One line per app keeps the document splittable.
    app = F.struct(F.col("app").alias("AppName"), "InnerAppLogs")
    logs.select(F.array(app).alias("AppLogs")).write.mode("overwrite").json(path)


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; blanks at the ends of values stay, null is an unquoted and '' a quoted empty field."""
    (df.write.mode("error").option("header", True).option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))


def store_processed_text(clean: DataFrame, path: str, now: Column, highest: int = 0, watch: Watch = _unwatched) -> DataFrame:
    """Cleaned articles (article_id, title, clean_body) as processed texts; null bodies are not stored."""
    rows = clean.where(F.col("clean_body").isNotNull()).select("article_id", "title", F.col("clean_body").alias("body"))
    rows = assign_ids(rows, ["article_id"], "text_id", highest)
    return _appended(rows.withColumn("data_entry_time", now), path, watch)
