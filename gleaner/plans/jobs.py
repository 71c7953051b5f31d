"""The seven data jobs, composed from operators.

Tables of a store are parquet folders under one root.  Listings are versioned
snapshots: a job writes a new version and never over the one it reads.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner import schemas
from gleaner.functions import fields
from gleaner.functions import text as tx
from gleaner.operators import articles, bars, cleaning, forum, listings, logs, pages, queues, ranking, threads
from gleaner.plans.counts import RunCounts
from gleaner.session import path_exists, written
from gleaner.sources import known_links, readers, writers


@dataclass
class Store:
    """Paths of the stored tables, and the counts of the jobs run with it."""

    spark: SparkSession
    root: str
    counts: RunCounts = field(default_factory=RunCounts)
    link_buckets: int = known_links.BUCKETS

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def read(self, table: str, schema: str) -> DataFrame:
        """A stored table; an empty one while nothing has been written."""
        if path_exists(self.spark, self.path(table)):
            return self.spark.read.parquet(self.path(table))
        return self.spark.createDataFrame([], schema)

    def known_links(self, stored: DataFrame) -> DataFrame:
        """The links of all stored articles, from the table that grows with them."""
        return known_links.catch_up(stored, self.path("known_links"), self.link_buckets)

    def summary(self) -> DataFrame:
        """One row: what the jobs run so far wrote."""
        values = self.counts.values()
        return self.spark.createDataFrame([tuple(values.values())], ", ".join(f"{name} BIGINT" for name in values))


def collect_news(store: Store, items: DataFrame, page_table: DataFrame, blocklist: DataFrame, now: Column) -> DataFrame:
    """Feed items and landed pages -> new articles, appended and returned.

    ``items`` has title, link, published; ``page_table`` page_id, url, html.
    """
    stored = store.read("articles", schemas.ARTICLE)
    seen = store.known_links(stored)
    rest = [c for c in items.columns if c != "link"]
    once = items.groupBy("link").agg(F.min(F.struct(*rest)).alias("item")).select("link", "item.*")
    sources = articles.link_length_filter(articles.source_from_feed(once))
    sources = sources.withColumn("item_no", F.col("link"))
    # Links that are known or blocked never reach the pages.
    fresh = articles.drop_blocked_hosts(articles.unseen_links(sources, seen), blocklist)
    fresh = written(store.counts.watch("sources")(fresh), "sources")
    raw = pages.extract_pages(page_table.join(fresh.select(F.col("link").alias("url")), "url", "left_semi"))
    rest = [c for c in raw.columns if c != "link"]
    raw = raw.groupBy("link").agg(F.min(F.struct(*rest)).alias("page")).select("link", "page.*").select(
        F.col("link").alias("item_no"), "title", "text", "canonical", "pubdate", F.col("authors").alias("page_authors"))
    kept = articles.accept_articles(fresh, raw, seen, blocklist).drop("item_no", "is_short")
    return writers.append_articles(
        kept, store.path("articles"), now, writers.max_id(stored, "article_id"), store.counts.watch("articles"))


def due_posts(queue: DataFrame, now: Column, lookback_hours: float) -> DataFrame:
    """Aged posts from the head of the queue (pos, value); broken entries stay behind."""
    return queues.drain_aged_prefix(queues.queue_entries(queue), now, lookback_hours)


def waiting_posts(queue: DataFrame, now: Column, lookback_hours: float) -> DataFrame:
    """What stays in the queue (pos, value, ...) when due_posts is taken: the young tail, with its order; store it as the next queue.

    Broken entries before the tail are in neither; see queues.rejected_entries.
    """
    return queues.queue_remainder(queues.queue_entries(queue.withColumn("entry", F.col("value")), "entry"), now, lookback_hours)


def harvest_posts(store: Store, due: DataFrame, posts: DataFrame, comments: DataFrame, extra: DataFrame,
                  cutoff: int, now: Column) -> DataFrame:
    """Due posts and their harvested threads -> submissions and comments, appended; returns the submissions.

    ``posts`` are ingested posts by permalink, ``comments`` and ``extra`` carry
    the permalink of their thread.  What is stored already is not stored again:
    posts by permalink, comments by their id at the source.
    """
    stored = store.read("submissions", schemas.SUBMISSION)
    single = forum.single_post_threads(posts.withColumn("thread_id", F.col("permalink"))).drop("thread_id")
    ready = forum.submission_gate(single.join(due.select("permalink"), "permalink", "left_semi"), cutoff)
    ready = ready.join(stored.select("permalink"), "permalink", "left_anti")
    added = writers.append_submissions(
        ready, store.path("submissions"), now, writers.max_id(stored, "submission_id"), store.counts.watch("submissions"))
    ids = added.select("permalink", "submission_id")
    known = store.read("comments", schemas.COMMENT)
    rows = forum.all_comments(comments, extra).join(ids, "permalink").drop("permalink")
    rows = rows.join(known.select("reddit_id"), "reddit_id", "left_anti")
    writers.append_comments(
        rows, store.path("comments"), now, writers.max_id(known, "comment_id"), store.counts.watch("comments"))
    return added


def harvest_threads(store: Store, due: DataFrame, landed: DataFrame, extra: DataFrame, cutoff: int, now: Column) -> DataFrame:
    """Due posts and their landed threads (permalink, value) -> submissions, comments and the batches to fetch next.

    The threads' comments are flattened in list order and stored, those of ``extra`` (permalink and comment columns; loaded by an
    earlier plan) behind them.  Where many comments are missing, "load more" nodes are chosen within the budget of calls and
    appended to ``fetches`` in batches of ids.  Threads that are broken or hold not exactly one post go to ``rejected_threads``.
    What is stored already is not stored again, so a run can be repeated: posts by permalink, comments by their id at the
    source, fetches and rejects by all their columns.  Of a permalink landed more than once the last text by order counts.
    Returns the new submissions; the counts of what was written are in ``store.counts``.
    """
    stored = store.read("submissions", schemas.SUBMISSION)
    once = landed.join(due.select("permalink"), "permalink", "left_semi").groupBy("permalink").agg(F.max("value").alias("value"))
    parsed = written(threads.parse_threads(once), "threads")
    _append_new(store, "rejected_threads", threads.rejected_threads(parsed), schemas.REJECTED_THREAD)
    posts = written(forum.submission_gate(threads.thread_posts(parsed), cutoff), "posts")
    added = writers.append_submissions(
        posts.drop("more_children").join(stored.select("permalink"), "permalink", "left_anti"), store.path("submissions"), now,
        writers.max_id(stored, "submission_id"), store.counts.watch("submissions"))
    # Read anew, and not only what was added: a run that stopped here goes on with the comments.
    ids = store.read("submissions", schemas.SUBMISSION).select("permalink", "submission_id").join(
        posts.select("permalink"), "permalink", "left_semi")

    nodes = threads.thread_nodes(parsed.where("n_posts = 1").join(posts.select("permalink"), "permalink", "left_semi"))
    tree = written(threads.thread_comments(nodes).drop("depth"), "comments")
    later = [c for c in tree.columns if c != "pos"]
    rows = forum.all_comments(tree, extra.select(*later).withColumn("pos", F.lit(2**62))).join(ids, "permalink").drop("permalink")
    known = store.read("comments", schemas.COMMENT)
    rows = rows.join(known.select("reddit_id"), "reddit_id", "left_anti")
    writers.append_comments(
        rows, store.path("comments"), now, writers.max_id(known, "comment_id"), store.counts.watch("comments"))

    found = forum.comments_found(posts.withColumn("submission_id", F.col("permalink")), tree.withColumnRenamed("permalink", "submission_id"))
    needing = forum.needs_more_comments(found).where("needs_more").select("permalink")
    _append_new(store, "fetches", fetch_plan(nodes.join(needing, "permalink", "left_semi")), schemas.FETCH)
    return added


def fetch_plan(nodes: DataFrame) -> DataFrame:
    """(permalink, more_id, batch_no, n_ids, batch): the calls that load the largest "load more" nodes of threads.

    A node that stands twice in a thread is loaded once.
    """
    mores = written(threads.thread_mores(nodes), "mores")
    none = mores.where("false")
    all_ = forum.collect_mores(mores.where("on_post"), mores.where("NOT on_post"), none)
    once = all_.groupBy("thread_id", "more_id").agg(F.max(F.struct("depth", "children")).alias("m")).select("thread_id", "more_id", "m.*")
    chosen = forum.select_more_batches(once.withColumn("n_children", F.size("children")))
    ids = chosen.select("thread_id", "more_id", F.explode("children").alias("child_id"))
    return forum.batch_ids(ids, ["thread_id", "more_id"], "child_id").withColumnRenamed("thread_id", "permalink")


def _append_new(store: Store, table: str, rows: DataFrame, schema: str) -> None:
    """Append the rows that the table does not hold yet."""
    known = store.read(table, schema)
    # Pinned: the table grows while it is read.
    fresh = written(rows.select(*known.columns).subtract(known), table)
    writers.append(fresh, store.path(table), watch=store.counts.watch(table))


def link_posts(store: Store, added: DataFrame, raw: DataFrame, blocklist: DataFrame, now: Column) -> DataFrame:
    """Links of new external posts to articles; unknown urls are made into articles first."""
    stored = store.read("articles", schemas.ARTICLE)
    external = forum.external_links(added).withColumn("created_utc", F.unix_timestamp("created_time"))
    links, made = articles.link_posts_to_articles(
        external, stored, store.known_links(stored), raw, blocklist, writers.max_id(stored, "article_id"))
    # Both results are needed after the article table has grown: fix them first.
    links, made = written(links, "links"), written(made, "made")
    writers.append(made.drop("submission_id", "is_short").withColumn("data_entry_time", now), store.path("articles"),
                   watch=store.counts.watch("articles"))
    return writers.append_links(
        links, store.path("article_posts"), now, store.read("article_posts", schemas.ARTICLE_POST), store.counts.watch("links"))


def load_bars(store: Store, raw: DataFrame, now: Column) -> bool:
    """Incoming bars of active listings, newer than the stored ones, appended."""
    active = listings.active_listings(store.read("listings", schemas.LISTING)).select("listing_id")
    stored = store.read("intraday", schemas.INTRADAY)
    wanted = bars.ingest_intraday(raw.join(active, "listing_id", "left_semi"))
    maxima = newest_bars(store, stored)
    highest = maxima.agg(F.max("highest").alias("m")).first()["m"] or 0
    return writers.append_intraday(
        bars.newer_bars(wanted, maxima), store.path("intraday"), now, highest, store.counts.watch("bars"))


def newest_bars(store: Store, stored: DataFrame) -> DataFrame:
    """(listing_id, last_time, highest): newest bar per listing and run, appended to as bars are.

    Only bars with an id above the highest seen are read, which the statistics of older files rule out, so a run does not read
    the history; a run that stopped after storing bars is made good by the next one.
    """
    schema = "listing_id INT, last_time TIMESTAMP, highest BIGINT"
    known = store.read("newest_bars", schema)
    highest = known.agg(F.max("highest").alias("m")).first()["m"]
    later = stored if highest is None else stored.where(F.col("intraday_id") > highest)
    found = later.groupBy("listing_id").agg(F.max("data_time").alias("last_time"), F.max("intraday_id").alias("highest"))
    writers.append(written(found.select("listing_id", "last_time", "highest"), "newest_bars"), store.path("newest_bars"))
    return store.read("newest_bars", schema)


def update_listings(store: Store, stored: DataFrame, fresh: DataFrame, version: str, now: Column) -> DataFrame:
    """Snapshot against stored listings: a new version with changed and new rows, then audits.

    The version is one write, and the audits belong to it, so a run that failed can be repeated under the same version.
    """
    changes = written(listings.changed_listings(stored, fresh), "changes")
    new = listings.new_listings(stored, fresh)
    kept = listings.update_listings(stored, changes.select("updated.*"), now)
    added = writers.numbered_listings(new, now, writers.max_id(stored, "listing_id"))
    writers.write_snapshot(kept.unionByName(added), store.path(version), again=True, watch=store.counts.watch("listings"))
    _audit(store, changes, version)
    return store.spark.read.parquet(store.path(version))


def update_active(store: Store, stored: DataFrame, members: DataFrame, version: str, now: Column) -> DataFrame:
    """Membership file against stored listings: a new version with new active flags, then audits."""
    changes = written(listings.changed_active(stored, listings.flag_active(stored, members)), "changes")
    kept = listings.update_listings(stored, changes.select("updated.*"), now)
    writers.write_snapshot(kept, store.path(version), again=True, watch=store.counts.watch("listings"))
    _audit(store, changes, version)
    return store.spark.read.parquet(store.path(version))


def _audit(store: Store, changes: DataFrame, version: str) -> None:
    """The audits of a version, in a folder of their own that a repeated run replaces."""
    others = store.read("audit_listings", schemas.AUDIT_LISTING + ", version STRING").where(F.col("version") != version)
    rows = writers.numbered_audits(changes, writers.max_id(others, "audit_id"))
    writers.write_snapshot(rows, f"{store.path('audit_listings')}/version={version}", again=True, watch=store.counts.watch("changed"))


def clean_text(store: Store, cutoff: int, now: Column) -> DataFrame:
    """Cleaned bodies of all stored articles, appended as processed texts."""
    stored = store.read("articles", schemas.ARTICLE)
    clean = cleaning.clean_articles(articles.has_body(stored), stored, cutoff)
    titled = clean.join(stored.select("article_id", "title"), "article_id")
    highest = writers.max_id(store.read("processed_text", schemas.PROCESSED_TEXT), "text_id")
    return writers.store_processed_text(titled, store.path("processed_text"), now, highest, store.counts.watch("texts"))


def summaries(texts: DataFrame, key: str, column: str = "body") -> DataFrame:
    """(key, summary, keywords) of texts."""
    docs = written(texts.where(F.col(column).isNotNull()).select(
        key, F.col(column).alias("text"), tx.split_sentences(F.col(column)).alias("sentences"),
        F.length(column).alias("n_chars")), "texts")
    words = ranking.keywords(docs, key).groupBy(key).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "word"))), lambda s: s["word"]).alias("keywords"))
    return ranking.summarize(docs, key).join(words, key, "left")


def summarize_logs(spark: SparkSession, log_path: str, history_path: str, new_history_path: str, today: Column) -> DataFrame:
    """Log file and history -> report; the history with today's rows goes to a new file."""
    parsed = logs.parse_log_lines(readers.scan_logs(spark, log_path))
    daily = logs.daily_log(parsed, fields.log_date(today))
    history = logs.keep_last_7(readers.scan_log_history(spark, history_path), daily)
    writers.write_log_history(history, new_history_path)
    kept = readers.scan_log_history(spark, new_history_path)
    return daily.join(logs.log_averages(kept), "app")
