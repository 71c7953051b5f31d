"""Whole jobs on small landed data, and streams over several micro-batches."""

import datetime

from pyspark.sql import functions as F

from gleaner.operators import articles
from gleaner.plans import jobs as plans
from gleaner.session import scratch_path
from gleaner.sources import readers, writers
from gleaner.streaming import jobs

NOW = datetime.datetime(2024, 3, 1)
PAGE = "<html><head><title>{title}</title><link rel='canonical' href='{canonical}'>" \
       "<meta name='author' content='Ann Lee'><meta property='article:published_time' content='2024-01-05T12:00:00-07:00'>" \
       "</head><body><nav>menu</nav><article><p>{text}</p><p>Second &amp; last.</p></article></body></html>"


def store(spark):
    return plans.Store(spark, scratch_path(spark, "store"), link_buckets=16)


def test_news_job(spark):
    s = store(spark)
    items = spark.createDataFrame(
        [("One title", "http://a.com/1", NOW), ("Two title", "http://a.com/2", NOW), ("Bad host", "http://bad.com/3", NOW),
         ("x", "y", NOW), ("One title", "http://a.com/1", NOW)], "title string, link string, published timestamp")
    body = "A long enough body of the article."
    pages = spark.createDataFrame(
        [(1, "http://a.com/1", PAGE.format(title="Page one", canonical="http://www.a.com/c/1", text=body)),
         (2, "http://a.com/2", PAGE.format(title="Page two", canonical="http://www.a.com/c/1", text=body)),
         (3, "http://bad.com/3", PAGE.format(title="Page bad", canonical="", text=body))], "page_id long, url string, html string")
    blocked = spark.createDataFrame([("bad.com",)], "host string")
    got = plans.collect_news(s, items, pages, blocked, F.lit(NOW)).collect()
    assert len(got) == 1
    row = got[0]
    assert row["article_id"] == 1000 and row["link"] == "http://a.com/1" and row["host"] == "www.a.com"
    assert row["title"] == "Page one" and row["authors"] == '["Ann Lee"]' and row["published_time"].hour == 19
    assert row["body"] == body + "\n\nSecond & last."
    # A second run finds the first link and the shared canonical link known.
    assert plans.collect_news(s, items, pages, blocked, F.lit(NOW)).count() == 0


def test_forum_job(spark):
    s = store(spark)
    made = writers.append_articles(
        articles.normalize_articles(
            spark.createDataFrame([(1, "Stored", "Some stored text.", "", "")], "item_no int, title string, text string, canonical string, pubdate string"),
            articles.source_from_feed(spark.createDataFrame([(1, "Stored", "http://a.com/1", NOW)], "item_no int, title string, link string, published timestamp")),
        ).drop("item_no", "is_short"), s.path("articles"), F.lit(NOW))
    assert made.first()["article_id"] == 1000
    old = "2024-02-01T00:00:00Z"
    queue = spark.createDataFrame(
        [(0, f'{{"CreatedTime":"{old}","Permalink":"/p/0"}}'), (1, f'{{"CreatedTime":"{old}","Permalink":"/p/1"}}'),
         (2, '{"CreatedTime":"2024-02-29T23:00:00Z","Permalink":"/p/2"}'), (3, f'{{"CreatedTime":"{old}","Permalink":"/p/3"}}')],
        "pos long, value string")
    due = plans.due_posts(queue, F.lit(NOW), 24.0)
    assert sorted(r["permalink"] for r in due.collect()) == ["/p/0", "/p/1"]
    posts = spark.createDataFrame(
        [(f"/p/{i}", f"post {i}", url, NOW, 5, 50, False, False, False) for i, url in ((0, "http://a.com/1"), (1, "http://b.com/9"), (2, "http://a.com/1"))],
        "permalink string, title string, url string, created_time timestamp, num_comments int, score int, is_deleted boolean, is_self boolean, is_media boolean")
    comments = spark.createDataFrame([("/p/0", "c1", NOW), ("/p/1", "c2", NOW)], "permalink string, reddit_id string, created_time timestamp")
    added = plans.harvest_posts(s, due, posts, comments, comments.where("reddit_id = 'c9'"), 30, F.lit(NOW))
    assert sorted(r["submission_id"] for r in added.collect()) == [1000, 1001]
    assert spark.read.parquet(s.path("comments")).count() == 2
    raw = spark.createDataFrame([("http://b.com/9", "New one", "New text body.", "", "")], "link string, title string, text string, canonical string, pubdate string")
    blocked = spark.createDataFrame([], "host string")
    links = plans.link_posts(s, added, raw, blocked, F.lit(NOW))
    assert sorted((r["article_id"], r["submission_id"]) for r in links.collect()) == [(1000, 1000), (1001, 1001)]
    assert spark.read.parquet(s.path("articles")).count() == 2


def test_market_jobs(spark, t):
    s = store(spark)
    stored, fresh = t("fx_listing"), t("fx_listing_fresh")
    version = plans.update_listings(s, stored, fresh, "listings", F.lit(NOW))
    audit = spark.read.parquet(s.path("audit_listings"))
    assert version.where(F.col("update_time") == F.lit(NOW)).count() == audit.count() + version.count() - stored.count()
    assert version.select("listing_id").distinct().count() == version.count()
    # The provider id of a listing never changes, and a second run changes nothing.
    assert version.join(stored, ["listing_id", "iex_id"]).count() == stored.count()
    n = audit.count()
    plans.update_listings(s, version, fresh, "listings2", F.lit(NOW))
    assert spark.read.parquet(s.path("audit_listings")).count() == n
    flagged = plans.update_active(s, version, t("fx_members"), "listings3", F.lit(NOW))
    assert flagged.count() == version.count()
    raw = t("fx_bars_raw")
    assert plans.load_bars(s, raw, F.lit(NOW))
    first = spark.read.parquet(s.path("intraday")).count()
    assert first > 0 and not plans.load_bars(s, raw, F.lit(NOW))
    assert spark.read.parquet(s.path("intraday")).count() == first


def test_text_job(spark, t):
    s = store(spark)
    writers.append(t("fx_article"), s.path("articles"))
    got = plans.clean_text(s, 5, F.lit(NOW))
    stored = spark.read.parquet(s.path("processed_text"))
    assert stored.count() == got.count() > 0
    report = plans.summaries(stored, "text_id")
    assert report.where("summary IS NOT NULL AND size(keywords) <= 20").count() == stored.count()


def test_log_job(spark, t):
    log, history, new = (scratch_path(spark, n) for n in ("log", "history", "history"))
    t("fx_log_lines").select("line").write.option("compression", "gzip").text(log)
    writers.write_log_history(t("fx_log_history"), history)
    report = plans.summarize_logs(spark, log, history, new, F.lit("2024-02-10"))
    assert report.count() == 7
    kept = readers.scan_log_history(spark, new)
    assert kept.groupBy("app").count().agg(F.max("count")).first()[0] == 7
    assert kept.where("log_date = '2024-02-09'").count() == 7


def test_articles_over_batches(spark):
    """A link known from an earlier batch is not stored again, by either key."""
    rows = [[("a", "l/x", "l/y")], [("b", "l/y", None), ("c", "l/z", "l/w")],
            [("d", "l/w", None), ("e", "l/q", "l/x"), ("f", "l/n", None)]]
    path = scratch_path(spark, "landed")
    schema = "item_no string, link string, canonical_link string, source_published_time timestamp"
    for batch in rows:
        spark.createDataFrame([(*r, NOW) for r in batch], schema).coalesce(1).write.mode("append").parquet(path)
    out, checkpoint = jobs.stream_paths(spark, "articles")
    jobs.stream_dedup_articles(jobs.landed(spark, path, schema, 1), out, checkpoint)
    assert sorted(r["item_no"] for r in spark.read.parquet(f"{out}/accepted").collect()) == ["a", "c", "f"]


def test_dedup_within_delay(spark):
    path = scratch_path(spark, "landed")
    spark.createDataFrame([("x", NOW), ("x", NOW), ("y", NOW)], "link string, seen_at timestamp").write.parquet(path)
    stream = jobs.landed(spark, path, "link string, seen_at timestamp")
    out, checkpoint = jobs.stream_paths(spark, "links")
    jobs.to_table(jobs.stream_dedup_links_within(stream, "seen_at", "1 hour"), out, checkpoint)
    assert spark.read.parquet(out).count() == 2


def test_readers(spark):
    path = scratch_path(spark, "xml")
    doc = "<rss><channel><title>F</title><item><title>T</title><link>http://a.com/1</link>" \
          "<pubDate>Mon, 01 Jan 2024 10:00:00 GMT</pubDate></item><item><title>U</title><link>l</link></item></channel></rss>"
    spark.createDataFrame([(doc,)], "value string").write.text(path)
    got = readers.feed_items(spark, path).orderBy("title").collect()
    assert [(r["title"], r["link"]) for r in got] == [("T", "http://a.com/1"), ("U", "l")]
    assert got[0]["published"].hour == 10 and got[1]["published"] is None
    assert readers.data_sources(spark).count() == 2
    nested = scratch_path(spark, "json")
    spark.createDataFrame([('{"AppLogs": [\n {"AppName": "A", "InnerAppLogs": [{"log_date": "2024-01-01", "info_count": 3}]}]}',)],
                          "value string").write.text(nested)
    assert readers.scan_log_history(spark, nested, multi_line=True).first()["info_count"] == 3
