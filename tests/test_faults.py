"""Cases that the derived views don't hold: chains, null orders, absent flags, odd pages."""

from __future__ import annotations

import json
import random

import datetime

import pytest
from pyspark.sql import functions as F

from gleaner import schemas
from gleaner.operators import articles, forum, listings, pages
from gleaner.plans import jobs
from gleaner.session import scratch_path


def test_batch_equals_accepting_one_by_one(spark):
    rng = random.Random(11)
    rows = [(f"k{i:03}", i // 3, f"l{rng.randint(0, 60)}", rng.choice([None, "", f"l{rng.randint(0, 60)}"])) for i in range(90)]
    rows += [("x1", 100, "x", "y"), ("x2", 101, "y", "z"), ("x3", 102, "z", None)]
    taken, want = set(), []
    for item, time, link, canonical in sorted(rows, key=lambda r: (r[1], r[2], r[0])):
        own = {x for x in (link, canonical) if x}
        if not own & taken:
            want.append(item)
            taken |= own
    df = spark.createDataFrame(rows, "item_no string, source_published_time int, link string, canonical_link string")
    assert sorted(r["item_no"] for r in articles.dedup_batch(df).collect()) == sorted(want)
    assert {"x1", "x3"} <= set(want) and "x2" not in want


def test_null_order_keeps_the_row(spark):
    rows = spark.createDataFrame([("a", None, 1), ("b", None, 2), ("b", "s", 3)], "k string, symbol string, v int")
    got = {r["k"]: (r["symbol"], r["v"]) for r in listings.last_wins(rows, "k", "symbol").collect()}
    assert got == {"a": (None, 1), "b": ("s", 3)}


def test_absent_flags_are_false(spark):
    post = json.dumps({"name": "t3_1", "title": "t", "url": "https://a.example/x", "num_comments": 40})
    rows = forum.ingest_submissions(spark.createDataFrame([(post,)], "value string"))
    kept = forum.external_links(forum.submission_gate(rows, 30)).collect()
    assert [(r["reddit_id"], r["score"], r["is_media"]) for r in kept] == [("t3_1", 0, False)]


def test_pages_without_and_with_two_articles(spark):
    head = "<html><head><title>Some title</title></head><body>"
    rows = [
        (1, "u1", head + "<article><p>First part here.</p></article><article><p>Second part.</p></article></body>"),
        (2, "u2", head + "<div><p>Only paragraphs here.<p>And another one.</p></div></body>"),
        (3, "u3", head + "<div>nothing</div></body>"),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in pages.extract_pages(df).collect()}
    assert got == {1: "First part here.\n\nSecond part.", 2: "Only paragraphs here.\n\nAnd another one."}


NOW = datetime.datetime(2024, 3, 1)


def test_forum_job_twice_and_queue(spark):
    store = jobs.Store(spark, scratch_path(spark, "store"))
    old = '{"CreatedTime":"2024-02-01T00:00:00Z","Permalink":"/p/%d"}'
    young = '{"CreatedTime":"2024-02-29T23:00:00Z","Permalink":"/p/2"}'
    queue = spark.createDataFrame([(0, old % 0), (1, "{broken"), (2, young), (3, old % 3), (4, "{broken")], "pos long, value string")
    due = jobs.due_posts(queue, F.lit(NOW), 24.0)
    assert [r["permalink"] for r in due.collect()] == ["/p/0"]
    assert sorted(r["pos"] for r in jobs.waiting_posts(queue, F.lit(NOW), 24.0).collect()) == [2, 3, 4]
    posts = spark.createDataFrame(
        [("/p/0", "post", "http://a.com/1", NOW, 5, 50, False, False, False)],
        "permalink string, title string, url string, created_time timestamp, num_comments int, score int, is_deleted boolean, is_self boolean, is_media boolean")
    comments = spark.createDataFrame([("/p/0", "c1", NOW)], "permalink string, reddit_id string, created_time timestamp")
    for _ in range(2):
        jobs.harvest_posts(store, due, posts, comments, comments.limit(0), 30, F.lit(NOW))
        assert spark.read.parquet(store.path("submissions")).count() == 1
        assert spark.read.parquet(store.path("comments")).count() == 1


def test_only_a_missing_path_is_an_empty_table(spark):
    store = jobs.Store(spark, scratch_path(spark, "store"))
    assert store.read("articles", schemas.ARTICLE).count() == 0
    spark.createDataFrame([("x",)], "v string").write.text(store.path("articles"))
    with pytest.raises(Exception, match="(?i)parquet"):
        store.read("articles", schemas.ARTICLE).count()
