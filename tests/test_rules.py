"""Golden rows, one per rule that is easy to get wrong."""

import datetime

import pytest
from pyspark.sql import functions as F

from gleaner.functions import fields, urls
from gleaner.functions import text as tx
from gleaner.operators import articles, bars, cleaning, forum, listings, logs, queues


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(fn(F.col("v")).alias("x")).first()["x"]


@pytest.mark.parametrize("value, body, short", [
    ("  ab ", None, None), ("éé", "éé", True), ("x" * 29, "x" * 29, True), ("x" * 30, "x" * 30, False)])
def test_clean_body(spark, value, body, short):
    assert one(spark, value, fields.clean_body) == body
    assert one(spark, value, fields.body_is_short) == short


@pytest.mark.parametrize("value, title", [("t" * 280, "t" * 280), ("t" * 281, None), (" abc ", "abc"), ("ab", None)])
def test_clean_title(spark, value, title):
    assert one(spark, value, fields.clean_title) == title


@pytest.mark.parametrize("url, host", [
    ("https://u@www.a.com:80/p", "www.a.com"), ("/rel/x", None), ("http://a b.com", None)])
def test_url(spark, url, host):
    assert one(spark, url, urls.url_host) == host
    assert one(spark, url, urls.is_valid_url) == (host is not None)


@pytest.mark.parametrize("canonical, host", [("/rel/x", "h"), ("http://c.org/a", "c.org"), ("", "h"), (None, "h")])
def test_resolve_host(spark, canonical, host):
    assert one(spark, canonical, lambda c: urls.resolve_host(c, F.lit("h"))) == host


@pytest.mark.parametrize("text, hour", [
    ("2020-08-01T12:00:00-07:00", 19), ("2020-08-01T12:00:00", None), ("x" * 25, None)])
def test_published_time(spark, text, hour):
    got = one(spark, text, lambda v: F.date_format(fields.published_time(v), "yyyy-MM-dd HH:mm"))
    assert got == (None if hour is None else f"2020-08-01 {hour}:00")


@pytest.mark.parametrize("text, seconds", [
    ("1h2m3.5s", 3724.0), ("90ms", 0.0), ("1.5s", 2.0), ("250us", 0.0), ("-2s", -2.0), ("0", 0.0), ("abc", None), ("3", None)])
def test_duration(spark, text, seconds):
    assert one(spark, text, lambda v: fields.round_seconds(fields.duration_seconds(v))) == seconds


@pytest.mark.parametrize("n, ratio", [(280, 1.0), (281, 0.7), (1000, 0.7), (1001, 0.5), (3000, 0.5), (10000, 0.3), (10001, 0.1)])
def test_summary_ratio(spark, n, ratio):
    assert one(spark, n, fields.summary_ratio, "int") == ratio


@pytest.mark.parametrize("line, app", [
    ("level=info application=App", "App"), ("application=a application=b x", "b"), ("nothing", ""), ("xapplication=App", "=App")])
def test_log_field(spark, line, app):
    """The last piece that contains the name counts, cut at a fixed length."""
    assert one(spark, line, lambda v: fields.log_field(v, "application")) == app


@pytest.mark.parametrize("text, normal", [
    ("<b>&amp;lt;ﬁ</b>", "&lt;fi"), ("<p></p>", None), ("a<script>x < y</script>b<!-- c -->", "ab"), ("1 < 2", "1 < 2"),
    ("plain", "plain"), ("é", "é")])
def test_normalize(spark, text, normal):
    assert one(spark, text, tx.normalize_text) == normal


def test_normalize_invalid_utf8(spark):
    df = spark.createDataFrame([(bytearray(b"a\xffb"),)], "v binary").select(F.col("v").cast("string").alias("v"))
    assert df.select(tx.normalize_text(F.col("v")).alias("x")).first()["x"] == "a�b"


@pytest.mark.parametrize("text, sentences", [
    ("Dr. Smith came. He left!", ["Dr. Smith came.", "He left!"]),
    ('He said "go." Then left', ['He said "go."', "Then left"]),
    ("one line\nnext line", ["one line", "next line"]),
    ("... ok? ab. abc.", ["ok?", "ab.", "abc."]),
    ("", [])])
def test_sentences(spark, text, sentences):
    got = one(spark, text, tx.split_sentences)
    assert got == [s for s in sentences if one(spark, s, tx.is_meaningful)]


@pytest.mark.parametrize("text, kept", [("...", False), (" ..", True), ("abc", True), ("ab", False)])
def test_meaningful(spark, text, kept):
    assert one(spark, text, tx.is_meaningful) is kept


def test_authors_and_chunks(spark):
    assert one(spark, None, articles.authors_json, "array<string>") == "[]"
    for n in (0, 1, 100, 101, 250):
        ids = [str(i) for i in range(n)]
        batches = one(spark, ids, forum.chunk_children, "array<string>")
        assert [len(b.split(",")) for b in batches] == [100] * (n // 100) + ([n % 100] if n % 100 else [])
        assert ",".join(batches) == ",".join(ids)


def test_needs_more(spark):
    rows = spark.createDataFrame(
        [(1, 10, 0, 0), (2, 0, 20, 0), (3, 0, 21, 14), (4, 0, 21, 15), (5, None, 5, 0)],
        "submission_id int, more_children int, num_comments int, comments_got int")
    got = {r["submission_id"]: r["needs_more"] for r in forum.needs_more_comments(rows).collect()}
    assert got == {1: True, 2: False, 3: True, 4: False, 5: False}


def test_find_article(spark):
    stored = spark.createDataFrame([(5, "u", None), (3, "x", "u"), (4, "y", "y")], "article_id long, link string, canonical_link string")
    wanted = spark.createDataFrame([("u",), ("nowhere",), ("y",)], "url string")
    assert sorted(articles.find_article(wanted, stored).collect()) == [("u", 3), ("y", 4)]


def test_source_from_stored_posts(spark):
    posts = spark.createDataFrame(
        [(1, "a", " http://a.com/1 ", 30), (2, "b", "http://b.com/2", 20), (3, "c", "http://c.com/3", 10),
         (4, "d", "nonsense", 5), (5, "e", "http://seen.com/1", 1)],
        "submission_id long, title string, url string, created_utc long")
    seen = spark.createDataFrame([("http://seen.com/1",)], "link string")
    got = articles.source_from_stored_posts(posts, seen).collect()
    assert [r["link"] for r in got] == ["http://c.com/3", "http://b.com/2", "http://a.com/1"]


def test_new_listings_and_members(spark):
    stored = spark.createDataFrame([("k",)], "iex_id string")
    fresh = spark.createDataFrame(
        [(True, "A", "n", "1", "et", "US", "USD", "X"), (True, "B", "n", "2", "cs", "US", "USD", "X"),
         (True, "C", "n", "3", "ad", "US", "USD", "X"), (False, "D", "n", "4", "et", "US", "USD", "X"),
         (True, "E", "n", "k", "et", "US", "USD", "X")],
        "is_enabled boolean, symbol string, name string, iex_id string, type string, region string, currency string, exchange string")
    got = {r["symbol"]: r["is_active"] for r in listings.new_listings(stored, fresh).collect()}
    assert got == {"A": True, "B": True, "C": False}
    rows = spark.createDataFrame([("Abc", False), (" abc", True)], "symbol string, is_active boolean")
    members = spark.createDataFrame([(" abc ",)], "symbol string")
    assert {r[0]: r[1] for r in listings.flag_active(rows, members).collect()} == {"Abc": True, " abc": False}


def test_new_bars(spark):
    day = datetime.datetime(2024, 1, 1)
    bar = "listing_id int, data_time timestamp, open double, close double, high double, low double, volume double, notional double, num_trades double"
    stored = spark.createDataFrame([(1, day, *[1.0] * 7)], bar)
    later = day + datetime.timedelta(minutes=1)
    incoming = spark.createDataFrame([
        (1, day, *[1.0] * 7), (1, later, 1.0, 1.0, 0.0, 0.0, 1.0, 0.0, 1.0), (2, day, *[1.0] * 7), (1, later, 0.0, *[1.0] * 6)], bar)
    got = sorted((r["listing_id"], r["high"]) for r in bars.new_bars(incoming, stored).collect())
    assert got == [(1, 0.0), (2, 1.0)]
    again = bars.new_bars(incoming, stored.unionByName(bars.new_bars(incoming, stored)))
    assert again.isEmpty()


def test_known_links(spark):
    rows = spark.createDataFrame([("x", None), ("y", "")], "link string, canonical_link string")
    assert sorted(r[0] for r in articles.known_links(rows).collect()) == ["x", "y"]


def test_dedup_batch(spark):
    rows = spark.createDataFrame(
        [("a", 1, "x", "y"), ("b", 2, "y", None), ("c", 3, "z", "y"), ("d", 4, "q", ""), ("e", 5, "r", "")],
        "item_no string, source_published_time int, link string, canonical_link string")
    assert sorted(r["item_no"] for r in articles.dedup_batch(rows).collect()) == ["a", "d", "e"]


def test_history(spark):
    history = spark.createDataFrame(
        [("A", datetime.date(2024, 1, d), 10.0 * d, *[d] * 7) for d in range(1, 8)],
        "app string, log_date date, run_time_s double, trace_count long, debug_count long, info_count long, "
        "warn_count long, error_count long, fatal_count long, panic_count long")
    today = history.where("log_date = '2024-01-07'").withColumn("log_date", F.lit("2024-01-08").cast("date"))
    kept = logs.keep_last_7(history, today)
    assert sorted(r["log_date"].day for r in kept.collect()) == [2, 3, 4, 5, 6, 7, 8]
    gap = history.where("day(log_date) <= 3").withColumn(
        "run_time_s", F.when(F.day("log_date") == 1, 10.0).when(F.day("log_date") == 3, 20.0))
    row = logs.log_averages(gap).first()
    assert row["run_time_avg_s"] == 10.0 and row["info_count_avg"] == 2


def test_first_line_run_time_counts(spark):
    lines = spark.createDataFrame([(1, "level=info application=App RunTime=90s")], "line_no long, line string")
    parsed = logs.parse_log_lines(lines)
    assert logs.last_runtime(parsed).first()["run_time_s"] == 90.0
    assert logs.log_level_counts(parsed).first()["info_count"] == 1


def test_queue(spark):
    now = datetime.datetime(2024, 1, 10)
    rows = spark.createDataFrame(
        [(i, now - datetime.timedelta(hours=h), "p") for i, h in enumerate((30, 5, 40))],
        "pos long, created_time timestamp, permalink string")
    assert [r["pos"] for r in queues.drain_aged_prefix(rows, F.lit(now), 24.0).collect()] == [0]
    assert queues.drain_aged_prefix(rows, F.lit(now), 1.0).count() == 3
    assert queues.capped_list(rows, "permalink", ["pos"], 0).count() == 1


def test_more_batches(spark):
    rows = [("t", 1, 7, 500), ("t", 2, 6, 1), ("t", 3, 6, 3201), ("t", 4, 1, 900), ("t", 5, 1, 800)]
    rows += [("u", i, 1, 50) for i in range(60)]
    nodes = spark.createDataFrame(rows, "thread_id string, more_id int, depth int, n_children int")
    got = forum.select_more_batches(nodes).collect()
    # Node 3 alone needs 33 calls, so nothing follows it.
    assert [r["more_id"] for r in got if r["thread_id"] == "t"] == [3]
    assert sorted(r["more_id"] for r in got if r["thread_id"] == "u") == list(range(33))


def test_flatten_order(spark):
    rows = spark.createDataFrame(
        [(1, 9, None), (2, 9, 1), (3, 9, 1), (4, 9, 2), (5, 9, 3), (6, 9, 4), (7, 9, 70)],
        "comment_id long, submission_id long, parent_id long")
    got = sorted((r["pos"], r["comment_id"], r["depth"]) for r in forum.flatten_comments(rows).collect())
    # All siblings first, then each subtree; 7 hangs on nothing.
    assert [g[1] for g in got] == [1, 2, 3, 4, 6, 5]
    assert [g[2] for g in got] == [1, 2, 2, 3, 4, 3]


def test_edit_distance_limit(spark):
    base = "The committee will meet again on Tuesday to discuss the budget proposal."
    nine, ten = base[:-9] + "#" * 9, base[:-10] + "#" * 10
    targets = spark.createDataFrame(
        [(1, 0, nine), (1, 1, ten), (1, 2, "abcde"), (2, 0, "abcde"), (1, 3, base)], "target_id long, pos int, sentence string")
    check = spark.createDataFrame([(1, base), (1, "vwxyz")], "target_id long, sentence string")
    got = sorted((r["target_id"], r["pos"]) for r in cleaning.unique_sentences(targets, check).collect())
    assert got == [(1, 1), (2, 0)]
