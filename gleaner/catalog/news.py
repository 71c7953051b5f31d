"""Sources, link checks, article fields, lookup and deduplication."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner.catalog.registry import now, query
from gleaner.functions import fields, sql, urls
from gleaner.operators import articles, ids, logs, pages
from gleaner.session import scratch_path
from gleaner.sources import known_links, readers, writers

# SQL for the host of an absolute URL: no user info, no port.
HOST = r"nullif(regexp_extract({}, '^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@]*@)?([^/:?# ]+)(?::[0-9]*)?(?:[/?#][^ ]*)?$', 1), '')"
SEEN = """
SELECT link FROM fx_article WHERE coalesce(link, '') <> ''
UNION SELECT canonical_link FROM fx_article WHERE coalesce(canonical_link, '') <> ''"""
TRIM = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"

SOURCE = f"""
SELECT item_no, title, link, 'RSS Feed' AS source, {HOST.format('link')} AS host, published FROM fx_feed"""

POST = f"""
SELECT submission_id, title, url AS link, 'Reddit Submission' AS source, {HOST.format('url')} AS host,
       make_timestamp(created_utc * 1000000) AS published, {{}}
FROM fx_submission"""

CLEAN_TITLE = f"CASE WHEN strlen({TRIM}) BETWEEN 3 AND 280 THEN {TRIM} END"


def _clean(column: str) -> str:
    return f"CASE WHEN strlen({TRIM.format(column)}) BETWEEN 3 AND 280 THEN {TRIM.format(column)} END"


def _body(column: str) -> str:
    return f"CASE WHEN strlen({TRIM.format(column)}) >= 3 THEN {TRIM.format(column)} END"


# The resolved host, blocked hosts and field rules, as one row per feed item.
ARTICLE = f"""
SELECT r.item_no, 'RSS Feed' AS source,
       coalesce(CASE WHEN strlen(r.canonical) > 2 THEN {HOST.format('r.canonical')} END, {HOST.format('f.link')}) AS host,
       f.link, f.published AS source_published_time,
       CASE WHEN strlen(r.pubdate) = 25 THEN CAST(CAST(r.pubdate AS TIMESTAMPTZ) AS TIMESTAMP) END AS published_time,
       {_clean('f.title')} AS source_title, {_clean('r.title')} AS title, {_clean('r.canonical')} AS canonical_link,
       {_body('r.text')} AS body, strlen({_body('r.text')}) < 30 AS is_short, '[]' AS authors
FROM fx_feed f JOIN fx_raw r ON r.item_no = f.item_no"""

GATED = f"""
SELECT a.* FROM ({ARTICLE}) a
WHERE a.body IS NOT NULL AND (a.title IS NOT NULL OR a.source_title IS NOT NULL)
  AND NOT EXISTS (SELECT 1 FROM fx_blocklist b WHERE b.host = a.host)"""

DEDUP = """
SELECT a.* FROM {rows} a
WHERE NOT EXISTS (SELECT 1 FROM {rows} b
                  WHERE (b.source_published_time < a.source_published_time
                         OR (b.source_published_time = a.source_published_time
                             AND (b.link < a.link OR (b.link = a.link AND b.item_no < a.item_no))))
                    AND (b.link IN (a.link, a.canonical_link) OR b.canonical_link IN (a.link, a.canonical_link)))"""

COLLECTED = f"""
WITH seen AS ({SEEN}),
src AS (SELECT f.item_no FROM fx_feed f
        WHERE (strlen(f.link) <= 1 OR f.link NOT IN (SELECT link FROM seen))
          AND coalesce({HOST.format('f.link')}, '') NOT IN (SELECT host FROM fx_blocklist)),
raw AS (SELECT r.item_no FROM fx_raw r WHERE strlen(r.canonical) <= 1 OR r.canonical NOT IN (SELECT link FROM seen)),
gated AS (SELECT g.* FROM ({GATED}) g WHERE g.item_no IN (SELECT item_no FROM src) AND g.item_no IN (SELECT item_no FROM raw)),
kept AS ({DEDUP.format(rows='gated')})
"""


def _sources(t):
    return articles.source_from_feed(t("fx_feed"))


def _seen(t):
    return articles.known_links(t("fx_article"))


def _normal(t):
    return articles.normalize_articles(t("fx_raw"), _sources(t))


# -- sources -----------------------------------------------------------------------

@query("source_from_feed", SOURCE)
def _(t):
    return _sources(t)


POST_COLUMNS = ["submission_id", "title", "link", "source", "host", "published"]


@query("source_from_post", f"""
SELECT submission_id, title, url AS link, 'Reddit Submission' AS source, {HOST.format('url')} AS host,
       make_timestamp(created_utc * 1000000) AS published FROM fx_submission""")
def _(t):
    return articles.source_from_post(t("fx_submission")).select(*POST_COLUMNS)


@query("source_from_stored_posts", f"""
WITH seen AS ({SEEN}), p AS (SELECT *, {TRIM.format('url')} AS u FROM fx_submission WHERE length(url) > 2)
SELECT submission_id, title, u AS link, 'Reddit Submission' AS source, {HOST.format('u')} AS host,
       make_timestamp(created_utc * 1000000) AS published
FROM p WHERE {HOST.format('u')} IS NOT NULL AND u NOT IN (SELECT link FROM seen) AND strlen(u) > 1
ORDER BY published""")
def _(t):
    return articles.source_from_stored_posts(t("fx_submission"), _seen(t)).select(*POST_COLUMNS)


@query("posts_by_time", """
SELECT submission_id, url, created_utc FROM fx_submission WHERE length(url) > 2 ORDER BY created_utc""")
def _(t):
    return articles.posts_by_time(t("fx_submission")).select("submission_id", "url", "created_utc")


# -- filters -----------------------------------------------------------------------

@query("link_length_filter", "SELECT * FROM fx_feed WHERE strlen(link) > 1")
def _(t):
    return articles.link_length_filter(t("fx_feed"))


@query("valid_url_filter", f"""
SELECT url FROM (SELECT url FROM pages UNION ALL SELECT url FROM fx_submission) WHERE {HOST.format('url')} IS NOT NULL""")
def _(t):
    return articles.valid_url_filter(t("pages").select("url").unionAll(t("fx_submission").select("url")))


@query("url_host", f"SELECT page_id, {HOST.format('url')} AS host FROM pages")
def _(t):
    return t("pages").select("page_id", urls.url_host(F.col("url")).alias("host"))


@query("resolve_host", f"""
SELECT r.item_no, coalesce(CASE WHEN strlen(r.canonical) > 2 THEN {HOST.format('r.canonical')} END, f.host) AS host
FROM fx_raw r JOIN fx_feed f ON f.item_no = r.item_no""")
def _(t):
    return t("fx_raw").join(t("fx_feed").select("item_no", "host"), "item_no").select(
        "item_no", urls.resolve_host(F.col("canonical"), F.col("host")).alias("host"))


@query("has_body", "SELECT article_id, body FROM fx_article WHERE body IS NOT NULL")
def _(t):
    return articles.has_body(t("fx_article")).select("article_id", "body")


@query("article_by_id", """
SELECT article_id, host, link, title, body FROM fx_article WHERE article_id = 1033""")
def _(t):
    return articles.article_by_id(t("fx_article"), 1033).select("article_id", "host", "link", "title", "body")


@query("export_host_bodies", """
SELECT article_id, body FROM fx_article WHERE host = 'www.src3.com' ORDER BY article_id LIMIT 10""")
def _(t):
    return articles.export_host_bodies(t("fx_article"), "www.src3.com", 10)


@query("limit_bodies", """
SELECT article_id, strlen(body) AS n_bytes FROM fx_article WHERE host = 'www.src2.com' ORDER BY article_id LIMIT 10""")
def _(t):
    return articles.export_host_bodies(t("fx_article"), "www.src2.com", 10).select(
        "article_id", F.octet_length("body").alias("n_bytes"))


# -- links and hosts -----------------------------------------------------------------

@query("known_links", SEEN)
def _(t):
    return _seen(t)


@query("unseen_links", f"""
SELECT s.* FROM ({SOURCE}) s WHERE strlen(s.link) <= 1 OR s.link NOT IN ({SEEN})""")
def _(t):
    return articles.unseen_links(_sources(t), _seen(t))


@query("unseen_links_stored", f"""
SELECT s.* FROM ({SOURCE}) s WHERE strlen(s.link) <= 1 OR s.link NOT IN ({SEEN})""")
def _(t):
    """The same from the lasting table of known links, filled by two runs."""
    path, stored = scratch_path(t.spark, "known_links"), t("fx_article")
    known_links.catch_up(stored.where("article_id < 1400"), path, 32)
    return articles.unseen_links(_sources(t), known_links.catch_up(stored, path, 32))


@query("known_link_table", """
SELECT link, min(article_id) AS article_id
FROM (SELECT article_id, link FROM fx_article UNION ALL SELECT article_id, canonical_link FROM fx_article)
WHERE coalesce(link, '') <> '' GROUP BY link""")
def _(t):
    """All links of the table after three runs, the last of which has nothing new."""
    path, stored = scratch_path(t.spark, "known_links"), t("fx_article")
    for part in (stored.where("article_id < 1300"), stored, stored):
        known_links.catch_up(part, path, 32)
    return known_links.known_link_table(t.spark, path, 32).groupBy("link").agg(F.min("article_id").alias("article_id"))


@query("unseen_canonical", f"""
SELECT * FROM fx_raw WHERE strlen(canonical) <= 1 OR canonical NOT IN ({SEEN})""")
def _(t):
    return articles.unseen_canonical(t("fx_raw"), _seen(t))


@query("drop_blocked_hosts", """
SELECT item_no, link, host FROM fx_feed WHERE host NOT IN (SELECT host FROM fx_blocklist)""")
def _(t):
    return articles.drop_blocked_hosts(t("fx_feed"), t("fx_blocklist")).select("item_no", "link", "host")


@query("find_article", f"""
WITH urls AS (SELECT DISTINCT {TRIM.format('url')} AS url FROM fx_submission UNION SELECT canonical FROM fx_raw)
SELECT u.url, min(a.article_id) AS article_id
FROM urls u JOIN (SELECT article_id, link AS l FROM fx_article UNION ALL SELECT article_id, canonical_link FROM fx_article) a
  ON a.l = u.url GROUP BY u.url""")
def _(t):
    wanted = t("fx_submission").select(fields.trimmed(F.col("url")).alias("url")).unionByName(
        t("fx_raw").select(F.col("canonical").alias("url")))
    return articles.find_article(wanted, t("fx_article"))


# -- articles --------------------------------------------------------------------------

ARTICLE_COLUMNS = ["item_no", "source", "host", "link", "source_published_time", "published_time", "source_title",
                   "title", "canonical_link", "body", "is_short", "authors"]


@query("normalize_articles", ARTICLE)
def _(t):
    return _normal(t)


@query("article_quality_gate", GATED)
def _(t):
    return articles.article_quality_gate(_normal(t), t("fx_blocklist")).select(*ARTICLE_COLUMNS)


@query("dedup_batch", f"WITH a0 AS ({ARTICLE}) " + DEDUP.format(rows="a0"))
def _(t):
    return articles.dedup_batch(_normal(t)).select(*ARTICLE_COLUMNS)


def _collected(t):
    return articles.accept_articles(_sources(t), t("fx_raw"), _seen(t), t("fx_blocklist"))


@query("collect_articles", COLLECTED + "SELECT * FROM kept")
def _(t):
    """The whole news job: unseen, not blocked, extracted, gated and deduplicated."""
    return _collected(t).select(*ARTICLE_COLUMNS)


@query("append_articles", COLLECTED + """
SELECT k.*, (SELECT max(article_id) FROM fx_article) + row_number() OVER (ORDER BY source_published_time, link) AS article_id,
       TIMESTAMP '2024-03-01 00:00:00' AS data_entry_time FROM kept k""")
def _(t):
    path = scratch_path(t.spark, "articles")
    writers.append_articles(_collected(t), path, now(), writers.max_id(t("fx_article"), "article_id"))
    return t.spark.read.parquet(path)


@query("assign_ids", """
SELECT link, 999 + row_number() OVER (ORDER BY link, article_id) AS text_id FROM fx_article""")
def _(t):
    rows = t("fx_article").select("article_id", "link")
    return ids.assign_ids(rows, ["link", "article_id"], "text_id").select("link", "text_id")


GATED_POSTS = """
posts AS (SELECT submission_id, url, title, make_timestamp(created_utc * 1000000) AS published FROM fx_submission
          WHERE NOT is_deleted AND num_comments + score >= 30 AND NOT (is_media OR is_self)),
wanted AS (SELECT submission_id, regexp_replace(url, '^\\s+|\\s+$', '', 'g') AS url, title, published FROM posts
           WHERE strlen(regexp_replace(url, '^\\s+|\\s+$', '', 'g')) > 2)"""

LINKED = f"""
WITH seen AS ({SEEN}), {GATED_POSTS},
stored AS (SELECT a.article_id, w.submission_id FROM wanted w
           JOIN (SELECT l, min(article_id) AS article_id FROM
                 (SELECT article_id, link AS l FROM fx_article UNION ALL SELECT article_id, canonical_link FROM fx_article)
                 GROUP BY l) a ON a.l = w.url
           WHERE w.url IN (SELECT link FROM seen)),
unknown AS (SELECT * FROM wanted WHERE url NOT IN (SELECT link FROM seen)),
page AS (SELECT u.submission_id AS item_no, u.url AS link, u.published AS source_published_time,
                {_clean('u.title')} AS source_title, {_clean('r.title')} AS title,
                {_clean('r.canonical')} AS canonical_link, {_body('r.text')} AS body,
                {HOST.format('u.url')} AS source_host,
                coalesce(CASE WHEN strlen(r.canonical) > 2 THEN {HOST.format('r.canonical')} END, {HOST.format('u.url')}) AS host
         FROM unknown u JOIN fx_raw r ON r.link = u.url
         WHERE strlen(r.canonical) <= 1 OR r.canonical NOT IN (SELECT link FROM seen)),
gated AS (SELECT * FROM page WHERE body IS NOT NULL AND (title IS NOT NULL OR source_title IS NOT NULL)
          AND coalesce(source_host, '') NOT IN (SELECT host FROM fx_blocklist)
          AND coalesce(host, '') NOT IN (SELECT host FROM fx_blocklist)),
kept AS ({DEDUP.format(rows='gated')}),
made AS (SELECT link, (SELECT max(article_id) FROM fx_article)
                + row_number() OVER (ORDER BY source_published_time, link, item_no) AS article_id FROM kept),
links AS (SELECT article_id, submission_id FROM stored
          UNION SELECT m.article_id, u.submission_id FROM unknown u JOIN made m ON m.link = u.url)
"""


def _links(t):
    from gleaner.operators import forum
    posts = forum.external_links(forum.submission_gate(t("fx_submission"), 30))
    posts = posts.withColumn("url", fields.trimmed(F.col("url")))
    highest = writers.max_id(t("fx_article"), "article_id")
    return articles.link_posts_to_articles(posts, t("fx_article"), _seen(t), t("fx_raw"), t("fx_blocklist"), highest)[0]


@query("link_posts_to_articles", LINKED + "SELECT * FROM links")
def _(t):
    return _links(t)


@query("append_links", LINKED + """
SELECT *, TIMESTAMP '2024-03-01 00:00:00' AS data_entry_time FROM links l
WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.article_id = l.article_id AND s.submission_id = l.submission_id)""")
def _(t):
    """Links of a second run: those to articles known before the run are stored already."""
    path = scratch_path(t.spark, "links")
    links = _links(t)
    stored = links.join(t("fx_article").select("article_id"), "article_id", "left_semi")
    writers.append_links(links.unionByName(links), path, now(), stored)
    return t.spark.read.parquet(path)


@query("run_summary", f"""
SELECT (SELECT count(*) FROM fx_feed) AS sources, (SELECT count(*) FROM ({GATED}) g) AS accepted,
       (SELECT count(*) FROM fx_queue) AS queued, (SELECT count(*) FROM fx_comment) AS comments""")
def _(t):
    return logs.run_summary(
        sources=_sources(t), accepted=articles.article_quality_gate(_normal(t), t("fx_blocklist")),
        queued=t("fx_queue"), comments=t("fx_comment"))


# -- field rules ---------------------------------------------------------------------------

@query("clean_body", f"SELECT item_no, {_body('text')} AS body, strlen({_body('text')}) < 30 AS is_short FROM fx_raw")
def _(t):
    return t("fx_raw").select("item_no", fields.clean_body(F.col("text")).alias("body"),
                              fields.body_is_short(F.col("text")).alias("is_short"))


@query("sql_fields", f"""
SELECT r.item_no, {_body('r.text')} AS body, {_clean('r.title')} AS title, {HOST.format('f.link')} AS host,
       CASE WHEN length(r.text) <= 280 THEN 1.0 WHEN length(r.text) <= 1000 THEN 0.7 WHEN length(r.text) <= 3000 THEN 0.5
            WHEN length(r.text) <= 10000 THEN 0.3 ELSE 0.1 END::DOUBLE AS ratio
FROM fx_raw r JOIN fx_feed f USING (item_no)""")
def _(t):
    """Field rules called from a query written in SQL."""
    sql.register(t.spark)
    return t.spark.sql(
        "SELECT r.item_no, clean_body(r.text) AS body, clean_title(r.title) AS title, url_host(f.link) AS host, "
        "summary_ratio(length(r.text)) AS ratio FROM {raw} r JOIN {feed} f ON f.item_no = r.item_no", raw=t("fx_raw"), feed=t("fx_feed"))


@query("clean_title", f"""
SELECT item_no, {_clean('title')} AS title, {_clean('canonical')} AS canonical_link, {_clean('text')} AS text_title FROM fx_raw""")
def _(t):
    return t("fx_raw").select("item_no", fields.clean_title(F.col("title")).alias("title"),
                              fields.clean_title(F.col("canonical")).alias("canonical_link"),
                              fields.clean_title(F.col("text")).alias("text_title"))


@query("published_time", """
SELECT item_no, CASE WHEN strlen(pubdate) = 25 THEN CAST(CAST(pubdate AS TIMESTAMPTZ) AS TIMESTAMP) END AS published_time
FROM fx_raw""")
def _(t):
    return t("fx_raw").select("item_no", fields.published_time(F.col("pubdate")).alias("published_time"))


@query("source_time", "SELECT article_id, source_published_time FROM fx_article")
def _(t):
    return t("fx_article").select("article_id", "source_published_time")


@query("epoch_to_ts", "SELECT submission_id, make_timestamp(created_utc * 1000000) AS created_time FROM fx_submission")
def _(t):
    return t("fx_submission").select("submission_id", fields.epoch_to_ts(F.col("created_utc")).alias("created_time"))


@query("authors_json", """
SELECT doc_id, CASE WHEN doc_id % 3 = 0 OR doc_id % 5 = 0 THEN '[]' ELSE concat('["', source, '","', lang, '"]') END AS authors
FROM documents""")
def _(t):
    """Two names per document, an empty array for some and null for others."""
    none = F.when(F.col("doc_id") % 3 == 0, F.array().cast("array<string>"))
    names = F.coalesce(none, F.when(F.col("doc_id") % 5 != 0, F.array("source", "lang")))
    return t("documents").select("doc_id", articles.authors_json(names).alias("authors"))


# -- landed files ----------------------------------------------------------------------------

@query("read_feed_list", """
SELECT concat('feed ', CAST(page_id AS VARCHAR)) AS name, url AS link,
       CASE WHEN page_id % 9 = 0 THEN 'x' ELSE concat(url, '/rss') END AS rss, 'news' AS category, page_id % 9 = 0 AS is_short
FROM pages""")
def _(t):
    path = scratch_path(t.spark, "feeds")
    rss = F.when(F.col("page_id") % 9 == 0, "x").otherwise(F.concat(F.lit(" "), "url", F.lit("/rss ")))
    writers.export_csv(t("pages").select(
        F.concat(F.lit("feed "), F.col("page_id")).alias("Name"), F.col("url").alias("Link"), rss.alias("RSS"),
        F.lit("news").alias("Category")), path)
    return readers.read_feed_list(t.spark, path)


@query("read_blocklist", "SELECT DISTINCT concat(source, '.com') AS host FROM documents")
def _(t):
    path = scratch_path(t.spark, "blocklist")
    t("documents").select(F.concat("source", F.lit(".com")), F.lit("note")).write.csv(path)
    return readers.read_blocklist(t.spark, path)


@query("read_channel_list", "SELECT source AS name FROM documents")
def _(t):
    path = scratch_path(t.spark, "channels")
    t("documents").select("source", "lang").write.csv(path)
    return readers.read_channel_list(t.spark, path)


@query("feed_items", """
SELECT concat('feed ', source) AS feed, concat('src title ', CAST(doc_id AS VARCHAR)) AS title,
       concat('http://', source, '.com/', CAST(doc_id AS VARCHAR)) AS link,
       CASE WHEN doc_id % 3 = 0 THEN NULL
            ELSE TIMESTAMP '2024-01-01 00:00:00' + (doc_id * 41 % 4000) * INTERVAL '10' MINUTE END AS published
FROM documents WHERE source <> 'src4'""")
def _(t):
    """Feeds written as XML, one channel per document batch; those of one source have no title."""
    path = scratch_path(t.spark, "feeds")
    when = F.date_format("source_published_time", "EEE, dd MMM yyyy HH:mm:ss '+0000'")
    item = F.struct(F.col("source_title").alias("title"), "link", when.alias("pubDate"))
    site = F.regexp_extract("link", "http://(.*)[.]com", 1)
    feeds = t("fx_article").select(
        F.when(site != "src4", F.concat(F.lit("feed "), site)).alias("title"), F.array(item).alias("item"))
    feeds.write.format("xml").option("rootTag", "rss").option("rowTag", "channel").save(path)
    return readers.feed_items(t.spark, path)


TEXT = r"""trim(regexp_replace(regexp_replace(
  replace(replace(replace(replace(replace(replace(
    regexp_replace(regexp_replace(regexp_replace(regexp_extract(html, '(?is)<article[^>]*>(.*?)</article\s*>', 1),
      '\s+', ' ', 'g'), '(?i)</(p|div|h[1-6]|li|blockquote)\s*>|<br\s*/?>', chr(10), 'g'),
      '<[/!?]?[a-zA-Z][^>]*>', '', 'g'),
    '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&'),
  ' +', ' ', 'g'), ' *\n[ \n]*', chr(10) || chr(10), 'g'), ' ' || chr(10))"""


@query("extract_pages", f"""
SELECT * FROM (
  SELECT page_id, url AS link,
         trim(replace(replace(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title\\s*>', 1), '\\s+', ' ', 'g'),
              '&quot;', '"'), '&amp;', '&')) AS title,
         {TEXT} AS text, 0 AS n_authors, '' AS canonical, '' AS pubdate
  FROM pages)
WHERE length(text) >= 10 AND length(title) >= 3""")
def _(t):
    return pages.extract_pages(t("pages")).withColumn("n_authors", F.size("authors")).drop("authors")
