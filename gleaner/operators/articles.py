"""News: sources, field normalisation, link checks, lookup and in-batch deduplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions import fields, urls
from gleaner.operators.ids import assign_ids
from gleaner.session import written

FEED_SOURCE = "RSS Feed"
POST_SOURCE = "Reddit Submission"


# -- sources ---------------------------------------------------------------

def source_from_feed(items: DataFrame) -> DataFrame:
    """Feed items (title, link, published) as sources."""
    return _with_source(items, FEED_SOURCE, F.col("link"), F.col("published"))


def source_from_post(posts: DataFrame) -> DataFrame:
    """Forum posts (title, url, created_utc) as sources."""
    return _with_source(posts, POST_SOURCE, F.col("url"), fields.epoch_to_ts(F.col("created_utc")))


def _with_source(rows: DataFrame, kind: str, link: Column, when: Column) -> DataFrame:
    used = {"title", "link", "url", "published", "created_utc", "host", "source"}
    return rows.select(
        *[c for c in rows.columns if c not in used],
        "title", link.alias("link"), F.lit(kind).alias("source"), urls.url_host(link).alias("host"),
        when.alias("published"),
    )


def posts_by_time(posts: DataFrame) -> DataFrame:
    """Stored posts with a url longer than two characters, oldest first."""
    return posts.where(F.length("url") > 2).orderBy("created_utc", "submission_id")


def source_from_stored_posts(posts: DataFrame, seen: DataFrame) -> DataFrame:
    """Back-fill sources: valid, unseen urls of stored posts, one output per post, oldest first."""
    rows = posts.where(F.length("url") > 2).withColumn("url", fields.trimmed(F.col("url")))
    rows = valid_url_filter(rows, "url")
    sources = source_from_post(rows)
    return link_length_filter(unseen_links(sources, seen)).orderBy("published", "submission_id")


# -- filters ---------------------------------------------------------------

def link_length_filter(rows: DataFrame, column: str = "link", longer_than: int = 1) -> DataFrame:
    """Rows whose link has more than ``longer_than`` bytes."""
    return rows.where(urls.long_link(F.col(column), longer_than))


def valid_url_filter(rows: DataFrame, column: str = "url") -> DataFrame:
    """Rows whose url is absolute with a scheme and a host."""
    return rows.where(urls.is_valid_url(F.col(column)))


def has_body(articles: DataFrame) -> DataFrame:
    return articles.where(F.col("body").isNotNull())


def article_by_id(articles: DataFrame, article_id: int) -> DataFrame:
    return articles.where(F.col("article_id") == article_id)


def export_host_bodies(articles: DataFrame, host: str, n: int = 10) -> DataFrame:
    """The first ``n`` bodies of a host by article id (a top-k report)."""
    return articles.where(F.col("host") == host).orderBy("article_id").limit(n).select("article_id", "body")


# -- joins with known links and hosts ---------------------------------------

def known_links(articles: DataFrame, seen: DataFrame | None = None) -> DataFrame:
    """Distinct links and canonical links, without null and ''."""
    links = articles.select(F.explode(F.array("link", "canonical_link")).alias("link"))
    if seen is not None:
        links = links.unionByName(seen.select("link"))
    return links.where(F.coalesce(F.col("link"), F.lit("")) != "").distinct()


def unseen(rows: DataFrame, seen: DataFrame, column: str) -> DataFrame:
    """Rows whose value of ``column`` is not a known link; null and one-byte values pass.

    Those values match nothing, and may be many: they are spread by a hash of their row, not sent to one task as nulls are.
    """
    is_link = F.coalesce(urls.long_link(F.col(column)), F.lit(False))
    hashed = [f.name for f in rows.schema if not any(x in f.dataType.simpleString() for x in ("map<", "variant"))]
    key = F.when(is_link, F.col(column)).otherwise(F.xxhash64(*(F.col(f"`{c}`") for c in hashed)).cast("string"))
    known = seen.select(F.col("link").alias("__known"))
    asked = rows.withColumns({"__is_link": is_link, "__key": key})
    matches = (F.col("__key") == F.col("__known")) & F.col("__is_link")
    return asked.join(known, matches, "left_anti").drop("__key", "__is_link")


def unseen_links(sources: DataFrame, seen: DataFrame) -> DataFrame:
    """Sources whose link is not known."""
    return unseen(sources, seen, "link")


def unseen_canonical(raw: DataFrame, seen: DataFrame) -> DataFrame:
    """Extracted pages whose canonical link is not known."""
    return unseen(raw, seen, "canonical")


def drop_blocked_hosts(rows: DataFrame, blocklist: DataFrame) -> DataFrame:
    """Rows whose host is not exactly a blocked one."""
    return rows.join(blocklist.select("host"), "host", "left_anti")


def find_article(wanted: DataFrame, articles: DataFrame) -> DataFrame:
    """(url, article_id): the lowest article whose link or canonical link is the url; no row without one.

    The two equalities become one equi-join; stored links that nobody wants go before they are aggregated.
    """
    wanted = wanted.select("url").distinct()
    lookup = (
        articles.select("article_id", F.explode(F.array("link", "canonical_link")).alias("url"))
        .join(wanted, "url", "left_semi")
        .groupBy("url").agg(F.min("article_id").alias("article_id"))
    )
    return lookup.select("url", "article_id")


# -- articles ---------------------------------------------------------------

def normalize_articles(raw: DataFrame, sources: DataFrame, key: str = "item_no") -> DataFrame:
    """Extracted page joined with its source -> article fields by the field rules."""
    page = raw.select(
        key, F.col("title").alias("page_title"), "text", "canonical", "pubdate",
        *(["page_authors"] if "page_authors" in raw.columns else []),
    )
    authors = F.col("page_authors") if "page_authors" in raw.columns else F.array().cast("array<string>")
    return sources.join(page, key).select(
        key,
        "source",
        urls.resolve_host(F.col("canonical"), F.col("host")).alias("host"),
        "link",
        F.col("published").alias("source_published_time"),
        fields.published_time(F.col("pubdate")).alias("published_time"),
        fields.clean_title(F.col("title")).alias("source_title"),
        fields.clean_title(F.col("page_title")).alias("title"),
        fields.clean_title(F.col("canonical")).alias("canonical_link"),
        fields.clean_body(F.col("text")).alias("body"),
        fields.body_is_short(F.col("text")).alias("is_short"),
        authors_json(authors).alias("authors"),
    )


def authors_json(authors: Column) -> Column:
    """Author array as JSON text; no authors give []."""
    return F.to_json(F.coalesce(authors, F.array().cast("array<string>")))


def article_quality_gate(articles: DataFrame, blocklist: DataFrame) -> DataFrame:
    """Articles with a body, a title of either kind and a resolved host that is not blocked."""
    kept = articles.where(
        F.col("body").isNotNull() & (F.col("title").isNotNull() | F.col("source_title").isNotNull())
    )
    return drop_blocked_hosts(kept, blocklist)


def dedup_batch(
    articles: DataFrame, key: str = "item_no", order: tuple[str, ...] = ("source_published_time", "link"),
) -> DataFrame:
    """Accept rows one by one: a row goes when an accepted earlier row has the same link or canonical link.

    Earlier means smaller by (``order``, ``key``).  A rejected row blocks
    nothing.  Each round accepts the rows that come first in all their links
    and rejects those that share a link with an accepted one; only rows behind
    an undecided one go on, so a batch without chains takes one round.  What is
    accepted is the first maximal independent set by rank: rounds follow the
    longest chain of ever earlier rows that each share a link with the next,
    which grows with the logarithm of a batch whose order has nothing to do
    with its links, and with half its length for a chain laid out in order.
    """
    rank = F.struct(*order, key)
    open_ = written(
        articles.select(
            F.col(key), rank.alias("__rank"),
            F.explode(F.array_distinct(F.array("link", "canonical_link"))).alias("__link"),
        ).where(F.coalesce(F.col("__link"), F.lit("")) != ""), "batch_links",
    )
    dropped = None
    while True:
        first = open_.groupBy("__link").agg(F.min("__rank").alias("__first"))
        placed = open_.join(first, "__link").withColumn("__ahead", F.col("__first") == F.col("__rank"))
        accepted = placed.groupBy(key).agg(F.min("__ahead").alias("__ok")).where("__ok").select(key)
        taken = open_.join(accepted, key, "left_semi").select("__link").distinct()
        rest = open_.join(accepted, key, "left_anti")
        lost = written(rest.join(taken, "__link", "left_semi").select(key).distinct(), "batch_dropped")
        dropped = lost if dropped is None else dropped.unionByName(lost)
        open_ = written(rest.join(lost, key, "left_anti"), "batch_links")
        if open_.isEmpty():
            return articles.join(dropped, key, "left_anti")


def accept_articles(
    sources: DataFrame, raw: DataFrame, seen: DataFrame, blocklist: DataFrame, key: str = "item_no",
) -> DataFrame:
    """Sources and their extracted pages -> articles worth storing (no ids yet).

    What passes the rules is written once: the rounds of the deduplication and those who range-sort the result read that.
    """
    fresh = drop_blocked_hosts(unseen_links(sources, seen), blocklist)
    pages = unseen_canonical(raw, seen)
    kept = article_quality_gate(normalize_articles(pages, fresh, key), blocklist)
    return dedup_batch(written(kept, "batch"), key)


def link_posts_to_articles(
    posts: DataFrame, articles: DataFrame, seen: DataFrame, raw: DataFrame, blocklist: DataFrame, max_id: int,
) -> tuple[DataFrame, DataFrame]:
    """External posts -> (links, new articles).

    A known url is linked to the stored article; an unknown one goes through
    the article rules, and is linked when accepted.  Posts sharing an unknown
    url all link to the one article made from it.
    """
    wanted = posts.where(F.octet_length("url") > 2)
    known = wanted.join(seen.select(F.col("link").alias("url")), "url", "left_semi")
    stored = known.join(find_article(known, articles), "url").select("article_id", "submission_id")

    unknown = wanted.join(seen.select(F.col("link").alias("url")), "url", "left_anti")
    sources = source_from_post(unknown)
    page = F.min(F.struct("title", "text", "canonical", "pubdate")).alias("page")
    # Written, so that Spark knows the size of the links: few ones go to the pages, and no text is shuffled for the others.
    linked = written(sources.select("link").where(F.col("link").isNotNull()).distinct(), "asked_links")
    asked = raw.join(linked, "link", "left_semi")
    pages = asked.groupBy("link").agg(page).select("link", "page.*")
    pages = sources.select("submission_id", "link").join(pages, "link").drop("link")
    made = accept_articles(sources, pages, seen, blocklist, "submission_id")
    made = assign_ids(made, ["source_published_time", "link", "submission_id"], "article_id", max_id)
    by_url = unknown.join(made.select(F.col("link").alias("url"), "article_id"), "url")
    links = stored.unionByName(by_url.select("article_id", "submission_id")).distinct()
    return links, made
