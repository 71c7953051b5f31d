"""Article extraction from a table of web pages, in native expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions import text as tx
from gleaner.functions.fields import trimmed
from gleaner.session import widened

MIN_TEXT, MIN_TITLE = 10, 3

TITLE = r"(?is)<title[^>]*>(.*?)</title\s*>"
ARTICLE = r"(?is)<article[^>]*>(.*?)</article\s*>"
PARAGRAPH = r"(?is)<p(?:\s[^>]*)?>(.*?)(?=</p\s*>|<p[\s>]|</body|\z)"
BLOCK_END = r"(?i)</(p|div|h[1-6]|li|blockquote)\s*>|<br\s*/?>"

# Entities decoded here, in this order; & comes last so that nothing is decoded twice.
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")]


def _attribute(tag: str, marker: str, wanted: str) -> list[str]:
    """Patterns for an attribute of a tag that carries a marker attribute, in either order."""
    value = rf"{wanted}\s*=\s*[\"']([^\"']*)[\"']"
    return [rf"(?is)<{tag}\b[^>]*{marker}[^>]*\s{value}", rf"(?is)<{tag}\b[^>]*\s{value}[^>]*{marker}"]


CANONICAL = _attribute("link", r"rel\s*=\s*[\"']canonical[\"']", "href")
AUTHOR = _attribute("meta", r"name\s*=\s*[\"']author[\"']", "content")
PUBLISHED = (
    _attribute("meta", r"property\s*=\s*[\"']article:published_time[\"']", "content")
    + [r"(?is)<time\b[^>]*\sdatetime\s*=\s*[\"']([^\"']*)[\"']"]
)


def _first(html: Column, patterns: list[str]) -> Column:
    """The first match of the first pattern that has one, else ''."""
    found = [F.nullif(F.regexp_extract(html, p, 1), F.lit("")) for p in patterns]
    return F.coalesce(*found, F.lit(""))


def _decoded(text: Column) -> Column:
    for entity, char in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def _plain(html: Column) -> Column:
    """Text of a piece of HTML: one paragraph per block, runs of blanks as one space."""
    lined = F.regexp_replace(F.regexp_replace(html, r"\s+", " "), BLOCK_END, "\n")
    bare = _decoded(tx.strip_html(lined))
    return trimmed(F.regexp_replace(F.regexp_replace(bare, r" +", " "), r" *\n[ \n]*", "\n\n"))


def extract_pages(pages: DataFrame) -> DataFrame:
    """(page_id, link, title, text, authors, canonical, pubdate) of pages (page_id, url, html).

    The text is that of all articles of a page, or of its paragraphs where it
    marks no article.  No row for a text under 10 or a title under 3
    characters.  An absent date or canonical link is ''.  The row is built once,
    as the one element of an array, so that the length test repeats nothing.
    """
    html = F.col("html")
    articles = F.array_join(F.regexp_extract_all(html, F.lit(ARTICLE), F.lit(1)), "</p>")
    paragraphs = F.array_join(F.regexp_extract_all(html, F.lit(PARAGRAPH), F.lit(1)), "</p>")
    row = F.struct(
        "page_id",
        F.col("url").alias("link"),
        trimmed(_decoded(F.regexp_replace(F.regexp_extract(html, TITLE, 1), r"\s+", " "))).alias("title"),
        _plain(F.when(html.rlike(ARTICLE), articles).otherwise(paragraphs)).alias("text"),
        F.filter(F.array_distinct(F.concat(*[F.regexp_extract_all(html, F.lit(p), F.lit(1)) for p in AUTHOR])),
                 lambda a: F.length(a) > 0).alias("authors"),
        _first(html, CANONICAL).alias("canonical"),
        _first(html, PUBLISHED).alias("pubdate"),
    )
    long_enough = lambda r: (F.length(r["text"]) >= MIN_TEXT) & (F.length(r["title"]) >= MIN_TITLE)
    rows = widened(pages.select("page_id", "url", "html"))
    return rows.select(F.explode(F.filter(F.array(row), long_enough)).alias("__row")).select("__row.*")
