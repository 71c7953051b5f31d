"""Main text of web pages by a maximum-scoring subsequence.

A page is a sequence of words and tags.  Words score by their surroundings (the block they stand in, inside a link or not): the
log-odds of being content, from labelled pages.  Tags score negative: a least cost, or the log-odds of being boilerplate where
those are larger.  One linear scan finds the contiguous region with the highest sum, and its blocks are the text.

Labelled pages are those that mark their article with <article> or <main>: at most `sample_pages` of them (lowest hash of the
id) give counts, summed by Spark; without any, every word scores 1 and every tag -1.  Menus, page headers, footers, sidebars,
forms, and elements with a class, id or role that is the name of adverts, notices or comments are no words at any place: they
neither add to a region nor appear in its text.  Script, style and the like are skipped as raw text.

The article is never outside by such a name or a form, nor is what holds it: <main>, or the outermost <article> elements that
stand in nothing outside (all, if every one does) and are no comments.  A form with most of a page's words is no form in this sense.  Containers
that have such a name as a part of theirs only ("page-with-comments") keep their words, which score negative unless the container
holds the article, stands in it, or has most of the words.

A block ends at a block-level tag; <br> is white space.  Null and empty pages have empty text; pages without a positive region
too; repeated rows are extracted each; an empty table gives no rows; other columns are ignored; pages are read whole.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

SAMPLE_PAGES = 2_000
TAG_COST = 0.5
_RAW = "script|style|noscript|template|iframe|svg|math|object|textarea|select|title"
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({_RAW})\b[^>]*>.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9]*)([^>]*)>|<[!?/][^>]*>", re.S | re.I
)
_CLASS = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_SPACE = re.compile(r"\s+")
_NAME = re.compile(r"[a-z]+")
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead "
    "tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
OUTSIDE = frozenset("head nav footer aside form menu button dialog header".split())
#: Class, id and role names that mark an element as no content; parts of the names of SUSPECT containers make them doubtful.
NOTICES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent cookie "
    "cookies disclaimer disqus footer gdpr masthead menu modal nav navbar navigation newsletter notice popup promo promoted "
    "promotion recommended related replies reply respond share sharing sidebar signup social sponsor sponsored subscribe "
    "toolbar widget".split()
)
MARKED = ("article", "main")
COMMENTS = frozenset("comment comments replies reply".split())
SUSPECT = frozenset("dd details div dl fieldset li ol section table td ul".split())


class _Element:
    """An open tag, the element around it, and what its names say: by tag, by a whole name, by a part of one."""

    def __init__(self, tag: str, attributes: str, parent: _Element | None) -> None:
        self.tag, self.parent, self.words = tag, parent, 0
        self.in_marked = parent is not None and (parent.in_marked or parent.tag in MARKED)
        self.by_tag = tag in OUTSIDE and tag != "form" and not (tag == "header" and self.in_marked)
        self.named = self.doubtful = self.comment = False
        if attributes and tag not in ("html", "body"):
            names = [(m[1] or m[2] or m[3] or "").lower() for m in _CLASS.finditer(attributes)]
            self.named = any(not NOTICES.isdisjoint(n.split()) for n in names)
            self.comment = any(not COMMENTS.isdisjoint(n.split()) for n in names)
            self.doubtful = tag in SUSPECT and any(not NOTICES.isdisjoint(_NAME.findall(n)) for n in names)
        if tag == "main" or (tag == "article" and not self.in_marked):
            self.named = False
        self.out = self.suspect = False

    def above(self) -> Iterator[_Element]:
        at = self.parent
        while at is not None:
            yield at
            at = at.parent


def _judge(elements: list[_Element], loose: int) -> None:
    """Settle which elements are outside and which are suspect; `loose` words stand in no element."""
    tops = [e for e in elements if e.tag in MARKED and not e.in_marked and not e.comment]
    mains = [e for e in tops if e.tag == "main" and not any(x.by_tag for x in e.above())]
    free = [e for e in tops if not any(x.by_tag or x.named or x.tag == "form" for x in e.above())]
    holders = {id(x) for e in mains or free or tops for x in e.above()}
    for e in elements:
        e.out = e.by_tag or (e.named and id(e) not in holders)
    kept = loose
    for e in reversed(elements):  # children come after their parents; what is outside adds no words
        if e.out:
            continue
        if e.parent is None:
            kept += e.words
        else:
            e.parent.words += e.words
    for e in elements:
        if id(e) not in holders and 2 * e.words <= kept:
            e.out = e.out or e.tag == "form"
            e.suspect = e.doubtful and not e.in_marked


def _parsed(page: str) -> Iterator[tuple[str, str, str, list[_Element]]]:
    """(kind, value, feature, open elements) of a page's words and tags; kinds: text, tag, end (of a block)."""
    open_: list[_Element] = []
    links = at = 0
    block = "body"
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            yield "text", page[at:m.start()], f"{block}{'+a' if links else ''}", open_
        at = m.end()
        if not m[3]:
            continue
        tag, closing = m[3].lower(), bool(m[2])
        if tag in BLOCKS:
            yield "end", "", "", open_
        if closing:
            if any(e.tag == tag for e in open_):
                while True:
                    e = open_.pop()
                    links -= e.tag == "a"
                    if e.tag == tag:
                        break
        elif tag not in VOID and not m[4].endswith("/"):
            if tag in BLOCKS and open_ and open_[-1].tag == "p":  # a block ends an open paragraph
                open_.pop()
            if tag == "a" and links:  # links don't nest
                while open_ and links:
                    links -= open_.pop().tag == "a"
            open_.append(_Element(tag, m[4], open_[-1] if open_ else None))
            links += tag == "a"
            yield "open", "", "", open_
        block = next((e.tag for e in reversed(open_) if e.tag in BLOCKS), "body")
        yield "tag", tag, f"<{tag}", open_
    if at < len(page):
        yield "text", page[at:], f"{block}{'+a' if links else ''}", open_


def tokens(page: str) -> Iterator[tuple[str, str, str, bool]]:
    """(kind, value, feature, inside a marked article); kinds: word run, tag, block end."""
    found, elements, loose = [], [], 0
    for kind, value, feature, open_ in _parsed(page):
        at = open_[-1] if open_ else None
        if kind == "open":
            elements.append(at)
        elif kind == "text":
            n = len(value.split())
            if at is None:
                loose += n
            else:
                at.words += n
        found.append((kind, value, feature, at))
    _judge(elements, loose)
    state: dict[int, tuple[bool, bool, bool]] = {id(None): (False, False, False)}
    for e in elements:
        out, suspect, marked = state[id(e.parent)]
        state[id(e)] = (out or e.out, suspect or e.suspect, marked or e.tag in MARKED)
    for kind, value, feature, at in found:
        out, suspect, marked = state[id(at)]
        if kind == "open":
            if at.out and not state[id(at.parent)][0]:
                yield "end", "", "", False
        elif not out:
            yield kind, value, feature + "+s" if suspect and kind == "text" else feature, marked


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        n: Counter = Counter()
        for page in batch["html"]:
            for kind, value, feature, inside in tokens(page):
                if kind == "text":
                    n[feature, inside] += len(value.split())
                elif kind == "tag":
                    n[feature, inside] += 1
        yield pd.DataFrame([(f, i, k) for (f, i), k in n.items()], columns=["feature", "inside", "n"])


def train(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> dict[str, float]:
    """Score by feature, from at most `sample_pages` marked pages.  Tag names are kept if HTML knows them as blocks or links."""
    marked = pages.filter(F.lower("html").rlike("<(article|main)[ >]")).select("page_id")
    picked = marked.orderBy(F.xxhash64("page_id"), "page_id").limit(sample_pages)
    rows = pages.select("page_id", "html").join(picked.distinct(), "page_id", "left_semi").select("html")
    found = rows.mapInPandas(_counted, "feature string, inside boolean, n long").groupBy("feature", "inside").agg(F.sum("n").alias("n"))
    known = [f"<{t}" for t in sorted(BLOCKS | {"a", "b", "i", "br", "img", "span", "em", "strong"})]
    counts = {(r[0], r[1]): r[2] for r in found.filter(F.col("feature").isin(known) | ~F.col("feature").startswith("<")).collect()}
    weights = {}
    for f in {f for f, _ in counts}:
        odds = math.log((counts.get((f, True), 0) + 1) / (counts.get((f, False), 0) + 1))
        weights[f] = min(-TAG_COST, odds) if f.startswith("<") or f.endswith("+s") else odds
    return weights


def _weight(weights: dict[str, float], feature: str) -> float:
    return weights.get(feature, -1.0 if feature.startswith("<") or feature.endswith("+s") else 1.0)


def main_text(page: str | None, weights: dict[str, float]) -> str:
    """The blocks of the region with the highest score, one per line."""
    if not page:
        return ""
    scores, texts = [], []
    for kind, value, feature, _ in tokens(page):
        if kind == "end":
            scores.append(0.0)
            texts.append(None)
        elif kind == "tag":
            scores.append(-TAG_COST if value in MARKED else _weight(weights, feature))
            texts.append(" " if value == "br" else "")
        else:
            scores.append(_weight(weights, feature) * len(value.split()))
            texts.append(html.unescape(value))
    best, total, start, region = 0.0, 0.0, 0, (0, 0)
    for i, x in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += x
        if total > best:
            best, region = total, (start, i + 1)
    blocks: list[list[str]] = [[]]
    for text in texts[region[0]:region[1]]:
        if text is None:
            blocks.append([])
        else:
            blocks[-1].append(text)
    lines = (_SPACE.sub(" ", "".join(b)).strip() for b in blocks)
    return "\n".join(x for x in lines if x)


def extract(pages: DataFrame, weights: dict[str, float]) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    @F.pandas_udf("string")
    def run(values: pd.Series) -> pd.Series:
        return pd.Series([main_text(v, weights) for v in values], dtype=object)

    return pages.select("page_id", "url", run("html").alias("text")).withColumn("n_chars", F.length("text").cast("long"))
