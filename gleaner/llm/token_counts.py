"""Token counts of fields and sections by offset-mapped attribution.

A whole document is encoded once with a byte-level vocabulary, whose tokens spell the text: running token lengths are offsets,
turned into code points.  Token spans are then joined with the document's section spans (both sorted, so the interval join
is a merge by binary search inside the row) and a token that crosses a border goes by an explicit rule to

* "largest": the section that holds most of its characters, the earlier one of equals (the default),
* "first": the section that holds its first character that is in any section.

Tokens that touch no section count in section -1, so counts always add up to the document's tokens.  Sections must not overlap.
Null and empty texts have no tokens and one empty line; repeated rows are counted each; an empty table
gives no rows; other columns are ignored; texts are never cut.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

RULES = ("largest", "first")


@lru_cache(maxsize=2)
def _encoding(path: str, pattern: str):
    """The encoding of a rank file and each token's length in bytes."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    sizes = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
    for token, rank in ranks.items():
        sizes[rank] = len(token)
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), sizes


def token_spans(text: str, encoding, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First code point and end of every token; a token that holds part of a character spans all of it."""
    ids = np.array(encoding.encode_ordinary(text), dtype=np.int64)
    ends = np.cumsum(sizes[ids])
    starts = ends - sizes[ids]
    if text.isascii():
        return starts, ends
    points = np.cumsum((np.frombuffer(text.encode(), dtype=np.uint8) & 0xC0) != 0x80) - 1  # of every byte
    return points[starts], points[ends - 1] + 1


def attribute(starts, ends, low, high, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Section number (-1: none) of every token, and whether it crosses a border; sections [low, high) are sorted."""
    n = len(low)
    if not n:
        return np.full(len(starts), -1), np.zeros(len(starts), dtype=bool)
    first = np.searchsorted(high, starts, side="right")  # first section that ends behind the token's start
    last = np.searchsorted(low, ends, side="left") - 1  # last one that begins before its end
    own = np.where(first <= last, first, -1)
    at = np.clip(own, 0, n - 1)
    crosses = (own >= 0) & ((starts < low[at]) | (ends > high[at]))
    if rule == "largest":
        for i in np.flatnonzero(crosses & (last > first)):
            k = np.arange(first[i], last[i] + 1)
            own[i] = k[np.argmax(np.minimum(ends[i], high[k]) - np.maximum(starts[i], low[k]))]
    return own, crosses


def lines(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Spans of a text's lines; a line holds its line feed, so the spans cover the text."""
    ends = np.cumsum([len(x) + 1 for x in text.split("\n")])
    ends[-1] -= 1
    return np.concatenate([[0], ends[:-1]]), ends


def count_tokens(docs: DataFrame, path: str, pattern: str, sections: Column | None = None, rule: str = "largest") -> DataFrame:
    """doc_id, section, start, end, n_tokens, n_crossing.

    `sections` is an array of (start, end) in code points; without it the sections are the lines.  A null array holds none, and a
    section with a null border is left out; tokens outside all sections are counted under section -1.
    """
    assert rule in RULES

    no_sections = sections is None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoding, sizes = _encoding(path, pattern)
        for batch in batches:
            parts = []
            for doc, text, low, high in zip(batch["doc_id"], batch["text"], batch["low"], batch["high"], strict=True):
                if no_sections:
                    low, high = lines(text)
                else:
                    low, high = np.asarray(low, dtype=np.int64), np.asarray(high, dtype=np.int64)
                starts, ends = token_spans(text, encoding, sizes)
                own, crosses = attribute(starts, ends, low, high, rule)
                n = np.bincount(own + 1, minlength=len(low) + 1)
                c = np.bincount(own[crosses] + 1, minlength=len(low) + 1)
                numbers = np.arange(-1, len(low))
                keep = (numbers >= 0) | (n > 0)
                spans = np.concatenate([[-1], low]), np.concatenate([[-1], high])
                parts.append((doc, numbers[keep], spans[0][keep], spans[1][keep], n[keep], c[keep]))
            if parts:
                frame = {"doc_id": np.repeat(np.array([p[0] for p in parts], dtype=object), [len(p[1]) for p in parts])}
                for i, name in enumerate(("section", "start", "end", "n_tokens", "n_crossing"), 1):
                    frame[name] = np.concatenate([p[i] for p in parts])
                yield pd.DataFrame(frame).astype({"doc_id": "Int64"})

    spans = F.array().cast("array<struct<start:long,end:long>>")
    if sections is not None:
        spans = F.coalesce(F.array_sort(F.filter(sections, lambda s: s["start"].isNotNull() & s["end"].isNotNull())), spans)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
        F.transform(spans, lambda s: s["start"]).alias("low"), F.transform(spans, lambda s: s["end"]).alias("high"),
    )
    return rows.mapInPandas(run, "doc_id long, section int, start long, end long, n_tokens long, n_crossing long")
