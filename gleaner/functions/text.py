"""Text expressions: HTML stripping, normalisation, sentence rules, tokens."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Elements whose whole content is dropped with their tags.
SKIPPED_ELEMENTS = [
    "frame", "frameset", "iframe", "noembed", "noframes", "noscript", "nostyle", "object", "script", "style",
]

# Abbreviations that do not end a sentence.
ABBREVIATIONS = [
    "Mr", "Mrs", "Ms", "Dr", "Prof", "Sr", "Jr", "St", "Gen", "Col", "Sgt", "Capt", "Lt", "Rep", "Sen", "Gov",
    "Hon", "Rev", "Inc", "Ltd", "Co", "Corp", "vs", "etc", "No", "Fig", "Jan", "Feb", "Mar", "Apr", "Jun",
    "Jul", "Aug", "Sep", "Sept", "Oct", "Nov", "Dec", "e.g", "i.e", "U.S", "a.m", "p.m",
]

# Words without weight in rankings.
STOP_WORDS = [
    "a", "about", "after", "all", "also", "am", "an", "and", "any", "are", "as", "at", "be", "because", "been",
    "before", "being", "but", "by", "can", "could", "did", "do", "does", "down", "for", "from", "had", "has",
    "have", "he", "her", "here", "him", "his", "how", "i", "if", "in", "into", "is", "it", "its", "just", "me",
    "more", "most", "my", "no", "not", "now", "of", "off", "on", "only", "or", "other", "our", "out", "over",
    "s", "said", "she", "so", "some", "such", "t", "than", "that", "the", "their", "them", "then", "there",
    "these", "they", "this", "those", "through", "to", "too", "under", "up", "very", "was", "we", "were", "what",
    "when", "where", "which", "while", "who", "why", "will", "with", "would", "you", "your",
]

SKIPPED_CONTENT = rf"(?is)<({'|'.join(SKIPPED_ELEMENTS)})\b[^>]*>.*?</\1\s*>"
COMMENT = r"(?s)<!--.*?-->"
TAG = r"<[/!?]?[a-zA-Z][^>]*>"

# Three adjacent characters: not punctuation, not a separator, not control.
MEANINGFUL = r"\P{P}\P{Z}\P{C}"

MARK = "\u0001"
SENTENCE_END = "([.!?]+[\"'”’»)\\]]*)(\\s)"


def abbreviation_mark(abbreviations: list[str], any_case: bool = False) -> str:
    """Pattern of a cut right after one of the abbreviations, with its full stop.

    Cuts are few, so the words are looked for backwards from a cut and not at every place of a text.  Looking back counts
    UTF-16 units, of which a letter may have two.
    """
    words = "|".join(a.replace(".", "[.]") for a in sorted(abbreviations, key=len, reverse=True)) if any_case else "|".join(
        a.replace(".", "[.]") for a in abbreviations)
    return rf"{'(?iu)' if any_case else ''}[.]{MARK}(?<=(?<!\p{{L}}{{1,2}})(?:{words})[.]{MARK})"


ABBREVIATION_MARK = abbreviation_mark(ABBREVIATIONS)
SPACE_EDGE = r"^\s+|\s+$"

TOKEN_BREAK = r"[^\p{L}\p{N}]+"


def strip_html(text: Column) -> Column:
    """Text without comments, tags and the content of skipped elements."""
    out = F.regexp_replace(text, COMMENT, "")
    out = F.regexp_replace(out, SKIPPED_CONTENT, "")
    return F.regexp_replace(out, TAG, "")


@F.pandas_udf(StringType())
def _unescape_nfkc(values: pd.Series) -> pd.Series:
    coded = values.str.contains("&", regex=False).fillna(False).astype(bool)
    return values.mask(coded, values[coded].map(html.unescape)).str.normalize("NFKC")


# A filter on the result must not run the Python step twice.
_unescape_nfkc = _unescape_nfkc.asNondeterministic()


def normalize_text(text: Column) -> Column:
    """Valid UTF-8, HTML removed, entities unescaped once, NFKC; null when nothing is left.

    Only rows with '&' or a non-ASCII character are sent to Python.
    """
    valid = F.make_valid_utf8(text)
    bare = F.nullif(F.when(valid.contains("<"), strip_html(valid)).otherwise(valid), F.lit(""))
    needs = bare.contains("&") | (F.octet_length(bare) != F.length(bare))
    return F.coalesce(_unescape_nfkc(F.when(needs, bare)), bare)


def split_sentences(text: Column, learned: list[str] | None = None) -> Column:
    """Array of sentences: cut at line ends and after . ! ? with closing quotes before white space.

    A cut right after an abbreviation is taken back: one of the fixed list, or
    with ``learned`` one of those in any case (see operators/vocabulary.py).
    Sentences are trimmed, and those without three adjacent meaningful
    characters dropped.
    """
    marked = F.regexp_replace(F.replace(text, F.lit(MARK), F.lit(" ")), SENTENCE_END, f"$1{MARK}$2")
    if learned is None:
        marked = F.regexp_replace(marked, ABBREVIATION_MARK, ".")
    elif learned:
        marked = F.regexp_replace(marked, abbreviation_mark(learned, any_case=True), ".")
    pieces = F.split(marked, rf"[\r\n{MARK}]+")
    return F.filter(F.transform(pieces, lambda p: F.regexp_replace(p, SPACE_EDGE, "")), is_meaningful)


def is_meaningful(sentence: Column) -> Column:
    """Three adjacent characters: non-punctuation, non-separator, non-control."""
    return sentence.rlike(MEANINGFUL)


def words(text: Column) -> Column:
    """Lower-case words in order, without stop words."""
    return F.filter(F.split(F.lower(text), TOKEN_BREAK), lambda w: ~w.isin("", *STOP_WORDS))
