"""The text and field rules as session functions for queries written in SQL.

They are SQL functions (``CREATE TEMPORARY FUNCTION .. RETURN``): their bodies become part of the calling query's plan, so nothing
runs row by row outside it.  Each equals the column expression of the same name in this package.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from gleaner.functions import fields
from gleaner.functions import text as tx


def quoted(text: str) -> str:
    """A text as an SQL literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


_TRIMMED = f"regexp_replace(value, {quoted(fields.EDGE_SPACE)}, '')"
_HOST = "try_parse_url({}, 'HOST')"
_MARK = quoted(tx.MARK)
_CUT = f"regexp_replace(replace(text, {_MARK}, ' '), {quoted(tx.SENTENCE_END)}, {quoted('$1' + tx.MARK + '$2')})"
_MENDED = f"regexp_replace({_CUT}, {quoted(tx.ABBREVIATION_MARK)}, '.')"
_PIECES = f"split(regexp_replace({_MENDED}, {quoted('[' + chr(92) + 'r' + chr(92) + 'n]+')}, {_MARK}), {_MARK})"
_STOP_WORDS = ", ".join(map(quoted, ["", *tx.STOP_WORDS]))

#: Name: parameters, result, body.
FUNCTIONS = {
    "trimmed": ("value STRING", "STRING", _TRIMMED),
    "clean_body": ("value STRING", "STRING", f"IF(octet_length({_TRIMMED}) >= {fields.MIN_BYTES}, {_TRIMMED}, NULL)"),
    "clean_title": ("value STRING", "STRING",
                    f"IF(octet_length({_TRIMMED}) BETWEEN {fields.MIN_BYTES} AND {fields.MAX_TITLE_BYTES}, {_TRIMMED}, NULL)"),
    "symbol_key": ("value STRING", "STRING", f"upper({_TRIMMED})"),
    "published_time": ("value STRING", "TIMESTAMP",
                       f"IF(octet_length(value) = 25, try_to_timestamp(value, {quoted(chr(39).join(['yyyy-MM-dd', 'T', 'HH:mm:ssXXX']))}), NULL)"),
    "age_hours": ("created TIMESTAMP, seen TIMESTAMP", "DOUBLE", "(unix_micros(seen) - unix_micros(created)) / 3.6e9"),
    "summary_ratio": ("n_chars BIGINT", "DOUBLE",
                      "CAST(CASE WHEN n_chars <= 280 THEN 10 WHEN n_chars <= 1000 THEN 7 WHEN n_chars <= 3000 THEN 5 "
                      "WHEN n_chars <= 10000 THEN 3 ELSE 1 END AS DOUBLE) / 10.0D"),
    "url_host": ("url STRING", "STRING", _HOST.format("url")),
    "is_valid_url": ("url STRING", "BOOLEAN",
                     f"coalesce(length(try_parse_url(url, 'PROTOCOL')), 0) > 0 AND coalesce(length({_HOST.format('url')}), 0) > 0"),
    "resolve_host": ("canonical STRING, source_host STRING", "STRING",
                     f"coalesce(IF(octet_length(canonical) > 2, nullif({_HOST.format('canonical')}, ''), NULL), source_host)"),
    "is_meaningful": ("sentence STRING", "BOOLEAN", f"rlike(sentence, {quoted(tx.MEANINGFUL)})"),
    "split_sentences": ("text STRING", "ARRAY<STRING>",
                        f"filter(transform({_PIECES}, p -> regexp_replace(p, {quoted(tx.SPACE_EDGE)}, '')), "
                        f"s -> rlike(s, {quoted(tx.MEANINGFUL)}))"),
    "words": ("text STRING", "ARRAY<STRING>", f"filter(split(lower(text), {quoted(tx.TOKEN_BREAK)}), w -> w NOT IN ({_STOP_WORDS}))"),
}


def register(spark: SparkSession) -> list[str]:
    """Create the functions in the session and return their names."""
    for name, (parameters, result, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {body}")
    return list(FUNCTIONS)
