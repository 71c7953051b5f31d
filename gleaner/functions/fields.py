"""Field rules: lengths, times, symbols, durations, log fields.

Lengths count bytes where the data model says so (``octet_length``) and code
points elsewhere (``length``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MIN_BYTES = 3
MAX_TITLE_BYTES = 280
SHORT_BODY_BYTES = 30

# White space removed at both ends of a field.
EDGE_SPACE = r"^[\s\x{85}\x{A0}\p{Z}]+|[\s\x{85}\x{A0}\p{Z}]+$"


def trimmed(value: Column) -> Column:
    return F.regexp_replace(value, EDGE_SPACE, "")


def clean_body(value: Column) -> Column:
    """Trimmed text; null under three bytes."""
    text = trimmed(value)
    return F.when(F.octet_length(text) >= MIN_BYTES, text)


def body_is_short(value: Column) -> Column:
    """Warning flag for a kept body under thirty bytes."""
    return F.octet_length(clean_body(value)) < SHORT_BODY_BYTES


def clean_title(value: Column) -> Column:
    """Trimmed text; null under 3 or over 280 bytes (titles, source titles, canonical links)."""
    text = trimmed(value)
    return F.when(F.octet_length(text).between(MIN_BYTES, MAX_TITLE_BYTES), text)


def published_time(value: Column) -> Column:
    """Timestamp of a 25-byte ISO text with an offset; null for anything else."""
    parsed = F.try_to_timestamp(value, F.lit("yyyy-MM-dd'T'HH:mm:ssXXX"))
    return F.when(F.octet_length(value) == 25, parsed)


def epoch_to_ts(seconds: Column) -> Column:
    """Whole epoch seconds to a timestamp."""
    return F.timestamp_seconds(F.floor(seconds))


def symbol_key(symbol: Column) -> Column:
    """Member-side symbol key: trimmed and upper case."""
    return F.upper(trimmed(symbol))


def age_hours(created: Column, now: Column) -> Column:
    """Hours from ``created`` to ``now``."""
    return (F.unix_micros(now) - F.unix_micros(created)) / F.lit(3.6e9)


def summary_tenths(n_chars: Column) -> Column:
    """Share of sentences a summary keeps, in tenths, by text length in characters."""
    return (
        F.when(n_chars <= 280, 10).when(n_chars <= 1000, 7).when(n_chars <= 3000, 5)
        .when(n_chars <= 10000, 3).otherwise(1)
    )


def summary_ratio(n_chars: Column) -> Column:
    return summary_tenths(n_chars) / F.lit(10.0)


# Seconds per unit of a duration text such as 1h2m3.5s.
DURATION_SECONDS = {"h": 3600.0, "m": 60.0, "s": 1.0, "ms": 1e-3, "us": 1e-6, "µs": 1e-6, "μs": 1e-6, "ns": 1e-9}
DURATION_PIECE = r"([0-9]+\.?[0-9]*|\.[0-9]+)(ns|us|µs|μs|ms|s|m|h)"


def duration_seconds(text: Column) -> Column:
    """Seconds of a duration text; null when the text is not a duration."""
    numbers = F.regexp_extract_all(text, F.lit(DURATION_PIECE), F.lit(1))
    units = F.regexp_extract_all(text, F.lit(DURATION_PIECE), F.lit(2))
    scale = F.create_map(*[F.lit(x) for pair in DURATION_SECONDS.items() for x in pair])
    total = F.aggregate(
        F.zip_with(numbers, units, lambda n, u: n.cast("double") * F.element_at(scale, u)),
        F.lit(0.0), lambda acc, x: acc + x,
    )
    signed = F.when(text.startswith("-"), -total).otherwise(total)
    return (
        F.when(text.rlike(f"^[-+]?({DURATION_PIECE})+$"), signed)
        .when(text.rlike(r"^[-+]?0$"), F.lit(0.0))
    )


def round_seconds(seconds: Column) -> Column:
    """Rounded to the whole second, halves away from zero."""
    return F.round(seconds.cast("decimal(20,9)"), 0).cast("double")


def log_field(line: Column, name: str) -> Column:
    """Value after ``name=`` in the last space-separated piece that contains it; '' when absent."""
    marker = f"{name}="
    pieces = F.filter(F.split(line, " "), lambda p: p.contains(marker))
    value = F.substring(F.try_element_at(pieces, F.lit(-1)), len(marker) + 1, 2**31 - 1)
    return F.coalesce(value, F.lit(""))


def trade_date(today: Column, days_back: int) -> Column:
    """The day ``days_back`` before today as yyyyMMdd."""
    return F.date_format(F.date_sub(today, days_back), "yyyyMMdd")


def log_date(today: Column) -> Column:
    """Logs are written the day before they are read."""
    return F.date_sub(today, 1)
