"""URL expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def url_host(url: Column) -> Column:
    """Host name without port and user info; null when the URL does not parse."""
    return F.try_parse_url(url, F.lit("HOST"))


def is_valid_url(url: Column) -> Column:
    """True for an absolute URL with a scheme and a host."""
    scheme = F.try_parse_url(url, F.lit("PROTOCOL"))
    return (F.coalesce(F.length(scheme), F.lit(0)) > 0) & (F.coalesce(F.length(url_host(url)), F.lit(0)) > 0)


def resolve_host(canonical: Column, source_host: Column) -> Column:
    """Host of the canonical link if that is longer than two bytes and has one, else the source host."""
    host = F.when(F.octet_length(canonical) > 2, F.nullif(url_host(canonical), F.lit("")))
    return F.coalesce(host, source_host)


def long_link(link: Column, longer_than: int = 1) -> Column:
    """True when the link has more than ``longer_than`` bytes."""
    return F.coalesce(F.octet_length(link), F.lit(0)) > longer_than
