"""Imports every module that registers queries."""

from gleaner.catalog import forums, logging, market, news, streams, textual  # noqa: F401
