"""Helpers for array expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    A plain column would be inlined and computed again for every element of a
    lambda that uses it.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def total(items: Column, value: Callable[[Column], Column]) -> Column:
    """Sum of a double expression over an array."""
    return F.aggregate(items, F.lit(0.0), lambda acc, e: acc + value(e))
