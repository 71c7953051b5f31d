"""Registry of queries and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.catalog.views import view, with_views
from gleaner.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def now() -> Column:
    """The fixed "now" of the registered queries; never the clock."""
    return F.lit("2024-03-01 00:00:00").cast("timestamp")


class Inputs:
    """Tables and derived views of one scale folder: ``t("fx_article")``."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = configure(spark)
        self.sf_dir = sf_dir

    def __call__(self, name: str) -> DataFrame:
        return view(self.spark, self.sf_dir, name)


def query(name: str, oracle: str | None = None):
    """Register ``fn(t)`` under ``name``, with the SQL that must give the same rows."""

    def wrap(fn: Callable[[Inputs], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Inputs(spark, sf_dir))

        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle:
            ORACLES[name] = with_views(oracle)
        return fn

    return wrap
