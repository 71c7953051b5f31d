"""Intraday price bars: ingest, incremental filter, bounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PRICE_COLUMNS = ["open", "close", "high", "low", "volume", "notional", "num_trades"]
IEX_SOURCE_ID = 1


def ingest_intraday(raw: DataFrame) -> DataFrame:
    """Bars of a trading day: time = date + minute, numbers to decimals, oldest first per listing."""
    minute = F.make_dt_interval(mins=F.col("minute_of_day"))
    rows = raw.select(
        "listing_id", F.lit(IEX_SOURCE_ID).cast("short").alias("source_id"),
        (F.col("trade_date").cast("timestamp") + minute).alias("data_time"),
        *[F.col(c).cast("decimal(20,6)").alias(c) for c in PRICE_COLUMNS],
    )
    return bars_by_time(rows)


def bars_by_time(bars: DataFrame) -> DataFrame:
    return bars.orderBy("listing_id", "data_time")


def positive_bars(bars: DataFrame) -> DataFrame:
    """Bars with trades, volume, open and close above zero (high, low and notional are not tested)."""
    return bars.where("num_trades > 0 AND volume > 0 AND open > 0 AND close > 0")


def latest_bar(bars: DataFrame) -> DataFrame:
    """Newest bar time per listing; aggregated before the shuffle."""
    return bars.groupBy("listing_id").agg(F.max("data_time").alias("last_time"))


def new_bars(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    """Positive incoming bars strictly newer than the listing's newest stored bar, if it has one."""
    last = latest_bar(stored)
    return (
        positive_bars(incoming).join(last, "listing_id", "left")
        .where(F.col("last_time").isNull() | (F.col("data_time") > F.col("last_time")))
        .drop("last_time")
    )


def newer_bars(incoming: DataFrame, maxima: DataFrame) -> DataFrame:
    """``new_bars`` against stored maxima (listing_id, last_time), of which a listing may have several."""
    return new_bars(incoming, maxima.withColumnRenamed("last_time", "data_time"))


def batch_bounds(bars: DataFrame) -> DataFrame:
    """First and last bar time and size of a batch per listing."""
    return bars.groupBy("listing_id").agg(
        F.min("data_time").alias("first_time"), F.max("data_time").alias("last_time"), F.count("*").alias("n_bars"))
