"""Queues and capped lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gleaner import schemas
from gleaner.functions import fields


def capped_list(events: DataFrame, key: str, order: list[str], n: int) -> DataFrame:
    """The newest ``n`` rows per key (at least one), with ``rank`` 1 = newest.

    A row_number limit is applied in every map partition before the shuffle,
    so a hot key sends at most ``n`` rows per partition.
    """
    newest = Window.partitionBy(key).orderBy(*[F.desc(c) for c in order])
    return events.withColumn("rank", F.row_number().over(newest)).where(F.col("rank") <= max(n, 1))


def capped_list_read(events: DataFrame, key: str, order: list[str], value: str, n: int) -> DataFrame:
    """One row per key with its capped list, newest first; at most ``n`` elements."""
    rows = capped_list(events, key, order, n)
    ordered = F.sort_array(F.collect_list(F.struct("rank", value)))
    return rows.groupBy(key).agg(F.transform(ordered, lambda s: s[value]).alias("items"))


def queue_json(created: Column, permalink: Column) -> Column:
    """Queue entry as JSON text."""
    return F.to_json(F.struct(created.alias("CreatedTime"), permalink.alias("Permalink")),
                     {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"})


def queue_entries(lines: DataFrame, column: str = "value") -> DataFrame:
    """Queue JSON -> created_time, permalink; both null when the text does not parse."""
    entry = F.from_json(F.col(column), schemas.QUEUE_ENTRY, {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]XXX"})
    rest = [c for c in lines.columns if c != column]
    return lines.withColumn("__entry", entry).select(
        *rest, F.col("__entry.CreatedTime").alias("created_time"), F.col("__entry.Permalink").alias("permalink"))


def rejected_entries(queue: DataFrame) -> DataFrame:
    """Entries without a creation time."""
    return queue.where(F.col("created_time").isNull())


def _stop(queue: DataFrame, now: Column, lookback_hours: float) -> Column:
    """The position of the first entry younger than the lookback: one aggregate, compared as a scalar."""
    young = fields.age_hours(F.col("created_time"), now) < lookback_hours
    return F.coalesce(queue.where(young).agg(F.min("pos").alias("stop")).scalar(), F.lit(2**63 - 1))


def drain_aged_prefix(queue: DataFrame, now: Column, lookback_hours: float) -> DataFrame:
    """Entries from the head of the queue up to the first one younger than the lookback.

    An old entry behind a younger one waits.
    """
    due = queue.where(F.col("created_time").isNotNull())
    return due.where(F.col("pos") < _stop(queue, now, lookback_hours))


def queue_remainder(queue: DataFrame, now: Column, lookback_hours: float) -> DataFrame:
    """What stays behind the aged prefix: the first young entry and all after it, in their order."""
    return queue.where(F.col("pos") >= _stop(queue, now, lookback_hours))
