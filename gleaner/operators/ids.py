"""Ascending ids and ranks without a window over all rows or over a hot group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gleaner.session import written

_PART, _SLOT = "__part", "__slot"
_SLOT_MASK = (1 << 33) - 1


def _laid_out(df: DataFrame, *order: str) -> DataFrame:
    """Rows range-sorted by ``order``, written with partition number and slot in the partition."""
    sorted_df = df.repartitionByRange(*order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id()
    return written(
        sorted_df.withColumn(_PART, F.shiftright(place, 33)).withColumn(_SLOT, place.bitwiseAND(F.lit(_SLOT_MASK))),
        "ranges",
    )


def assign_ids(df: DataFrame, order: list[str], name: str, max_id: int = 0, first_id: int = 1000) -> DataFrame:
    """Add ``name``: ids ascending by ``order`` after ``max(max_id, first_id - 1)``.

    The offsets table has one row per range partition, whatever the data size,
    so its window and its broadcast are bounded.
    """
    rows = _laid_out(df, *order)
    per_part = rows.groupBy(_PART).agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1))
    offsets = per_part.select(_PART, F.coalesce(before, F.lit(0)).alias("__before"))
    start = max(max_id, first_id - 1)
    return (
        rows.join(F.broadcast(offsets), _PART)
        .withColumn(name, F.col("__before") + F.col(_SLOT) + F.lit(start + 1))
        .drop(_PART, _SLOT, "__before")
    )


def rank_within(df: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """Add ``name``: the 1-based rank of a row in its group by ``order``.

    Groups are cut along the range partitions, so a group holding a large
    share of all rows is ranked by many tasks.
    """
    rows = _laid_out(df, *group, *order)
    pieces = rows.groupBy(_PART, *group).agg(F.count("*").alias("__n"))
    # Only a partition's first group can have rows in earlier partitions, and
    # a group has one piece per partition it touches.
    spread = Window.partitionBy(*group).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        pieces.withColumn("__before", F.sum("__n").over(spread))
        .where(F.col("__before").isNotNull()).drop("__n")
    )
    local = F.row_number().over(Window.partitionBy(_PART, *group).orderBy(_SLOT))
    return (
        rows.withColumn("__local", local)
        .join(F.broadcast(carried), [_PART, *group], "left")
        .withColumn(name, (F.col("__local") + F.coalesce(F.col("__before"), F.lit(0))).cast("long"))
        .drop(_PART, _SLOT, "__local", "__before")
    )
