"""Keyed state of the streams, kept by Spark in the session's state store (RocksDB, see gleaner/session.py).

A processor sees one key at a time; what it keeps lies on the executor's disk and in the checkpoint, not in its heap, and a micro-batch
touches the state of its own keys only.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import TimestampType

# Posts that fall due in one hour are one key, or so many: keys cost calls, so their number follows the time and not the posts.
HOUR_MS, SALTS = 3_600_000, 16


# -- release by timers ------------------------------------------------------------------

class ReleaseWhenDue(StatefulProcessor):
    """Holds posts until the clock reaches their due time; a key's timer stands at the first due time of what it holds."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "permalink STRING, created_us BIGINT, due_ms BIGINT")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        new = [(r["permalink"], r["created_us"], r["due_ms"]) for r in rows]
        if new:
            self.waiting.appendList(new)
            # One that stood later fires too, and finds what is left.
            self.handle.registerTimer(min(r[2] for r in new))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        # All that is due by the clock leaves with the first timer.
        last = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        held = [tuple(r) for r in self.waiting.get()]
        kept = [r for r in held if r[2] > last]
        if kept:
            if len(kept) < len(held):
                self.waiting.put(kept)
            self.handle.registerTimer(min(r[2] for r in kept))
        elif held:
            self.waiting.clear()
        for permalink, created_us, due_ms in held:
            if due_ms <= last:
                yield Row(permalink=permalink, created_us=created_us)

    def close(self) -> None:
        pass


def released(queue: DataFrame, lookback_hours: float) -> DataFrame:
    """Posts (permalink, created_time, arrived) of a stream, each once, when the clock has passed their age of ``lookback_hours``.

    The clock is the watermark of ``arrived``: the latest arrival of the batches before, in whole milliseconds.  A post that
    arrives late is not dropped, and one that was old enough on arrival leaves with the next batch.  Posts with a null time wait
    for nothing; see ``without_time``.
    """
    clocked = queue.where("permalink IS NOT NULL AND created_time IS NOT NULL AND arrived IS NOT NULL").withWatermark("arrived", "0 seconds")
    due_us = F.unix_micros("created_time") + F.lit(round(lookback_hours * 3_600_000_000))
    # Without the watermarked column no row counts as too late.
    rows = clocked.select("permalink", F.unix_micros("created_time").alias("created_us"), F.ceil(due_us / 1000).alias("due_ms"))
    rows = rows.withColumns({"hour": F.floor(F.col("due_ms") / HOUR_MS), "salt": F.pmod(F.xxhash64("permalink"), F.lit(SALTS))})
    out = rows.groupBy("hour", "salt").transformWithState(
        statefulProcessor=ReleaseWhenDue(), outputStructType="permalink STRING, created_us BIGINT",
        outputMode="Append", timeMode="eventTime")
    return out.select("permalink", F.timestamp_micros("created_us").alias("created_time"))


def without_time(queue: DataFrame) -> DataFrame:
    """Posts that ``released`` leaves out."""
    return queue.where("permalink IS NULL OR created_time IS NULL OR arrived IS NULL")


# -- links ------------------------------------------------------------------------------

class KnownLinks(StatefulProcessor):
    """Remembers the links of accepted rows; asked for a link, tells whether it was accepted before.

    Rows are claims of accepted rows and questions of new ones; claims of a batch count for its questions.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.known = handle.getValueState("known", "known BOOLEAN")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        is_claimed, asked = False, []
        for r in rows:
            if r["is_claim"]:
                is_claimed = True
            else:
                asked.append(r["row_key"])
        # Every call of the state costs, so a claim is stored unasked.
        if is_claimed:
            self.known.update((True,))
        is_known = is_claimed or self.known.exists()
        for row_key in asked:
            yield Row(row_key=row_key, is_known=is_known)

    def close(self) -> None:
        pass


def known_keys(questions: DataFrame, claims: DataFrame) -> DataFrame:
    """(row_key, is_known) for every link of the questions (row_key, link), given the claims (link) so far."""
    none = F.lit(None).cast(questions.schema["row_key"].dataType)
    both = questions.select("link", "row_key", F.lit(False).alias("is_claim")).unionByName(
        claims.select("link", none.alias("row_key"), F.lit(True).alias("is_claim")))
    key = questions.schema["row_key"].dataType.simpleString()
    return both.groupBy("link").transformWithState(
        statefulProcessor=KnownLinks(), outputStructType=f"row_key {key}, is_known BOOLEAN", outputMode="Append", timeMode="None")


# -- capped lists -----------------------------------------------------------------------

class NewestRows(StatefulProcessor):
    """The newest ``n`` rows of a key; a batch reads and writes the lists of its own keys."""

    def __init__(self, fields: list[str], order: list[str], schema: str, n: int) -> None:
        self.fields, self.order, self.schema, self.n = fields, [fields.index(c) for c in order], schema, n

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.kept = handle.getListState("newest", self.schema)

    def _age(self, row: tuple) -> tuple:
        # Null is smaller than any value, as in the batch form.
        return tuple((row[i] is not None, row[i]) for i in self.order)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        held = (tuple(r) for r in self.kept.get()) if self.kept.exists() else iter(())
        new = (tuple(r[c] for c in self.fields) for r in rows)
        top = heapq.nlargest(self.n, (r for part in (held, new) for r in part), key=self._age)
        self.kept.put(top)
        for rank, row in enumerate(top, 1):
            yield Row(**dict(zip(self.fields, row, strict=True)), rank=rank)

    def close(self) -> None:
        pass


def _cut(key: str, order: list[str], n: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            newest = batch.sort_values(order, ascending=False, na_position="last", kind="stable")
            yield newest.groupby(key, dropna=False, sort=False).head(n)

    return run


def capped_lists(events: DataFrame, key: str, order: list[str], n: int) -> DataFrame:
    """The newest ``n`` rows (at least one) of every key that a batch touches, with ``rank`` 1 = newest.

    Rows are cut to ``n`` per key before the shuffle, piece by piece, so a hot key sends few of them.
    """
    n = max(n, 1)

    def ddl(frame: DataFrame) -> str:
        return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema)

    # Times are kept as microseconds: state hands them back in the worker's time zone.
    times = [f.name for f in events.schema if f.dataType == TimestampType()]
    cut = events.mapInPandas(_cut(key, order, n), ddl(events)).withColumns({c: F.unix_micros(c) for c in times})
    lists = cut.groupBy(key).transformWithState(
        statefulProcessor=NewestRows(events.columns, order, ddl(cut), n), outputStructType=f"{ddl(cut)}, rank INT",
        outputMode="Update", timeMode="None")
    return lists.withColumns({c: F.timestamp_micros(c) for c in times})
