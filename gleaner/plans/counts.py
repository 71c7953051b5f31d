"""What a run did, counted in the passes that wrote the rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


class RunCounts:
    """Row counts of a run by name.

    A watched frame is counted where it is written, by an observation of that
    very write, so nothing is read or computed twice.  Watch the rows that
    are written and nothing before a shuffle, and write what is watched.
    """

    def __init__(self) -> None:
        self._seen: dict[str, Observation] = {}

    def watch(self, name: str) -> Callable[[DataFrame], DataFrame]:
        """A step to put before one write; a name watched again is counted anew."""
        def step(rows: DataFrame) -> DataFrame:
            self._seen[name] = Observation()
            return rows.observe(self._seen[name], F.count(F.lit(1)).alias("rows"))

        return step

    def values(self) -> dict[str, int]:
        """Counts of all writes that took place; an empty batch that is not written has none."""
        return {name: seen.get["rows"] for name, seen in self._seen.items()}
