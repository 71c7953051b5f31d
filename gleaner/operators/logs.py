"""Application logs: level counts, run times, history and averages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gleaner.functions import fields
from gleaner.schemas import LOG_COUNTERS

# Level text per counter, in counter order (fixed values).
LEVELS = ["trace", "debug", "info", "warning", "error", "fatal", "panic"]
HISTORY_DAYS = 7


def parse_log_lines(lines: DataFrame) -> DataFrame:
    """(line_no, app, level, run_time) of each line; absent fields are ''."""
    return lines.select(
        "line_no",
        fields.log_field(F.col("line"), "application").alias("app"),
        fields.log_field(F.col("line"), "level").alias("level"),
        fields.log_field(F.col("line"), "RunTime").alias("run_time"),
    )


def log_line_filter(parsed: DataFrame) -> DataFrame:
    """Lines whose app and level each have more than two bytes."""
    return parsed.where((F.octet_length("app") > 2) & (F.octet_length("level") > 2))


def log_level_counts(parsed: DataFrame) -> DataFrame:
    """Seven level counters per app; an app with other levels only still has a row."""
    counters = [F.count_if(F.col("level") == lv).alias(c) for lv, c in zip(LEVELS, LOG_COUNTERS)]
    return log_line_filter(parsed).groupBy("app").agg(*counters)


def last_runtime(parsed: DataFrame) -> DataFrame:
    """The last parseable run time per app, in whole seconds."""
    seconds = fields.duration_seconds(F.col("run_time"))
    return (
        parsed.where((F.octet_length("app") > 2) & (F.octet_length("run_time") > 2))
        .withColumn("seconds", seconds).where(F.col("seconds").isNotNull())
        .groupBy("app").agg(fields.round_seconds(F.max_by("seconds", "line_no")).alias("run_time_s"))
    )


def daily_log(parsed: DataFrame, day: Column) -> DataFrame:
    """Today's log row per app: counters and last run time, in one pass over the lines.

    The same rows as ``log_level_counts`` left joined with ``last_runtime``.
    """
    levelled = F.octet_length("level") > 2
    counters = [F.count_if(levelled & (F.col("level") == lv)).alias(c) for lv, c in zip(LEVELS, LOG_COUNTERS)]
    seconds = F.when(F.octet_length("run_time") > 2, fields.duration_seconds(F.col("run_time")))
    last = F.max_by("seconds", F.when(F.col("seconds").isNotNull(), F.col("line_no")))
    return (
        parsed.where(F.octet_length("app") > 2).withColumn("seconds", seconds)
        .groupBy("app").agg(fields.round_seconds(last).alias("run_time_s"), F.count_if(levelled).alias("n"), *counters)
        .where("n > 0").select("app", day.cast("date").alias("log_date"), "run_time_s", *LOG_COUNTERS)
    )


def keep_last_7(history: DataFrame, today: DataFrame, days: int = HISTORY_DAYS) -> DataFrame:
    """History with today's rows added, the newest seven per app."""
    rows = history.withColumn("__new", F.lit(0)).unionByName(today.withColumn("__new", F.lit(1)))
    newest = Window.partitionBy("app").orderBy(F.desc("__new"), F.desc("log_date"))
    return rows.withColumn("__rank", F.row_number().over(newest)).where(F.col("__rank") <= days).drop("__rank", "__new")


def sort_history(history: DataFrame) -> DataFrame:
    """The history by app and day, oldest first."""
    return history.orderBy("app", "log_date")


def log_averages(history: DataFrame) -> DataFrame:
    """Averages per app over the kept history: counters truncated, run time in whole nanoseconds.

    A day without a run time counts as zero.
    """
    nanos = F.sum(F.coalesce(F.round(F.col("run_time_s") * 1e9).cast("long"), F.lit(0)))
    whole = [F.floor(F.sum(c) / F.count("*")).cast("long").alias(f"{c}_avg") for c in LOG_COUNTERS]
    return history.groupBy("app").agg(
        (F.floor(nanos / F.count("*")) / 1e9).alias("run_time_avg_s"), *whole, F.count("*").alias("n_days"))


def log_report(today: DataFrame, history: DataFrame) -> DataFrame:
    """One row per app of today's log with its current values and averages."""
    return today.join(log_averages(keep_last_7(history, today)), "app")


def run_summary(**counted: DataFrame) -> DataFrame:
    """One row of counts, one column per named table."""
    names = list(counted)
    rows = None
    for name in names:
        one = counted[name].select(*[F.lit(int(n == name)).alias(n) for n in names])
        rows = one if rows is None else rows.unionByName(one)
    return rows.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])
