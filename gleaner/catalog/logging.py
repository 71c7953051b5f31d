"""Application logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner.catalog.registry import query
from gleaner.functions import fields
from gleaner.operators import logs
from gleaner.schemas import LOG_COUNTERS
from gleaner.session import scratch_path
from gleaner.sources import readers, writers

PARSED = """
SELECT line_no,
       coalesce(list_extract(list_transform(list_filter(string_split(line, ' '), lambda p: contains(p, 'application=')), lambda p: p[13:]), -1), '') AS app,
       coalesce(list_extract(list_transform(list_filter(string_split(line, ' '), lambda p: contains(p, 'level=')), lambda p: p[7:]), -1), '') AS level,
       coalesce(list_extract(list_transform(list_filter(string_split(line, ' '), lambda p: contains(p, 'RunTime=')), lambda p: p[9:]), -1), '') AS run_time
FROM fx_log_lines"""

COUNTS = f"""
SELECT app, {', '.join(f"count(*) FILTER (level = '{lv}') AS {c}" for lv, c in zip(logs.LEVELS, LOG_COUNTERS))}
FROM ({PARSED}) WHERE strlen(app) > 2 AND strlen(level) > 2 GROUP BY app"""

SECONDS = r"""
  coalesce(TRY_CAST(nullif(regexp_extract(run_time, '([0-9.]+)h', 1), '') AS DOUBLE), 0) * 3600
  + coalesce(TRY_CAST(nullif(regexp_extract(run_time, '([0-9.]+)m([^s]|$)', 1), '') AS DOUBLE), 0) * 60
  + coalesce(TRY_CAST(nullif(regexp_extract(run_time, '([0-9.]+)s', 1), '') AS DOUBLE), 0)
  + coalesce(TRY_CAST(nullif(regexp_extract(run_time, '([0-9.]+)ms', 1), '') AS DOUBLE), 0) / 1000"""

RUNTIME = f"""
SELECT app, round(CAST(arg_max({SECONDS}, line_no) AS DECIMAL(20,9)))::DOUBLE AS run_time_s
FROM ({PARSED}) WHERE strlen(app) > 2 AND strlen(run_time) > 2 GROUP BY app"""

TODAY = f"""
SELECT c.app, DATE '2024-02-10' AS log_date, r.run_time_s, {', '.join(f'c.{c}' for c in LOG_COUNTERS)}
FROM ({COUNTS}) c LEFT JOIN ({RUNTIME}) r ON r.app = c.app"""

KEPT = f"""
SELECT app, log_date, run_time_s, {', '.join(LOG_COUNTERS)} FROM (
  SELECT *, row_number() OVER (PARTITION BY app ORDER BY is_new DESC, log_date DESC) AS rn FROM (
    SELECT *, 0 AS is_new FROM fx_log_history
    UNION ALL BY NAME SELECT *, 1 AS is_new FROM ({TODAY}))) WHERE rn <= 7"""


def averages(rows: str) -> str:
    whole = ", ".join(f"CAST(floor(sum({c}) / count(*)) AS BIGINT) AS {c}_avg" for c in LOG_COUNTERS)
    return f"""
SELECT app, floor(sum(coalesce(run_time_s, 0) * 1000000000) / count(*)) / 1000000000 AS run_time_avg_s, {whole}, count(*) AS n_days
FROM ({rows}) GROUP BY app"""


def _parsed(t):
    return logs.parse_log_lines(t("fx_log_lines"))


def _today(t):
    return logs.daily_log(_parsed(t), F.lit("2024-02-10"))


def _kept(t):
    return logs.keep_last_7(t("fx_log_history"), _today(t))


@query("log_fields", PARSED)
def _(t):
    return _parsed(t)


@query("log_line_filter", f"SELECT * FROM ({PARSED}) WHERE strlen(app) > 2 AND strlen(level) > 2")
def _(t):
    return logs.log_line_filter(_parsed(t))


@query("log_level_counts", COUNTS)
def _(t):
    return logs.log_level_counts(_parsed(t))


@query("last_runtime", RUNTIME)
def _(t):
    return logs.last_runtime(_parsed(t))


@query("duration_seconds", f"SELECT line_no, {SECONDS} AS seconds FROM ({PARSED}) WHERE run_time <> ''")
def _(t):
    return _parsed(t).where("run_time <> ''").select(
        "line_no", fields.duration_seconds(F.col("run_time")).alias("seconds"))


@query("daily_log", TODAY)
def _(t):
    return _today(t)


@query("keep_last_7", KEPT)
def _(t):
    return _kept(t)


@query("sort_history", "SELECT app, log_date, info_count FROM fx_log_history ORDER BY app, log_date")
def _(t):
    return logs.sort_history(t("fx_log_history")).select("app", "log_date", "info_count")


@query("log_averages", averages(KEPT))
def _(t):
    return logs.log_averages(_kept(t))


@query("log_report", f"SELECT d.*, a.* EXCLUDE (app) FROM ({TODAY}) d JOIN ({averages(KEPT)}) a ON a.app = d.app")
def _(t):
    return logs.log_report(_today(t), t("fx_log_history"))


@query("scan_logs", "SELECT line FROM fx_log_lines")
def _(t):
    """Log lines written as gzip text and read back."""
    path = scratch_path(t.spark, "log")
    t("fx_log_lines").select("line").write.option("compression", "gzip").text(path)
    return readers.scan_logs(t.spark, path).select("line")


@query("scan_log_history", f"SELECT app, log_date, run_time_s, {', '.join(LOG_COUNTERS)} FROM fx_log_history")
def _(t):
    """The nested history written and read back."""
    path = scratch_path(t.spark, "history")
    writers.write_log_history(t("fx_log_history"), path)
    return readers.scan_log_history(t.spark, path)


@query("write_log_history", KEPT)
def _(t):
    """The kept history written as the new nested file and read back."""
    path = scratch_path(t.spark, "history")
    writers.write_log_history(_kept(t), path)
    return readers.scan_log_history(t.spark, path).select("app", "log_date", "run_time_s", *LOG_COUNTERS)
