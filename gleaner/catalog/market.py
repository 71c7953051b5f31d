"""Listings and bars."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner.catalog.registry import now, query
from gleaner.functions import fields
from gleaner.operators import bars, listings
from gleaner.session import scratch_path
from gleaner.sources import readers, writers

SEVEN = listings.SNAPSHOT_COLUMNS

STORED = "SELECT * FROM fx_bars WHERE NOT is_new"
INCOMING = "SELECT * FROM fx_bars WHERE is_new"
BAR_COLUMNS = "listing_id, data_time, " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in bars.PRICE_COLUMNS)
DIFFERS = " OR ".join(f"o.{c} IS DISTINCT FROM n.{c}" for c in SEVEN)


def _doubles(df):
    """Decimals as doubles, so both engines print them alike."""
    return df.select(*[
        F.col(f.name).cast("double").alias(f.name) if f.dataType.typeName() == "decimal" else F.col(f.name)
        for f in df.schema.fields])


def _stored(t):
    return t("fx_bars").where("NOT is_new").drop("is_new")


def _incoming(t):
    return t("fx_bars").where("is_new").drop("is_new")


# -- bars -----------------------------------------------------------------------

@query("ingest_intraday", f"""
SELECT listing_id, CAST(1 AS SMALLINT) AS source_id,
       CAST(trade_date AS TIMESTAMP) + minute_of_day * INTERVAL '1' MINUTE AS data_time,
       {', '.join(f'CAST(CAST({c} AS DECIMAL(20,6)) AS DOUBLE) AS {c}' for c in bars.PRICE_COLUMNS)}
FROM fx_bars_raw ORDER BY listing_id, data_time""")
def _(t):
    return _doubles(bars.ingest_intraday(t("fx_bars_raw")))


@query("bars_by_time", f"SELECT {BAR_COLUMNS} FROM fx_bars ORDER BY listing_id, data_time")
def _(t):
    return _doubles(bars.bars_by_time(t("fx_bars").drop("is_new")))


@query("positive_bars", f"""
SELECT {BAR_COLUMNS} FROM fx_bars WHERE num_trades > 0 AND volume > 0 AND open > 0 AND close > 0""")
def _(t):
    return _doubles(bars.positive_bars(t("fx_bars").drop("is_new")))


@query("latest_bar", "SELECT listing_id, max(data_time) AS last_time FROM fx_bars GROUP BY listing_id")
def _(t):
    return bars.latest_bar(t("fx_bars"))


@query("new_bars", f"""
WITH last AS (SELECT listing_id, max(data_time) AS last_time FROM ({STORED}) GROUP BY listing_id)
SELECT i.listing_id, i.data_time, {', '.join(f'CAST(i.{c} AS DOUBLE) AS {c}' for c in bars.PRICE_COLUMNS)}
FROM ({INCOMING}) i LEFT JOIN last ON last.listing_id = i.listing_id
WHERE i.num_trades > 0 AND i.volume > 0 AND i.open > 0 AND i.close > 0
  AND (last_time IS NULL OR i.data_time > last_time)""")
def _(t):
    return _doubles(bars.new_bars(_incoming(t), _stored(t)))


BATCH = f"""
WITH last AS (SELECT listing_id, max(data_time) AS last_time FROM ({STORED}) GROUP BY listing_id),
batch AS (SELECT i.* FROM ({INCOMING}) i LEFT JOIN last ON last.listing_id = i.listing_id
          WHERE i.num_trades > 0 AND i.volume > 0 AND i.open > 0 AND i.close > 0
            AND (last_time IS NULL OR i.data_time > last_time))"""


@query("batch_bounds", BATCH + """
SELECT listing_id, min(data_time) AS first_time, max(data_time) AS last_time, count(*) AS n_bars
FROM batch GROUP BY listing_id""")
def _(t):
    return bars.batch_bounds(bars.new_bars(_incoming(t), _stored(t)))


@query("append_intraday", BATCH + f"""
SELECT listing_id, CAST(1 AS SMALLINT) AS source_id, data_time, strftime(data_time, '%Y-%m') AS trade_month,
       {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in bars.PRICE_COLUMNS)}
FROM batch""")
def _(t):
    """The appended table, read back; ids of bars of one listing and time are in any order and left out."""
    path = scratch_path(t.spark, "intraday")
    batch = bars.new_bars(_incoming(t), _stored(t)).withColumn("source_id", F.lit(bars.IEX_SOURCE_ID).cast("short"))
    writers.append_intraday(batch, path, now())
    month = F.col("trade_month").cast("string").alias("trade_month")
    rows = t.spark.read.option("basePath", path).parquet(path)
    return _doubles(rows.select("listing_id", "source_id", "data_time", month, *bars.PRICE_COLUMNS))


@query("trade_date", """
SELECT l_shipdate AS today, strftime(CAST(l_shipdate AS DATE) - 1, '%Y%m%d') AS trade_date,
       CAST(CAST(l_shipdate AS DATE) - 1 AS DATE) AS log_date, count(*) AS n
FROM lineitem GROUP BY ALL""")
def _(t):
    today = F.col("today").cast("date")
    return (
        t("lineitem").groupBy(F.col("l_shipdate").cast("timestamp").alias("today")).agg(F.count("*").alias("n"))
        .select("today", fields.trade_date(today, 1).alias("trade_date"), fields.log_date(today).alias("log_date"), "n")
    )


# -- listings ----------------------------------------------------------------------

@query("scan_listings", "SELECT * FROM fx_listing ORDER BY listing_id")
def _(t):
    return readers.scan_listings(t("fx_listing"))


@query("by_listing_id", "SELECT listing_id, symbol FROM fx_listing ORDER BY listing_id")
def _(t):
    return readers.scan_listings(t("fx_listing")).select("listing_id", "symbol")


@query("ingest_symbols", """
SELECT TIMESTAMP '2024-03-01 00:00:00' AS update_time, is_enabled, symbol, name, iex_id, type, region, currency, exchange FROM fx_listing_fresh""")
def _(t):
    """Snapshots as JSON: half of the symbols one a line, half as arrays of a type."""
    rows = t("fx_listing_fresh").withColumnsRenamed({"is_enabled": "isEnabled", "iex_id": "iexId"})
    symbol = F.struct(*rows.columns)
    lone = rows.where("symbol LIKE '%2'").select(F.to_json(symbol).alias("value"))
    many = rows.where("symbol NOT LIKE '%2'").groupBy("type", "exchange").agg(F.to_json(F.collect_list(symbol)).alias("value"))
    return listings.ingest_symbols(lone.unionByName(many.select("value")), now())


@query("active_listings", "SELECT * FROM fx_listing WHERE is_active AND is_enabled ORDER BY listing_id")
def _(t):
    return listings.active_listings(t("fx_listing"))


@query("russell_listings", "SELECT * FROM fx_listing WHERE is_russell3000 AND is_enabled ORDER BY listing_id")
def _(t):
    return listings.russell_listings(t("fx_listing"))


CHANGED = f"""
SELECT o.listing_id, o.update_time, o.iex_id, o.is_active, o.is_sp500, o.is_russell3000,
       {', '.join(f'o.{c} AS old_{c}, n.{c} AS new_{c}' for c in SEVEN)}
FROM fx_listing o JOIN fx_listing_fresh n ON o.iex_id = n.iex_id WHERE {DIFFERS}"""


@query("changed_listings", CHANGED)
def _(t):
    changes = listings.changed_listings(t("fx_listing"), t("fx_listing_fresh"))
    pairs = [F.col(f"{side}.{c}").alias(f"{name}_{c}") for c in SEVEN
             for side, name in (("original", "old"), ("updated", "new"))]
    return changes.select("original.listing_id", "original.update_time", "original.iex_id", "updated.is_active",
                          "updated.is_sp500", "updated.is_russell3000", *pairs)


MEMBER = "upper(l.symbol) IN (SELECT upper(trim(symbol)) FROM {})"


@query("flag_active", f"""
SELECT l.* REPLACE ({MEMBER.format('fx_members')} AS is_active) FROM fx_listing l""")
def _(t):
    return listings.flag_active(t("fx_listing"), t("fx_members"))


@query("flag_index", f"""
SELECT l.* REPLACE ({MEMBER.format('fx_members')} AS is_sp500, {MEMBER.format('fx_members_large')} AS is_russell3000)
FROM fx_listing l""")
def _(t):
    return listings.flag_index(t("fx_listing"), t("fx_members"), t("fx_members_large"))


@query("index_sizes", """
SELECT a.n AS n_small, b.n AS n_large, b.n >= a.n AS is_ordered
FROM (SELECT count(*) AS n FROM fx_members) a, (SELECT count(*) AS n FROM fx_members_large) b""")
def _(t):
    return listings.index_sizes(t("fx_members"), t("fx_members_large"))


@query("changed_active", f"""
SELECT l.listing_id, l.symbol, l.is_active AS old_active, NOT l.is_active AS new_active
FROM fx_listing l WHERE l.is_active <> ({MEMBER.format('fx_members')})""")
def _(t):
    stored = t("fx_listing")
    changes = listings.changed_active(stored, listings.flag_active(stored, t("fx_members")))
    return changes.select("original.listing_id", "original.symbol", F.col("original.is_active").alias("old_active"),
                          F.col("updated.is_active").alias("new_active"))


@query("changed_index", f"""
SELECT * FROM (
  SELECT l.listing_id, l.is_sp500 AS old_small, {MEMBER.format('fx_members')} AS new_small,
         l.is_russell3000 AS old_large, {MEMBER.format('fx_members_large')} AS new_large
  FROM fx_listing l)
WHERE old_small <> new_small OR old_large <> new_large""")
def _(t):
    stored = t("fx_listing")
    changes = listings.changed_index(
        stored, listings.flag_index(stored, t("fx_members"), t("fx_members_large")))
    return changes.select(
        "original.listing_id", F.col("original.is_sp500").alias("old_small"),
        F.col("updated.is_sp500").alias("new_small"), F.col("original.is_russell3000").alias("old_large"),
        F.col("updated.is_russell3000").alias("new_large"))


NEW = """
SELECT n.is_enabled, n.type IN ('et', 'cs') AS is_active, n.symbol, n.name, n.iex_id, n.type, n.region, n.currency, n.exchange
FROM fx_listing_fresh n
WHERE n.is_enabled AND NOT EXISTS (SELECT 1 FROM fx_listing o WHERE o.iex_id = n.iex_id)"""


@query("new_listings", NEW)
def _(t):
    return listings.new_listings(t("fx_listing"), t("fx_listing_fresh"))


@query("insert_new_listings", f"""
SELECT CAST((SELECT max(listing_id) FROM fx_listing) + row_number() OVER (ORDER BY iex_id) AS INTEGER) AS listing_id,
       TIMESTAMP '2024-03-01 00:00:00' AS update_time, x.*, false AS is_sp500, false AS is_russell3000
FROM ({NEW}) x""")
def _(t):
    path = scratch_path(t.spark, "listings")
    new = listings.new_listings(t("fx_listing"), t("fx_listing_fresh"))
    writers.insert_new_listings(new, path, now(), writers.max_id(t("fx_listing"), "listing_id"))
    return t.spark.read.parquet(path)


@query("audit_listings", f"""
SELECT CAST(row_number() OVER (ORDER BY o.listing_id) AS INTEGER) AS audit_id, o.*
FROM fx_listing o JOIN fx_listing_fresh n ON o.iex_id = n.iex_id WHERE {DIFFERS}""")
def _(t):
    path = scratch_path(t.spark, "audit")
    writers.audit_listings(listings.changed_listings(t("fx_listing"), t("fx_listing_fresh")), path)
    return t.spark.read.parquet(path)


@query("update_listings", f"""
SELECT o.listing_id,
       CASE WHEN {DIFFERS} THEN TIMESTAMP '2024-03-01 00:00:00' ELSE o.update_time END AS update_time,
       coalesce(n.is_enabled, o.is_enabled) AS is_enabled, o.is_active, coalesce(n.symbol, o.symbol) AS symbol,
       coalesce(n.name, o.name) AS name, o.iex_id, coalesce(n.type, o.type) AS type,
       coalesce(n.region, o.region) AS region, coalesce(n.currency, o.currency) AS currency,
       coalesce(n.exchange, o.exchange) AS exchange, o.is_sp500, o.is_russell3000
FROM fx_listing o LEFT JOIN fx_listing_fresh n ON o.iex_id = n.iex_id""".replace(
    f"WHEN {DIFFERS}", f"WHEN n.iex_id IS NOT NULL AND ({DIFFERS})"))
def _(t):
    path = scratch_path(t.spark, "snapshot")
    changes = listings.changed_listings(t("fx_listing"), t("fx_listing_fresh"))
    writers.write_snapshot(listings.update_listings(t("fx_listing"), changes.select("updated.*"), now()), path)
    return t.spark.read.parquet(path)


@query("last_wins", f"""
SELECT exchange, type, listing_id, symbol FROM (
  SELECT *, row_number() OVER (PARTITION BY exchange ORDER BY listing_id DESC) AS rn FROM fx_listing) WHERE rn = 1""")
def _(t):
    return listings.last_wins(t("fx_listing"), "exchange", "listing_id").select("exchange", "type", "listing_id", "symbol")


@query("insert_or_update_plan", f"""
WITH ch AS ({CHANGED}), act AS (SELECT * FROM fx_listing l WHERE l.is_active <> ({MEMBER.format('fx_members')}))
SELECT 'audit' AS action, iex_id, old_symbol AS symbol, is_active FROM ch
UNION ALL SELECT 'update', iex_id, new_symbol, is_active FROM ch
UNION ALL SELECT 'insert', iex_id, symbol, is_active FROM ({NEW})
UNION ALL SELECT 'audit active', iex_id, symbol, is_active FROM act
UNION ALL SELECT 'update active', iex_id, symbol, NOT is_active FROM act""")
def _(t):
    return listings.update_plan(t("fx_listing"), t("fx_listing_fresh"), t("fx_members"))


@query("symbol_key", """
SELECT upper(trim(symbol)) AS symbol_key, count(*) AS n FROM fx_members GROUP BY 1""")
def _(t):
    return t("fx_members").groupBy(fields.symbol_key(F.col("symbol")).alias("symbol_key")).agg(F.count("*").alias("n"))


# -- landed files ---------------------------------------------------------------------

@query("read_membership", "SELECT symbol FROM fx_members")
def _(t):
    path = scratch_path(t.spark, "members")
    t("fx_members").select(F.lit("x").alias("Rank"), F.col("symbol").alias("Symbol"), F.lit(1).alias("Weight")).write.option(
        "header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return readers.read_membership(t.spark, path)
