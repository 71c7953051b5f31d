"""Market listings: reconciliation with provider snapshots and membership files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner import schemas
from gleaner.functions import fields

SNAPSHOT_COLUMNS = ["is_enabled", "symbol", "name", "type", "region", "currency", "exchange"]
ACTIVE_TYPES = ["et", "cs"]


def ingest_symbols(lines: DataFrame, now: Column, column: str = "value") -> DataFrame:
    """Snapshot JSON, one array or one symbol a line -> listing rows as of ``now``; broken lines give none.

    A symbol without a flag is not enabled.
    """
    text = F.when(F.col(column).rlike(r"^\s*\["), F.col(column)).otherwise(F.concat(F.lit("["), F.col(column), F.lit("]")))
    symbols = lines.select(F.inline(F.from_json(text, schemas.SYMBOLS_JSON)))
    return symbols.where("iexId IS NOT NULL OR symbol IS NOT NULL").select(
        now.alias("update_time"), F.coalesce("isEnabled", F.lit(False)).alias("is_enabled"), "symbol", "name",
        F.col("iexId").alias("iex_id"), "type", "region", "currency", "exchange")


def active_listings(listings: DataFrame) -> DataFrame:
    """Active and enabled listings by id."""
    return listings.where(F.col("is_active") & F.col("is_enabled")).orderBy("listing_id")


def russell_listings(listings: DataFrame) -> DataFrame:
    """Enabled listings of the large index by id."""
    return listings.where(F.col("is_russell3000") & F.col("is_enabled")).orderBy("listing_id")


def last_wins(rows: DataFrame, key: str, order: str) -> DataFrame:
    """One row per key: the last by ``order``; a partial aggregate, so a hot key costs nothing.

    A null order comes before any value; of equal orders the choice does not depend on the layout.
    """
    rank = F.struct(F.col(order).isNotNull(), F.col(order), F.xxhash64(*rows.columns))
    last = F.max_by(F.struct(*rows.columns), rank).alias("__last")
    return rows.groupBy(key).agg(last).select("__last.*")


def _any_differs(old: str, new: str, columns: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [~F.col(f"{old}.{c}").eqNullSafe(F.col(f"{new}.{c}")) for c in columns])


def _changes(stored: DataFrame, fresh: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(original, updated) structs of the rows where any of ``columns`` differs."""
    joined = stored.alias("o").join(fresh.alias("n"), F.col(f"o.{key}") == F.col(f"n.{key}"))
    original = F.struct(*[F.col(f"o.{c}") for c in stored.columns])
    updated = F.struct(*[F.col(f"n.{c}" if c in columns else f"o.{c}").alias(c) for c in stored.columns])
    return joined.where(_any_differs("o", "n", columns)).select(original.alias("original"), updated.alias("updated"))


def changed_listings(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """Listings whose snapshot differs in any of seven columns, as (original, updated).

    Of stored rows with one provider id the last by listing id counts; every
    fresh duplicate is compared.
    """
    return _changes(last_wins(stored, "iex_id", "listing_id"), fresh, "iex_id", SNAPSHOT_COLUMNS)


def changed_active(stored: DataFrame, flagged: DataFrame) -> DataFrame:
    """Listings whose active flag differs."""
    return _changes(stored, flagged, "listing_id", ["is_active"])


def changed_index(stored: DataFrame, flagged: DataFrame) -> DataFrame:
    """Listings whose index flags differ."""
    return _changes(stored, flagged, "listing_id", ["is_sp500", "is_russell3000"])


def new_listings(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """Enabled snapshot rows with an unknown provider id, one per id; active by type."""
    return (
        fresh.where("is_enabled").join(stored.select("iex_id"), "iex_id", "left_anti")
        .transform(lambda rows: last_wins(rows, "iex_id", "symbol"))
        .select("is_enabled", F.coalesce(F.col("type").isin(ACTIVE_TYPES), F.lit(False)).alias("is_active"),
                "symbol", "name", "iex_id", "type", "region", "currency", "exchange")
    )


def _is_member(listings: DataFrame, members: DataFrame, flag: str) -> DataFrame:
    """Replace ``flag`` by whether the upper-case stored symbol is in the trimmed, upper-case members."""
    keys = members.select(fields.symbol_key(F.col("symbol")).alias("__key")).distinct().withColumn("__hit", F.lit(True))
    return (
        listings.withColumn("__key", F.upper("symbol")).join(keys, "__key", "left")
        .withColumn(flag, F.col("__hit").isNotNull()).select(*listings.columns)
    )


def flag_active(listings: DataFrame, members: DataFrame) -> DataFrame:
    """Listings with ``is_active`` set by membership."""
    return _is_member(listings, members, "is_active")


def flag_index(listings: DataFrame, small_index: DataFrame, large_index: DataFrame) -> DataFrame:
    """Listings with both index flags set by membership."""
    return _is_member(_is_member(listings, small_index, "is_sp500"), large_index, "is_russell3000")


def index_sizes(small_index: DataFrame, large_index: DataFrame) -> DataFrame:
    """One row: sizes of both files, and whether the large one is the larger."""
    sizes = small_index.select(F.lit(1).alias("a"), F.lit(0).alias("b")).unionByName(
        large_index.select(F.lit(0).alias("a"), F.lit(1).alias("b")))
    return sizes.agg(F.sum("a").alias("n_small"), F.sum("b").alias("n_large")).withColumn(
        "is_ordered", F.col("n_large") >= F.col("n_small"))


def audit_rows(changes: DataFrame) -> DataFrame:
    """The superseded versions with their old update time."""
    return changes.select("original.*")


def update_listings(stored: DataFrame, updated: DataFrame, now: Column) -> DataFrame:
    """Stored listings with changed ones replaced by id and stamped; the provider id never changes.

    Returns a new snapshot; write it to a new path, never over the one being read.
    """
    fresh = last_wins(updated, "listing_id", "symbol").withColumn("update_time", now)
    joined = stored.alias("o").join(fresh.alias("n"), F.col("o.listing_id") == F.col("n.listing_id"), "left")
    hit = F.col("n.listing_id").isNotNull()
    keep = {"listing_id", "iex_id"}
    return joined.select(*[
        F.col(f"o.{c}") if c in keep else F.when(hit, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c)
        for c in stored.columns
    ])


def insertable(new: DataFrame, now: Column) -> DataFrame:
    """New listings with the defaults of the listing table."""
    return new.select(
        now.alias("update_time"), "is_enabled", "is_active", "symbol", "name", "iex_id", "type", "region",
        "currency", "exchange", F.lit(False).alias("is_sp500"), F.lit(False).alias("is_russell3000"),
    )


def update_plan(stored: DataFrame, fresh: DataFrame, members: DataFrame) -> DataFrame:
    """What both update jobs would do, as (action, iex_id, symbol, is_active)."""
    def rows(df: DataFrame, action: str) -> DataFrame:
        return df.select(F.lit(action).alias("action"), "iex_id", "symbol", "is_active")

    changed = changed_listings(stored, fresh)
    active = changed_active(stored, flag_active(stored, members))
    return (
        rows(audit_rows(changed), "audit")
        .unionByName(rows(changed.select("updated.*"), "update"))
        .unionByName(rows(new_listings(stored, fresh), "insert"))
        .unionByName(rows(audit_rows(active), "audit active"))
        .unionByName(rows(active.select("updated.*"), "update active"))
    )
