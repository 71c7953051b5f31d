"""Explicit schemas of the stored tables and landed records, as DDL text."""

from __future__ import annotations

ARTICLE = (
    "article_id BIGINT, data_entry_time TIMESTAMP, source STRING, host STRING, link STRING, "
    "source_published_time TIMESTAMP, published_time TIMESTAMP, source_title STRING, title STRING, "
    "canonical_link STRING, body STRING, authors STRING"
)

SUBMISSION = (
    "submission_id BIGINT, reddit_id STRING, title STRING, url STRING, permalink STRING, "
    "data_entry_time TIMESTAMP, created_time TIMESTAMP, user_name STRING, subreddit_name STRING, "
    "subreddit_id STRING, selftext STRING, selftext_html STRING, num_comments INT, score INT, "
    "up_votes INT, down_votes INT, is_nsfw BOOLEAN, is_self BOOLEAN"
)

COMMENT = (
    "comment_id BIGINT, submission_id BIGINT, reddit_id STRING, parent_id STRING, "
    "data_entry_time TIMESTAMP, created_time TIMESTAMP, user_name STRING, body STRING, "
    "body_html STRING, up_votes INT, down_votes INT, is_deleted BOOLEAN"
)

ARTICLE_POST = "article_id BIGINT, submission_id BIGINT, data_entry_time TIMESTAMP"

FETCH = "permalink STRING, more_id STRING, batch_no BIGINT, n_ids INT, batch STRING"

REJECTED_THREAD = "permalink STRING, fault STRING"

LISTING = (
    "listing_id INT, update_time TIMESTAMP, is_enabled BOOLEAN, is_active BOOLEAN, symbol STRING, "
    "name STRING, iex_id STRING, type STRING, region STRING, currency STRING, exchange STRING, "
    "is_sp500 BOOLEAN, is_russell3000 BOOLEAN"
)

AUDIT_LISTING = "audit_id INT, " + LISTING

DATA_SOURCE = "source_id SMALLINT, source_name STRING"

# Fixed values of the data source table.
DATA_SOURCES = [(1, "IEX"), (2, "Alpha Vantage")]

INTRADAY = (
    "intraday_id BIGINT, listing_id INT, source_id SMALLINT, data_time TIMESTAMP, "
    "update_time TIMESTAMP, open DECIMAL(20,6), close DECIMAL(20,6), high DECIMAL(20,6), "
    "low DECIMAL(20,6), volume DECIMAL(20,6), notional DECIMAL(20,6), num_trades DECIMAL(20,6)"
)

PROCESSED_TEXT = (
    "text_id BIGINT, data_entry_time TIMESTAMP, title STRING, body STRING"
)

# Landed records.
FEED_LIST = "Name STRING, Link STRING, RSS STRING, Category STRING"

FEED_CHANNEL = (
    "title STRING, item ARRAY<STRUCT<title: STRING, link: STRING, pubDate: STRING>>"
)

POST_JSON = (
    "name STRING, title STRING, url STRING, permalink STRING, created_utc DOUBLE, author STRING, "
    "subreddit STRING, subreddit_id STRING, selftext STRING, selftext_html STRING, "
    "num_comments INT, score INT, ups INT, downs INT, over_18 BOOLEAN, is_self BOOLEAN, "
    "is_reddit_media_domain BOOLEAN, deleted BOOLEAN"
)

# Symbols of the listing snapshot, in the provider's names.
SYMBOLS_JSON = (
    "ARRAY<STRUCT<symbol: STRING, name: STRING, iexId: STRING, type: STRING, region: STRING, currency: STRING, exchange: STRING, "
    "isEnabled: BOOLEAN>>"
)

QUEUE_ENTRY = "CreatedTime TIMESTAMP, Permalink STRING"

LOG_COUNTERS = [
    "trace_count", "debug_count", "info_count", "warn_count", "error_count", "fatal_count", "panic_count",
]

LOG_HISTORY = (
    "AppLogs ARRAY<STRUCT<AppName: STRING, InnerAppLogs: ARRAY<STRUCT<log_date: DATE, run_time_s: DOUBLE, "
    "trace_count: BIGINT, debug_count: BIGINT, info_count: BIGINT, warn_count: BIGINT, "
    "error_count: BIGINT, fatal_count: BIGINT, panic_count: BIGINT>>>>"
)
