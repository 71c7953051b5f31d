"""Derived input views over the given tables, as SQL both engines run.

Every view is a function of key columns only: no clock, no random numbers, and
every view keeps all rows of its table.  Planted cases (unseen links, orphans,
vanished symbols) are values, never row filters.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]

VIEWS: dict[str, str] = {}

VIEWS["fx_article"] = """
SELECT doc_id + 1000 AS article_id,
       TIMESTAMP '2024-02-01 00:00:00' + doc_id * INTERVAL '1' MINUTE AS data_entry_time,
       'RSS Feed' AS source,
       concat('www.', source, '.com') AS host,
       concat('http://', source, '.com/', CAST(doc_id AS STRING)) AS link,
       CASE WHEN doc_id % 3 = 0 THEN NULL
            ELSE TIMESTAMP '2024-01-01 00:00:00' + (doc_id * 41 % 4000) * INTERVAL '10' MINUTE END AS source_published_time,
       CASE WHEN doc_id % 5 = 0 THEN NULL
            ELSE TIMESTAMP '2024-01-01 00:00:00' + (doc_id * 37 % 400) * INTERVAL '100' MINUTE END AS published_time,
       concat('src title ', CAST(doc_id AS STRING)) AS source_title,
       concat('title ', CAST(doc_id AS STRING)) AS title,
       CASE WHEN doc_id % 4 = 0 THEN NULL
            ELSE concat('https://www.', source, '.com/a/', CAST(doc_id AS STRING)) END AS canonical_link,
       CASE WHEN doc_id % 25 = 0 THEN NULL ELSE text END AS body,
       '[]' AS authors
FROM documents
"""

VIEWS["fx_feed"] = """
SELECT doc_id AS item_no,
       concat('src title ', CAST(doc_id AS STRING)) AS title,
       CASE WHEN doc_id % 50 = 0 THEN 'x'
            WHEN doc_id % 3 = 2 THEN concat('http://', source, '.com/new/', CAST(doc_id AS STRING))
            ELSE concat('http://', source, '.com/', CAST(doc_id AS STRING)) END AS link,
       concat(source, '.com') AS host,
       TIMESTAMP '2024-01-01 00:00:00' + (doc_id * 41 % 4000) * INTERVAL '10' MINUTE AS published
FROM documents
"""

VIEWS["fx_raw"] = """
SELECT doc_id AS item_no,
       CASE WHEN doc_id % 50 = 0 THEN 'x'
            WHEN doc_id % 3 = 2 THEN concat('http://', source, '.com/new/', CAST(doc_id AS STRING))
            ELSE concat('http://', source, '.com/', CAST(doc_id AS STRING)) END AS link,
       CASE WHEN doc_id % 11 = 0 THEN '  ab ' WHEN doc_id % 13 = 0 THEN '' ELSE concat(' title ', CAST(doc_id AS STRING), ' ') END AS title,
       CASE WHEN doc_id % 17 = 0 THEN ' a ' ELSE text END AS text,
       CASE WHEN doc_id % 4 = 0 THEN ''
            WHEN doc_id % 10 = 1 THEN concat('https://www.shared.com/a/', CAST(doc_id - doc_id % 40 AS STRING))
            WHEN doc_id % 3 = 2 THEN concat('https://www.', source, '.com/b/', CAST(doc_id AS STRING))
            ELSE concat('https://www.', source, '.com/a/', CAST(doc_id AS STRING)) END AS canonical,
       CASE WHEN doc_id % 3 = 0 THEN '' WHEN doc_id % 3 = 1 THEN '2024-01-05T12:00:00-07:00' ELSE '2024-01-05T12:00:00' END AS pubdate
FROM documents
"""

VIEWS["fx_blocklist"] = """
SELECT DISTINCT CASE WHEN source IN ('src1', 'src5') THEN concat(source, '.com')
                     WHEN source = 'src7' THEN concat('www.', source, '.com')
                     ELSE concat('blocked.', source, '.com') END AS host
FROM documents
"""

VIEWS["fx_listing"] = """
SELECT CAST(1000 + c_custkey AS INT) AS listing_id,
       TIMESTAMP '2023-01-01 00:00:00' AS update_time,
       c_custkey % 10 <> 0 AS is_enabled,
       c_custkey % 4 <> 0 AS is_active,
       concat(CASE WHEN c_custkey % 2 = 0 THEN 'sym' ELSE 'SYM' END, CAST(c_custkey AS STRING)) AS symbol,
       c_name AS name,
       concat('IEX_', CAST(c_custkey AS STRING)) AS iex_id,
       CASE WHEN c_custkey % 3 = 0 THEN 'et' WHEN c_custkey % 3 = 1 THEN 'cs' ELSE 'ad' END AS type,
       'US' AS region, 'USD' AS currency, c_mktsegment AS exchange,
       c_custkey % 5 = 0 AS is_sp500,
       c_custkey % 2 = 0 AS is_russell3000
FROM customer
"""

VIEWS["fx_listing_fresh"] = """
SELECT c_custkey % 10 <> 0 AND c_custkey % 23 <> 0 AS is_enabled,
       concat(CASE WHEN c_custkey % 2 = 0 THEN 'sym' ELSE 'SYM' END, CAST(c_custkey AS STRING), CASE WHEN c_custkey % 19 = 0 THEN 'B' ELSE '' END) AS symbol,
       CASE WHEN c_custkey % 17 = 0 THEN concat(c_name, ' Inc') ELSE c_name END AS name,
       concat(CASE WHEN c_custkey % 13 = 0 THEN 'RENAMED_' ELSE 'IEX_' END, CAST(c_custkey AS STRING)) AS iex_id,
       CASE WHEN c_custkey % 29 = 0 THEN 'wt' WHEN c_custkey % 3 = 0 THEN 'et' WHEN c_custkey % 3 = 1 THEN 'cs' ELSE 'ad' END AS type,
       'US' AS region, 'USD' AS currency, c_mktsegment AS exchange
FROM customer
UNION ALL
SELECT s_suppkey % 5 <> 0, concat('NEW', CAST(s_suppkey AS STRING)), s_name, concat('NEW_', CAST(s_suppkey AS STRING)),
       CASE WHEN s_suppkey % 3 = 0 THEN 'et' WHEN s_suppkey % 3 = 1 THEN 'cs' ELSE 'ad' END, 'US', 'USD', 'NYS'
FROM supplier
"""

VIEWS["fx_members"] = """
SELECT CASE WHEN c_custkey % 3 = 0 THEN concat(' Sym', CAST(c_custkey AS STRING), ' ')
            ELSE concat('other', CAST(c_custkey AS STRING)) END AS symbol
FROM customer
"""

VIEWS["fx_members_large"] = """
SELECT CASE WHEN c_custkey % 7 <> 0 THEN concat('sym', CAST(c_custkey AS STRING))
            ELSE concat('other', CAST(c_custkey AS STRING)) END AS symbol
FROM customer
"""

VIEWS["fx_bars_raw"] = """
SELECT CAST(1000 + l_suppkey AS INT) AS listing_id,
       CAST(l_shipdate AS DATE) AS trade_date,
       CAST((l_orderkey * 7 + l_linenumber) % 390 + 570 AS INT) AS minute_of_day,
       l_orderkey % 3 = 0 AS is_new,
       l_partkey % 2 = 1 AS is_late_date,
       CASE WHEN l_orderkey % 11 = 0 THEN 0.0 ELSE l_extendedprice / 100 END AS open,
       l_extendedprice / 100 + 1 AS close, l_extendedprice / 100 + 2 AS high, l_extendedprice / 100 - 1 AS low,
       CASE WHEN l_orderkey % 7 = 0 THEN 0 ELSE CAST(l_quantity AS INT) END AS volume,
       l_extendedprice AS notional, l_linenumber AS num_trades
FROM lineitem
"""

# Bars with their time; incoming bars with a late date come ten years later.
VIEWS["fx_bars"] = """
SELECT listing_id, is_new,
       CAST(trade_date AS TIMESTAMP) + minute_of_day * INTERVAL '1' MINUTE
         + CASE WHEN is_new AND is_late_date THEN 3650 ELSE 0 END * INTERVAL '1' DAY AS data_time,
       CAST(open AS DECIMAL(20,6)) AS open, CAST(close AS DECIMAL(20,6)) AS close,
       CAST(high AS DECIMAL(20,6)) AS high, CAST(low AS DECIMAL(20,6)) AS low,
       CAST(volume AS DECIMAL(20,6)) AS volume, CAST(notional AS DECIMAL(20,6)) AS notional,
       CAST(num_trades AS DECIMAL(20,6)) AS num_trades
FROM fx_bars_raw
"""

VIEWS["fx_submission"] = """
SELECT 1000 + o_orderkey AS submission_id,
       concat('t3_', CAST(o_orderkey AS STRING)) AS reddit_id,
       concat('post ', CAST(o_orderkey AS STRING)) AS title,
       CASE WHEN o_orderkey % 7 = 0 THEN '' WHEN o_orderkey % 8 = 1 THEN ' not a url '
            ELSE concat(' http://src', CAST(o_orderkey % 20 AS STRING), CASE WHEN o_orderkey % 3 = 2 THEN '.com/new/' ELSE '.com/' END,
                        CAST(o_orderkey % 1000 AS STRING)) END AS url,
       concat('/r/x/', CAST(o_orderkey AS STRING)) AS permalink,
       1704067200 + o_orderkey * 60 AS created_utc,
       CAST(o_orderkey % 60 AS INT) AS num_comments,
       CAST(o_orderkey % 100 - 20 AS INT) AS score,
       CAST(o_orderkey % 25 AS INT) AS more_children,
       CAST(o_orderkey % 45 AS INT) AS comments_got,
       o_orderkey % 31 = 0 AS is_deleted, o_orderkey % 7 = 0 AS is_self, o_orderkey % 9 = 0 AS is_media
FROM orders
"""

VIEWS["fx_comment"] = """
SELECT conv_id * 100 + turn AS comment_id,
       conv_id AS submission_id,
       CASE WHEN turn = 0 THEN NULL ELSE conv_id * 100 + CAST(floor((turn - 1) / 2.0) AS BIGINT) END AS parent_id,
       role AS user_name, text AS body,
       conv_id % 10 = 0 AND turn = 1 AS is_deleted
FROM conversations
"""

# Threads of 200 comments: a chain with a leaf beside every fifth; in every second thread a missing parent and a circle of two.
VIEWS["fx_deep_comment"] = """
SELECT doc_id AS comment_id, doc_id - doc_id % 200 AS submission_id,
       CASE WHEN doc_id % 200 = 0 THEN NULL WHEN doc_id % 400 = 333 THEN -1 - doc_id
            WHEN doc_id % 400 = 14 THEN doc_id + 5 WHEN doc_id % 400 = 19 THEN doc_id - 5
            WHEN doc_id % 5 = 0 THEN doc_id - 2 ELSE doc_id - 1 END AS parent_id
FROM documents
"""

# Parent table of the key check: every seventh conversation is missing from it.
VIEWS["fx_thread"] = """
SELECT DISTINCT CASE WHEN conv_id % 7 = 0 THEN -1 - conv_id ELSE conv_id END AS submission_id FROM conversations
"""

VIEWS["fx_more"] = """
SELECT l_suppkey % 10 AS thread_id,
       l_suppkey * 10 + l_partkey % 5 AS more_id,
       CAST(l_partkey % 5 + 3 AS INT) AS depth,
       concat('c', CAST(l_orderkey AS STRING), '_', CAST(l_linenumber AS STRING)) AS child_id
FROM lineitem
"""

VIEWS["fx_log_lines"] = """
SELECT event_id AS line_no,
       concat('time="2024-01-01T00:00:00Z" level=',
              CASE WHEN event_id % 499 = 0 THEN 'panic' WHEN event_id % 97 = 0 THEN 'fatal' WHEN event_type = 'click' THEN 'info'
                   WHEN event_type = 'view' THEN 'debug' WHEN event_type = 'signup' THEN 'warning' WHEN event_type = 'error' THEN 'error' ELSE 'trace' END,
              ' msg=RunSummary ',
              CASE WHEN event_id % 5 = 0 THEN concat('RunTime=', CAST(event_id % 90 AS STRING), 'm', CAST(event_id % 60 AS STRING), '.6s ') ELSE '' END,
              CASE WHEN event_id % 101 = 0 THEN '' ELSE concat('application=App', CAST(user_id % 7 AS STRING)) END) AS line
FROM events
"""

VIEWS["fx_log_history"] = """
SELECT concat('App', CAST(user_id % 7 AS STRING)) AS app,
       CAST(ts AS DATE) AS log_date,
       CAST(max(event_id % 3600) AS DOUBLE) AS run_time_s,
       CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS trace_count,
       CAST(sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS BIGINT) AS debug_count,
       count(*) AS info_count,
       CAST(sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) AS BIGINT) AS warn_count,
       CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS error_count,
       CAST(sum(CASE WHEN event_id % 97 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fatal_count,
       CAST(sum(CASE WHEN event_id % 499 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS panic_count
FROM events
GROUP BY 1, 2
"""

# Queue of aged posts; a few entries behind the head are far younger.
VIEWS["fx_queue"] = """
SELECT event_id AS pos,
       CAST(ts AS TIMESTAMP) + CASE WHEN event_id % 997 = 996 THEN 40 ELSE 0 END * INTERVAL '1' DAY AS created_time,
       concat('/r/', event_type, '/', CAST(event_id AS STRING)) AS permalink
FROM events
"""

_NAME = re.compile(r"\b(FROM|JOIN)\s+([a-z_0-9]+)")


def _needs(sql: str) -> list[str]:
    return [m[1] for m in _NAME.findall(sql)]


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table or derived view as a DataFrame."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    def source(match: re.Match) -> str:
        word, target = match.groups()
        if target in VIEWS:
            return f"{word} ({_NAME.sub(source, VIEWS[target])})"
        return f"{word} parquet.`{sf_dir}/{target}.parquet`"

    return spark.sql(_NAME.sub(source, VIEWS[name]))


def with_views(sql: str) -> str:
    """Oracle SQL with the derived views it reads put in front as CTEs."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in _needs(text):
            if name in VIEWS:
                visit(VIEWS[name])
                if name not in order:
                    order.append(name)

    visit(sql)
    ctes = ",\n".join(f"{name} AS ({VIEWS[name]})" for name in order)
    body = sql.strip()
    if not ctes:
        return body
    if body.upper().startswith("WITH RECURSIVE"):
        return f"WITH RECURSIVE {ctes},\n{body[len('WITH RECURSIVE'):]}"
    if body.upper().startswith("WITH"):
        return f"WITH {ctes},\n{body[len('WITH'):]}"
    return f"WITH {ctes}\n{body}"
