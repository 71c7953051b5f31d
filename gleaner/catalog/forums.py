"""Posts, comment trees, "load more" batches, queues and key checks."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gleaner.catalog.registry import now, query
from gleaner.functions import fields
from gleaner.operators import forum, queues, threads
from gleaner.plans import jobs
from gleaner.session import scratch_path, written
from gleaner.sources import writers

NOW = "TIMESTAMP '2024-03-01 00:00:00'"

POSTS = """
SELECT submission_id, num_comments, score, is_deleted, is_self, is_media FROM fx_submission"""


def _post_json(t):
    """Posts as the JSON lines a harvester lands."""
    post = F.struct(
        F.col("reddit_id").alias("name"), "title", "url", "permalink",
        (F.col("created_utc") + 0.5).alias("created_utc"), F.lit("someone").alias("author"),
        F.lit("x").alias("subreddit"), F.lit("t5_x").alias("subreddit_id"), F.lit("").alias("selftext"),
        F.lit(None).cast("string").alias("selftext_html"), "num_comments", "score", F.col("score").alias("ups"),
        F.lit(0).alias("downs"), F.lit(False).alias("over_18"), "is_self",
        F.col("is_media").alias("is_reddit_media_domain"), F.col("is_deleted").alias("deleted"))
    return t("fx_submission").select(F.to_json(post).alias("value"))


INGESTED = """
SELECT reddit_id, title, url, permalink, make_timestamp(created_utc * 1000000) AS created_time, 'someone' AS user_name,
       'x' AS subreddit_name, 't5_x' AS subreddit_id, '' AS selftext, CAST(NULL AS VARCHAR) AS selftext_html,
       num_comments, score, score AS up_votes, CAST(0 AS INTEGER) AS down_votes, false AS is_nsfw, is_self, is_media, is_deleted
FROM fx_submission"""


@query("ingest_submissions", INGESTED)
def _(t):
    return forum.ingest_submissions(_post_json(t))


@query("append_submissions", f"""
SELECT x.*, 999 + row_number() OVER (ORDER BY created_time, permalink) AS submission_id, {NOW} AS data_entry_time
FROM ({INGESTED}) x""")
def _(t):
    path = scratch_path(t.spark, "submissions")
    writers.append_submissions(forum.ingest_submissions(_post_json(t)), path, now())
    return t.spark.read.parquet(path)


@query("submission_gate", POSTS + " WHERE NOT is_deleted AND num_comments + score >= 40")
def _(t):
    return forum.submission_gate(t("fx_submission"), 40).select(
        "submission_id", "num_comments", "score", "is_deleted", "is_self", "is_media")


@query("external_links", POSTS + " WHERE NOT (is_media OR is_self)")
def _(t):
    return forum.external_links(t("fx_submission")).select(
        "submission_id", "num_comments", "score", "is_deleted", "is_self", "is_media")


@query("needs_more_comments", """
SELECT submission_id, more_children >= 10 OR (num_comments > 20
       AND CAST(CAST(comments_got AS FLOAT) / CAST(num_comments AS FLOAT) AS FLOAT) < CAST(0.667 AS FLOAT)) AS needs_more
FROM fx_submission""")
def _(t):
    return forum.needs_more_comments(t("fx_submission")).select("submission_id", "needs_more")


@query("comments_found", """
SELECT p.submission_id, CAST(count(c.comment_id) AS INTEGER) AS comments_got
FROM fx_thread p LEFT JOIN fx_comment c ON c.submission_id = p.submission_id GROUP BY p.submission_id""")
def _(t):
    return forum.comments_found(t("fx_thread"), t("fx_comment")).select("submission_id", "comments_got")


@query("single_post_threads", """
SELECT conv_id AS thread_id, turn, text FROM conversations c
WHERE role = 'user' AND (SELECT count(*) FROM conversations p WHERE p.conv_id = c.conv_id AND p.role = 'user') = 1""")
def _(t):
    """Conversations as harvested threads whose user turns are the posts."""
    posts = t("conversations").where("role = 'user'").select(F.col("conv_id").alias("thread_id"), "turn", "text")
    return forum.single_post_threads(posts)


TREE = """
WITH RECURSIVE tree AS (
  SELECT comment_id, submission_id, 1 AS depth, [CAST(0 AS BIGINT), comment_id] AS path FROM fx_comment WHERE parent_id IS NULL
  UNION ALL
  SELECT c.comment_id, c.submission_id, p.depth + 1,
         list_concat(list_transform(p.path, lambda x, i: CASE WHEN i % 2 = 1 THEN 1 ELSE x END), [CAST(0 AS BIGINT), c.comment_id])
  FROM fx_comment c JOIN tree p ON c.parent_id = p.comment_id)
SELECT c.*, CAST(tree.depth AS INTEGER) AS depth, row_number() OVER (PARTITION BY tree.submission_id ORDER BY path) AS pos
FROM fx_comment c JOIN tree ON tree.comment_id = c.comment_id"""


@query("flatten_comments", TREE)
def _(t):
    return forum.flatten_comments(t("fx_comment"))


DEEP = """
WITH RECURSIVE tree AS (
  SELECT comment_id, submission_id, 1 AS depth, [CAST(0 AS BIGINT), comment_id] AS path FROM fx_deep_comment WHERE parent_id IS NULL
  UNION ALL
  SELECT c.comment_id, c.submission_id, p.depth + 1,
         list_concat(list_transform(p.path, lambda x, i: CASE WHEN i % 2 = 1 THEN 1 ELSE x END), [CAST(0 AS BIGINT), c.comment_id])
  FROM fx_deep_comment c JOIN tree p ON c.parent_id = p.comment_id)"""


@query("flatten_deep_comments", DEEP + """
SELECT comment_id, submission_id, CAST(depth AS INTEGER) AS depth, row_number() OVER (PARTITION BY submission_id ORDER BY path) AS pos
FROM tree""")
def _(t):
    """Documents as threads of 200 comments, about 160 deep."""
    return forum.flatten_comments(t("fx_deep_comment")).select("comment_id", "submission_id", "depth", "pos")


@query("rejected_comments", DEEP + """
SELECT comment_id, submission_id, CASE WHEN comment_id % 400 IN (14, 19) THEN 'cycle' ELSE 'orphan' END AS fault
FROM fx_deep_comment WHERE comment_id NOT IN (SELECT comment_id FROM tree)""")
def _(t):
    """Comments below a missing one, and two that are each other's parent."""
    return forum.rejected_comments(t("fx_deep_comment"))


# -- landed threads ---------------------------------------------------------------------

def _landed(t):
    """Documents as landed threads (permalink, value) of 50 comments: a chain, and beside every fourth of it a leaf after it.

    Every fourth thread is cut off, some hold two posts, every second has a "load more" node.
    """
    k = F.col("doc_id") % 50
    parent = F.when(k == 0, F.concat(F.lit("t3_"), F.floor(F.col("doc_id") / 50))).otherwise(
        F.concat(F.lit("t1_c"), F.when(k % 5 == 0, F.col("doc_id") - 2).otherwise(F.col("doc_id") - 1)))
    text = F.when(F.col("doc_id") % 9 == 0, F.lit("[deleted]")).otherwise(F.col("text"))
    data = F.to_json(F.struct(
        F.concat(F.lit("c"), "doc_id").alias("id"), parent.alias("parent_id"), (F.col("doc_id") * 60 + 1704067200.5).alias("created_utc"),
        F.col("source").alias("author"), text.alias("body"), (F.col("doc_id") % 7).alias("ups"),
        F.when(k % 2 == 0, F.col("doc_id") % 3).alias("downs")))
    rows = t("documents").select("doc_id", F.floor(F.col("doc_id") / 50).alias("thread"), (k % 5 == 4).alias("leaf"), data.alias("data"))
    order = Window.partitionBy("thread").orderBy("doc_id")
    leaf = F.concat(F.lit('{"kind":"t1","data":'), F.expr("left(data, length(data) - 1)"), F.lit(',"replies":""}}'))
    head = F.concat(F.lit('{"kind":"t1","data":'), F.expr("left(data, length(data) - 1)"),
                    F.lit(',"replies":{"kind":"Listing","data":{"children":['))
    rows = rows.withColumn("leaf_text", F.when(F.col("leaf"), leaf))
    tail = F.concat(F.lit("]}}}}"), F.coalesce(F.concat(F.lit(","), F.lag("leaf_text").over(order)), F.lit("")))
    rows = rows.select("thread", "doc_id", "leaf_text", F.when(~F.col("leaf"), head).alias("head"), F.when(~F.col("leaf"), tail).alias("tail"))
    all_ = F.array_sort(F.collect_list(F.struct("doc_id", "leaf_text", "head", "tail"))).alias("rows")
    heads, tails = (F.transform(F.col(f"rows.{n}"), lambda x: F.coalesce(x, F.lit(""))) for n in ("head", "tail"))
    last = F.coalesce(F.element_at("rows", -1)["leaf_text"], F.lit(""))
    comments = F.concat(F.array_join(heads, ""), last, F.array_join(F.reverse(tails), ""))
    ids = F.array_join(F.transform(F.sequence(F.lit(1), F.when(F.col("thread") % 3 == 0, 150).otherwise(F.col("thread") % 5 + 1)),
                                   lambda i: F.concat(F.lit('"x'), F.lpad(i.cast("string"), 3, "0"), F.lit('"'))), ",")
    more = F.when(F.col("thread") % 2 == 0, F.concat(
        F.lit(',{"kind":"more","data":{"id":"m'), "thread", F.lit('","children":['), ids, F.lit("]}}"))).otherwise("")
    post = F.concat(F.lit('{"kind":"t3","data":{"name":"t3_'), "thread", F.lit('","title":"post '), "thread",
                    F.lit('","created_utc":1704067200.7,"num_comments":60,"score":'), F.col("thread") * 13 % 50, F.lit("}}"))
    twice = F.when(F.col("thread") % 7 == 2, F.concat(F.lit(","), post)).otherwise("")
    listing = '{"kind":"Listing","data":{"children":['
    value = F.concat(F.lit("[" + listing), post, twice, F.lit("]}}," + listing), comments, more, F.lit("]}}]"))
    value = F.when(F.col("thread") % 4 == 3, F.substring(value, F.lit(1), (F.length(value) / 2).cast("int"))).otherwise(value)
    grouped = rows.groupBy("thread").agg(all_)
    return grouped.select(F.concat(F.lit("/r/x/"), "thread").alias("permalink"), value.alias("value"))


# Which threads are whole, and the comments in them with their places.
THREADS = """
d AS (SELECT doc_id, doc_id // 50 AS thread, doc_id % 50 AS k, source, text FROM documents),
ends AS (SELECT max(doc_id) AS last FROM documents),
c AS (
  SELECT concat('/r/x/', CAST(thread AS VARCHAR)) AS permalink, thread,
         CASE WHEN k % 5 = 4 AND k < 49 AND doc_id < last THEN k + 2 WHEN k % 5 = 0 AND k > 0 THEN k ELSE k + 1 END AS pos,
         CAST(CASE WHEN k % 5 = 4 THEN k - 1 - (k - 1) // 5 + 2 ELSE k - k // 5 + 1 END AS INTEGER) AS depth,
         concat('c', CAST(doc_id AS VARCHAR)) AS reddit_id,
         CASE WHEN k = 0 THEN concat('t3_', CAST(thread AS VARCHAR))
              ELSE concat('t1_c', CAST(CASE WHEN k % 5 = 0 THEN doc_id - 2 ELSE doc_id - 1 END AS VARCHAR)) END AS parent_id,
         make_timestamp((1704067200 + doc_id * 60) * 1000000) AS created_time, source AS user_name,
         CASE WHEN doc_id % 9 = 0 THEN '[deleted]' ELSE text END AS body, CAST(NULL AS VARCHAR) AS body_html,
         CAST(doc_id % 7 AS INTEGER) AS up_votes, CAST(CASE WHEN k % 2 = 0 THEN doc_id % 3 ELSE 0 END AS INTEGER) AS down_votes,
         doc_id % 9 = 0 AS is_deleted
  FROM d, ends WHERE thread % 4 <> 3 AND thread % 7 <> 2)"""

# Those of them that are due and pass the gate, with their ids.
READY = THREADS + """,
s AS (SELECT thread, 999 + row_number() OVER (ORDER BY concat('/r/x/', CAST(thread AS VARCHAR))) AS submission_id
      FROM (SELECT DISTINCT thread FROM c WHERE thread % 10 <> 9 AND thread * 13 % 50 >= 10)),
big AS (SELECT thread FROM s WHERE thread % 6 = 0)"""


def _parsed(t):
    return written(threads.parse_threads(_landed(t)), "threads")


@query("ingest_comments", f"WITH {THREADS} SELECT * EXCLUDE (thread) FROM c")
def _(t):
    """Comments of nested threads, about 40 levels deep, as a list with places."""
    whole = _parsed(t).where("n_posts = 1")
    comments = threads.thread_comments(threads.thread_nodes(whole))
    return comments.withColumn("created_time", F.date_trunc("second", "created_time"))


@query("rejected_threads", """
SELECT DISTINCT concat('/r/x/', CAST(doc_id // 50 AS VARCHAR)) AS permalink,
       CASE WHEN doc_id // 50 % 4 = 3 THEN 'broken' ELSE 'several posts' END AS fault
FROM documents WHERE doc_id // 50 % 4 = 3 OR doc_id // 50 % 7 = 2""")
def _(t):
    return threads.rejected_threads(_parsed(t))


def _harvest(t):
    """The whole forum job on landed threads into an empty store."""
    store = jobs.Store(t.spark, scratch_path(t.spark, "store"))
    landed = written(_landed(t), "landed")
    number = F.substring_index("permalink", "/", -1).cast("long")
    due = landed.where(number % 10 != 9).select("permalink")
    extra = t.spark.createDataFrame([], "permalink STRING, reddit_id STRING, parent_id STRING, created_time TIMESTAMP, user_name STRING, "
                                    "body STRING, body_html STRING, up_votes INT, down_votes INT, is_deleted BOOLEAN")
    jobs.harvest_threads(store, due, landed, extra, 70, now())
    return store


@query("harvest_threads", f"""
WITH {READY}
SELECT 999 + row_number() OVER (ORDER BY submission_id, pos) AS comment_id, submission_id, c.* EXCLUDE (permalink, thread, pos, depth),
       {NOW} AS data_entry_time
FROM c JOIN s USING (thread)""")
def _(t):
    """The comments that the forum job stores."""
    return t.spark.read.parquet(_harvest(t).path("comments"))


@query("fetch_plan", f"""
WITH {READY},
ids AS (SELECT thread, unnest(generate_series(1, 150)) AS i FROM big)
SELECT concat('/r/x/', CAST(thread AS VARCHAR)) AS permalink, concat('m', CAST(thread AS VARCHAR)) AS more_id,
       CAST((i - 1) // 100 AS BIGINT) AS batch_no, CAST(count(*) AS INTEGER) AS n_ids,
       string_agg(concat('x', lpad(CAST(i AS VARCHAR), 3, '0')), ',' ORDER BY i) AS batch
FROM ids GROUP BY ALL""")
def _(t):
    """The batches of ids that the forum job wants loaded next."""
    return t.spark.read.parquet(_harvest(t).path("fetches"))


@query("run_counts", f"""
WITH {READY}
SELECT (SELECT count(DISTINCT doc_id // 50) FROM documents
        WHERE doc_id // 50 % 10 <> 9 AND (doc_id // 50 % 4 = 3 OR doc_id // 50 % 7 = 2)) AS rejected_threads,
       (SELECT count(*) FROM s) AS submissions, (SELECT count(*) FROM c JOIN s USING (thread)) AS comments,
       (SELECT 2 * count(*) FROM big) AS fetches""")
def _(t):
    """What the forum job reports, counted by the writes themselves."""
    return _harvest(t).summary()


@query("all_comments", """
SELECT comment_id, submission_id, body FROM fx_comment UNION ALL
SELECT comment_id + 1000000, submission_id, body FROM fx_comment""")
def _(t):
    base = t("fx_comment").select("comment_id", "submission_id", "body")
    return forum.all_comments(base, base.withColumn("comment_id", F.col("comment_id") + 1000000))


@query("append_comments", f"""
SELECT 999 + row_number() OVER (ORDER BY submission_id, comment_id) AS comment_id, submission_id,
       CAST(comment_id AS VARCHAR) AS reddit_id, CAST(parent_id AS VARCHAR) AS parent_id, user_name, body, is_deleted,
       make_timestamp(1704067200000000 + comment_id * 1000000) AS created_time, {NOW} AS data_entry_time
FROM fx_comment""")
def _(t):
    path = scratch_path(t.spark, "comments")
    rows = t("fx_comment").select(
        "submission_id", F.col("comment_id").cast("string").alias("reddit_id"), F.col("parent_id").cast("string"),
        "user_name", "body", "is_deleted", fields.epoch_to_ts(F.col("comment_id") + 1704067200.7).alias("created_time"))
    writers.append_comments(rows, path, now())
    return t.spark.read.parquet(path)


@query("chunk_children", """
WITH r AS (SELECT thread_id, more_id, depth, child_id,
                  (row_number() OVER (PARTITION BY thread_id, more_id, depth ORDER BY child_id) - 1) // 100 AS batch_no FROM fx_more)
SELECT thread_id, more_id, depth, CAST(batch_no AS BIGINT) AS batch_no, CAST(count(*) AS INTEGER) AS n_ids,
       string_agg(child_id, ',' ORDER BY child_id) AS batch
FROM r GROUP BY ALL""")
def _(t):
    return forum.batch_ids(t("fx_more"), ["thread_id", "more_id", "depth"], "child_id")


@query("chunk_array", """
WITH w AS (SELECT doc_id, string_split(text, ' ') AS words FROM documents),
n AS (SELECT doc_id, words, unnest(generate_series(0, (len(words) - 1) // 100)) AS batch_no FROM w)
SELECT doc_id, CAST(batch_no AS BIGINT) AS batch_no,
       array_to_string(words[batch_no * 100 + 1 : batch_no * 100 + 100], ',') AS batch FROM n""")
def _(t):
    """The array form, on the words of each text as ids."""
    batches = forum.chunk_children(F.split("text", " "))
    return t("documents").select("doc_id", F.posexplode(batches).alias("batch_no", "batch")).withColumn(
        "batch_no", F.col("batch_no").cast("long"))


NODES = "SELECT thread_id, more_id, depth, CAST(count(*) AS INTEGER) AS n_children FROM fx_more GROUP BY ALL"


def _nodes(t):
    return t("fx_more").groupBy("thread_id", "more_id", "depth").agg(F.count("*").cast("int").alias("n_children"))


@query("collect_mores", """
SELECT conv_id AS thread_id, CAST(turn AS INTEGER) AS depth,
       CASE turn % 3 WHEN 0 THEN '0' WHEN 1 THEN '0,1' ELSE '0,1,2' END AS children FROM conversations WHERE turn % 4 <> 3""")
def _(t):
    """Turns as nodes: 0 of four hangs on the post, 1 on a comment, 2 is loose, 3 has no children."""
    ids = F.transform(F.sequence(F.lit(0), F.col("turn").cast("int") % 3), lambda i: i.cast("string"))
    quarter = F.col("turn") % 4
    children = F.when(quarter == 3, F.array().cast("array<string>")).otherwise(ids)
    node = F.struct(F.col("turn").cast("int").alias("depth"), children.alias("children"))
    nodes = t("conversations").select(F.col("conv_id").alias("thread_id"), quarter.alias("q"), node.alias("more"))
    mores = forum.collect_mores(nodes.where("q IN (0, 3)"), nodes.where("q = 1"), nodes.where("q = 2"))
    return mores.select("thread_id", "depth", F.array_join("children", ",").alias("children"))


SELECTED = f"""
WITH nodes AS (SELECT * FROM ({NODES}) WHERE depth <= 6 AND n_children >= 2),
run AS (SELECT *, CAST(ceil(n_children / 100.0) AS BIGINT) AS calls,
        coalesce(sum(CAST(ceil(n_children / 100.0) AS BIGINT)) OVER (PARTITION BY thread_id ORDER BY n_children DESC, more_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent FROM nodes)
SELECT thread_id, more_id, depth, n_children, calls, CAST(spent AS BIGINT) AS spent FROM run WHERE spent <= 32"""


@query("select_more_batches", SELECTED)
def _(t):
    return forum.select_more_batches(_nodes(t))


@query("largest_mores_first", f"""
SELECT thread_id, more_id, n_children, row_number() OVER (PARTITION BY thread_id ORDER BY n_children DESC, more_id) AS place
FROM ({SELECTED})""")
def _(t):
    return forum.largest_mores_first(forum.select_more_batches(_nodes(t))).select("thread_id", "more_id", "n_children", "place")


@query("check_keys", """
SELECT 'repeated' AS violation, comment_id AS key_value, count(*) AS n
FROM (SELECT comment_id FROM fx_comment UNION ALL SELECT comment_id FROM fx_comment WHERE user_name = 'assistant')
GROUP BY comment_id HAVING count(*) > 1
UNION ALL
SELECT 'orphan', comment_id, 1
FROM (SELECT * FROM fx_comment UNION ALL SELECT * FROM fx_comment WHERE user_name = 'assistant')
WHERE submission_id NOT IN (SELECT submission_id FROM fx_thread)""")
def _(t):
    """Comments with those of one role stored twice, against a parent table with missing threads."""
    rows = t("fx_comment")
    rows = rows.unionByName(rows.where("user_name = 'assistant'"))
    return forum.check_keys(rows, "comment_id", "submission_id", t("fx_thread"))


@query("export_csv", """
SELECT CAST(COLUMNS(*) AS VARCHAR) FROM fx_submission""")
def _(t):
    """Submissions written to CSV with a header and read back."""
    path = scratch_path(t.spark, "export")
    writers.export_csv(t("fx_submission"), path)
    return t.spark.read.csv(path, header=True, nullValue="NULL")


# -- queues -----------------------------------------------------------------------------

@query("queue_json", """
SELECT pos, concat('{"CreatedTime":"', strftime(created_time, '%Y-%m-%dT%H:%M:%S.%f'), 'Z","Permalink":"', permalink, '"}') AS value,
       created_time, permalink FROM fx_queue""")
def _(t):
    """Queue entries written as JSON and read back."""
    lines = t("fx_queue").select("pos", queues.queue_json(F.col("created_time"), F.col("permalink")).alias("value"))
    return queues.queue_entries(lines.withColumn("json", F.col("value")), "json")


@query("rejected_entries", "SELECT pos FROM fx_queue WHERE pos % 50 = 7")
def _(t):
    """Every fiftieth entry is broken JSON."""
    text = queues.queue_json(F.col("created_time"), F.col("permalink"))
    lines = t("fx_queue").select("pos", F.when(F.col("pos") % 50 == 7, F.lit("{broken")).otherwise(text).alias("value"))
    return queues.rejected_entries(queues.queue_entries(lines)).select("pos")


@query("drain_aged_prefix", """
SELECT * FROM fx_queue WHERE pos < coalesce((
  SELECT min(pos) FROM fx_queue
  WHERE created_time > TIMESTAMP '2024-01-30 00:00:00' - INTERVAL '24' HOUR), 9223372036854775807)""")
def _(t):
    when = F.lit("2024-01-30 00:00:00").cast("timestamp")
    return queues.drain_aged_prefix(t("fx_queue"), when, 24.0)


@query("queue_remainder", """
SELECT * FROM fx_queue WHERE pos >= coalesce((
  SELECT min(pos) FROM fx_queue
  WHERE created_time > TIMESTAMP '2024-01-30 00:00:00' - INTERVAL '24' HOUR), 9223372036854775807)""")
def _(t):
    when = F.lit("2024-01-30 00:00:00").cast("timestamp")
    return queues.queue_remainder(t("fx_queue"), when, 24.0)


@query("age_hours", """
SELECT pos, (epoch_us(TIMESTAMP '2024-01-30 00:00:00') - epoch_us(created_time)) / 3.6e9 AS age_hours FROM fx_queue""")
def _(t):
    when = F.lit("2024-01-30 00:00:00").cast("timestamp")
    return t("fx_queue").select("pos", fields.age_hours(F.col("created_time"), when).alias("age_hours"))


CAPPED = """
SELECT user_id, event_id, ts, CAST(rn AS INTEGER) AS rank FROM (
  SELECT user_id, event_id, CAST(ts AS TIMESTAMP) AS ts, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) WHERE rn <= 20"""


def _events(t):
    return t("events").select("user_id", "event_id", F.col("ts").cast("timestamp").alias("ts"))


@query("capped_list", CAPPED)
def _(t):
    return queues.capped_list(_events(t), "user_id", ["ts", "event_id"], 20)


@query("capped_list_read", f"""
SELECT user_id, string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY rank) AS items FROM ({CAPPED}) GROUP BY user_id""")
def _(t):
    lists = queues.capped_list_read(_events(t), "user_id", ["ts", "event_id"], "event_id", 20)
    return lists.select("user_id", F.array_join(F.col("items").cast("array<string>"), ",").alias("items"))
