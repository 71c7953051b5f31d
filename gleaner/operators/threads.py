"""Landed threads: listings in JSON, with replies nested to any depth, as flat tables.

A thread is two listings, the post's and the comments'; a comment holds its replies as a further listing, and a "load more" node
stands where ids were left out.  Texts are parsed into VARIANT values once, so no schema limits how deep replies go.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions import fields
from gleaner.operators.forum import ingest_submissions
from gleaner.operators.ids import rank_within
from gleaner.session import Scratch, scratch_path

POSTS, COMMENTS, REPLIES = "$[0].data.children", "$[1].data.children", "$.data.replies.data.children"
POST, COMMENT, MORE = "t3", "t1", "more"
DELETED = "[deleted]"
# Reply levels read in one pass; each further pass starts from what hangs below.
LEVELS = 12


def parse_threads(landed: DataFrame, column: str = "value") -> DataFrame:
    """(permalink, thread, n_posts): thread is a VARIANT, null for text that is no JSON."""
    parsed = landed.select("permalink", F.try_parse_json(F.col(column)).alias("thread"))
    n_posts = F.size(F.filter(_children("thread", POSTS), lambda c: _text(c, "$.kind") == POST))
    return parsed.withColumn("n_posts", n_posts)


def rejected_threads(parsed: DataFrame) -> DataFrame:
    """(permalink, fault) of landed threads that are broken or do not hold exactly one post."""
    fault = F.when(F.col("thread").isNull(), "broken").when(F.col("n_posts") == 0, "no post").otherwise("several posts")
    return parsed.where(F.col("thread").isNull() | (F.col("n_posts") != 1)).select("permalink", fault.alias("fault"))


def thread_posts(parsed: DataFrame) -> DataFrame:
    """Submission columns and ``more_children`` of the threads that hold exactly one post.

    The permalink is the one the thread was landed under.
    """
    post = F.try_variant_get(F.get(_children("thread", POSTS), F.lit(0)), "$.data", "variant")
    mores = F.filter(_children("thread", COMMENTS), lambda c: _text(c, "$.kind") == MORE)
    more = _children(F.get(mores, F.lit(0)), "$.data.children")
    single = parsed.where("n_posts = 1").select(
        F.to_json(post).alias("value"), "permalink", F.size(more).alias("more_children"))
    kept = ingest_submissions(single, keep=["permalink", "more_children"])
    return kept.withColumn("is_deleted", F.col("is_deleted") | F.coalesce(F.col("selftext") == DELETED, F.lit(False)))


def thread_nodes(parsed: DataFrame) -> DataFrame:
    """All comments and "load more" nodes of parsed threads, one row per node.

    (permalink, path, kind, the comment columns, more_id, children): ``path`` holds the node's 0-based places among its siblings
    from the top level down.  A pass reads ``LEVELS`` levels; nodes at the last of them hand their replies to the next pass, so
    there is one pass per eight levels and a subtree is written once per pass.
    """
    spark = parsed.sparkSession
    path = scratch_path(spark, "threads")
    Scratch.note(path)
    roots = parsed.select("permalink", F.array().cast("array<int>").alias("above"), _children("thread", COMMENTS).alias("kids"))
    n = 0
    while True:
        tops = roots.select("permalink", "above", F.posexplode("kids").alias("place", "node"))
        start = F.concat("above", F.array("place"))
        found = tops.select("permalink", (F.size("above") + LEVELS).alias("last"), F.inline(_below(F.col("node"), start, LEVELS)))
        kids = _children("node", REPLIES)
        found.select(
            "permalink", "path", *_node_columns(F.col("node")),
            F.when((F.size("path") == F.col("last")) & (F.size(kids) > 0), kids).alias("kids"),
        ).write.parquet(f"{path}/pass={n}")
        roots = spark.read.parquet(f"{path}/pass={n}").where("kids IS NOT NULL").select("permalink", F.col("path").alias("above"), "kids")
        if roots.isEmpty():
            break
        n += 1
    return spark.read.option("basePath", path).parquet(*[f"{path}/pass={k}" for k in range(n + 1)]).drop("kids", "pass")


def thread_comments(nodes: DataFrame) -> DataFrame:
    """Comment columns of the nodes with ``depth`` and ``pos``, the place in the thread's list.

    All siblings come first, then the subtree of each sibling in turn.
    """
    inner = F.flatten(F.transform(F.slice("path", 1, F.size("path") - 1), lambda i: F.array(F.lit(1), i)))
    order = F.concat(inner, F.array(F.lit(0), F.element_at("path", -1)))
    comments = nodes.where(F.col("kind") == COMMENT).withColumn("__order", order)
    return rank_within(comments, ["permalink"], ["__order"], "pos").select(
        "permalink", "pos", F.size("path").alias("depth"), "reddit_id", "parent_id", "created_time", "user_name", "body", "body_html",
        "up_votes", "down_votes", "is_deleted")


def thread_mores(nodes: DataFrame) -> DataFrame:
    """(thread_id, on_post, more): the "load more" nodes, ``more`` as ``collect_mores`` takes it."""
    return nodes.where(F.col("kind") == MORE).select(
        F.col("permalink").alias("thread_id"), (F.size("path") == 1).alias("on_post"),
        F.struct("more_id", F.coalesce("more_depth", F.size("path") - 1).alias("depth"), "children").alias("more"))


def _children(value: Column | str, path: str) -> Column:
    """The nodes of a listing; none for '' and whatever else is no listing."""
    kids = F.try_variant_get(F.col(value) if isinstance(value, str) else value, path, "array<variant>")
    return F.coalesce(kids, F.array().cast("array<variant>"))


def _text(node: Column, path: str) -> Column:
    return F.try_variant_get(node, path, "string")


def _below(node: Column, path: Column, levels: int) -> Column:
    """Array of (path, node): the node and what hangs below it, ``levels`` levels in all."""
    own = F.array(F.struct(path.alias("path"), node.alias("node")))
    if levels == 1:
        return own
    return F.concat(own, F.flatten(F.transform(
        _children(node, REPLIES), lambda kid, place: _below(kid, F.concat(path, F.array(place)), levels - 1))))


def _node_columns(node: Column) -> list[Column]:
    """Kind, comment columns and "load more" columns of a node; absent counts are 0."""
    body = _text(node, "$.data.body")
    deleted = F.coalesce(F.try_variant_get(node, "$.data.deleted", "boolean"), F.lit(False))
    return [
        _text(node, "$.kind").alias("kind"), _text(node, "$.data.id").alias("reddit_id"), _text(node, "$.data.parent_id").alias("parent_id"),
        fields.epoch_to_ts(F.try_variant_get(node, "$.data.created_utc", "double")).alias("created_time"),
        _text(node, "$.data.author").alias("user_name"), body.alias("body"), _text(node, "$.data.body_html").alias("body_html"),
        *[F.coalesce(F.try_variant_get(node, f"$.data.{n}", "int"), F.lit(0)).alias(c) for n, c in (("ups", "up_votes"), ("downs", "down_votes"))],
        (deleted | F.coalesce(body == DELETED, F.lit(False))).alias("is_deleted"),
        _text(node, "$.data.id").alias("more_id"), F.try_variant_get(node, "$.data.depth", "int").alias("more_depth"),
        F.try_variant_get(node, "$.data.children", "array<string>").alias("children"),
    ]
