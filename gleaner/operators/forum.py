"""Forum threads: gates, comment trees, "load more" batches and key checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gleaner import schemas
from gleaner.functions import fields
from gleaner.operators.ids import rank_within
from gleaner.session import Scratch, scratch_path

MORE_CHILDREN_CUTOFF = 10
MANY_COMMENTS = 20
FOUND_SHARE = 0.667
MAX_DEPTH, MIN_CHILDREN, MAX_CALLS, IDS_PER_CALL = 6, 2, 32, 100


def ingest_submissions(lines: DataFrame, column: str = "value", keep: list[str] | None = None) -> DataFrame:
    """Post JSON -> submission columns; epoch seconds become timestamps, absent flags false and absent counts 0.

    ``keep`` names further columns of ``lines``; one that is a submission column replaces the post's own.
    """
    no, zero, keep = F.lit(False), F.lit(0), keep or []
    post = F.from_json(F.col(column), schemas.POST_JSON)
    return lines.select(post.alias("p"), *keep).select(
        *keep, F.col("p.name").alias("reddit_id"), "p.title", "p.url", *([] if "permalink" in keep else ["p.permalink"]),
        fields.epoch_to_ts(F.col("p.created_utc")).alias("created_time"),
        F.col("p.author").alias("user_name"), F.col("p.subreddit").alias("subreddit_name"), "p.subreddit_id",
        "p.selftext", "p.selftext_html", F.coalesce("p.num_comments", zero).alias("num_comments"), F.coalesce("p.score", zero).alias("score"),
        F.coalesce("p.ups", zero).alias("up_votes"), F.coalesce("p.downs", zero).alias("down_votes"),
        F.coalesce("p.over_18", no).alias("is_nsfw"), F.coalesce("p.is_self", no).alias("is_self"),
        F.coalesce("p.is_reddit_media_domain", no).alias("is_media"), F.coalesce("p.deleted", no).alias("is_deleted"),
    )


def submission_gate(posts: DataFrame, cutoff: int) -> DataFrame:
    """Posts that are not deleted and whose comments plus score reach the cutoff; null is false or 0."""
    deleted, zero = F.coalesce("is_deleted", F.lit(False)), F.lit(0)
    return posts.where(~deleted & (F.coalesce("num_comments", zero) + F.coalesce("score", zero) >= cutoff))


def external_links(posts: DataFrame) -> DataFrame:
    """Posts that are neither self posts nor on the forum's media domain; null is false."""
    return posts.where(~(F.coalesce("is_media", F.lit(False)) | F.coalesce("is_self", F.lit(False))))


def needs_more_comments(posts: DataFrame) -> DataFrame:
    """Add ``needs_more``: many unloaded children, or too small a share of many comments found."""
    share = (F.col("comments_got").cast("float") / F.col("num_comments").cast("float")).cast("float")
    missing = (F.col("num_comments") > MANY_COMMENTS) & (share < F.lit(FOUND_SHARE).cast("float"))
    many = F.coalesce(F.col("more_children"), F.lit(0)) >= MORE_CHILDREN_CUTOFF
    return posts.withColumn("needs_more", many | F.coalesce(missing, F.lit(False)))


def comments_found(posts: DataFrame, comments: DataFrame) -> DataFrame:
    """Posts with ``comments_got``, the number of stored comments."""
    got = comments.groupBy("submission_id").agg(F.count("*").cast("int").alias("comments_got"))
    return posts.drop("comments_got").join(got, "submission_id", "left").fillna({"comments_got": 0})


def single_post_threads(posts: DataFrame) -> DataFrame:
    """Posts (thread_id, ...) of the harvested threads that hold exactly one post."""
    single = posts.groupBy("thread_id").agg(F.count("*").alias("n")).where("n = 1").select("thread_id")
    return posts.join(single, "thread_id", "left_semi")


def all_comments(base: DataFrame, extra: DataFrame) -> DataFrame:
    """Base and later loaded comments, repeats kept."""
    return base.unionByName(extra)


def comment_paths(comments: DataFrame) -> DataFrame:
    """(comment_id, submission_id, path, fault): ``path`` holds the ids from the top-level comment down to the comment.

    Input is the flat adjacency (comment_id, submission_id, parent_id, ...), null parent = top level, each id once.  A comment
    that hangs on no top-level comment has the fault "orphan" (an ancestor is missing) or "cycle".

    Pointer doubling: every comment knows the piece of its path up to some ancestor, and a round joins it with that ancestor's
    piece, so pieces double and a tree of depth d takes about log2(d) rounds.  Finished comments are only read again.
    """
    spark = comments.sparkSession
    path = scratch_path(spark, "paths")
    Scratch.note(path)
    piece = ["comment_id", "submission_id", "above", "path", "fault"]
    start = comments.select(
        "comment_id", "submission_id", F.col("parent_id").alias("above"), F.array("comment_id").alias("path"),
        F.lit(None).cast("string").alias("fault"))
    start.write.parquet(f"{path}/round=0")
    is_open = F.col("above").isNotNull() & F.col("fault").isNull()
    n = 0
    while True:
        rounds = [spark.read.parquet(f"{path}/round={k}") for k in range(n + 1)]
        open_ = rounds[n].where(is_open)
        if open_.isEmpty():
            break
        known = rounds[n]
        for done in rounds[:n]:
            known = known.unionByName(done.where(~is_open))
        ahead = known.select(
            F.col("comment_id").alias("above"), F.col("above").alias("next"), F.col("path").alias("ahead"), F.col("fault").alias("why"))
        joined = open_.drop("fault").join(ahead, "above", "left")
        fault = (
            F.when(F.col("ahead").isNull(), "orphan").when(F.col("why").isNotNull(), F.col("why"))
            .when(F.col("above").eqNullSafe(F.col("comment_id")) | F.arrays_overlap("path", F.array("next")), "cycle"))
        joined.select(
            "comment_id", "submission_id", F.col("next").alias("above"), F.concat("ahead", "path").alias("path"), fault.alias("fault"),
        ).write.parquet(f"{path}/round={n + 1}")
        n += 1
    done = spark.read.option("basePath", path).parquet(*[f"{path}/round={k}" for k in range(n + 1)]).where(~is_open)
    return done.select(*[c for c in piece if c != "above"])


def flatten_comments(comments: DataFrame) -> DataFrame:
    """Comment trees as lists: adds ``depth`` and ``pos``, the place in the thread's list.

    All siblings come first, then the subtree of each sibling in turn;
    siblings are in comment_id order.  Comments that hang on no top-level
    comment are left out, as they are in no tree; see ``rejected_comments``.
    """
    found = comment_paths(comments).where("fault IS NULL")
    # An inner node sorts after all leaves of its level: its step is flagged 1.
    last = F.size("path") - 1
    steps = F.transform("path", lambda i, k: F.struct((k < last).cast("long").alias("inner"), i.alias("id")))
    placed = found.select("comment_id", "submission_id", F.size("path").alias("depth"), steps.alias("steps"))
    ranked = rank_within(placed, ["submission_id"], ["steps"], "pos").drop("steps", "submission_id")
    return comments.join(ranked, "comment_id")


def rejected_comments(comments: DataFrame) -> DataFrame:
    """(comment_id, submission_id, fault): the comments that ``flatten_comments`` leaves out, and why."""
    return comment_paths(comments).where("fault IS NOT NULL").select("comment_id", "submission_id", "fault")


def chunk_children(children: Column, size: int = IDS_PER_CALL) -> Column:
    """Array of ids -> array of comma-separated batches of at most ``size`` ids."""
    starts = F.when(F.size(children) > 0, F.sequence(F.lit(1), F.size(children), F.lit(size)))
    batches = F.transform(starts, lambda i: F.concat_ws(",", F.slice(children, i, F.lit(size))))
    return F.coalesce(batches, F.array().cast("array<string>"))


def batch_ids(ids: DataFrame, node: list[str], child: str, size: int = IDS_PER_CALL) -> DataFrame:
    """Flat (node, child) rows -> (node, batch_no, batch), at most ``size`` ids per row.

    The set-level form of ``chunk_children``: ids are ranked within their node
    first, so a node with very many ids never becomes one row.
    """
    ranked = rank_within(ids, node, [child], "__rank")
    batch_no = F.floor((F.col("__rank") - 1) / size).cast("long").alias("batch_no")
    return (
        ranked.groupBy(*node, batch_no).agg(F.sort_array(F.collect_list(child)).alias("ids"))
        .select(*node, "batch_no", F.size("ids").alias("n_ids"), F.concat_ws(",", "ids").alias("batch"))
    )


def collect_mores(on_posts: DataFrame, on_comments: DataFrame, loose: DataFrame) -> DataFrame:
    """"Load more" nodes (thread_id, depth, children) from posts, comments and the thread itself.

    Each input has thread_id and ``more``, a struct (depth, children, perhaps
    more fields) or null; nodes without children are dropped.
    """
    nodes = on_posts.select("thread_id", "more")
    for other in (on_comments, loose):
        nodes = nodes.unionByName(other.select("thread_id", "more"))
    return nodes.where(F.size("more.children") > 0).select("thread_id", "more.*")


def select_more_batches(nodes: DataFrame) -> DataFrame:
    """The "load more" nodes to fetch: depth <= 6, at least 2 children, largest first, 32 calls per thread.

    ``nodes`` has thread_id, more_id, depth, n_children.  The budget is tested
    before each node, so the last one may overshoot.  Each node costs at least
    one call, so no thread can pass its first 33 nodes: a row_number filter
    cuts every map partition to those before the shuffle.
    """
    fit = nodes.where((F.col("depth") <= MAX_DEPTH) & (F.col("n_children") >= MIN_CHILDREN))
    order = Window.partitionBy("thread_id").orderBy(F.desc("n_children"), "more_id")
    head = fit.withColumn("__rank", F.row_number().over(order)).where(F.col("__rank") <= MAX_CALLS + 1)
    calls = F.ceil(F.col("n_children") / IDS_PER_CALL)
    spent = F.sum("calls").over(order.rowsBetween(Window.unboundedPreceding, -1))
    return (
        head.withColumn("calls", calls).withColumn("spent", F.coalesce(spent, F.lit(0)))
        .where(F.col("spent") <= MAX_CALLS).drop("__rank")
    )


def largest_mores_first(chosen: DataFrame) -> DataFrame:
    """Chosen "load more" nodes with ``place``, their order of fetching inside a thread (at most 33 nodes)."""
    order = Window.partitionBy("thread_id").orderBy(F.desc("n_children"), "more_id")
    return chosen.withColumn("place", F.row_number().over(order).cast("long"))


def repeated_keys(rows: DataFrame, key: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return rows.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def missing_parents(rows: DataFrame, column: str, parents: DataFrame) -> DataFrame:
    """Rows whose foreign key is in no parent row; a null key is allowed."""
    keys = parents.select(column).distinct()
    return rows.where(F.col(column).isNotNull()).join(keys, column, "left_anti")


def check_keys(rows: DataFrame, key: str, column: str, parents: DataFrame) -> DataFrame:
    """Violations of a declared primary and foreign key as (violation, key_value, n)."""
    twice = repeated_keys(rows, [key]).select(F.lit("repeated").alias("violation"), F.col(key).alias("key_value"), "n")
    orphans = missing_parents(rows, column, parents).select(
        F.lit("orphan").alias("violation"), F.col(key).alias("key_value"), F.lit(1).cast("long").alias("n"))
    return twice.unionByName(orphans)
