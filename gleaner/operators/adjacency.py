"""Neighbouring articles: those of the same host just before and after in time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gleaner.session import pinned, written

N_BEFORE, N_AFTER = 10, 5
# A host timeline longer than this is cut into time slices.
HOT_ROWS = 1_000_000
SLICES = 256
# Targets per block, see ``place_targets``.
BLOCK_TARGETS = 256

_LINE = ["kind", "host"]
_PEERS = ["kind", "host", "t"]


def timelines(articles: DataFrame) -> DataFrame:
    """(article_id, kind, host, t): an article stands on one timeline per time column it has."""
    entries = F.array(
        F.struct(F.lit("published").alias("kind"), F.col("published_time").alias("t")),
        F.struct(F.lit("source").alias("kind"), F.col("source_published_time").alias("t")),
        F.struct(F.lit("entry").alias("kind"), F.col("data_entry_time").alias("t")),
    )
    return articles.select("article_id", "host", F.inline(entries)).where(F.col("t").isNotNull())


def target_places(targets: DataFrame) -> DataFrame:
    """(article_id, kind, host, t): the one timeline a target looks along, chosen by its own nulls."""
    kind = (
        F.when(F.col("published_time").isNotNull(), "published")
        .when(F.col("source_published_time").isNotNull(), "source").otherwise("entry")
    )
    t = F.coalesce("published_time", "source_published_time", "data_entry_time")
    return targets.select("article_id", kind.alias("kind"), "host", t.alias("t"))


def _peer_groups(line: DataFrame, places: DataFrame, n_head: int) -> DataFrame:
    """One row per (timeline, time): its first ``n_head`` article ids and its number of targets.

    No target needs more of a group than that: the lowest ids win ties, and
    one place is spare for the target itself.  The row_number limit also runs
    before the shuffle, so one hot time value sends few rows.
    """
    first = Window.partitionBy(*_PEERS).orderBy("article_id")
    heads = (
        line.withColumn("__rank", F.row_number().over(first)).where(F.col("__rank") <= n_head)
        .groupBy(*_PEERS).agg(F.sort_array(F.collect_list("article_id")).alias("head"))
    )
    counts = places.groupBy(*_PEERS).agg(F.count("*").alias("n_targets"))
    return heads.join(counts, _PEERS, "left").fillna({"n_targets": 0})


def _sliced(groups: DataFrame, line: DataFrame, hot_rows: int) -> tuple[DataFrame, bool]:
    """Add ``slice``: 0 on ordinary timelines, a time slice on those of more than ``hot_rows`` rows.

    At most total / hot_rows timelines are hot, which bounds the table of cut
    points.  It is checkpointed: all branches must see the same cuts.
    """
    hot = pinned(line.groupBy(*_LINE).agg(F.count("*").alias("n")).where(F.col("n") > hot_rows).drop("n"))
    if hot.isEmpty():
        return groups.withColumn("slice", F.lit(0)), False
    shares = [i / SLICES for i in range(1, SLICES)]
    cuts = pinned(
        groups.join(hot, _LINE, "left_semi").groupBy(*_LINE)
        .agg(F.percentile_approx(F.unix_micros("t"), shares, 10000).alias("cuts"))
    )
    number = F.size(F.filter("cuts", lambda c: c <= F.unix_micros("t")))
    sliced = groups.join(cuts, _LINE, "left").withColumn(
        "slice", F.coalesce(F.when(F.col("cuts").isNotNull(), number), F.lit(0))).drop("cuts")
    return written(sliced, "slices"), True


def _with_halo(groups: DataFrame, n_before: int, n_after: int) -> DataFrame:
    """Slices with the groups that surround them: the last ``n_before`` before and first ``n_after`` behind.

    Slice ends are summarised first (a few groups per slice), so the windows
    over slices are short.  Added rows are marked ``is_halo``.
    """
    place = [*_LINE, "slice"]
    group = F.struct("t", "head")

    def ends(newest: bool, n: int, name: str) -> DataFrame:
        order = Window.partitionBy(*place).orderBy(F.desc("t") if newest else F.asc("t"))
        return (
            groups.withColumn("__rank", F.row_number().over(order)).where(F.col("__rank") <= n)
            .groupBy(*place).agg(F.sort_array(F.collect_list(group)).alias(name))
        )

    edges = ends(True, n_before, "tail").join(ends(False, n_after, "lead"), place)
    slices = Window.partitionBy(*_LINE).orderBy("slice")
    before = F.flatten(F.collect_list("tail").over(slices.rowsBetween(-n_before, -1)))
    after = F.flatten(F.collect_list("lead").over(slices.rowsBetween(1, n_after)))
    halo = (
        edges.select(*place, before.alias("b"), after.alias("a"))
        .select(*place, F.concat(
            F.slice("b", F.greatest(F.size("b") - n_before, F.lit(0)) + 1, n_before), F.slice("a", 1, n_after),
        ).alias("around"))
        .select(*place, F.inline("around"))
        .withColumn("n_targets", F.lit(0).cast("long")).withColumn("is_halo", F.lit(True))
    )
    return groups.withColumn("is_halo", F.lit(False)).unionByName(halo)


def place_targets(
    targets: DataFrame, articles: DataFrame, n_before: int = N_BEFORE, n_after: int = N_AFTER,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """(article_id, block, before, after): neighbour ids per target, nearest first.

    ``before`` has times up to the target's, newest first; ``after`` times from
    it on, oldest first; ties go to the lowest id.  An article of equal time is
    on both sides.  Rows are never joined with rows of the same host: groups of
    equal time see the few groups around them through a window.

    ``block`` labels about 256 targets that lie next to each other, so that
    later steps can ship neighbours once per block and not once per target.
    """
    line, places = timelines(articles), target_places(targets)
    groups = _peer_groups(line, places, max(n_before, n_after) + 1)
    groups, is_sliced = _sliced(groups, line, hot_rows)
    if is_sliced:
        groups = _with_halo(groups, n_before, n_after)
    order = Window.partitionBy(*_LINE, "slice").orderBy("t")
    earlier = F.collect_list("head").over(order.rowsBetween(-n_before, -1))
    later = F.collect_list("head").over(order.rowsBetween(1, n_after))
    seen = F.sum(F.least("n_targets", F.lit(BLOCK_TARGETS))).over(order.rowsBetween(Window.unboundedPreceding, 0))
    around = groups.select(
        "*",
        F.slice(F.flatten(F.reverse(earlier)), 1, n_before).alias("earlier"),
        F.slice(F.flatten(later), 1, n_after).alias("later"),
        F.floor(seen / BLOCK_TARGETS).alias("part"),
        F.ceil(F.col("n_targets") / BLOCK_TARGETS).alias("n_salts"),
    )
    if is_sliced:
        around = around.where(~F.col("is_halo"))

    def side(near: str, n: int) -> Column:
        peers = F.filter("head", lambda i: i != F.col("article_id"))
        return F.slice(F.concat(peers, near), 1, n)

    salt = F.pmod(F.xxhash64("article_id"), F.col("n_salts"))
    return places.join(around.where("n_targets > 0"), _PEERS).select(
        "article_id", F.xxhash64(*_LINE, "slice", "part", salt).alias("block"),
        side("earlier", n_before).alias("before"), side("later", n_after).alias("after"),
    )


def adjacent_articles(
    targets: DataFrame, articles: DataFrame, n_before: int = N_BEFORE, n_after: int = N_AFTER,
    hot_rows: int = HOT_ROWS, blocks: bool = False,
) -> DataFrame:
    """(target_id, side, rank, article_id): at most 10 articles before and 5 after each target.

    With ``blocks`` also the block of the target (see ``place_targets``), one for all rows of a repeated id.
    """
    placed = place_targets(targets, articles, n_before, n_after, hot_rows)
    if blocks:
        placed = placed.withColumn("block", F.min("block").over(Window.partitionBy("article_id")))

    def listed(side: str) -> Column:
        return F.transform(side, lambda i, rank: F.struct(
            F.lit(side).alias("side"), (rank + 1).alias("rank"), i.alias("article_id")))

    return placed.select(
        *["block"] * blocks, F.col("article_id").alias("target_id"), F.inline(after_then_before(listed("after"), listed("before"))))


def after_then_before(after: Column, before: Column) -> Column:
    """Both sides of a target as one list, ``after`` first."""
    return F.concat(after, before)
