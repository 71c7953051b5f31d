"""Article text: sentence tables and removal of sentences shared with neighbours."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions import near
from gleaner.functions import text as tx
from gleaner.functions.near import MAX_DISTANCE
from gleaner.operators import vocabulary
from gleaner.operators.adjacency import place_targets
from gleaner.session import shuffle_width, widened, written

# Pairs of sentences that a task judges together.
TOGETHER = 1_000_000
# Length bands, each at least ten wide, so near lengths lie in neighbouring bands:
# tens up to 300, hundreds up to 2300, then one band.
FINE_END, FINE, COARSE, N_COARSE = 300, 10, 100, 20
# Check sentences compared at once in one array.
PIECE = 1000


def normalize_text(docs: DataFrame, column: str = "text") -> DataFrame:
    """Replace the column by its normalised text."""
    return docs.withColumn(column, tx.normalize_text(F.col(column)))


def sentences(docs: DataFrame, key: str, column: str = "text", learned: list[str] | None = None) -> DataFrame:
    """(key, pos, sentence) of an already normalised text column; ``learned`` abbreviations replace the fixed list."""
    return explode_sentences(docs.select(key, tx.split_sentences(F.col(column), learned).alias("sentences")), key)


def sentences_learned(docs: DataFrame, key: str, column: str = "text") -> DataFrame:
    """(key, pos, sentence) with the abbreviations that the texts themselves show.

    The list goes into a pattern.  Its score falls with a word's length faster than counts grow, so it holds short words only.
    """
    learned = [r["word"] for r in vocabulary.abbreviations(docs, column).collect()]
    return sentences(docs, key, column, learned)


def explode_sentences(docs: DataFrame, key: str) -> DataFrame:
    """Array column ``sentences`` -> one row per sentence with its 0-based position."""
    return docs.select(key, F.posexplode("sentences").alias("pos", "sentence"))


def non_empty_sentences(rows: DataFrame, column: str = "sentence") -> DataFrame:
    """Sentences with three adjacent meaningful characters."""
    return rows.where(tx.is_meaningful(F.col(column)))


def rejoin_sentences(rows: DataFrame, key: str) -> DataFrame:
    """(key, text): sentences of a document joined by one space in order."""
    ordered = F.array_sort(F.collect_list(F.struct("pos", "sentence")))
    return rows.groupBy(key).agg(
        F.concat_ws(" ", F.transform(ordered, lambda s: s["sentence"])).alias("text"))


def article_sentences(articles: DataFrame) -> DataFrame:
    """(article_id, sentences): body normalised and split, once per article."""
    rows = widened(articles.where(F.col("body").isNotNull()).select("article_id", "body"))
    body = rows.select("article_id", tx.normalize_text(F.col("body")).alias("text"))
    return body.where(F.col("text").isNotNull()).select("article_id", tx.split_sentences(F.col("text")).alias("sentences"))


def check_sentence_pool(adjacent: DataFrame, sentence_table: DataFrame, packed: bool = False) -> DataFrame:
    """(target_id, side, rank, article_id, pos, sentence): all sentences of all neighbours, repeats kept.

    ``packed``, of neighbours with the block of their target, is the pool as (block, article_id, targets, sentences): a text
    stands there once for all targets of a block that it is next to, and a target in one block only.
    """
    if packed:
        known = adjacent.where(F.col("target_id").isNotNull())
        adjacent = known.groupBy("block", "article_id").agg(F.collect_set("target_id").alias("targets"))
        return adjacent.join(sentence_table, "article_id").select("block", "article_id", "targets", "sentences")
    return explode_pool(adjacent.join(sentence_table, "article_id"))


def explode_pool(rows: DataFrame) -> DataFrame:
    return rows.select("target_id", "side", "rank", "article_id", F.posexplode("sentences").alias("pos", "sentence"))


def except_sentences(targets: DataFrame, check: DataFrame) -> DataFrame:
    """Target sentences without an equal check sentence of the same target; ``check`` may be a packed pool."""
    if "targets" in check.columns:
        return _in_blocks(targets, check, judge_near=False)
    return targets.join(check.select("target_id", "sentence").distinct(), ["target_id", "sentence"], "left_anti")


def _band(n: Column) -> Column:
    coarse = FINE_END // FINE + F.least(F.floor((n - FINE_END) / COARSE), F.lit(N_COARSE))
    return F.when(n < FINE_END, F.floor(n / FINE)).otherwise(coarse).cast("int")


def _is_near(one: Column, candidates: Column) -> Column:
    """Some candidate sentence has an edit distance under ten to the sentence, in code points."""
    return F.exists(candidates, lambda c: (
        (F.abs(F.length(c) - F.length(one)) <= MAX_DISTANCE) & (F.levenshtein(c, one, MAX_DISTANCE) >= 0)))


def unique_sentences(targets: DataFrame, check: DataFrame) -> DataFrame:
    """Target sentences (target_id, pos, sentence) with no check sentence at an edit distance under ten.

    Equal sentences go first by an anti join.  The others meet check sentences
    of their own target whose length is near enough, in arrays of about a
    thousand, so no sentence pair is ever a row.  The check sentences are
    computed once and written without repeats; all steps read that table.
    A packed pool is never taken apart: its texts travel once per block.
    """
    if "targets" in check.columns:
        return _in_blocks(targets, check, judge_near=True)
    place = ["target_id", "band"]
    band = _band(F.length("sentence"))
    check = written(check.select("target_id", band.alias("band"), "sentence").distinct(), "check")
    sizes = check.groupBy(*place).agg(F.ceil(F.count("*") / PIECE).alias("n_pieces"))
    arrays = (
        check.join(sizes, place)
        .withColumn("piece", F.pmod(F.xxhash64("sentence"), F.col("n_pieces")))
        .groupBy(*place, "piece")
        .agg(F.collect_list("sentence").alias("pool"))
    )
    left = written(except_sentences(targets, check), "left")
    near = (
        left.select("target_id", "pos", "sentence", F.explode(F.array(band - 1, band, band + 1)).alias("band"))
        .join(arrays, place)
        .where(_is_near(F.col("sentence"), F.col("pool")))
        .select("target_id", "pos").distinct()
    )
    return left.join(near, ["target_id", "pos"], "left_anti").select("target_id", "pos", "sentence")


def _in_blocks(targets: DataFrame, check: DataFrame, judge_near: bool) -> DataFrame:
    """``except_sentences`` or ``unique_sentences`` with a packed pool; a block is one group of a task.

    Targets without check sentences have no block and are dealt by their own place.
    """
    width = shuffle_width(targets.sparkSession)
    blocks = check.select(F.explode("targets").alias("target_id"), "block").distinct()
    own = targets.select("target_id", "pos", "sentence").join(blocks, "target_id", "left").withColumn(
        "block", F.coalesce("block", F.xxhash64("target_id", "pos", "sentence")))
    shipped = check.select(F.col("block").alias("of_block"), F.col("targets").alias("for_targets"), "sentences")

    def kept(own: pa.Table, shipped: pa.Table) -> pa.Table:
        return _kept(own, shipped, judge_near)

    return (
        own.repartition(width, "block").groupBy("block")
        .cogroup(shipped.repartition(width, "of_block").groupBy("of_block"))
        .applyInArrow(kept, targets.select("target_id", "pos", "sentence").schema))


def _kept(own: pa.Table, shipped: pa.Table, judge_near: bool) -> pa.Table:
    """One block: its target sentences without those that are equal to, or near, a check sentence of their target."""
    number: dict[str, int] = {}
    pools = defaultdict(list)
    for targets, sentences in zip(shipped["for_targets"].to_pylist(), shipped["sentences"].to_pylist(), strict=True):
        codes = np.array([number.setdefault(x, len(number)) for x in sentences if x is not None], dtype=np.int64)
        for target in targets:
            pools[target].append(codes)
    places = defaultdict(list)
    for place, target in enumerate(own["target_id"].to_pylist()):
        places[target].append(place)
    coded = [-1 if x is None else number.setdefault(x, len(number)) for x in own["sentence"].to_pylist()]
    coded = np.array(coded, dtype=np.int64)
    keep, groups, open_ = np.ones(own.num_rows, dtype=bool), [], []
    for target, found in places.items():
        if target in pools:
            found, pool = np.array(found), np.unique(np.concatenate(pools[target]))
            keep[found] = ~np.isin(coded[found], pool)
            groups.append(found[keep[found]])
            open_.append((np.unique(coded[groups[-1]][coded[groups[-1]] >= 0]), pool))
    if judge_near and open_:
        # A place of a target goes as a whole, also where the target's id stands twice.
        pos = own["pos"].to_numpy()
        for found, (different, _), lost in zip(groups, open_, _shared(near.Sentences(list(number)), open_), strict=True):
            gone = np.isin(coded[found], different[lost])
            keep[found[np.isin(pos[found], pos[found[gone]])]] = False
    return own.select(["target_id", "pos", "sentence"]).filter(pa.array(keep))


def unshared_sentences(targets: DataFrame, articles: DataFrame, **adjacency) -> DataFrame:
    """(article_id, n_neighbours, n_check, pos, kept): a target's sentences that no neighbour has, nor one nearer than ten edits.

    Each article is normalised and split once and written.  Its sentences then
    travel once per block of adjacent targets; a block is one group of a task,
    where different sentences are described once and a pair of them is judged
    once, for all targets of the block (see functions/near.py).
    """
    width = shuffle_width(articles.sparkSession)
    table = written(article_sentences(articles), "sentences")
    placed = written(
        place_targets(targets.where(F.col("body").isNotNull()), articles, **adjacency), "neighbours")
    both = F.concat("before", "after")
    needed = placed.select("block", F.explode(F.array_distinct(F.concat(F.array("article_id"), both))).alias("other_id")).distinct()
    shipped = needed.join(table.withColumnRenamed("article_id", "other_id"), "other_id").select(
        F.col("block").alias("of_block"), "other_id", "sentences")
    wanted = placed.select("block", "article_id", both.alias("others"))
    # Explicit numbers: blocks are small in bytes and costly to compare, so partitions must not be merged by size.
    return (
        wanted.repartition(width, "block").groupBy("block")
        .cogroup(shipped.repartition(width, "of_block").groupBy("of_block"))
        .applyInArrow(_unshared, "article_id long, n_neighbours int, n_check long, pos array<int>, kept array<string>"))


def _unshared(wanted: pa.Table, shipped: pa.Table) -> pa.Table:
    """One block: targets with the ids of their neighbours, and the sentences of all articles it needs."""
    number: dict[str, int] = {}
    texts = {}
    for article, sentences in zip(shipped["other_id"].to_pylist(), shipped["sentences"].to_pylist(), strict=True):
        texts[article] = np.array([number.setdefault(x, len(number)) for x in sentences], dtype=np.int64)
    known, named, none = near.Sentences(list(number)), list(number), np.zeros(0, dtype=np.int64)
    targets, open_ = [], []
    for article, others in zip(wanted["article_id"].to_pylist(), wanted["others"].to_pylist(), strict=True):
        check = [texts.get(i, none) for i in others]
        pool = np.unique(np.concatenate([none, *check]))
        different = np.unique(texts.get(article, none))
        targets.append((article, len(others), sum(map(len, check))))
        open_.append((different[~np.isin(different, pool, assume_unique=True)], pool))
    shared = _shared(known, open_)
    rows = []
    for (article, *counts), (different, _), lost in zip(targets, open_, shared, strict=True):
        own = texts.get(article, none)
        pos = np.flatnonzero(np.isin(own, different[~lost]))
        rows.append((article, *counts, pos.tolist(), [named[i] for i in own[pos].tolist()]))
    columns = [list(c) for c in zip(*rows, strict=True)] if rows else [[]] * len(_UNSHARED)
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _UNSHARED, strict=True)], schema=_UNSHARED)


def _shared(known: near.Sentences, open_: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    """For each target's (own sentences, pool) which of its own are near one of the pool.

    Pairs come up again for targets that are each other's neighbours, so many targets are judged together and a pair once.
    """
    ends = np.cumsum([len(own) for own, _ in open_], dtype=np.int64)
    out = np.zeros(int(ends[-1]) if open_ else 0, dtype=bool)
    held, waiting = [], 0

    def judge() -> None:
        place, one, two = map(np.concatenate, zip(*held, strict=True))
        keys, back = np.unique(np.minimum(one, two) << 32 | np.maximum(one, two), return_inverse=True)
        out[place[known.near(keys >> 32, keys & ((1 << 32) - 1))[back]]] = True

    for (own, pool), end in zip(open_, ends.tolist(), strict=True):
        for place, other in near.near_in_pool(known, own, pool):
            held.append((end - len(own) + place, own[place], other))
            waiting += len(place)
            if waiting > TOGETHER:
                judge()
                held, waiting = [], 0
    if held:
        judge()
    return np.split(out, ends[:-1])


_UNSHARED = pa.schema([
    ("article_id", pa.int64()), ("n_neighbours", pa.int32()), ("n_check", pa.int64()), ("pos", pa.list_(pa.int32())),
    ("kept", pa.list_(pa.string())),
])


def unique_article_sentences(targets: DataFrame, articles: DataFrame, **adjacency) -> DataFrame:
    """(target_id, pos, sentence): ``unique_sentences`` of stored articles against the sentences of their neighbours."""
    rows = unshared_sentences(targets, articles, **adjacency)
    return rows.select(F.col("article_id").alias("target_id"), F.inline(F.arrays_zip("pos", F.col("kept").alias("sentence"))))


def clean_articles(targets: DataFrame, articles: DataFrame, cutoff: int, **adjacency) -> DataFrame:
    """(article_id, clean_body): the body without sentences it shares with its neighbours.

    Null when there are fewer than ``cutoff`` neighbours or check sentences, or
    when fewer than two sentences stay.  Neighbours on both sides and those
    without a body count as neighbours, a sentence of one on both sides twice.
    """
    enough = (F.col("n_neighbours") >= cutoff) & (F.col("n_check") >= cutoff) & (F.size("kept") >= 2)
    return unshared_sentences(targets, articles, **adjacency).select(
        "article_id", F.when(enough, F.array_join("kept", " ")).alias("clean_body"))
