"""Extractive summaries and keywords by graph centrality inside each document.

Sentence graph: the weight from sentence i to j is the BM25 score of j for the
words of i,

    w(i, j) = sum over words t of a(i, t) * b(j, t),        i != j
    a(i, t) = count of t in i
    b(j, t) = idf(t) * a(j, t) * (K1 + 1) / (a(j, t) + K1 * (1 - B + B * len(j) / mean len))

The matrix is a product over words, so one damped step
``r(j) = (1 - d) / n + d * sum_i r(i) * w(i, j) / out(i)`` is taken by way of
the words: sentences -> words -> sentences, minus the diagonal.  Work per step
is linear in the words of the document; sentence pairs never appear.  All
steps of a document run inside its row.

Word graph of the keywords: neighbouring words are joined.  Many documents of
a task are one sparse matrix, so a damped step is one pass over their edges.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gleaner.functions import text as tx
from gleaner.functions.arrays import let, total
from gleaner.functions.fields import summary_tenths
from gleaner.operators.vocabulary import in_base_forms
from gleaner.session import shuffle_width, written

ROUNDS, DAMPING = 20, 0.85
K1, B = 1.5, 0.75
N_KEYWORDS = 20
SCORE_DIGITS = 6
# Words of the documents whose keywords are ranked at once.
TOGETHER = 500_000


def _iterate(step, n: Column) -> Column:
    start = F.transform(F.sequence(F.lit(1), n), lambda _: F.lit(1.0) / n)
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, lambda r, _: step(r))


def _sentence_graph(table: DataFrame, key: str) -> DataFrame:
    """(key, posts, rows): per word its (i, a, b), per sentence its (t, a, b), both in index order.

    Words of a single sentence make no edge and are left out.  The word ''
    with weight 0 stands in every sentence, so every sentence has its row.
    One shuffle by document; every later grouping stays inside it.
    """
    base = table.select(key, F.transform("sentences", tx.words).alias("w")).select(
        key, F.size("w").alias("n"),
        (F.aggregate("w", F.lit(0), lambda acc, s: acc + F.size(s)) / F.size("w")).alias("mean"),
        F.posexplode("w").alias("pos", "words"),
    )
    entries = (
        base.select(key, "n", "mean", "pos", F.size("words").alias("len"),
                    F.explode(F.concat(F.array(F.lit("")), "words")).alias("word"))
        .repartition(shuffle_width(table.sparkSession), key)
        .groupBy(key, "n", "mean", "pos", "len", "word").agg(F.count("*").cast("double").alias("count"))
        .withColumn("df", F.count("*").over(Window.partitionBy(key, "word"))).where("df > 1")
        .withColumn("t", F.dense_rank().over(Window.partitionBy(key).orderBy("word")) - 1)
    )
    idf = F.log(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    saturated = F.col("count") * (K1 + 1) / (
        F.col("count") + K1 * (1 - B + B * F.col("len") / F.greatest("mean", F.lit(1e-9))))
    real = F.col("word") != ""
    entries = entries.select(
        key, "pos", "t",
        F.when(real, F.col("count")).otherwise(0.0).alias("a"), F.when(real, idf * saturated).otherwise(0.0).alias("b"))

    def listed(by: str, other: str, name: str) -> DataFrame:
        inner = entries.groupBy(key, by).agg(
            F.sort_array(F.collect_list(F.struct(F.col(other).alias("at"), "a", "b"))).alias("items"))
        outer = inner.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(by, "items"))).alias("lists"))
        return outer.select(key, F.transform("lists", lambda x: x["items"]).alias(name))

    return listed("t", "pos", "posts").join(listed("pos", "t", "rows"), key)


def _sentence_scores(posts: Column, rows: Column, n: Column) -> Column:
    """Scores in sentence order after the fixed number of rounds."""
    totals = F.transform(posts, lambda p: total(p, lambda e: e["b"]))
    own = F.transform(rows, lambda row: total(row, lambda e: e["a"] * e["b"]))

    def inverse_out(sums: Column, diagonal: Column) -> Column:
        out = F.transform(
            rows, lambda row, i: total(row, lambda e: e["a"] * F.get(sums, e["at"])) - F.get(diagonal, i))
        return F.transform(out, lambda o: F.when(o > 1e-12, 1.0 / o).otherwise(F.lit(0.0)))

    def step(r: Column, inverse: Column, diagonal: Column) -> Column:
        def spread(x: Column) -> Column:
            through = F.transform(posts, lambda p: total(p, lambda e: e["a"] * F.get(x, e["at"])))
            return let(through, lambda y: F.transform(rows, lambda row, j: (1 - DAMPING) / n + DAMPING * (
                total(row, lambda e: e["b"] * F.get(y, e["at"])) - F.get(diagonal, j) * F.get(x, j))))
        return let(F.zip_with(r, inverse, lambda a, b: a * b), spread)

    return let(totals, lambda sums: let(own, lambda diagonal: let(
        inverse_out(sums, diagonal),
        lambda inverse: _iterate(lambda r: step(r, inverse, diagonal), n))))


def sentence_scores(table: DataFrame, key: str) -> DataFrame:
    """(key, scores): centrality of each sentence, rounded; documents of at least two sentences."""
    graph = _sentence_graph(table.where(F.size("sentences") > 1), key)
    n = F.size("rows")
    scores = _sentence_scores(F.col("posts"), F.col("rows"), n)
    return graph.select(key, F.transform(scores, lambda s: F.round(s, SCORE_DIGITS)).alias("scores"))


def summarize(table: DataFrame, key: str) -> DataFrame:
    """(key, summary): the most central sentences in text order, one per line.

    ``table`` has key, sentences and n_chars, the length of the text that sets
    the share of sentences to keep.  One-sentence texts pass through.
    """
    some = table.where(F.size("sentences") > 0)
    n = F.size("sentences")
    keep = F.floor((n * summary_tenths(F.col("n_chars")) + 9) / 10).cast("int")
    ranked = F.array_sort(F.transform("scores", lambda s, j: F.struct((-s).alias("score"), j.alias("pos"))))
    best = F.array_sort(F.transform(F.slice(ranked, 1, keep), lambda s: s["pos"]))
    chosen = F.transform(best, lambda p: F.get("sentences", p))
    return some.join(sentence_scores(some, key), key, "left").select(
        key, F.array_join(F.when(F.col("scores").isNull(), F.col("sentences")).otherwise(chosen), "\n").alias("summary"))


def keywords(
    docs: DataFrame, key: str, column: str = "text", n_words: int = N_KEYWORDS, forms: DataFrame | None = None,
) -> DataFrame:
    """(key, rank, word): the most central words of the graph that joins neighbouring words.

    Words are lower-cased, stop words dropped.  With ``forms`` (word, form) the
    forms of a word are one word; see ``vocabulary.word_forms``.
    """
    # Texts without words give empty lists; a filter here would split every text twice.
    worded = docs.select(key, tx.words(F.col(column)).alias("w"))
    if forms is not None:
        worded = written(in_base_forms(worded, key, forms), "words")
    # One shuffle by document; its graph is built and ranked inside a task, many documents at once.
    lists = worded.repartition(shuffle_width(docs.sparkSession), key).groupBy(key).agg(F.collect_list("w").alias("lists"))
    fields = f"`{key}` {lists.schema[key].dataType.simpleString()}, rank int, word string"
    return lists.mapInArrow(partial(_ranked_words, n_words=n_words), fields)


def _ranked_words(batches: Iterator[pa.RecordBatch], n_words: int) -> Iterator[pa.RecordBatch]:
    """(key, lists of words) -> (key, rank, word), some documents of about ``TOGETHER`` words at a time."""
    for batch in batches:
        key, lists = batch.columns
        first = np.asarray(lists.offsets)
        ends = np.asarray(lists.values.offsets)[first] if len(lists.values) else first
        share = (ends[1:] - ends[0]) // TOGETHER
        for part in np.unique(share):
            some = np.flatnonzero(share == part)
            lo, hi = int(some[0]), int(some[-1]) + 1
            doc, rank, word = _central_words(lists.slice(lo, hi - lo), n_words)
            yield pa.RecordBatch.from_arrays(
                [key.take(pa.array(doc + lo)), pa.array(rank, pa.int32()), word], names=[batch.schema.names[0], "rank", "word"])


def _central_words(lists: pa.ListArray, n_words: int) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(document, rank, word) of documents given as lists of words each; several lists of a document are read side by side.

    A list of one word repeated gives that word, once for each such list, beside what the document's graph gives.
    """
    n_docs = len(lists)
    owner = np.repeat(np.arange(n_docs), np.diff(np.asarray(lists.offsets)))  # document of a list
    inner = lists.flatten()
    size = np.diff(np.asarray(inner.offsets))
    words = inner.flatten().dictionary_encode()
    spelled = words.dictionary
    by_name = np.asarray(pc.sort_indices(spelled))
    name = np.empty(len(by_name), dtype=np.int64)
    name[by_name] = np.arange(len(by_name))
    code = name[np.asarray(words.indices)]  # codes in the order of the words
    row = np.repeat(np.arange(len(size)), size)
    start = np.cumsum(size) - size
    place = np.arange(len(code)) - start[row]
    differs = np.bincount(row, weights=code != code[start[row]], minlength=len(size)) > 0
    one = np.flatnonzero(~differs & (size > 0))

    order = np.lexsort((place, owner[row]))  # keeps lists of one document side by side, and single lists as they are
    doc, code_at = owner[row][order], code[order]
    nodes, node = np.unique(doc * len(by_name) + code_at, return_inverse=True)
    step = (doc[1:] == doc[:-1]) & (node[1:] != node[:-1])
    u, v = node[:-1][step], node[1:][step]
    edges = np.unique(np.concatenate([u * len(nodes) + v, v * len(nodes) + u]))
    u, v = edges // max(len(nodes), 1), edges % max(len(nodes), 1)
    degree = np.bincount(u, minlength=len(nodes))
    linked = degree > 0
    of_doc = nodes // max(len(by_name), 1)
    n = np.maximum(np.bincount(of_doc[linked], minlength=n_docs), 1)[of_doc]
    scores, out = 1.0 / n, np.maximum(degree, 1)
    for _ in range(ROUNDS):
        scores = (1 - DAMPING) / n + DAMPING * np.bincount(v, weights=(scores / out)[u], minlength=len(nodes))
    rounded = np.floor(scores * 10 ** SCORE_DIGITS + 0.5)
    at = np.flatnonzero(linked)
    at = at[np.lexsort((nodes[at], -rounded[at], of_doc[at]))]
    count = np.bincount(of_doc[at], minlength=n_docs)
    rank = np.arange(len(at)) - (np.cumsum(count) - count)[of_doc[at]]
    at, rank = at[rank < n_words], rank[rank < n_words]
    best = np.concatenate([nodes[at] % max(len(by_name), 1), code[start[one]]])
    word = spelled.take(pa.array(by_name[best]))
    return np.concatenate([of_doc[at], owner[one]]), np.concatenate([rank + 1, np.ones(len(one), dtype=np.int64)]), word
