"""Toxicity by a classifier chain.

Linear (logistic) models over the presence of words and word beginnings, one per category, in order; each later model also
gets the log-odds that the earlier ones give.  While training those are out-of-fold predictions, so a later model never sees
how well an earlier one knows its own training rows.  The categories are the label column `toxic` and `severe`: toxic rows
whose number of toxic features is above the median of the toxic rows.

Training reads at most `sample_rows` labelled rows (lowest hash of the id) and keeps at most `vocabulary` features, chosen by
the z-score of their share in toxic rows; both bounds are parameters.  All documents are scored, whole.  Null texts count as
empty; labels without a document or without a value are left out; of several labels of an id the highest holds; without
toxic (or without clean) labels nothing is toxic; repeated rows are scored each; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

CATEGORIES = ("toxic", "severe")
SAMPLE_ROWS = 8_000
VOCABULARY = 4_096
FOLDS = 4
CACHE_WORDS = 100_000
_WORD = re.compile(r"\w+")


def features(word: str) -> tuple[str, ...]:
    """The word and its beginnings of three to five characters."""
    return (word, *("^" + word[:n] for n in (3, 4, 5) if len(word) >= n))


def _words(text: str | None) -> set[str]:
    return set(_WORD.findall(text.lower())) if text else set()


@dataclass
class Linear:
    weights: np.ndarray
    bias: float

    def margin(self, rows: np.ndarray, cols: np.ndarray, n: int, extra: np.ndarray) -> np.ndarray:
        k = len(self.weights) - extra.shape[1]
        return np.bincount(rows, self.weights[cols], minlength=n) + self.bias + extra @ self.weights[k:]


def fit_linear(rows, cols, extra, y, k, l2=0.03, rounds=400) -> Linear:
    """Logistic regression by accelerated gradient steps on sparse presence features and dense extra columns."""
    n, d = len(y), k + extra.shape[1]
    if not 0 < y.sum() < n:
        return Linear(np.zeros(d), -20.0 if not y.sum() else -1e-9)
    w, v = np.zeros(d + 1), np.zeros(d + 1)
    w[d] = v[d] = np.log(y.mean() / (1 - y.mean()))
    per_row = np.bincount(rows, minlength=n).max(initial=0) + (extra**2).sum(axis=1).max(initial=0) + 1
    seen = np.concatenate([np.bincount(cols, minlength=k), (extra**2).sum(axis=0), [n]]) * 0.25 + l2
    step = 1 / (seen * min(per_row, 8.0))
    for i in range(rounds):
        z = np.bincount(rows, v[cols], minlength=n) + extra @ v[k:d] + v[d]
        g = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        grad = np.concatenate([np.bincount(cols, g[rows], minlength=k), extra.T @ g, [g.sum()]])
        grad[:d] += l2 * v[:d]
        new = v - step * grad
        v = new + i / (i + 3) * (new - w)
        w = new
    return Linear(w[:d], float(w[d]))


def _logit(z: np.ndarray) -> np.ndarray:
    return np.clip(z, -10, 10)


@dataclass
class Chain:
    """A trained chain: the feature index and one linear model per category."""

    index: dict[str, int]
    models: list[Linear]

    def probabilities(self, found: list[np.ndarray]) -> np.ndarray:
        """One row per list of feature numbers, one column per category."""
        n = len(found)
        rows = np.repeat(np.arange(n), [len(f) for f in found])
        cols = np.concatenate([*found, np.zeros(0, int)]).astype(int)
        extra = np.zeros((n, 0))
        for model in self.models:
            extra = np.column_stack([extra, _logit(model.margin(rows, cols, n, extra))])
        return 1 / (1 + np.exp(-extra))


def fit_chain(found: list[np.ndarray], labels: np.ndarray, folds: np.ndarray, index: dict[str, int]) -> Chain:
    """Models in category order; earlier categories enter by their out-of-fold log-odds."""
    n, k = len(found), len(index)
    sizes = np.array([len(f) for f in found], dtype=int)
    rows, cols = np.repeat(np.arange(n), sizes), np.concatenate([*found, np.zeros(0, int)]).astype(int)
    extra, models = np.zeros((n, 0)), []
    for c in range(labels.shape[1]):
        y = labels[:, c].astype(float)
        models.append(fit_linear(rows, cols, extra, y, k))
        held = np.zeros(n)
        for fold in range(FOLDS if c + 1 < labels.shape[1] else 0):
            inside = folds != fold
            at = np.cumsum(inside) - 1
            use = inside[rows]
            model = fit_linear(at[rows[use]], cols[use], extra[inside], y[inside], k)
            held = np.where(inside, held, model.margin(rows, cols, n, extra))
        extra = np.column_stack([extra, _logit(held)])
    return Chain(index, models)


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        n, pos = Counter(), Counter()
        for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
            own = {f for w in _words(text) for f in features(w)}
            n.update(own)
            if toxic:
                pos.update(own)
        yield pd.DataFrame({"feature": list(n), "n": list(n.values()), "pos": [pos[f] for f in n]})


def _indexed(index: dict[str, int]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [sorted({index[f] for w in _words(t) for f in features(w) if f in index}) for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "toxic": batch["toxic"], "found": found})

    return run


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, vocabulary: int = VOCABULARY) -> Chain:
    known = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    picked = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    rows = docs.select("doc_id", "text").join(picked, "doc_id").dropDuplicates(["doc_id", "text"])
    counts = rows.select("text", "toxic").mapInPandas(_counted, "feature string, n long, pos long")
    counts = counts.groupBy("feature").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos")).filter("n >= 3")
    total = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("pos")).first()
    n1, n0 = total["pos"], total["n"] - total["pos"]
    if not n1 or not n0:
        return Chain({}, [Linear(np.zeros(c), -20.0) for c in range(len(CATEGORIES))])
    share = (F.col("n") / total["n"]).cast("double")
    spread = F.sqrt(share * (1 - share) * (1 / n1 + 1 / n0) + 1e-12)
    z = (F.col("pos") / n1 - (F.col("n") - F.col("pos")) / n0) / spread
    chosen = counts.withColumn("z", z).filter("abs(z) >= 2.5").orderBy(F.abs("z").desc(), "feature").limit(vocabulary).collect()
    index = {r["feature"]: i for i, r in enumerate(chosen)}
    strong = np.array([r["z"] > 0 for r in chosen], dtype=bool)
    sample = rows.mapInPandas(_indexed(index), "doc_id long, toxic int, found array<int>").toPandas()
    sample = sample.sort_values("doc_id", kind="stable")
    found = [np.asarray(f, dtype=int) for f in sample["found"]]
    toxic = sample["toxic"].to_numpy() > 0
    hits = np.array([strong[f].sum() for f in found])
    severe = toxic & (hits > np.median(hits[toxic]))
    folds = sample["doc_id"].to_numpy() * 2654435761 % (1 << 32) % FOLDS
    return fit_chain(found, np.column_stack([toxic, severe]), folds, index)


def score(chain: Chain) -> Column:
    """Struct of one probability per category for the column `text`."""
    index = chain.index

    @F.pandas_udf(", ".join(f"p_{c} double" for c in CATEGORIES))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        cache: dict[str, tuple[int, ...]] = {}
        for texts in batches:
            found = []
            for text in texts:
                own: set[int] = set()
                for word in _words(text):
                    hit = cache.get(word)
                    if hit is None:
                        if len(cache) >= CACHE_WORDS:
                            cache.clear()
                        hit = cache[word] = tuple(index[f] for f in features(word) if f in index)
                    if hit:
                        own.update(hit)
                found.append(np.fromiter(sorted(own), dtype=int, count=len(own)))
            yield pd.DataFrame(chain.probabilities(found), columns=[f"p_{c}" for c in CATEGORIES])

    return run(F.col("text"))


def toxic_scores(docs: DataFrame, chain: Chain, least: float = 0.5) -> DataFrame:
    """One row per document: doc_id, p_toxic, p_severe, toxic, severe."""
    scored = docs.select("doc_id", score(chain).alias("p")).select("doc_id", "p.*")
    return scored.select("*", *[(F.col(f"p_{c}") >= least).alias(c) for c in CATEGORIES])


def drop_toxic(docs: DataFrame, chain: Chain, least: float = 0.5) -> DataFrame:
    return docs.withColumn("__p", score(chain)).filter(F.col("__p.p_toxic") < least).drop("__p")
