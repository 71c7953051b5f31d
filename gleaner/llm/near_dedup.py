"""Near duplicates by ProbMinHash signatures, banding and exact verification.

A text is the weighted set of its runs of five words (lower case, letters and digits; a shorter text is one run); a run's weight
is its count to the power `damping`: 1 takes counts as they are (the query does), 0 makes it the plain set.  ProbMinHash lets every
run arrive in a Poisson process whose rate is the run's weight, each arrival at a random register; a register keeps the run
of its earliest arrival, and a run is followed only until its next arrival is later than every register's.  Two registers
agree with the probability Jaccard of the weighted sets, which for texts without repeated runs is the plain Jaccard.

Bands of registers give candidates; a link is a pair whose exact probability Jaccard is `least` or more, and a class is a connected
component of links.  Texts with the same words are one node.  In a bucket every node is first tested against one leader, which
joins most of what belongs together.  Buckets that still hold several classes are searched whole, in blocks of members by
signature; such a task reports which nodes could reach `least` with one of another class, and a spanning forest of the classes
that meet so.  Every tree of that forest is verified in blocks by the exact runs of its nodes: a task joins classes as it finds
links and tests no pair inside a class.  So pairs never are rows, however many nodes of a group are almost, but not quite, near.
With 32 bands of 6, a pair at 0.8 shares no bucket with probability 6e-5; the signature filter (4.5 standard deviations) adds
about 1e-5.

Null, empty and wordless texts are alone in their class; repeated rows and copies share a class; rows without an identifier
take part, but name a class only if no row of it has one; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType

from gleaner.llm.common import pinned, spread
from gleaner.llm.components import components

WORDS = 5
LEAST = 0.8
BANDS, ROWS = 32, 6
#: Nodes, and runs of all its nodes, that a block of a bucket or tree holds on average.
BLOCK, BLOCK_RUNS = 512, 500_000
CACHE_WORDS = 100_000
_WORD = re.compile(r"\w+")
_M1, _M2, _STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser."""
    x = (x ^ x >> np.uint64(30)) * _M1
    x = (x ^ x >> np.uint64(27)) * _M2
    return x ^ x >> np.uint64(31)


class _Hashes(dict):
    """Hash of a word, computed when it is first asked for."""

    def __missing__(self, word: str) -> int:
        if len(self) > CACHE_WORDS:
            self.clear()
        self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return self[word]


class Shingler:
    """Runs of five words as 64-bit hashes."""

    def __init__(self) -> None:
        self.known = _Hashes()

    def words(self, text: str | None) -> list[str]:
        return _WORD.findall(text.lower()) if text else []

    def __call__(self, words: list[str]) -> np.ndarray:
        h = np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))
        n = max(1, len(h) - WORDS + 1)
        out = np.zeros(n, dtype=np.uint64)
        for k in range(min(WORDS, len(h))):
            out = mixed(out + h[k:k + n] + _STEP)
        return out

    def weighted(self, text: str, damping: float) -> tuple[np.ndarray, np.ndarray]:
        """The different runs of a text, in order, and their weights."""
        with np.errstate(over="ignore"):
            runs, counts = np.unique(self(self.words(text)), return_counts=True)
        return runs, counts.astype(float) ** damping


def prob_jaccard(runs: np.ndarray, weights: np.ndarray, others: np.ndarray, their: np.ndarray) -> float:
    """Sum over common runs i of 1 / sum over all runs j of max(w_j / w_i, v_j / v_i)."""
    _, at, to = np.intersect1d(runs, others, assume_unique=True, return_indices=True)
    w, v = weights[at], their[to]
    order = np.argsort(w / v, kind="stable")
    w, v = w[order], v[order]
    first = weights.sum() - np.cumsum(w) + w  # of the runs whose ratio w / v is not smaller, and those the other lacks
    second = their.sum() - np.cumsum(v[::-1])[::-1]  # of the runs whose ratio is smaller, and those this one lacks
    return float((1 / (first / w + second / v)).sum())


def prob_minhash(runs: np.ndarray, weights: np.ndarray, registers: int) -> np.ndarray:
    """The run of the earliest arrival at each register."""
    times, owner = np.full(registers, np.inf), np.zeros(registers, dtype=np.uint64)
    clock, nth = np.zeros(len(runs)), 0
    horizon = registers * (np.log(registers) + 1) / weights.sum()
    with np.errstate(over="ignore"):
        while len(runs):
            block = int(min(64, max(2, np.ceil(horizon * weights.max() * 0.6)), max(2, 200_000 // len(runs))))
            steps = (np.arange(nth, nth + block, dtype=np.uint64) + np.uint64(1)) * _STEP
            draw = mixed(runs[:, None] + steps[None, :])
            u = ((draw >> np.uint64(11)).astype(np.float64) + 0.5) / 2**53
            at = clock[:, None] + np.cumsum(-np.log(u) / weights[:, None], axis=1)
            place = (mixed(draw ^ _M1) % np.uint64(registers)).astype(np.int64).ravel()
            who, when = np.repeat(runs, block), at.ravel()
            early = when < times[place]
            place, who, when = place[early], who[early], when[early]
            np.minimum.at(times, place, when)
            kept = when == times[place]
            owner[place[kept]] = who[kept]
            clock, nth = at[:, -1], nth + block
            going = clock < times.max()
            runs, weights, clock = runs[going], weights[going], clock[going]
    return owner


def _signed(damping: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingle = Shingler()
        for batch in batches:
            rows = []
            for doc, key, text in zip(batch["doc_id"], batch["key"], batch["text"], strict=True):
                words = shingle.words(text)
                if not words:
                    rows.append((doc, None, None, None, key))
                    continue
                with np.errstate(over="ignore"):
                    runs, counts = np.unique(shingle(words), return_counts=True)
                    owner = prob_minhash(runs, counts.astype(float) ** damping, BANDS * ROWS)
                    bands = np.arange(BANDS, dtype=np.uint64) * _STEP
                    for k in range(ROWS):
                        bands = mixed(bands ^ owner[k::ROWS])
                node = hashlib.blake2b(" ".join(words).encode("utf-8", "surrogatepass"), digest_size=16).digest()
                rows.append((doc, node, owner.astype("<u2").tobytes(), bands.view(np.int64), key))
            yield pd.DataFrame(rows, columns=["doc_id", "node", "sig", "bands", "key"]).astype({"doc_id": "Int64"})

    return run


@F.pandas_udf(DoubleType())
def agreement(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([float(np.mean(np.frombuffer(x, "<u2") == np.frombuffer(y, "<u2"))) for x, y in zip(a, b, strict=True)])


def similarity(damping: float):
    """UDF of two texts: the probability Jaccard of their weighted runs; equal texts on the left are read once in a row."""
    @F.pandas_udf(DoubleType())
    def measured(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        shingle = Shingler()
        for left, right in batches:
            out, last, own = [], None, None
            for x, y in zip(left, right, strict=True):
                own = own if x is last else shingle.weighted(x, damping)
                last = x
                out.append(prob_jaccard(*own, *shingle.weighted(y, damping)))
            yield pd.Series(out, dtype=float)

    return measured


def _plausible(least: float) -> float:
    m = BANDS * ROWS
    return least - 4.5 * (least * (1 - least) / m) ** 0.5


def _linked(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, least: float, damping: float) -> DataFrame:
    """Pairs (a, b) whose exact similarity is `least` or more; texts travel only for pairs whose signatures allow it."""
    sig = nodes.select("node", "sig")
    near = (
        pairs.join(sig.toDF("a", "sig_a"), "a").join(sig.toDF("b", "sig_b"), "b")
        .filter(agreement("sig_a", "sig_b") >= _plausible(least)).select("a", "b")
    )
    near = pinned(near, "near")
    both = near.join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b")
    return both.filter(similarity(damping)("text_a", "text_b") >= least - 1e-9).select("a", "b")


def _sides(group: pd.DataFrame, key: tuple) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(i, the others to compare it with, the share of registers that agree) of a block pair, or one block, sorted by node."""
    _, low, high = key
    sig, side = np.stack([np.frombuffer(s, "<u2") for s in group["sig"]]), group["block"].to_numpy()
    second = np.flatnonzero(side == high)
    for i in np.flatnonzero(side == low):
        others = second[np.searchsorted(second, i, "right"):] if low == high else second
        yield i, others, (sig[others] == sig[i]).mean(axis=1)


def _meetings(least: float):
    """Nodes of a block pair whose signatures could reach `least` with one of another class, and a forest of the classes that meet."""
    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("node", kind="stable")
        nodes, roots = group["node"].to_numpy(), group["root"].to_numpy()
        label = pd.factorize(roots)[0]
        tree, met, out = label.copy(), np.zeros(len(label), bool), []
        for i, others, share in _sides(group, key):
            others = others[(share >= _plausible(least)) & (label[others] != label[i])]
            met[others] = True
            met[i] |= len(others) > 0
            for j in others[tree[others] != tree[i]]:
                if tree[j] != tree[i]:
                    out.append((nodes[i], roots[i], roots[j]))
                    tree[tree == tree[j]] = tree[i]
        out += [(nodes[i], roots[i], roots[i]) for i in np.flatnonzero(met)]
        return pd.DataFrame(out, columns=["node", "root", "other"])

    return run


def _verified(least: float):
    """Links that join the classes of a block pair: at most one fewer than it has classes."""
    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("node", kind="stable")
        nodes, label = group["node"].to_numpy(), pd.factorize(group["root"])[0]
        runs = [np.frombuffer(r, "<u8") for r in group["runs"]]
        size = np.array([len(r) for r in runs])
        place = np.cumsum(size) - size
        which = np.unique(np.concatenate(runs), return_inverse=True)[1]
        weights = np.concatenate([np.frombuffer(w, "<f8") if w else np.ones(n) for w, n in zip(group["weights"], size, strict=True)])
        plain = np.array([not w for w in group["weights"]])
        shares = weights / np.repeat(np.add.reduceat(weights, place), size)
        own = np.zeros(which.max() + 1)
        out = []
        for i, others, share in _sides(group, key):
            others = others[(share >= _plausible(least)) & (label[others] != label[i])]
            if not len(others):
                continue
            mine = slice(place[i], place[i] + size[i])
            at, starts = spread(place[others], size[others]), np.cumsum(size[others]) - size[others]
            own[which[mine]] = 1.0
            common = np.add.reduceat(own[which[at]], starts)
            own[which[mine]] = shares[mine]
            bound = np.add.reduceat(np.minimum(own[which[at]], shares[at]), starts)  # never below the similarity
            own[which[mine]] = 0.0
            exact = plain[others] & plain[i]
            value = np.where(exact, common / (size[i] + size[others] - common), bound)
            for k in np.flatnonzero(value >= least - 1e-9):
                j = others[k]
                if label[j] == label[i]:
                    continue
                theirs = slice(place[j], place[j] + size[j])
                if exact[k] or prob_jaccard(runs[i], weights[mine], runs[j], weights[theirs]) >= least - 1e-9:
                    out.append((nodes[i], nodes[j]))
                    label[label == label[j]] = label[i]
        return pd.DataFrame(out, columns=["a", "b"])

    return run


def _paired(rows: DataFrame, blocks: Column) -> DataFrame:
    """Every row once for each block pair of its group that holds its own block: block, low, high."""
    rows = rows.withColumn("blocks", blocks.cast("int")).withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    rows = rows.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.withColumns({"low": F.least("block", "with"), "high": F.greatest("block", "with")}).drop("blocks", "with")


def _weighted_runs(damping: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingle = Shingler()
        for batch in batches:
            pairs = [shingle.weighted(text, damping) for text in batch.pop("text")]
            batch["runs"] = [r.astype("<u8").tobytes() for r, _ in pairs]
            batch["weights"] = [w.astype("<f8").tobytes() if (w != 1).any() else b"" for _, w in pairs]
            batch["size"] = [len(r) for r, _ in pairs]
            yield batch

    return run


def links(nodes: DataFrame, docs: DataFrame, least: float = LEAST, damping: float = 1.0, block: int = BLOCK) -> DataFrame:
    """Verified links (a, b) that connect every class of `nodes` (node, sig, bands, key); `docs` has (key, text).

    Only the texts of nodes that share a bucket are fetched.
    """
    members = nodes.select(F.explode("bands").alias("bucket"), "node")
    leaders = members.groupBy("bucket").agg(F.min("node").alias("leader"), F.count("*").alias("n")).filter("n > 1")
    members = pinned(members.join(leaders, "bucket"), "buckets")
    wanted = nodes.select("node", "key").join(members.select("node").distinct(), "node", "left_semi")
    texts = docs.join(wanted, "key").groupBy("node").agg(F.first("text").alias("text"))
    texts = pinned(texts, "texts")
    tested = members.filter("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    found = pinned(_linked(tested, nodes, texts, least, damping), "leader_links")
    apart = _meeting_nodes(members, nodes, components(found), least, block)

    described = apart.join(nodes.select("node", "sig"), "node").join(texts, "node").mapInPandas(
        _weighted_runs(damping), "node binary, root binary, tree binary, sig binary, runs binary, weights binary, size long"
    )
    described = pinned(described, "described")
    total = described.groupBy("tree").agg(F.count("*").alias("n"), F.sum("size").alias("size"))
    blocks = total.select("tree", F.greatest(F.ceil(F.col("n") / block), F.ceil(F.col("size") / BLOCK_RUNS)).alias("blocks"))
    placed = _paired(described.drop("size").join(blocks, "tree"), F.col("blocks"))
    more = placed.groupBy("tree", "low", "high").applyInPandas(_verified(least), "a binary, b binary")
    return found.unionByName(pinned(more, "more_links"))


def _meeting_nodes(members: DataFrame, nodes: DataFrame, roots: DataFrame, least: float, block: int) -> DataFrame:
    """(node, root, tree) of nodes that could be near one of another class in their bucket; a tree holds all classes that meet."""
    placed = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    open_ = placed.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi")
    rest = placed.join(open_.select("bucket"), "bucket", "left_semi").filter("n > 2")
    rest = _paired(rest, F.ceil(F.col("n") / block)).select("bucket", "low", "high", "block", "node", "root")
    rest = rest.join(nodes.select("node", "sig"), "node")
    met = rest.groupBy("bucket", "low", "high").applyInPandas(_meetings(least), "node binary, root binary, other binary")
    met = pinned(met, "meetings")
    trees = components(met.select(F.col("root").alias("a"), F.col("other").alias("b"))).toDF("root", "tree")
    return met.select("node", "root").distinct().join(trees, "root").select("node", "root", "tree")


def _classes(docs: DataFrame, least: float, damping: float, block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, key (of its text), root (null without words), class_id, class_size."""
    key = F.unhex(F.md5(F.col("text").cast("binary"))).alias("key")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), key, "text")
    signed = texts.mapInPandas(_signed(damping), "doc_id long, node binary, sig binary, bands array<long>, key binary")
    signed = pinned(signed, "signed")
    nodes = pinned(
        signed.filter("node is not null").groupBy("node").agg(*[F.first(c).alias(c) for c in ("sig", "bands", "key")]), "nodes"
    )
    roots = pinned(components(links(nodes, texts.select("key", "text"), least, damping, block)), "roots")
    ids = signed.select("doc_id", "node", "key")
    owned = ids.filter("node is not null").groupBy("node").agg(F.min("doc_id").alias("id"), F.count("*").alias("n"))
    owned = owned.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    classes = owned.groupBy("root").agg(F.min("id").alias("class_id"), F.sum("n").alias("class_size"))
    of_node = owned.select("node", "root").join(classes, "root").select("node", "root", "class_id", "class_size")
    return ids.join(of_node, "node", "left").select(
        "doc_id", "key", "root", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"),
    )


def near_classes(docs: DataFrame, least: float = LEAST, damping: float = 1.0, block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, class_id (smallest doc_id of the class), class_size."""
    return _classes(docs, least, damping, block).select("doc_id", "class_id", "class_size")


def drop_near(docs: DataFrame, least: float = LEAST, damping: float = 1.0) -> DataFrame:
    """One row of each class stays: one with the smallest doc_id; of texts without words, one of each repeated row."""
    own = _classes(docs, least, damping).filter("doc_id <=> class_id")
    one = own.filter("root is not null").groupBy("root").agg(F.first("doc_id").alias("doc_id"), F.min("key").alias("key"))
    kept = own.filter("root is null").select("doc_id", "key").distinct().unionByName(one.select("doc_id", "key"))
    kept = kept.select(F.col("doc_id").alias("__keep"), F.col("key").alias("__kept_key"))
    rows = docs.withColumn("__key", F.unhex(F.md5(F.col("text").cast("binary")))).dropDuplicates(["doc_id", "__key"])
    same = rows["doc_id"].eqNullSafe(F.col("__keep")) & F.col("__key").eqNullSafe(F.col("__kept_key"))
    return rows.join(kept, same, "left_semi").drop("__key")
