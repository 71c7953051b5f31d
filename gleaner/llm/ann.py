"""Nearest neighbours by hierarchical navigable small-world graphs.

Vectors are dealt over shards of about `shard_rows` by a hash of their identifier; a task builds one graph per shard, over its
distinct vectors, and stores it as flat arrays in one row (vectors, neighbours per layer, entry point).  Blocks of queries meet
every shard's graph (a stated query set against all rows, in blocks) and the shard results are merged by a limit per query
that Spark applies before its shuffle.  Equal vectors are one graph node with its identifiers, of which the k + 1 smallest can be
among any query's k nearest; so copies neither cut the graph into islands nor lose a place.

Nearness is the inner product, computed on the original components in double precision for what is returned.  For vectors of
unequal length the graph adds one component, sqrt(M^2 - |x|^2), that turns it into a distance.  Vectors that are null, zero or
hold null or non-finite components take no part; rows without an identifier neither; repeated rows (same identifier) count
once per row; vectors of another length than the most frequent one of the table take no part; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from gleaner.llm.common import pinned

K, M, EF_BUILD, EF_SEARCH = 20, 16, 80, 120
SHARD_ROWS, QUERY_ROWS = 8_192, 1_024


class Graph:
    """One HNSW graph: `near[layer]` holds M (2 M at the bottom) neighbours per node, -1 where there are fewer."""

    def __init__(self, x: np.ndarray, near: list[np.ndarray], entry: int) -> None:
        self.x, self.near, self.entry = x, near, entry

    def search(self, q: np.ndarray, start: list[tuple[float, int]], ef: int, layer: int, seen: np.ndarray, stamp: int):
        """The `ef` best (score, node) that a best-first walk from `start` finds."""
        x, near = self.x, self.near[layer]
        best = list(start)
        heapq.heapify(best)
        todo = [(-s, n) for s, n in start]
        heapq.heapify(todo)
        for _, n in start:
            seen[n] = stamp
        while todo:
            s, n = heapq.heappop(todo)
            if len(best) >= ef and -s < best[0][0]:
                break
            new = near[n]
            new = new[new >= 0]
            new = new[seen[new] != stamp]
            if not len(new):
                continue
            seen[new] = stamp
            for score, node in zip((x[new] @ q).tolist(), new.tolist(), strict=True):
                if len(best) < ef:
                    heapq.heappush(best, (score, node))
                    heapq.heappush(todo, (-score, node))
                elif score > best[0][0]:
                    heapq.heapreplace(best, (score, node))
                    heapq.heappush(todo, (-score, node))
        return best

    def descend(self, q: np.ndarray, down_to: int) -> list[tuple[float, int]]:
        """Greedy walk from the entry point to the layer above `down_to`."""
        at, score = self.entry, float(self.x[self.entry] @ q)
        for layer in range(len(self.near) - 1, down_to, -1):
            while True:
                new = self.near[layer][at]
                new = new[new >= 0]
                if not len(new):
                    break
                s = self.x[new] @ q
                j = int(s.argmax())
                if s[j] <= score:
                    break
                at, score = int(new[j]), float(s[j])
        return [(score, at)]


def _spread(x: np.ndarray, found: list[tuple[float, int]], most: int) -> list[int]:
    """Neighbours, best first, that are nearer to the node than to a neighbour already chosen; filled up by the rest."""
    order = [n for _, n in sorted(found, key=lambda f: (-f[0], f[1]))]
    if len(order) <= most:
        return order
    v = x[order]
    between = v @ v.T
    own = np.array([s for s, _ in sorted(found, key=lambda f: (-f[0], f[1]))])
    chosen: list[int] = []
    highest = np.full(len(order), -np.inf)
    for i in range(len(order)):
        if highest[i] < own[i]:
            chosen.append(i)
            if len(chosen) == most:
                break
            np.maximum(highest, between[i], out=highest)
    if len(chosen) < most:
        taken = set(chosen)
        chosen += [i for i in range(len(order)) if i not in taken][:most - len(chosen)]
    return [order[i] for i in chosen]


def build(x: np.ndarray, seed: int = 0) -> Graph:
    """A graph over rows of equal norm (largest inner product = nearest), inserted one by one."""
    n = len(x)
    levels = (-np.log(1 - np.random.default_rng(seed).random(n)) / math.log(M)).astype(int)
    near: list[np.ndarray] = [np.full((n, 2 * M if not k else M), -1, dtype=np.int32) for k in range(int(levels.max(initial=0)) + 1)]
    size = [np.zeros(n, dtype=np.int32) for _ in near]
    seen = np.zeros(n, dtype=np.int64)
    graph, top = Graph(x, near, 0), int(levels[0])
    stamp = 0
    for i in range(1, n):
        q, level = x[i], int(levels[i])
        full = graph.near
        graph.near = full[:top + 1]
        start = graph.descend(q, min(level, top))
        graph.near = full
        for layer in range(min(level, top), -1, -1):
            stamp += 1
            start = graph.search(q, start, EF_BUILD, layer, seen, stamp)
            most = near[layer].shape[1]
            own = _spread(x, start, M)
            near[layer][i, :len(own)] = own
            size[layer][i] = len(own)
            for j in own:
                k = size[layer][j]
                if k < most:
                    near[layer][j, k] = i
                    size[layer][j] = k + 1
                else:
                    ids = [*near[layer][j].tolist(), i]
                    kept = _spread(x, list(zip((x[ids] @ x[j]).tolist(), ids, strict=True)), most)
                    near[layer][j] = -1
                    near[layer][j, :len(kept)] = kept
                    size[layer][j] = len(kept)
        if level > top:
            top, graph.entry = level, i
    return graph


def _usable(vector: Column, id_: Column) -> Column:
    bad = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    return id_.isNotNull() & vector.isNotNull() & ~F.exists(vector, bad) & F.exists(vector, lambda v: v != 0)


def _flat(group: pd.DataFrame) -> pd.DataFrame:
    """One row: the shard's graph as flat arrays."""
    group = group.sort_values("id", kind="stable")
    raw = np.stack(group["vector"].to_numpy()).astype(np.float64)
    ids = group["id"].to_numpy(np.int64)
    distinct, node = np.unique(raw, axis=0, return_inverse=True)
    order = np.argsort(node.ravel(), kind="stable")
    counts = np.bincount(node.ravel(), minlength=len(distinct))
    first = np.repeat(np.cumsum(counts) - counts, counts)
    kept = order[np.arange(len(order)) - first <= K]
    starts = np.concatenate([[0], np.cumsum(np.minimum(counts, K + 1))]).astype("<i8")
    square = (distinct**2).sum(axis=1)
    extra = np.sqrt(np.maximum(0, square.max() - square))
    extra = np.where(extra < 1e-3 * math.sqrt(square.max()), 0, extra)
    graph = build(np.column_stack([distinct, extra]).astype(np.float32))
    near = b"".join(a.astype("<i4").tobytes() for a in graph.near)
    return pd.DataFrame({
        "shard": [int(group["shard"].iloc[0])], "nodes": [len(distinct)], "layers": [len(graph.near)], "entry": [graph.entry],
        "vectors": [distinct.astype("<f8").tobytes()], "extra": [extra.astype("<f4").tobytes()], "near": [near],
        "starts": [starts.tobytes()], "ids": [ids[kept].astype("<i8").tobytes()],
    })


GRAPH = "shard int, nodes int, layers int, entry int, vectors binary, extra binary, near binary, starts binary, ids binary"


def index(rows: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per shard with its graph; `rows` has (id, vector)."""
    shards = max(1, math.ceil(rows.count() / shard_rows))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("id", F.lit(7)), F.lit(shards)).cast("int"))
    return pinned(dealt.groupBy("shard").applyInPandas(_flat, GRAPH), "graphs")


def _block(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values("id", kind="stable")
    return pd.DataFrame({
        "block": [int(group["block"].iloc[0])], "query_ids": [group["id"].to_numpy("<i8").tobytes()],
        "queries": [np.stack(group["vector"].to_numpy()).astype("<f8").tobytes()],
    })


def _searched(k: int, ef: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                n = r.nodes
                raw = np.frombuffer(r.vectors, "<f8").reshape(n, -1)
                extra = np.frombuffer(r.extra, "<f4")
                widths = [2 * M] + [M] * (r.layers - 1)
                flat, near, at = np.frombuffer(r.near, "<i4"), [], 0
                for w in widths:
                    near.append(flat[at:at + n * w].reshape(n, w))
                    at += n * w
                graph = Graph(np.column_stack([raw, extra]).astype(np.float32), near, r.entry)
                starts, ids = np.frombuffer(r.starts, "<i8"), np.frombuffer(r.ids, "<i8")
                seen, out = np.zeros(n, dtype=np.int64), []
                queries = np.frombuffer(r.queries, "<f8").reshape(-1, raw.shape[1])
                for stamp, (own, q) in enumerate(zip(np.frombuffer(r.query_ids, "<i8").tolist(), queries, strict=True), 1):
                    wide = np.append(q, 0).astype(np.float32)
                    hits = graph.search(wide, graph.descend(wide, 0), ef, 0, seen, stamp)
                    nodes = np.array([h[1] for h in hits])
                    found = []
                    for node, score in zip(nodes.tolist(), (raw[nodes] * q).sum(axis=1).tolist(), strict=True):
                        found += [(-score, i) for i in ids[starts[node]:starts[node + 1]].tolist() if i != own]
                    out += [(own, i, -s) for s, i in heapq.nsmallest(k, found)]
                yield pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    return run


def nearest(
    table: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K,
    ef: int = EF_SEARCH, shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every row of `table` that `is_query` selects."""
    vector = F.col(vector_col).cast("array<double>")
    rows = table.filter(_usable(vector, F.col(id_col))).select(
        F.col(id_col).cast("long").alias("id"), vector.alias("vector"), is_query.alias("is_query")
    )
    sizes = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").first()
    rows = rows.filter(F.size("vector") == (sizes["d"] if sizes else 0))
    graphs = index(rows.select("id", "vector"), shard_rows)
    queries = rows.filter("is_query").select("id", "vector").dropDuplicates(["id"])
    blocks = max(1, math.ceil(queries.count() / query_rows))
    queries = queries.withColumn("block", F.pmod(F.xxhash64("id", F.lit(11)), F.lit(blocks)).cast("int"))
    packed = pinned(
        queries.groupBy("block").applyInPandas(_block, "block int, query_ids binary, queries binary"), "query_blocks"
    )
    shards = graphs.agg(F.max("shard")).first()[0]
    pairs = packed.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards or 0))))
    hits = pairs.join(graphs, "shard").mapInPandas(_searched(k, ef), "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return pinned(hits, "hits").withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
