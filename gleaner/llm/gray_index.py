"""SimHash near duplicates over a Gray-order hierarchical index.

A text's fingerprint has a bit set where over half the hashes of its 3-word shingles have it (repeats count; lower case A-Z, words
separated by the six ASCII blanks; a shorter text is one shingle, a text without words has fingerprint zero and links like any
other).  Fingerprints with at most two differing bits are linked, and a component is named by its smallest doc_id.

Each different fingerprint is one node, however many texts have it.  Two that differ in at most two bits agree on one of three
blocks of bits, so nodes are dealt by the values of three blocks; a block value shared by more than LIMIT nodes is divided by
three blocks of the bits that are left, and so on, so what one task indexes is bounded and no pair is lost.

Inside a bucket the fingerprints are sorted by Gray rank, so neighbours share most bits.  Every FAN neighbours get a node above
them that holds the bits they all share and the mask of those, and so on up to a root.  A search goes down from the root and adds
to the differences so far those in the bits that a node's mask has beyond its parent's; a whole group is left as soon as the sum
exceeds the limit.  At a leaf the sum is the distance.  A bucket reports a spanning star for each of its components, never its
links, and components of the stars are those of the links.

Null and empty texts have fingerprint zero; repeated rows share a component; rows without an identifier take part, but name a
component only if it has no other rows (null then); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from gleaner.llm.common import pinned, spread
from gleaner.llm.components import components

SHINGLE = 3
SEED = 42
DIFFERING = 2
BITS = 64
#: Fingerprints under one node of the index.
FAN = 8
#: Most fingerprints of a bucket that is indexed whole; larger ones are divided.
LIMIT = 4096
#: Hashes counted, and pairs of a query and a node followed, at once.
AT_ONCE = 1 << 18

SIGNED = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])
STAR = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def fingerprint(text: bytes) -> int:
    """The 64-bit SimHash of a text."""
    words = text.lower().split()  # bytes: A-Z and ASCII blanks only
    if not words:
        return 0
    spelled = b" ".join(words)
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    stop = np.cumsum(size + 1) - 1
    start = (stop - size)[:max(1, len(words) - SHINGLE + 1)].tolist()
    stop = stop[min(SHINGLE, len(words)) - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    counts, n = np.zeros(BITS, dtype=np.int64), len(start)
    for at in range(0, n, AT_ONCE):
        some = zip(start[at:at + AT_ONCE], stop[at:at + AT_ONCE], strict=True)
        hashes = np.fromiter((digest(spelled[i:j], SEED) for i, j in some), dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        codes = np.fromiter((fingerprint(t.as_py() or b"") for t in batch.column(1)), dtype=np.uint64, count=batch.num_rows)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(codes.view(np.int64))], schema=SIGNED)


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The place of a code in the reflected Gray sequence."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """One tree per bucket over codes sorted by (bucket, Gray rank)."""

    def __init__(self, codes: np.ndarray, sizes: np.ndarray) -> None:
        self.codes, self.sizes = codes, sizes
        every = np.full(len(codes), np.iinfo(np.uint64).max, dtype=np.uint64)
        #: From the leaves up: mask and bits of a node, its last leaf, its first child and their number.
        self.levels = [(every, codes, np.arange(len(codes)), None, None)]
        low, high, last = codes, codes, np.arange(len(codes))
        while sizes.max(initial=1) > 1:
            groups = -(-sizes // FAN)
            place = spread(np.zeros(len(sizes), dtype=np.int64), groups)
            first = np.repeat(np.cumsum(sizes) - sizes, groups) + place * FAN
            count = np.minimum(np.repeat(sizes, groups) - place * FAN, FAN)
            low, high = np.bitwise_and.reduceat(low, first), np.bitwise_or.reduceat(high, first)
            last, sizes = last[first + count - 1], groups
            self.levels.append((~(low ^ high), low, last, first, count))

    def near(self, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Arrays (i, j), i < j: places of codes of one bucket with at most `limit` differing bits."""
        bucket = np.repeat(np.arange(len(self.sizes)), self.sizes)
        share = np.cumsum(np.repeat(self.sizes, self.sizes)) // AT_ONCE
        cuts = [0, *(np.flatnonzero(np.diff(share)) + 1).tolist(), len(bucket)]
        for low, high in zip(cuts, cuts[1:], strict=False):
            yield self._search(np.arange(low, high), bucket[low:high], limit)

    def _search(self, query: np.ndarray, node: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
        code = self.codes
        mask, bits, last, first, count = self.levels[-1]
        sum_ = np.bitwise_count((code[query] ^ bits[node]) & mask[node]).astype(np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            mask, bits, last, first, count = self.levels[level]
            keep = (sum_ <= limit) & (last[node] > query)
            query, node, sum_ = query[keep], node[keep], sum_[keep]
            if not level:
                break
            n = count[node]
            child = spread(first[node], n)
            query, held, sum_ = np.repeat(query, n), np.repeat(mask[node], n), np.repeat(sum_, n)
            own_mask, own_bits = self.levels[level - 1][0][child], self.levels[level - 1][1][child]
            sum_ = sum_ + np.bitwise_count((code[query] ^ own_bits) & own_mask & ~held)
            node = child
        return query, node


def stars(n: int, links: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The smallest member of the component of each of n places."""
    root = np.arange(n)
    for a, b in links:
        while len(a):
            x, y = root[a], root[b]
            apart = x != y
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
            while (root[root] != root).any():
                root = root[root]
    return root


def _linked(limit: int):
    """Rows (mask, value, fp), whole buckets one after the other, to stars (a, b) of fingerprints."""
    def some(rows: np.ndarray) -> pa.RecordBatch:
        order = np.lexsort((gray_rank(rows[:, 2].view(np.uint64)), rows[:, 1], rows[:, 0]))
        rows = rows[order]
        new = np.flatnonzero(np.concatenate([[True], (rows[1:, :2] != rows[:-1, :2]).any(axis=1)]))
        codes = np.ascontiguousarray(rows[:, 2])
        root = stars(len(rows), GrayIndex(codes.view(np.uint64), np.diff(np.append(new, len(rows)))).near(limit))
        moved = np.flatnonzero(root != np.arange(len(rows)))
        return pa.RecordBatch.from_arrays([pa.array(codes[moved]), pa.array(codes[root[moved]])], schema=STAR)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((0, 3), dtype=np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            held = np.concatenate([held, np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])])
            if len(held) > AT_ONCE // 8:  # the last bucket may go on in the next batch
                last = int((held[:, :2] == held[-1, :2]).all(axis=1).sum())
                if last < len(held):
                    yield some(held[:-last])
                    held = held[-last:]
        if len(held):
            yield some(held)

    return run


def _blocks(mask: int) -> list[int]:
    """The mask with each third of the bits it leaves free."""
    free = [k for k in range(BITS) if not mask >> k & 1]
    return [mask | sum(1 << k for k in free[i::DIFFERING + 1]) for i in range(DIFFERING + 1)]


def _long(x: int) -> Column:
    return F.lit(x - (1 << BITS) if x >> (BITS - 1) else x).cast("long")


def links(codes: DataFrame) -> DataFrame:
    """Stars (a, b) that connect what `codes` (fp, each once) has within two differing bits."""
    masks, rows, found = [0], codes.select("fp", _long(0).alias("mask")), None
    while True:
        below = {m: _blocks(m) for m in masks}
        pairs = [c for m in masks for c in (_long(m), F.array(*map(_long, below[m])))]
        parts = F.explode(F.element_at(F.create_map(*pairs), F.col("mask")))
        members = rows.select("fp", parts.alias("mask")).select("fp", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("value"))
        sizes = members.groupBy("mask", "value").agg(F.count("*").alias("n")).filter("n > 1")
        members = pinned(members.join(sizes, ["mask", "value"]), "buckets")
        fit = members.filter(F.col("n") <= LIMIT).select("mask", "value", "fp")
        fit = fit.repartition("mask", "value").sortWithinPartitions("mask", "value")
        near = pinned(fit.mapInArrow(_linked(DIFFERING), "a long, b long"), "stars")
        found = near if found is None else found.unionByName(near)
        masks = sorted({c for m in masks for c in below[m]})
        rows = members.filter(F.col("n") > LIMIT).select("fp", "mask")
        if rows.isEmpty():
            return found


def near_components(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hexadecimal digits), component_id."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    signed = pinned(texts.mapInArrow(_signed, "doc_id long, fp long"), "signed")
    codes = pinned(signed.groupBy("fp").agg(F.min("doc_id").alias("id")), "codes")
    roots = components(links(codes.select("fp"))).select(F.col("node").alias("fp"), "root")
    rooted = pinned(codes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "rooted")
    named = rooted.groupBy("root").agg(F.min("id").alias("component_id"))
    of_code = rooted.select("fp", "root").join(named, "root").select("fp", "component_id")
    return signed.join(of_code, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
