"""Exact duplicates by Patricia tries.

Texts are equal when their normalised forms (runs of ASCII white space are one space) are identical byte for byte.  Every map
task inserts its texts into a compressed radix trie whose terminal nodes hold the smallest identifier and the number of
rows; that pre-aggregates hot texts before the shuffle.  The nodes' full byte strings are then dealt by length and content
hash, sorted by both, and merged in a second trie.  A trie that reaches its byte budget is emitted and dropped: in the map
step at any point, in the merge step between two (length, hash) keys, where the finished subtrees can't be met again.

Null texts count as empty; rows without an identifier take part and lose against any identifier; repeated rows count each;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

SPACE = r"[\x20\x09-\x0D]+"
#: Bytes of keys a trie may hold before finished subtrees are emitted.
TRIE_BYTES = 32 << 20


class Patricia:
    """A compressed radix trie over byte strings; a terminal holds [smallest id, rows, tag]."""

    def __init__(self) -> None:
        self.root: list = [b"", None, {}]
        self.bytes = 0

    def insert(self, key: bytes, owner: int | None, rows: int, tag: object) -> None:
        node, at = self.root, 0
        while True:
            if at == len(key):
                if node[1] is None:
                    node[1] = [owner, rows, tag]
                else:
                    held = node[1]
                    if held[0] is None or (owner is not None and owner < held[0]):
                        held[0] = owner
                    held[1] += rows
                return
            child = node[2].get(key[at])
            if child is None:
                node[2][key[at]] = [key[at:], [owner, rows, tag], {}]
                self.bytes += len(key) - at + 200
                return
            label = child[0]
            if not key.startswith(label, at):
                low, high = 1, min(len(label), len(key) - at)
                while low < high:  # length of the common prefix
                    mid = (low + high + 1) // 2
                    low, high = (mid, high) if key.startswith(label[:mid], at) else (low, mid - 1)
                lower = [label[low:], child[1], child[2]]
                child[0], child[1], child[2] = label[:low], None, {label[low]: lower}
                self.bytes += 200
                label = child[0]
            at += len(label)
            node = child

    def terminals(self) -> Iterator[tuple[bytes, list]]:
        """Every key with its terminal; the trie is empty afterwards."""
        stack = [(b"", self.root)]
        self.root, self.bytes = [b"", None, {}], 0
        while stack:
            prefix, node = stack.pop()
            key = prefix + node[0]
            if node[1] is not None:
                yield key, node[1]
            stack.extend((key, child) for child in node[2].values())


COLUMNS = "length long, hash long, key binary, sha string, keep_id long, group_size long"


def _frames(trie: Patricia, with_key: bool) -> Iterator[pd.DataFrame]:
    rows, held = [], 0
    for key, (owner, count, (length, digest, sha)) in trie.terminals():
        rows.append((length, digest, key if with_key else None, sha, owner, count))
        held += len(key)
        if held > 8 << 20:
            yield _frame(rows)
            rows, held = [], 0
    if rows:
        yield _frame(rows)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=["length", "hash", "key", "sha", "keep_id", "group_size"])
    return frame.astype({"keep_id": "Int64"})


def _inserted(merge: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trie, last = Patricia(), None
        for batch in batches:
            ids = batch["keep_id"].astype(object).where(batch["keep_id"].notna(), None)
            for length, digest, key, sha, owner, count in zip(
                batch["length"], batch["hash"], batch["key"], batch["sha"], ids, batch["group_size"], strict=True
            ):
                if trie.bytes > TRIE_BYTES and (not merge or (length, digest) != last):
                    yield from _frames(trie, not merge)
                last = (length, digest)
                trie.insert(bytes(key), None if owner is None else int(owner), int(count), (length, digest, sha))
        yield from _frames(trie, not merge)

    return run


def owners(keys: DataFrame) -> DataFrame:
    """(length, hash, sha, keep_id, group_size) of every distinct key of a frame with COLUMNS."""
    local = keys.mapInPandas(_inserted(merge=False), COLUMNS)
    dealt = local.repartition("length", "hash").sortWithinPartitions("length", "hash")
    return dealt.mapInPandas(_inserted(merge=True), COLUMNS).drop("key")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    norm = F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), SPACE, " ")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), norm.alias("norm"))
    sha = F.sha2(F.col("norm").cast("binary"), 256)
    keys = rows.select(
        F.octet_length("norm").cast("long").alias("length"), F.xxhash64("norm").alias("hash"),
        F.col("norm").cast("binary").alias("key"), sha.alias("sha"), F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
    )
    ids = rows.select("doc_id", sha.alias("sha"))
    return ids.join(owners(keys).select("sha", "keep_id", "group_size"), "sha").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """The documents without exact copies: of equal texts, one row with the smallest doc_id stays."""
    norm = F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), SPACE, " ")
    rows = docs.withColumn("__sha", F.sha2(norm.cast("binary"), 256)).dropDuplicates(["doc_id", "__sha"])
    kept = exact_groups(docs).filter("kept").select(F.col("doc_id").alias("__keep"), F.col("text_sha256").alias("__kept_sha")).distinct()
    same = rows["doc_id"].eqNullSafe(F.col("__keep")) & (F.col("__sha") == F.col("__kept_sha"))
    return rows.join(kept, same, "left_semi").drop("__sha")


ORACLE = r"""
WITH n AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h FROM documents),
g AS (SELECT h, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY h)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, h AS text_sha256 FROM n JOIN g USING (h)
"""
