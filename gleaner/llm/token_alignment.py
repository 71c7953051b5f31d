"""Alignment of two tokenizers' ids over the same bytes.

A byte-level BPE (A) encodes a blank and the text, a SentencePiece model (B) the text, to which it adds the blank itself.  Byte
offsets where tokens of both end cut the tokens into groups; the A and B tokens of a group are linked, and the count of a pair of
ids is the number of documents that hold it linked.

Neither tokenizer joins a character to a blank after it (a piece of B that did would be refused), so both cut a text before each
space that follows a character other than white space, and what lies between (a unit, mostly a word) is encoded the same
anywhere.  A worker encodes and aligns a unit once; documents are rows of unit numbers.

Identity map: an array over A's ids names the B id of the same bytes.  Pairs of that kind (all groups of one token each, but
where B has two ids for the bytes) are counted in one vector of the length of A's vocabulary per task, which is all that is
shuffled of them.  Only pairs of irregular groups enter the pair shuffle, once per chunk of documents that holds them; the totals
go back to the chunks, not to the documents, and a chunk's documents are summed up by units.  Chunks are bounded by words, vectors
by the vocabulary; no row is made per link.

Null, empty and wordless texts, and those whose joined A or B bytes differ from blank and text (a text with U+2581, for one), have
no tokens and count for nothing; repeated rows and rows without an identifier are documents of their own; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from gleaner.llm.common import pinned, spread

#: Words after which a chunk of documents is closed.
CHUNK_WORDS = 1_000_000
#: Units a worker knows before it forgets them all.
CACHE_UNITS = 300_000
#: Units encoded as one text; documents whose new units are looked for together; entries of one array in a row.
TOGETHER, DOCUMENTS, BLOCK = 4096, 256, 8192
#: Pairs expanded at once.
AT_ONCE = 2_000_000
B_BITS = 15
MARK = "▁"
_BLANK_BEFORE_SPACE = re.compile(r"\s ")
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")
NONE = np.zeros(0, dtype=np.int64)


def units(text: str) -> list[str]:
    """A text cut before each space that follows a character other than white space; the space is left out."""
    parts = text.split(" ")
    if not _BLANK_BEFORE_SPACE.search(" " + text):
        return parts
    out = [parts[0]]
    for part in parts[1:]:
        if not out[-1] or out[-1][-1].isspace():
            out[-1] += " " + part
        else:
            out.append(part)
    return out


def byte_of() -> dict[str, int]:
    """The byte for each letter of a byte-level vocabulary: printable Latin-1 stands for itself, the rest for 256 and on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}


def _summed(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys, place = np.unique(keys, return_inverse=True)
    return keys, np.bincount(place, weights=times, minlength=len(keys)).astype(np.int64)


def packed(numbers: np.ndarray) -> bytes:
    """Small numbers as bytes of one weight after the other, compressed; most are below 256 or 65,536."""
    return zlib.compress(numbers.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def unpacked(stored: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(stored), dtype=np.uint8).reshape(4, -1).T.copy().view("<i4").ravel().astype(np.int64)


class Aligner:
    """Both tokenizers and the units a worker has aligned."""

    def __init__(self, path_a: str, path_b: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=path_b)
        letters = byte_of()
        spelled = sorted((i, t) for t, i in self.a.get_vocab(with_added_tokens=True).items())
        self.bytes_a = [b""] * (spelled[-1][0] + 1)
        for i, t in spelled:
            self.bytes_a[i] = bytes(letters[c] for c in t) if all(c in letters for c in t) else t.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces) or len(pieces) >> B_BITS:
            raise ValueError("pieces across blanks, or too many pieces")
        self.bytes_b = [bytes([int(m[1], 16)]) if (m := _BYTE.fullmatch(p)) else p.replace(MARK, " ").encode() for p in pieces]
        self.len_a, self.len_b = (np.array([len(x) for x in t], dtype=np.int64) for t in (self.bytes_a, self.bytes_b))
        #: A's id to the B id of the same bytes, a piece rather than a byte; -1 without one.
        self.same = np.full(len(self.bytes_a), -1, dtype=np.int64)
        own = {x: i for i, x in sorted(enumerate(self.bytes_b), key=lambda e: (not _BYTE.fullmatch(pieces[e[0]]), -e[0]))}
        for i, x in enumerate(self.bytes_a):
            self.same[i] = own.get(x, -1)
        #: Decimal ids followed by what may come after them.
        self.words_a = [b"%d%s" % (i, s) for i in range(len(self.bytes_a)) for s in (b",", b"|")]
        self.words_b = [b"%d%s" % (i, s) for i in range(len(pieces)) for s in (b",", b";", b"\n")]
        self.words = self.words_a + self.words_b
        self.start = self.b.encode("a")
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.groups: list[bytes] = []  # of a unit, spelled
        self.bad: set[int] = set()
        self.parts: list[tuple[np.ndarray, ...]] = []

    def identical(self, pairs: np.ndarray) -> np.ndarray:
        return self.same[pairs >> B_BITS] == (pairs & ((1 << B_BITS) - 1))

    def learn(self, new: list[str]) -> None:
        plain = [u for u in new if u and MARK not in u and not u[-1].isspace()]
        for at in range(0, len(plain), TOGETHER):
            self._encode(plain[at:at + TOGETHER])
        for u in new:
            if u not in self.number:
                spelled = " " + u
                ids = None if MARK in u else (self.a.encode(spelled, add_special_tokens=False).ids, self.b.encode("a" + spelled))
                if ids is None or not self._align([u], ids[0], ids[1][len(self.start):]):
                    self._refuse(u)

    def _encode(self, some: list[str]) -> None:
        text = " ".join(some)
        if not self._align(some, self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)):
            if len(some) == 1:
                self._refuse(some[0])
            else:
                self._encode(some[:len(some) // 2])
                self._encode(some[len(some) // 2:])

    def _refuse(self, unit: str) -> None:
        self.bad.add(len(self.groups))
        self._add([unit], [b""], np.zeros((1, 4), dtype=np.int64), np.zeros(1, dtype=np.int64), NONE, NONE)

    def _add(self, some, spelled, sums, n_pairs, pairs, times) -> None:
        for u in some:
            self.number[u] = len(self.number)
        self.groups += spelled
        self.parts.append((sums, n_pairs, pairs, times))

    def _align(self, some: list[str], ids_a: list[int], ids_b: list[int]) -> bool:
        """Groups and pairs of units that were encoded as one text; False if bytes differ from theirs."""
        raw = [b" " + u.encode() for u in some]
        whole = b"".join(raw)
        if b"".join(map(self.bytes_a.__getitem__, ids_a)) != whole or b"".join(map(self.bytes_b.__getitem__, ids_b)) != whole:
            return False
        a, b = np.array(ids_a, dtype=np.int64), np.array(ids_b, dtype=np.int64)
        end_a, end_b = np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b])
        end_unit = np.cumsum([len(r) for r in raw])
        marked = np.zeros(len(whole) + 1, dtype=bool)
        marked[end_b] = True
        last_a = marked[end_a]
        cut = end_a[last_a]
        if not np.isin(end_unit, cut, assume_unique=True).all():
            return False
        group_a, group_b = np.cumsum(last_a) - last_a, np.searchsorted(cut, end_b)
        last_b = np.append(group_b[1:] != group_b[:-1], True)
        unit = np.searchsorted(end_unit, cut)  # of each group
        n_a, n_b = np.bincount(group_a, minlength=len(cut)), np.bincount(group_b, minlength=len(cut))
        sums = np.column_stack([
            np.bincount(unit, weights=x, minlength=len(some)) for x in (n_a, n_b, np.ones(len(cut)), n_a * n_b)
        ]).astype(np.int64)

        # A's ids, then B's, of each group in turn, as places in the table of words.
        order = np.zeros(len(a) + len(b), dtype=np.int64)
        order[np.arange(len(a)) + (np.cumsum(n_b) - n_b)[group_a]] = 2 * a + last_a
        closing = last_b.astype(np.int64) + (last_b & np.append(unit[1:] != unit[:-1], True)[group_b])
        order[np.arange(len(b)) + np.cumsum(n_a)[group_b]] = len(self.words_a) + 3 * b + closing
        spelled = b"".join(map(self.words.__getitem__, order.tolist())).split(b"\n")[:-1]

        own_a, times_a = np.unique(group_a << 20 | a, return_counts=True)
        own_b, times_b = np.unique(group_b << 20 | b, return_counts=True)
        low, mask = (1 << 20) - 1, own_b >> 20
        first = np.searchsorted(mask, own_a >> 20)
        count = np.searchsorted(mask, own_a >> 20, side="right") - first
        share, found = np.cumsum(count) // AT_ONCE, []
        for part in range(int(share[-1]) + 1):
            k = np.flatnonzero(share == part)
            i, j = np.repeat(k, count[k]), spread(first[k], count[k])
            pair = (own_a[i] & low) << B_BITS | own_b[j] & low
            found.append(_summed(unit[own_a[i] >> 20] << 32 | pair, times_a[i] * times_b[j]))
        pairs, times = _summed(*map(np.concatenate, zip(*found, strict=True)))
        n_pairs = np.bincount(pairs >> 32, minlength=len(some))
        self._add(some, spelled, sums, n_pairs, pairs & ((1 << 32) - 1), times)
        return True

    def table(self) -> tuple[np.ndarray, ...]:
        """Of all units known: sums (A, B, groups, links), number of pairs, pairs, times."""
        if len(self.parts) > 1:
            self.parts = [tuple(map(np.concatenate, zip(*self.parts, strict=True)))]
        return self.parts[0] if self.parts else (np.zeros((0, 4), dtype=np.int64), NONE, NONE, NONE)


@lru_cache(maxsize=1)
def aligner(path_a: str, path_b: str) -> Aligner:
    """One for each worker process; its tasks share what it has learnt."""
    return Aligner(path_a, path_b)


#: Rows of one document (0), of some units of a chunk (1), of pairs (2) and of identity pairs (3).
FIELDS = pa.schema([
    ("chunk", pa.int64()), ("kind", pa.int32()), ("nth", pa.int32()), ("doc_id", pa.int64()),
    ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()),
    ("x", pa.binary()), ("y", pa.binary()), ("z", pa.binary()),
    ("keys", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())),
])
STORED = (
    "chunk long, kind int, nth int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "x binary, y binary, z binary, keys array<long>, counts array<long>"
)


def _rows(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=FIELDS)


def _blocks(chunk: int, kind: int, keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(keys), BLOCK):
        yield _rows([{"chunk": chunk, "kind": kind, "keys": keys[at:at + BLOCK], "counts": counts[at:at + BLOCK]}])


def _chunk_rows(known: Aligner, chunk: int, docs: list[tuple], vector: np.ndarray) -> Iterator[pa.RecordBatch]:
    """What is stored of one chunk; identity pairs are added to the task's vector."""
    sums, n_pairs, pairs, times = known.table()
    used = [d for d in docs if d[1] is not None]
    all_units = np.concatenate([d[1] for d in used]) if used else np.zeros(0, dtype=np.int32)
    local, place = np.unique(all_units, return_inverse=True)
    size = n_pairs[local]
    entry = spread((np.cumsum(n_pairs) - n_pairs)[local], size)
    pair, often = pairs[entry], times[entry]
    distinct, pair_no = np.unique(pair, return_inverse=True)
    start, frequency = np.cumsum(size) - size, np.zeros(len(distinct), dtype=np.int64)

    rows, at, held, waiting = [], 0, [], 0
    for nth, (doc, own, sha) in enumerate(docs):
        row = {"chunk": chunk, "kind": 0, "nth": nth, "doc_id": doc, "n_a": 0, "n_b": 0, "n_groups": 0, "n_links": 0, "groups_sha256": sha}
        if own is not None:
            n_a, n_b, n_groups, n_links = sums[own].sum(axis=0).tolist()
            mine, count = np.unique(place[at:at + len(own)], return_counts=True)
            at += len(own)
            row |= {"n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_links,
                    "x": packed(np.diff(mine, prepend=0)), "y": packed(count)}
            # Each pair once for each document.
            held.append(np.unique(pair_no[spread(start[mine], size[mine])]))
            waiting += len(held[-1])
            if waiting > AT_ONCE:
                frequency += np.bincount(np.concatenate(held), minlength=len(distinct))
                held, waiting = [], 0
        rows.append(row)
        if len(rows) == DOCUMENTS:
            yield _rows(rows)
            rows = []
    if rows:
        yield _rows(rows)
    if held:
        frequency += np.bincount(np.concatenate(held), minlength=len(distinct))

    for nth, at in enumerate(range(0, len(local), BLOCK)):
        some = slice(start[at], start[at] + size[at:at + BLOCK].sum())
        yield _rows([{
            "chunk": chunk, "kind": 1, "nth": nth, "x": size[at:at + BLOCK].astype("<i4").tobytes(),
            "y": often[some].astype("<i4").tobytes(), "z": pair[some].astype("<i8").tobytes(),
        }])
    identical = known.identical(distinct)
    np.add.at(vector, distinct[identical] >> B_BITS, frequency[identical])
    yield from _blocks(chunk, 2, distinct[~identical], frequency[~identical])


def _encoded(path_a: str, path_b: str, chunk_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, base = aligner(path_a, path_b), TaskContext.get().partitionId() << 32
        vector = np.zeros(len(known.bytes_a), dtype=np.int64)
        docs, words, nth = [], 0, 0
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for at in range(0, len(ids), DOCUMENTS):
                split = [units(t) if t else [] for t in batch.column(1)[at:at + DOCUMENTS].to_pylist()]
                new = dict.fromkeys(u for s in split for u in s if u not in known.number)
                known.learn(list(new))
                number, groups = known.number.__getitem__, known.groups.__getitem__
                for doc, own in zip(ids[at:at + DOCUMENTS], split, strict=True):
                    own = np.fromiter(map(number, own), dtype=np.int32, count=len(own))
                    if not len(own) or known.bad and not known.bad.isdisjoint(own.tolist()):
                        docs.append((doc, None, ""))
                    else:
                        docs.append((doc, own, hashlib.sha256(b";".join(map(groups, own.tolist()))).hexdigest()))
                        words += len(own)
                if words >= chunk_words:
                    yield from _chunk_rows(known, base + nth, docs, vector)
                    docs, words, nth = [], 0, nth + 1
                    if len(known.number) > CACHE_UNITS:
                        known.forget()
        if docs:
            yield from _chunk_rows(known, base + nth, docs, vector)
        if len(known.number) > CACHE_UNITS:
            known.forget()
        filled = np.flatnonzero(vector)
        yield from _blocks(base, 3, filled, vector[filled])

    return run


ALIGNED = pa.schema([
    ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
    ("n_best", pa.int64()), ("count_sum", pa.int64()), ("groups_sha256", pa.string()),
])


def _joined(values: list[bytes | None], kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(v or b"" for v in values), dtype=kind).astype(np.int64)


def _summed_up(same: np.ndarray, identical: np.ndarray, best: np.ndarray):
    """A chunk's documents and units, and its pairs' totals, to the finished rows."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.sort_by([("kind", "ascending"), ("nth", "ascending")])
        kind = left["kind"].to_numpy()
        docs, blocks = left.slice(0, int((kind == 0).sum())), left.slice(int((kind == 0).sum()))
        size, often = _joined(blocks["x"].to_pylist(), "<i4"), _joined(blocks["y"].to_pylist(), "<i4")
        pair = _joined(blocks["z"].to_pylist(), "<i8")
        a, b = pair >> B_BITS, pair & ((1 << B_BITS) - 1)
        keys, totals = right["key"].to_numpy(), right["total"].to_numpy()
        order = np.argsort(keys)
        keys, totals = keys[order], totals[order]
        own = same[a] == b
        count = identical[a] * own
        count[~own] = totals[np.searchsorted(keys, pair[~own])]
        unit = np.repeat(np.arange(len(size)), size)
        of_unit = np.zeros((len(size) + 1, 2), dtype=np.int64)
        np.add.at(of_unit, unit, np.column_stack([often * (count == best[a]), often * count]))
        of_doc = np.zeros((len(docs), 2), dtype=np.int64)
        for i, (steps, times) in enumerate(zip(docs["x"].to_pylist(), docs["y"].to_pylist(), strict=True)):
            if steps is not None:
                of_doc[i] = unpacked(times) @ of_unit[np.cumsum(unpacked(steps))]
        out = docs.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"])
        out = out.append_column("n_best", pa.array(of_doc[:, 0])).append_column("count_sum", pa.array(of_doc[:, 1]))
        return out.append_column("groups_sha256", docs["groups_sha256"]).cast(ALIGNED)

    return run


def align(docs: DataFrame, path_a: str, path_b: str, chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    stored = pinned(texts.mapInArrow(_encoded(path_a, path_b, chunk_words), STORED), "aligned")
    entries = stored.select("chunk", "kind", F.explode(F.arrays_zip("keys", "counts")).alias("e")).select(
        "chunk", "kind", F.col("e.keys").alias("key"), F.col("e.counts").alias("n"))
    pairs = entries.filter("kind = 2")
    totals = pinned(pairs.groupBy("key").agg(F.sum("n").alias("total")), "totals")

    known = aligner(path_a, path_b)
    identical, best = np.zeros(len(known.bytes_a), dtype=np.int64), np.zeros(len(known.bytes_a), dtype=np.int64)
    # Both have at most one row per id of A.
    for key, n in entries.filter("kind = 3").groupBy("key").agg(F.sum("n")).collect():
        identical[key] = n
    a = F.shiftright("key", B_BITS)
    for key, n in totals.groupBy(a.alias("a")).agg(F.max("total")).collect():
        best[key] = n
    best = np.maximum(best, identical)

    wanted = pairs.select(F.col("chunk").alias("of_chunk"), "key").join(totals, "key")
    rows = stored.filter("kind < 2").drop("keys", "counts")
    return rows.groupBy("chunk").cogroup(wanted.groupBy("of_chunk")).applyInArrow(
        _summed_up(known.same, identical, best),
        "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string",
    )
