"""Packing by minimum bin slack.

A document's ids (with the end id) are one piece, or pieces of the capacity and a rest when longer.  What is packed is the
histogram of piece lengths, which has at most `capacity` entries at any corpus size: for each bin the longest length left is
taken and a bitset subset-sum over the lengths left finds the fullest feasible filling; the combination is removed as many
times as the histogram holds it.  The resulting plan (bounded by the capacity, not the corpus) maps the r-th piece of a
length to its sequence and offset.  Ranks come from counts per (task, length), so a hot length is never in one task.

Null texts count as empty and are one piece of the end id; repeated rows are packed each; an empty table gives no rows;
other columns are ignored; all texts are encoded whole.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from gleaner.llm.common import pinned

CAPACITY = 4096
END_ID = 1
#: Words whose ids a worker remembers before the generation before the last is forgotten.
CACHE_WORDS = 500_000
#: Documents whose unknown words are encoded together.
TOGETHER = 256

_BLANK = re.compile(r"[ \t\n\r]+")
_SEPARATOR = re.compile(r"[\x1c-\x1f]")  # blanks to Python, not to the tokenizer
#: Marks after a letter are pre-tokens apart from it; letters below U+0250 are composed and have one small letter each.
_MARKS = ".,;:!?*&%$#+-=~|/()[]{}"
_FAR = re.compile("[<\u0250-\U0010ffff]")


class WordEncoder:
    """Ids as little-endian bytes for a tokenizer whose pre-tokens never cross white space: a word is encoded once.

    What a worker has learnt is kept in two generations, so frequent words stay known in bounded memory.
    """

    def __init__(self, path: str, remembered: int) -> None:
        from tokenizers import Tokenizer, normalizers

        self.remembered = remembered
        self.tokenizer = Tokenizer.from_file(path)
        # For words that the normaliser leaves as they are.
        self.bare = Tokenizer.from_file(path)
        self.bare.normalizer = normalizers.Sequence([])
        self._check()
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)  # ids that end a pre-token
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {"": b""}
        self.old: dict[str, bytes] = {}

    def _check(self) -> None:
        """What the shortcuts rest on: lower case, blanks that only separate, marks that are pre-tokens of their own."""
        def ids(text: str, tokenizer=self.tokenizer) -> list[int]:
            return tokenizer.encode(text, add_special_tokens=False).ids

        parts = [ids(w) for w in ("word", "of", ",", "more", ".")]
        if not ids("Word  oF,\tMORE.") == sum(parts, []) == ids("word of,more.", self.bare):
            raise ValueError("not a tokenizer of separate lower-case words")
        if any(ids(f"word{m}{m}") != parts[0] + ids(m + m) or ids(f"Évı{m}") != ids("évı", self.bare) + ids(m) for m in _MARKS):
            raise ValueError("not a tokenizer of words apart from marks")

    def _plain(self, words: list[str], tokenizer) -> None:
        """Learn words of letters only, one pre-token each: they are encoded as one text and cut at the ends."""
        if not words:
            return
        text = " ".join(words)
        ids = np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) == len(words) and stops[-1] == len(ids):
            spelled, at = ids.tobytes(), 0
            for w, stop in zip(words, (4 * stops).tolist(), strict=True):
                self.known[w] = spelled[at:stop]
                at = stop

    def _encode(self, words: list[str]) -> None:
        """Learn words; those without far letters are in lower case."""
        known = self.known
        plain = [w for w in words if w.isalpha()]
        far = set(filter(_FAR.search, plain)) if _FAR.search(" ".join(plain)) else set()
        self._plain([w for w in plain if w not in far] if far else plain, self.bare)
        self._plain(list(far), self.tokenizer)
        rest = [w for w in words if w not in known]
        for w, e in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False), strict=True):
            known[w] = np.array(e.ids, dtype="<u4").tobytes()

    def _learn(self, words: set[str]) -> None:
        known, old = self.known, self.old
        again = words & old.keys()
        known.update(zip(again, map(old.__getitem__, again)))
        new = list(words - again)
        if not new:
            return
        bare = [w.rstrip(_MARKS) for w in new]
        # Some letters end in a combining mark once they are normalised, which joins the marks behind it.
        ends = {c for c in {b[-1:] for b in bare} if unicodedata.normalize("NFC", c).lower()[-1:].isalpha()}
        bare = [b if b[-1:] in ends else w for w, b in zip(new, bare, strict=True)]
        marks = [w[len(b):] for w, b in zip(new, bare, strict=True)]
        text = "\n".join(bare)
        if _FAR.search(text):
            bare = [b if _FAR.search(b) else b.lower() for b in bare]
        else:
            bare = text.lower().split("\n")
        need = set(bare).union(marks).difference(known)
        again = need & old.keys()
        known.update(zip(again, map(old.__getitem__, again)))
        self._encode(list(need - again))
        known.update({w: known[b] + known[m] for w, b, m in zip(new, bare, marks, strict=True)})

    def __call__(self, texts: list[str]) -> Iterator[bytes]:
        for at in range(0, len(texts), TOGETHER):
            if len(self.known) > self.remembered:
                self.known, self.old = {"": b""}, self.known
            split = [t.split() if not _SEPARATOR.search(t) else _BLANK.split(t) for t in texts[at:at + TOGETHER]]
            found = [list(map(self.known.get, words)) for words in split]
            unknown = [[i for i, ids in enumerate(f) if ids is None] for f in found]
            self._learn({words[i] for words, gaps in zip(split, unknown, strict=True) for i in gaps})
            for words, f, gaps in zip(split, found, unknown, strict=True):
                for i in gaps:
                    f[i] = self.known[words[i]]
                yield b"".join(f)


@lru_cache(maxsize=2)
def encoder(path: str, remembered: int = CACHE_WORDS) -> WordEncoder:
    """One encoder for each worker process; its tasks share what it has learnt."""
    return WordEncoder(path, remembered)


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"


def _cut(path: str, capacity: int, end_id: int, remembered: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, part = encoder(path, remembered), TaskContext.get().partitionId()
        seen: dict[int, int] = defaultdict(int)
        end, width = np.array([end_id], dtype="<u4").tobytes(), 4 * capacity
        for batch in batches:
            rows = []
            for doc, ids in zip(batch["doc_id"], encode(batch["text"].tolist()), strict=True):
                ids += end
                for piece, at in enumerate(range(0, len(ids), width)):
                    own = ids[at:at + width]
                    n = len(own) // 4
                    rows.append((doc, piece, at // 4, n, zlib.crc32(own), part, seen[n]))
                    seen[n] += 1
            frame = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"])
            yield frame.astype({"doc_id": "Int64"})

    return run


def fullest(counts: dict[int, int], room: int) -> list[int]:
    """The multiset of available lengths with the largest sum up to `room` (bitset subset-sum)."""
    mask, reach, steps = (1 << (room + 1)) - 1, 1, []
    for length in sorted((n for n, c in counts.items() if c and n <= room), reverse=True):
        left, times = min(counts[length], room // length), 1
        while left:  # multiplicities by powers of two
            take = min(times, left)
            wider = (reach | reach << take * length) & mask
            if wider != reach:
                steps.append((length, take, reach))
                reach = wider
            left -= take
            times *= 2
        if reach >> room:
            break
    at, found = reach.bit_length() - 1, []
    for length, take, before in reversed(steps):
        if not before >> at & 1:
            found += [length] * take
            at -= take * length
    return found


def plan_bins(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, ranks, first sequence, pieces of the length per sequence, offset), by length and rank."""
    counts, used, plan, sequence = dict(histogram), defaultdict(int), [], 0
    while counts:
        top = max(counts)
        counts[top] -= 1
        combo = [top, *fullest(counts, capacity - top)]
        counts[top] += 1
        many = {n: combo.count(n) for n in set(combo)}
        times, offset = min(counts[n] // m for n, m in many.items()), 0
        for n, m in sorted(many.items(), reverse=True):
            plan.append((n, used[n], times * m, sequence, m, offset))
            used[n] += times * m
            offset += n * m
            counts[n] -= times * m
            if not counts[n]:
                del counts[n]
        sequence += times
    return sorted(plan)


def _placed(plan: list[tuple]):
    table = np.array(plan, dtype=np.int64).reshape(-1, 6)
    key = table[:, 0] << 44 | table[:, 1]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            length, rank = batch["length"].to_numpy(), batch["rank"].to_numpy()
            row = table[np.searchsorted(key, length << 44 | rank, side="right") - 1]
            copy, slot = np.divmod(rank - row[:, 1], row[:, 4])
            yield batch.drop(columns="rank").assign(sequence_id=row[:, 3] + copy, offset=row[:, 5] + slot * length)

    return run


def pack(
    docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, remembered: int = CACHE_WORDS
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    `remembered` words a generation stay in a worker (some 200 bytes each); fewer cost time, not results.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    pieces = pinned(texts.mapInPandas(_cut(tokenizer_path, capacity, end_id, remembered), PIECES), "pieces")
    by_task = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    bases = by_task.select("part", "length", F.coalesce(before, F.lit(0)).alias("base"))
    histogram = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    ranked = pieces.join(bases, ["part", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("nth")).alias("rank")
    )
    return ranked.mapInPandas(
        _placed(plan_bins(histogram, capacity)),
        "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
    )
