"""Sampled segmentations of a piece vocabulary by forward filtering and backward sampling; lossless decoding.

A text is written with its blanks as the vocabulary's blank mark and one mark in front.  Pieces hold the mark only at their
start, so the lattice falls into words (a run of marks and what follows), which are independent.  Forward filtering sums the
weights of all ways to reach each place of a word, once per distinct word; backward sampling draws pieces from the word's end,
all words of a batch side by side.  A piece of rank r weighs r^-theta (the vocabulary has merge ranks, no probabilities), a
character without a piece is spelled in bytes.  Draws depend on the row's key, the word's place in the row and the step, not
on batches or tasks, so every run gives the same pieces.

A blank mark that stands in the text itself is spelled in bytes, so decoding gives back every text.  Null and empty texts have
no pieces; rows without an identifier draw as key 0; repeated rows draw alike; an empty table gives no rows; other columns are
ignored; texts are never cut.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

THETA = 1.0
BYTE_PENALTY = 20.0
#: Places of words a worker remembers before it forgets half of them, and code points sampled side by side.
CACHE_PLACES = 700_000
TOGETHER = 400_000
MARK, KEPT = "▁", "\ud800"  # the blank mark; a stand-in, never valid text, for a mark in the text
#: Words; a line feed stands alone, as no piece holds one beside other characters (checked when a vocabulary is read).
_WORD = re.compile(rf"{MARK}*[^{MARK}\n]+|{MARK}+|\n")
_M1, _M2, _STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * _M1
    x = (x ^ x >> np.uint64(27)) * _M2
    return x ^ x >> np.uint64(31)


def _words(text: str) -> list[str]:
    """The words of a text with one mark in front; where blanks stand alone, each begins a word."""
    text = MARK + text.replace(MARK, KEPT)
    if "  " in text or text.startswith(MARK + " "):
        return _WORD.findall(text.replace(" ", MARK))
    words = text.replace(" ", " " + MARK)
    return list(filter(None, words.replace("\n", " \n ").split(" "))) if "\n" in words else words.split(" ")


class Sampler:
    def __init__(self, path: str, theta: float = THETA) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.vocab_size()
        self.spelled: list[bytes] = [b""] * size
        self.byte = [0] * 256
        found: dict[str, tuple[int, float]] = {}
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte[int(piece[1:-1], 16)] = i
                self.spelled[i] = bytes([int(piece[1:-1], 16)])
            elif not (model.is_control(i) or model.is_unknown(i)):
                found[piece] = (i, float((i + 1.0) ** -theta))
                self.spelled[i] = piece.replace(MARK, " ").encode()
        if any("\n" in p and p != "\n" or MARK in p.lstrip(MARK) for p in found):
            raise ValueError("the vocabulary has pieces across words")
        self.longest = max(map(len, found))
        self.width = -(-self.longest // 8) * 8  # whole machine words of flags
        self.ids = np.array([-1, *(i for i, _ in found.values())], dtype=np.int32)
        self.weights = np.array([0.0, *(w for _, w in found.values())])
        with np.errstate(over="ignore"):
            self.powers = np.array([pow(int(_M1), k, 1 << 64) for k in range(self.longest)], dtype=np.uint64)
        self._tabulate(list(found))
        self._clear()

    def _tabulate(self, pieces: list[str]) -> None:
        """An open hash table of all ends of pieces, by hash: the number of the piece, 0 if the end is none itself."""
        numbers: dict[str, int] = {}
        for k, piece in enumerate(pieces, 1):
            numbers[piece] = k
            for i in range(1, len(piece)):
                numbers.setdefault(piece[i:], 0)
        powers = self.powers.tolist()
        hashes = [(sum(ord(c) * p for c, p in zip(reversed(end), powers)) + len(end)) % (1 << 64) for end in numbers]
        self.shift = np.uint64(64 - max(18, (4 * len(hashes)).bit_length()))
        size = 1 << 64 - int(self.shift)
        self.keys, self.numbers = np.zeros(size + len(hashes), dtype=np.uint64), np.zeros(size + len(hashes), dtype=np.int32)
        with np.errstate(over="ignore"):
            home = (np.array(hashes, dtype=np.uint64) * _STEP >> self.shift).tolist()
        taken: dict[int, int] = {}
        for h, at, k in zip(hashes, home, numbers.values(), strict=True):
            while at in taken:
                at += 1
            taken[at] = h
            self.numbers[at] = k
        self.keys[list(taken)] = np.array(list(taken.values()), dtype=np.uint64)

    def _lookup(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which hashes are ends of pieces, and the numbers of these pieces."""
        at = (hashes * _STEP >> self.shift).astype(np.int64)
        key = self.keys[at]
        other = np.flatnonzero((key != hashes) & (key != 0))
        while len(other):
            at[other] += 1
            key[other] = self.keys[at[other]]
            other = other[(key[other] != hashes[other]) & (key[other] != 0)]
        which = np.flatnonzero(key == hashes)
        return which, self.numbers[at[which]]

    def _clear(self) -> None:
        self.base: dict[str, int] = {}
        self.used = 0
        self.upto = np.zeros((1 << 16, self.width), dtype=np.float32)
        self.piece = np.zeros((1 << 16, self.width), dtype=np.int32)
        self.uses = np.zeros(1 << 16, dtype=np.int32)  # portions that used a word, at its first place
        self.size = np.zeros(1 << 16, dtype=np.int32)  # its length, too

    def _forget(self) -> None:
        """Keep the words that the most portions used, in half the places; older uses count for less."""
        words, base = list(self.base), np.fromiter(self.base.values(), dtype=np.int64, count=len(self.base))
        size = np.diff(base, append=self.used)
        order = np.argsort(-self.uses[base], kind="stable")
        keep = np.sort(order[np.cumsum(size[order]) <= CACHE_PLACES // 2])
        base, size = base[keep], size[keep]
        moved = np.cumsum(size) - size
        self.used = int(size.sum())
        places = np.repeat(base - moved, size) + np.arange(self.used)
        self.upto[:self.used], self.piece[:self.used] = self.upto.take(places, axis=0), self.piece.take(places, axis=0)
        self.uses[moved], self.size[moved] = self.uses[base] >> 1, self.size[base]
        self.base = dict(zip(map(words.__getitem__, keep.tolist()), moved.tolist(), strict=True))

    def _filter(self, words: list[str]) -> None:
        """Forward filtering: for every place of a word the cumulative shares of the pieces that end there, by length.

        Substrings are looked up by rolling hashes, longer ones only where a piece ends so.  All words advance side by side, place
        by place; the longest come first, so the words that have a j-th place lie together in what is kept by place.
        """
        if not words:
            return
        words.sort(key=len, reverse=True)
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        base = np.cumsum(lengths + 1) - lengths - 1
        total = int(base[-1] + lengths[-1] + 1)
        end = self.used + total
        while end > len(self.upto):
            self.upto = np.concatenate([self.upto, np.zeros_like(self.upto)])
            self.piece = np.concatenate([self.piece, np.zeros_like(self.piece)])
            self.uses = np.concatenate([self.uses, np.zeros_like(self.uses)])
            self.size = np.concatenate([self.size, np.zeros_like(self.size)])
        upto, piece = self.upto[self.used:end], self.piece[self.used:end]
        codes = np.zeros(total, dtype=np.uint64)  # a word's first place stays zero, which no piece holds
        depth = np.arange(total) - np.repeat(base, lengths + 1)
        inside = np.flatnonzero(depth)
        codes[inside] = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        alive = np.concatenate([[len(words)], np.searchsorted(-lengths, -np.arange(1, lengths[0] + 1), side="right")])
        start = np.cumsum(alive) - alive
        column = start[depth] + np.repeat(np.arange(len(words)), lengths + 1)
        weights = np.zeros((self.longest, total))  # by place
        at, rolling = inside, np.zeros(len(inside), dtype=np.uint64)
        with np.errstate(over="ignore"):
            for k in range(self.longest):
                rolling = rolling + codes[at - k] * self.powers[k]
                which, number = self._lookup(rolling + np.uint64(k + 1))
                at, rolling = at[which], rolling[which]
                whole = np.flatnonzero(number)
                number, place = number[whole], at[whole]
                weights[k, column[place]] = self.weights[number]
                piece[place, k] = self.ids[number]
        bare = inside[weights[0, column[inside]] == 0]
        weights[0, column[bare]] = np.exp(-BYTE_PENALTY)
        piece[bare, 0] = -1 - codes[bare].astype(np.int64)
        plain = bare[codes[bare] < 128]  # one byte
        piece[plain, 0] = np.array(self.byte)[codes[plain].astype(np.int64)]
        sums = np.zeros(total)  # by place
        sums[:len(words)], upto[:] = 1.0, 2.0
        for j, (n, first) in enumerate(zip(alive[1:].tolist(), start[1:].tolist(), strict=True), 1):
            m = min(j, self.longest)  # no piece is longer than what lies before a place
            part = weights[:m, first:first + n]
            for k in range(m):
                part[k] *= sums[start[j - 1 - k]:start[j - 1 - k] + n]
                if k:
                    part[k] += part[k - 1]
            sums[first:first + n] = part[-1]
            part /= part[-1].copy()
            np.putmask(part, part > 1 - 1e-6, 2.0)
            upto[base[:n] + j, :m] = part.T
            if j % 16 == 0:  # only shares count, so a word's last sums are scaled together
                scale = sums[first:first + n].copy()
                for k in range(min(j, self.longest - 1) + 1):
                    sums[start[j - k]:start[j - k] + n] /= scale
        self.uses[base + self.used], self.size[base + self.used] = 0, lengths
        self.base.update(zip(words, (base + self.used).tolist(), strict=True))
        self.used = end

    def __call__(self, keys: list[int], texts: list[str]) -> Iterator[np.ndarray]:
        """The pieces of every text."""
        at = 0
        while at < len(texts):
            stop, chars = at, 0
            while stop < len(texts) and (stop == at or chars + len(texts[stop]) <= TOGETHER):
                chars += len(texts[stop])
                stop += 1
            yield from self._together(keys[at:stop], texts[at:stop])
            at = stop

    def _together(self, keys: list[int], texts: list[str]) -> list[np.ndarray]:
        if self.used > CACHE_PLACES:
            self._forget()
        split = [_words(t) if t else [] for t in texts]
        self._filter(list(set().union(*split).difference(self.base)))
        counts = np.array([len(w) for w in split])
        get = self.base.__getitem__
        base = np.fromiter(map(get, chain.from_iterable(split)), dtype=np.int64, count=counts.sum())
        self.uses[base] += 1
        left = self.size[base].astype(np.int64)
        first = np.cumsum(counts) - counts
        nth = (np.arange(len(base)) - np.repeat(first, counts)).astype(np.uint64)
        with np.errstate(over="ignore"):
            seed = _mixed(np.repeat(np.array(keys, dtype=np.uint64), counts) + nth * _STEP)
            live, step, who, when, what = np.arange(len(base)), 0, [], [], []
            while len(live):
                place = base[live] + left[live]
                u = (_mixed(seed[live] + np.uint64(step + 1) * _M2) >> np.uint64(11)).astype(np.float64) / 2**53
                below = self.upto.take(place, axis=0) <= u[:, None].astype(np.float32)
                slot = np.bitwise_count(below.view(np.uint64)).sum(axis=1, dtype=np.int64)
                who.append(live)
                when.append(np.full(len(live), step, dtype=np.int32))
                what.append(self.piece.take(place * self.width + slot))
                left[live] -= slot + 1
                live = live[left[live] > 0]
                step += 1
        if not who:
            return [np.zeros(0, dtype=np.int32) for _ in texts]
        who, when, what = np.concatenate(who), np.concatenate(when), np.concatenate(what)
        bounds = np.concatenate([[0], np.cumsum(np.bincount(who, minlength=len(base)))])
        ordered = np.empty_like(what)
        ordered[bounds[who + 1] - 1 - when] = what  # a word's pieces were drawn from its end
        what = ordered
        out = [what[bounds[a]:bounds[a + n]] for a, n in zip(first, counts, strict=True)]
        return [self._in_bytes(x) if (x < 0).any() else x for x in out]

    def _in_bytes(self, ids: np.ndarray) -> np.ndarray:
        spelled = []
        for i in ids.tolist():
            if i >= 0:
                spelled.append(i)
            else:
                char = chr(-1 - i)
                spelled += [self.byte[b] for b in (MARK if char == KEPT else char).encode()]
        return np.array(spelled, dtype=np.int32)

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.spelled.__getitem__, ids))[1:].decode()


@lru_cache(maxsize=2)
def sampler(path: str, theta: float) -> Sampler:
    return Sampler(path, theta)


def sample_pieces(docs: DataFrame, path: str, theta: float = THETA, seed: int = 0) -> DataFrame:
    """doc_id, n_pieces, pieces (array of ids), lossless (whether the pieces decode to the text)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        draw = sampler(path, theta)
        for batch in batches:
            ids = [0 if pd.isna(i) else int(i) for i in batch["doc_id"]]
            keys = [xxhash.xxh3_64_intdigest(i.to_bytes(8, "little", signed=True), seed) for i in ids]
            texts, at = batch["text"].tolist(), 0
            while at < len(texts):  # some megabytes of pieces at once
                stop, chars = at, 0
                while stop < len(texts) and (stop == at or chars < 2_000_000):
                    chars += len(texts[stop])
                    stop += 1
                pieces = list(draw(keys[at:stop], texts[at:stop]))
                yield pd.DataFrame({
                    "doc_id": batch["doc_id"].iloc[at:stop].astype("Int64").array, "n_pieces": [len(p) for p in pieces], "pieces": pieces,
                    "lossless": [draw.decode(p.tolist()) == t for p, t in zip(pieces, texts[at:stop], strict=True)],
                })
                at = stop

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInPandas(run, "doc_id long, n_pieces long, pieces array<int>, lossless boolean")
