"""Sentences nearer than ten edits, for many pairs at once.

Helpers for code that runs inside a task on one block of articles.  A pair is first judged by lengths and letter counts, which an edit
changes by at most one and two; what is left is decided by the edit distance in code points, computed inside a band of 19 diagonals,
a row of it in the bits of one word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

MAX_DISTANCE = 9
BAND = 2 * MAX_DISTANCE + 1
# Letters are counted in so many classes, by code point.
CLASSES = 64
# Pairs judged, pairs whose distance is computed, and places of their longer sentences, at once.
JUDGED, MEASURED, PLACES = 100_000, 16_384, 1 << 21
# Bits of the band, and of its cells behind the first one of a sentence.
_BITS, _FIRST = np.uint32((1 << BAND) - 1), np.uint32((1 << BAND) - (1 << MAX_DISTANCE))
# In places behind and before a sentence: no code point.
_EMPTY = np.uint32(0xFFFFFFFF)


class Sentences:
    """Different sentences of a block by number: code points, lengths, letter counts."""

    def __init__(self, texts: list[str]) -> None:
        self.points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        self.length = np.array([len(t) for t in texts], dtype=np.int64)
        self.start = np.cumsum(self.length) - self.length
        owner = np.repeat(np.arange(len(texts)), self.length)
        cell = owner * CLASSES + self.points % CLASSES
        counts = np.bincount(cell, minlength=len(texts) * CLASSES).reshape(-1, CLASSES)
        self.letters = np.minimum(counts, np.iinfo(np.int16).max).astype(np.int16)

    def near(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which pairs (a, b) of numbers are nearer than ten edits."""
        out = np.zeros(len(a), dtype=bool)
        for at in range(0, len(a), JUDGED):
            x, y = a[at:at + JUDGED], b[at:at + JUDGED]
            apart = np.abs(self.letters[x] - self.letters[y]).sum(axis=1, dtype=np.int64)
            short = np.maximum(self.length[x], self.length[y]) <= MAX_DISTANCE
            open_ = ~short & (apart <= 2 * MAX_DISTANCE) & (np.abs(self.length[x] - self.length[y]) <= MAX_DISTANCE)
            out[at:at + JUDGED] = short
            left = np.flatnonzero(open_)
            left = left[np.argsort(self.length[x[left]], kind="stable")]  # like lengths together
            k = 0
            while k < len(left):
                width = int(self.length[x[left[min(k + MEASURED, len(left)) - 1]]]) + BAND
                some = left[k:k + min(MEASURED, max(1, PLACES // width))]
                out[at + some] = self._measured(x[some], y[some])
                k += len(some)
        return out

    def _padded(self, which: np.ndarray, before: int, width: int) -> np.ndarray:
        """Code points of sentences in rows, with `before` empty places in front and at least one class of places behind."""
        n = self.length[which]
        rows = np.full((len(which), before + width + BAND), _EMPTY)
        row = np.repeat(np.arange(len(which)), n)
        place = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        rows[row, before + place] = self.points[np.repeat(self.start[which], n) + place]
        return rows

    def _measured(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the edit distance is at most nine; pairs come by length of a.

        A pair's row of the table, cells (i, i + k - 9) for k in the band, is one word of bits: which cells are one more, or one
        less, than the cell before them.  The distance is followed on the diagonal that ends the table, where it never falls.
        """
        n, end = self.length[a], (self.length[b] - self.length[a] + MAX_DISTANCE).astype(np.uint32)
        longest = int(n.max())
        left, right = self._padded(a, 0, longest), self._padded(b, MAX_DISTANCE, max(longest, int(self.length[b].max())))
        score = np.maximum(end, MAX_DISTANCE).astype(np.int64) - MAX_DISTANCE
        more, less = np.full(len(a), _FIRST), np.zeros(len(a), dtype=np.uint32)
        equal = np.zeros((len(a), 32), dtype=bool)
        alive, out = np.arange(len(a)), np.zeros(len(a), dtype=bool)
        for i in range(longest + 1):
            done = int(np.searchsorted(n, i, side="right"))
            open_ = score[done:] <= MAX_DISTANCE
            out[alive[:done]] = score[:done] <= MAX_DISTANCE
            few = 2 * np.count_nonzero(open_) <= len(open_)
            if done or few:
                stay = done + np.flatnonzero(open_) if few else slice(done, None)
                alive, n, end, score, more, less, left, right = (
                    x[stay] for x in (alive, n, end, score, more, less, left, right))
                equal = equal[:len(alive)]
                if not len(alive):
                    break
            np.equal(left[:, i, None], right[:, i:i + BAND], out=equal[:, :BAND])
            same = np.packbits(equal, axis=1, bitorder="little").view("<u4").ravel()
            diagonal = ((((same & more) + more) ^ more) | same | less) & _BITS
            wider, narrower = less | ~(diagonal | more), diagonal & more
            score += 1 - (diagonal >> end & 1).astype(np.int64)
            diagonal >>= 1
            more, less = (narrower | ~(diagonal | wider)) & _BITS, diagonal & wider
        return out


def near_in_pool(sentences: Sentences, own: np.ndarray, pool: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (place in `own`, number in `pool`) whose lengths differ by at most nine, some at a time."""
    pool = pool[np.argsort(sentences.length[pool], kind="stable")]
    sizes = sentences.length[pool]
    first = np.searchsorted(sizes, sentences.length[own] - MAX_DISTANCE)
    count = np.searchsorted(sizes, sentences.length[own] + MAX_DISTANCE, side="right") - first
    share = np.cumsum(count) // JUDGED
    for part in np.unique(share):
        k = np.flatnonzero(share == part)
        n = count[k]
        place = np.arange(int(n.sum())) + np.repeat(first[k] - (np.cumsum(n) - n), n)
        yield np.repeat(k, n), pool[place]
