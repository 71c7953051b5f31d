"""Periodic runs of words by an online sparse diagonal DP.

The words of a text go by once, in order.  An earlier occurrence of word i at i - q is a match on the diagonal of lag q; matches
of consecutive words lengthen the diagonal, and a diagonal that ends is a run at once if it is long enough.

Two words of a text may share very many lags, so only those that can belong to a run are followed.  A run of smallest period q,
2^j <= q < 2^(j+1), and at least 4q words repeats each of its stretches of 3 * 2^j words q words later, and not nearer: a nearer
repeat overlaps so far (by Fine and Wilf) that q would not be the smallest period.  So a stretch of that length needs its nearest
earlier occurrence only, and only if that lies at a lag of the class.  Stretches of 1, 2, 3, 6, 12, ... words are numbered by
sorting pairs of shorter ones that repeat; what does not repeat is not looked at again.  Work is n log^2 n and memory n, for any
number of equal words, and no run is lost.

Words are separated by the six ASCII blanks.  Documents chosen by the checksum of their identifier have their tail replaced by
repeats of its head first (`repeated`); rows without an identifier are taken as they are.  Null and empty texts have no words and
no runs; repeated rows are handled each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

LEAST_WORDS = 6
LEAST_PERIODS = 4
#: Candidates turned into Python numbers at once.
AT_ONCE = 65_536

RESULT = pa.schema([
    ("doc_id", pa.int64()), ("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64()),
    ("exponent_milli", pa.int64()), ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string()),
])


def repeated(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """Of one document in ten, by its identifier, the words from a on are repeats of the p words there."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * ((n - a) // p + 1))[:n - a]


def _joined(head: np.ndarray, tail: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of the stretches head[i] + tail[i + shift] (-1: occurs once), and of those that repeat (place, lag to the nearest earlier)."""
    rank = np.full(len(head), -1, dtype=np.int64)
    at = np.flatnonzero((head[:len(head) - shift] >= 0) & (tail[shift:] >= 0))
    if not len(at):
        return rank, at, at
    key = head[at] * (tail.max() + 1) + tail[at + shift]
    order = np.argsort(key, kind="stable")
    key, at = key[order], at[order]
    again = np.concatenate([[False], key[1:] == key[:-1]])
    often = again.copy()
    often[:-1] |= again[1:]
    rank[at[often]] = np.cumsum(~again)[often]
    later = np.flatnonzero(again)
    return rank, at[later], at[later] - at[later - 1]


def candidates(ids: np.ndarray) -> np.ndarray:
    """Rows (place, lag, words): stretches from a place whose nearest earlier occurrence may belong to a run, by place."""
    n, found = len(ids), [np.zeros((0, 3), dtype=np.int64)]
    one = np.where(np.bincount(ids)[ids] > 1, ids, -1) if n else ids
    if n < LEAST_WORDS or not (one >= 0).any():
        return found[0]
    two, _, _ = _joined(one, one, 1)
    rank, at, lag = _joined(two, one, 2)
    words, low = 3, 1
    while len(at) and LEAST_PERIODS * low <= n:
        own = (lag >= low) & (lag < 2 * low)
        found.append(np.column_stack([at[own], lag[own], np.full(int(own.sum()), words)]))
        rank, at, lag = _joined(rank, rank, words)
        words, low = 2 * words, 2 * low
    rows = np.concatenate(found)
    return rows[np.lexsort((rows[:, 1], rows[:, 0]))]


def _in_turn(rows: np.ndarray) -> Iterator[list[int]]:
    """Rows of a large array as lists, without a list of all of them."""
    for at in range(0, len(rows), AT_ONCE):
        yield from rows[at:at + AT_ONCE].tolist()


def runs(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start, then period."""
    found: list[tuple[int, int, int]] = []
    active: dict[int, tuple[int, int]] = {}  # lag: first matching word, end of the match

    def end(lag: int, first: int, stop: int) -> None:
        length = stop - first + lag
        if length >= max(LEAST_WORDS, LEAST_PERIODS * lag):
            found.append((first - lag, length, lag))

    now = -1
    for place, group in groupby(_in_turn(candidates(ids)), itemgetter(0)):
        current = {}
        for _, lag, words in group:
            first = active.pop(lag)[0] if place == now + 1 and lag in active else place
            current[lag] = (first, place + words)
        for lag, match in active.items():  # diagonals that this word did not lengthen have ended
            end(lag, *match)
        active, now = current, place
    for lag, match in active.items():
        end(lag, *match)
    return sorted(found)


def describe(words: list[bytes]) -> tuple:
    """What the digest columns hold of one text: n_runs, the longest run, and the two hashes."""
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    found = runs(np.fromiter(map(number.__getitem__, words), dtype=np.int64, count=len(words))) if len(number) < len(words) else []
    if found:
        keep = np.ones(len(words), dtype=bool)
        for start, length, period in found:
            keep[start + period:start + length] = False
        words = [words[i] for i in np.flatnonzero(keep).tolist()]
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    start, length, period = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    return (
        len(found), start, length, period, 1000 * length // period if found else None,
        hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(words)).hexdigest(),
    )


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0).to_pylist()
        rows = [(i, *describe(repeated((t.as_py() or b"").split(), i))) for i, t in zip(ids, batch.column(1), strict=True)]
        columns = zip(*rows, strict=True) if rows else [[]] * len(RESULT)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, RESULT, strict=True)], schema=RESULT)


def find_runs(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(
        _described, "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
        "runs_sha256 string, collapsed_sha256 string",
    )
