"""Periodic runs, Gray-order index and token alignment against brute force, with the edge cases of every operator."""

import hashlib
import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import xxhash

from gleaner.llm import gray_index, periodic_runs, token_alignment

SCHEMA = "doc_id long, text string, fp long, root string, chunk int, key string, kind string, n int"


def frame(spark, texts, ids=None):
    """Documents with extra columns whose names the operators use inside."""
    rows = [(ids[i] if ids else i, t, 1, "x", 1, "x", "x", 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def plain_words(text):
    return [w for w in "".join(" " if c in " \t\n\v\f\r" else c for c in text or "").split(" ") if w]


# periodic runs


def runs_by_definition(words):
    found, n = [], len(words)
    for q in range(1, n):
        i = q
        while i < n:
            j = i
            while j < n and words[j] == words[j - q]:
                j += 1
            start, length = i - q, j - i + q
            if j > i and length >= max(6, 4 * q):
                shorter = any(all(words[k] == words[k - p] for k in range(start + p, j)) for p in range(1, q))
                if not shorter:
                    found.append((start, length, q))
            i = max(j, i + 1)
    return sorted(found)


def periodic_row(doc_id, text):
    words = plain_words(text)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and words:
        n, g = len(words), h // 10
        a = g % n
        p = 1 + int((n - a) / (3 + g % 8))
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = runs_by_definition(words)
    best = max(found, key=lambda r: (r[1], -r[0], -r[2])) if found else (None, None, None)
    kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + m for s, m, q in found)]
    listed = "".join(f"{s},{m},{q}\n" for s, m, q in found)
    return (doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None,
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(" ".join(kept).encode()).hexdigest())


def repeating_text(rng):
    words = []
    while len(words) < rng.randint(0, 70):
        block = [rng.choice("abcd") for _ in range(rng.randint(1, 9))]
        words += (block * 8)[:rng.randint(1, 7 * len(block))]
    return "".join(w + rng.choice(" \t\n\v\f\r") for w in words)


def test_runs_match_their_definition(spark):
    rng = random.Random(11)
    texts = [None, "", " ", "a " * 5, "a " * 6, "a b " * 3, "a b " * 4, "a\x1cb\xa0c " * 7, "日 本 " * 20, *[repeating_text(rng) for _ in range(400)]]
    ids = [None, None, *range(2, len(texts) - 2), 7, -5]
    got = [tuple(r) for r in periodic_runs.find_runs(frame(spark, texts, ids)).collect()]
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i in ids) > 20
    assert sorted(got, key=repr) == sorted([periodic_row(i, t) for i, t in zip(ids, texts)], key=repr)


def test_runs_of_all_short_sequences():
    for n, letters in ((12, 2), (8, 3)):
        for words in itertools.product(range(letters), repeat=n):
            assert periodic_runs.runs(np.array(words)) == runs_by_definition(words)


def test_runs_edges(spark):
    assert periodic_runs.find_runs(frame(spark, [])).count() == 0
    same = periodic_runs.find_runs(frame(spark, ["x y z " * 9] * 3, [None, 4, 4])).collect()
    assert len({tuple(r)[1:] for r in same}) == 1 and same[0]["n_runs"] == 1


def test_long_texts_take_linear_work():
    one = periodic_runs.describe([b"a"] * 300_000)
    assert one[:5] == (1, 0, 300_000, 1, 300_000_000)
    block = [b"%d" % i for i in range(50_000)]
    assert periodic_runs.describe(block * 5)[:4] == (1, 0, 250_000, 50_000)


# Gray-order index


def fingerprint_by_definition(text):
    words = plain_words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def components_by_definition(ids, codes):
    root = list(range(len(codes)))
    for i, j in itertools.combinations(range(len(codes)), 2):
        if (codes[i] ^ codes[j]).bit_count() <= 2 and root[i] != root[j]:
            old, new = root[j], root[i]
            root = [new if r == old else r for r in root]
    least = {}
    for r, i in zip(root, ids):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    return [least.get(r) for r in root]


def near_copies(rng):
    texts = [None, "", " \t", "one", "ONE", "one two", "É x", "é x", "a\xa0b c"]
    for _ in range(12):
        words = [rng.choice("abcdefgh") + str(rng.randint(0, 30)) for _ in range(rng.randint(60, 260))]
        for _ in range(10):
            copy = list(words)
            for _ in range(rng.randint(0, 2)):
                copy[rng.randrange(len(copy))] = "new" + str(rng.randint(0, 9))
            texts.append(" ".join(copy).upper() if rng.random() < 0.3 else "  ".join(copy))
    return texts


@pytest.mark.parametrize("limit", [4096, 3])
def test_components_match_all_pairs(spark, monkeypatch, limit):
    """With a small limit every bucket is divided several times."""
    monkeypatch.setattr(gray_index, "LIMIT", limit)
    rng = random.Random(12)
    texts = near_copies(rng)
    ids = [None if i % 17 == 3 else 900 - i for i in range(len(texts))]
    codes = [fingerprint_by_definition(t) for t in texts]
    want = list(zip(ids, [f"{c:016x}" for c in codes], components_by_definition(ids, codes)))
    got = [tuple(r) for r in gray_index.near_components(frame(spark, texts, ids)).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert 12 < len(set(codes)) and len({w[2] for w in want}) < len(set(codes))


def test_index_finds_every_link_of_a_bucket(monkeypatch):
    monkeypatch.setattr(gray_index, "AT_ONCE", 500)
    rng = np.random.default_rng(3)
    for n in (1, 2, 9, 300):
        codes = rng.integers(0, 2**63, size=max(1, n // 30), dtype=np.uint64)[rng.integers(0, max(1, n // 30), n)]
        for _ in range(3):
            codes ^= np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64)
        codes = np.unique(codes)
        bucket = np.sort(rng.integers(0, 3, len(codes)))
        codes = codes[np.lexsort((gray_index.gray_rank(codes), bucket))]
        index = gray_index.GrayIndex(codes, np.unique(bucket, return_counts=True)[1])
        got = {(int(a), int(b)) for i, j in index.near(2) for a, b in zip(i, j)}
        near = np.bitwise_count(codes[:, None] ^ codes) <= 2
        assert got == {(a, b) for a, b in zip(*np.nonzero(near)) if a < b and bucket[a] == bucket[b]}


def test_gray_ranks_follow_the_sequence():
    place = np.arange(1024, dtype=np.uint64)
    assert (gray_index.gray_rank(place ^ place >> np.uint64(1)) == place).all()


def test_components_edges(spark):
    assert gray_index.near_components(frame(spark, [])).count() == 0
    rows = gray_index.near_components(frame(spark, ["q"] * 3 + [None, None], [None, 8, 8, None, None])).collect()
    assert sorted((r["component_id"] or 0) for r in rows) == [0, 0, 8, 8, 8]


# token alignment

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


def groups_by_definition(known, text):
    """Groups of a text that is encoded whole, or None."""
    if not text:
        return None
    a, b = known.a.encode(" " + text, add_special_tokens=False).ids, known.b.encode(text)
    raw = (" " + text).encode()
    if any(b"".join(t[i] for i in ids) != raw for t, ids in ((known.bytes_a, a), (known.bytes_b, b))):
        return None
    ends_a = list(itertools.accumulate(len(known.bytes_a[i]) for i in a))
    ends_b = list(itertools.accumulate(len(known.bytes_b[i]) for i in b))
    groups, i, j = [], 0, 0
    for cut in sorted(set(ends_a) & set(ends_b)):
        x, y = [], []
        while i < len(a) and ends_a[i] <= cut:
            x.append(a[i])
            i += 1
        while j < len(b) and ends_b[j] <= cut:
            y.append(b[j])
            j += 1
        groups.append((x, y))
    return groups


def alignment_by_definition(known, ids, texts):
    groups = [groups_by_definition(known, t) for t in texts]
    links = [Counter((x, y) for a, b in g or [] for x in a for y in b) for g in groups]
    count = Counter(pair for link in links for pair in link)
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    for i, g, link in zip(ids, groups, links):
        if g is None:
            yield (i, 0, 0, 0, 0, 0, 0, "")
            continue
        spelled = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        yield (i, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(link.values()),
               sum(n for p, n in link.items() if count[p] == best[p[0]]), sum(n * count[p] for p, n in link.items()),
               hashlib.sha256(spelled.encode()).hexdigest())


BITS = ["a", "b", "the", "ing", "tion", " ", " ", "  ", "\n", "\t", "\xa0", "　", "é", "日本", "語", "12", "'s", "<s>", "<|endoftext|>",
        "<0x41>", "ﬁ", "́", "😀", "-", "====", "\x00", "\x1c", ".", "▁", " word", " The", " extraordinary", "Zug"]


def odd_texts(rng, n):
    return [None, "", " ", "   ", "a ", "▁", "a" * 30_000, " \n " * 200,
            *["".join(rng.choice(BITS) for _ in range(rng.randint(0, 25))) for _ in range(n)]]


@pytest.mark.parametrize("words", [1_000_000, 40])
def test_alignment_matches_whole_encodings(spark, words):
    """With few words a chunk the totals come from many chunks."""
    texts = odd_texts(random.Random(13), 250)
    ids = [None, None, *range(2, len(texts) - 1), 5]
    got = [tuple(r) for r in token_alignment.align(frame(spark, texts, ids), A, B, words).collect()]
    want = list(alignment_by_definition(token_alignment.Aligner(A, B), ids, texts))
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert sum(w[1] > 0 for w in want) > 100


def test_alignment_in_small_pieces(monkeypatch):
    """Chunks, expansions and forgetting do not change a result."""
    known = token_alignment.Aligner(A, B)
    texts = odd_texts(random.Random(14), 120)
    for name, value in (("TOGETHER", 3), ("AT_ONCE", 5), ("BLOCK", 4)):
        monkeypatch.setattr(token_alignment, name, value)
    for text in texts:
        own = token_alignment.units(text) if text else []
        known.learn([u for u in dict.fromkeys(own) if u not in known.number])
        groups = groups_by_definition(known, text)
        refused = not own or any(known.number[u] in known.bad for u in own)
        assert refused == (groups is None)
        if groups:
            spelled = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
            assert b";".join(known.groups[known.number[u]] for u in own).decode() == spelled
            assert " ".join(own) == text


def test_alignment_edges(spark):
    assert token_alignment.align(frame(spark, []), A, B).count() == 0
    rows = token_alignment.align(frame(spark, ["same words here"] * 3, [None, 6, 6]), A, B).collect()
    assert {r["count_sum"] for r in rows} == {3 * rows[0]["n_links"]} and len(rows) == 3


def test_identity_map_has_equal_bytes():
    known = token_alignment.Aligner(A, B)
    for i, j in enumerate(known.same):
        assert j < 0 or known.bytes_a[i] == known.bytes_b[j]
    assert (known.same >= 0).sum() > 15_000


# sections of token counts


def test_null_sections(spark):
    from pyspark.sql import functions as F

    from gleaner.llm import token_counts

    rows = [(1, "one two three", [(0, 3), (4, 13)]), (2, "one two", None), (3, "one two", [(0, 3), None]), (4, None, [(0, 0)])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, parts array<struct<start:long,end:long>>")
    got = token_counts.count_tokens(docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN, F.col("parts")).collect()
    counts = {(r["doc_id"], r["section"]): r["n_tokens"] for r in got}
    assert counts[1, 0] == 1 and counts[1, 1] == 2 and counts[2, -1] == 2
    assert counts[3, 0] == 1 and counts[3, -1] == 1 and counts[4, 0] == 0
