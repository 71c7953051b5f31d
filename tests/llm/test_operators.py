"""Operators against brute force, with nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from gleaner.llm import (
    ann, components, exact_dedup, html_text, licenses, near_dedup, packing, sampled_pieces, token_counts, toxicity,
)

SCHEMA = "doc_id long, text string, sha string, node string, root string, n long, length long, bucket string"


def frame(spark, texts, ids=None):
    """Documents with extra columns whose names the operators use inside."""
    rows = [(ids[i] if ids else i, t, "x", "x", "x", 1, 1, "x") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def prose(rng, n):
    return " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta", "theta"]) + str(rng.randint(0, 40)) for _ in range(n))


# exact duplicates


def test_exact_groups_match_brute_force(spark):
    texts = [None, "", " ", "a\tb", "a \n b", "a  b", "ab", "abc", "abd", "é", "é", "long " * 40000, "long " * 40000 + "x", "a b"]
    rows = exact_dedup.exact_groups(frame(spark, texts)).collect()
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for t in texts]
    assert len(rows) == len(texts)
    for r in rows:
        same = [i for i, t in enumerate(norm) if t == norm[r["doc_id"]]]
        assert (r["keep_id"], r["group_size"], r["kept"]) == (min(same), len(same), r["doc_id"] == min(same))
        assert r["text_sha256"] == hashlib.sha256(norm[r["doc_id"]].encode()).hexdigest()


def test_exact_groups_edges(spark):
    assert exact_dedup.exact_groups(frame(spark, [])).count() == 0
    rows = exact_dedup.exact_groups(frame(spark, ["a", "a", "a"], [None, 5, 5])).collect()
    assert [(r["keep_id"], r["group_size"]) for r in rows] == [(5, 3)] * 3


def test_trie_spills_between_keys_only(monkeypatch):
    rng = random.Random(3)
    keys = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 9))) for _ in range(500)]
    trie, want = exact_dedup.Patricia(), {}
    for i, k in enumerate(keys):
        trie.insert(k, i, 1, None)
        want[k] = (min(i, want.get(k, (i, 0))[0]), want.get(k, (0, 0))[1] + 1)
    assert {k: (t[0], t[1]) for k, t in trie.terminals()} == want


# near duplicates


def brute_classes(texts, least=0.8):
    sets = []
    for t in texts:
        w = re.findall(r"\w+", (t or "").lower())
        sets.append({tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    parent = list(range(len(texts)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= least * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return [find(i) for i in range(len(texts))]


def test_near_classes_match_brute_force(spark):
    rng = random.Random(5)
    base = prose(rng, 120).split()
    texts = [None, "", "!!", "one two", "One  two!", "one two three", "word " * 3000]
    for _ in range(60):  # copies of one text that differ from each other more than from it
        own = list(base)
        for k in rng.sample(range(120), rng.choice([1, 2, 3, 4])):
            own[k] = f"new{rng.random()}"
        texts.append(" ".join(own))
    texts += [prose(rng, rng.randint(5, 80)) for _ in range(30)] + [" ".join(base)]
    rows = near_dedup.near_classes(frame(spark, texts)).collect()
    assert {r["doc_id"]: r["class_id"] for r in rows} == dict(enumerate(brute_classes(texts)))
    sizes = collections.Counter(r["class_id"] for r in rows)
    assert all(r["class_size"] == sizes[r["class_id"]] for r in rows)


def weighted_classes(texts, least=0.8):
    """Classes by the probability Jaccard of run counts, its sums written out over all pairs."""
    bags = []
    for t in texts:
        w = re.findall(r"\w+", (t or "").lower())
        bags.append(collections.Counter(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else {})
    root = list(range(len(texts)))
    for i, x in enumerate(bags):
        for j in range(i):
            y = bags[j]
            common = [r for r in x if r in y]
            if len(common) < 0.4 * max(len(x), len(y)) and max([*x.values(), *y.values()], default=1) == 1:
                continue
            total = sum(1 / sum(max(x.get(q, 0) / x[r], y.get(q, 0) / y[r]) for q in {*x, *y}) for r in common)
            if total >= least - 1e-9:
                a, b = sorted((root[i], root[j]))
                root = [a if r == b else r for r in root]
    return root


def test_near_classes_match_weighted_brute_force(spark):
    rng = random.Random(11)
    base = prose(rng, 60).split()
    phrase = " ".join(base[:12])
    texts = [
        " ".join(base), " ".join(base * 3), " ".join(base) + " " + (phrase + " ") * 6, (phrase + " ") * 30, phrase + " end",
        (phrase + " ") * 28 + "other end of it all", "a b c d e " * 40 + "x", "a b c d e " * 41 + "y z", None, "a b",
    ]
    for k in range(12):  # a passage repeated more or less often decides the weighted similarity
        texts.append(" ".join(base[:40]) + " " + (" ".join(base[40:52]) + " ") * (k % 5 + 1) + f"tail{k // 6}")
    rows = near_dedup.near_classes(frame(spark, texts)).collect()
    want = weighted_classes(texts)
    assert {r["doc_id"]: r["class_id"] for r in rows} == dict(enumerate(want))
    assert want != brute_classes(texts)


def test_buckets_of_many_blocks_and_unlike_texts(spark):
    rng = random.Random(12)
    passage, texts = prose(rng, 100), []
    for k in range(150):  # alike to 0.7 by a passage they share, and no link
        texts.append(passage + " " + " ".join(f"own{k}x{n}" for n in range(20)))
    for k in range(0, 150, 3):  # but every third has a copy that differs in a word, which links the two
        texts.append(texts[k] + " changed")
    want = brute_classes(texts)
    assert len(set(want)) == 150
    for block in (16, near_dedup.BLOCK):
        rows = near_dedup.near_classes(frame(spark, texts), block=block).collect()
        assert {r["doc_id"]: r["class_id"] for r in rows} == dict(enumerate(want))


def test_probability_jaccard_by_definition():
    rng = np.random.default_rng(3)
    for _ in range(200):
        x, y = (rng.permutation(12)[:rng.integers(1, 12)].astype(np.uint64) for _ in range(2))
        x, y = np.sort(x), np.sort(y)
        w, v = rng.integers(1, 5, len(x)).astype(float), rng.integers(1, 5, len(y)).astype(float)
        a, b = dict(zip(x.tolist(), w)), dict(zip(y.tolist(), v))
        want = sum(1 / sum(max(a.get(j, 0) / a[i], b.get(j, 0) / b[i]) for j in {*a, *b}) for i in a if i in b)
        assert abs(near_dedup.prob_jaccard(x, w, y, v) - want) < 1e-9


def test_stages_keep_one_of_repeated_rows(spark):
    a, b = "one two three four five six seven eight", "other words " * 20
    rows = [(1, a), (1, a), (1, b), (2, a), (0, b), (None, a), (None, "alone here"), (None, "alone here"), (None, "only this"), (3, "x y"), (3, "p q")]
    rows += [(4, None), (4, None), (5, "!!"), (5, "!!"), (6, "a\tb"), (6, "a b")]
    docs = frame(spark, [t for _, t in rows], [i for i, _ in rows])
    want = [(None, "alone here"), (None, "only this"), (0, b), (1, a), (3, "p q"), (3, "x y"), (4, ""), (5, "!!"), (6, "a b")]
    for stage in (exact_dedup.drop_copies, near_dedup.drop_near):
        kept = stage(docs)
        got = [(r["doc_id"], re.sub(r"\s", " ", r["text"] or "")) for r in kept.collect()]
        assert sorted(got, key=str) == sorted(want, key=str) and kept.columns == docs.columns


def test_near_classes_empty(spark):
    assert near_dedup.near_classes(frame(spark, [])).count() == 0
    assert near_dedup.near_classes(frame(spark, [None, ""])).count() == 2


def test_prob_minhash_estimates_probability_jaccard():
    rng = np.random.default_rng(1)
    keys = rng.integers(1, 2**63, 60, dtype=np.uint64)
    a, b = rng.integers(1, 6, 60).astype(float), rng.integers(0, 6, 60).astype(float)
    has = b > 0
    want = sum(1 / np.maximum(a / a[i], b / b[i]).sum() for i in range(60) if has[i])
    x = near_dedup.prob_minhash(keys, a, 4096)
    y = near_dedup.prob_minhash(keys[has], b[has], 4096)
    assert abs((x == y).mean() - want) < 4 * math.sqrt(want * (1 - want) / 4096)


def test_components_match_union_find(spark):
    rng = random.Random(2)
    links = [(rng.randint(0, 200), rng.randint(0, 200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 340)]
    parent = list(range(400))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {n: find(n) for a, b in links if a != b for n in (a, b)}


# packing


def test_pack_ids_and_places(spark):
    from tokenizers import Tokenizer

    path = P.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    rng = random.Random(1)
    texts = [None, "", "It's DON'T 12.5, É. a\u0085b \x1c x ..", "w " * 200] + [prose(rng, rng.randint(1, 60)) for _ in range(60)]
    rows = packing.pack(frame(spark, texts), path, capacity=64).collect()
    want = {}
    for i, t in enumerate(texts):
        ids = tok.encode(t or "", add_special_tokens=False).ids + [1]
        for piece, at in enumerate(range(0, len(ids), 64)):
            own = ids[at:at + 64]
            want[i, piece] = (at, len(own), zlib.crc32(np.array(own, "<u4").tobytes()))
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in rows} == want
    bins = collections.defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 64
    assert len(bins) <= -(-sum(r["length"] for r in rows) // 64) + 1
    assert packing.pack(frame(spark, []), path).count() == 0


def test_fullest_is_optimal():
    rng = random.Random(4)
    for _ in range(200):
        counts = {rng.randint(1, 30): rng.randint(1, 3) for _ in range(4)}
        room = rng.randint(0, 60)
        sums = {0}
        for n, c in counts.items():
            sums = {s + k * n for s in sums for k in range(c + 1)}
        got = packing.fullest(counts, room)
        assert sum(got) == max(s for s in sums if s <= room)
        assert all(collections.Counter(got)[n] <= counts[n] for n in got)


# pages


def test_main_text(spark):
    pages = [
        (i, "u", f"<html><body><nav><a>Menu here</a></nav><div class='ad'>Buy now words</div><article><h1>Title {i}</h1><p>One &amp; two"
                 f"<br>three  <b>four</b><p>Five words are in here</article><div id=comments><p>reader words words</p></div><footer>end of it</footer>")
        for i in range(20)
    ]
    pages += [(50, "u", None), (51, "u", ""), (52, "u", "<div>no article but plain words</div><form>input text</form>")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r["page_id"]: r for r in html_text.extract(df, html_text.train(df)).collect()}
    assert got[3]["text"] == "Title 3\nOne & two three four\nFive words are in here"
    assert (got[50]["text"], got[51]["text"], got[50]["n_chars"]) == ("", "", 0)
    assert got[52]["text"] == "no article but plain words"
    empty = df.limit(0)
    assert html_text.train(empty) == {} and html_text.extract(empty, {}).count() == 0
    assert html_text.main_text("<p>plain words of a page</p>", {}) == "plain words of a page"
    assert html_text.main_text("<!-- open " + "x" * 100000, {}) == ""


def test_main_text_keeps_articles_with_suspect_names():
    body = "<h1>Title words here</h1><p>One two three four five</p><p class='ad-lib'>Six seven eight nine</p>"
    want = "Title words here\nOne two three four five\nSix seven eight nine"
    around = "<nav><a>Menu here</a></nav>{}<div id=comments><article class=comment>reader words words</article></div><footer>end</footer>"
    for page in (
        f"<main class='content has-sidebar'>{body}</main>", f"<article class='post category-social'>{body}</article>",
        f"<div id='page-with-comments'><article>{body}</article></div>", f"<main class='widget'><article>{body}</article></main>",
        f"<div class='widget'><article>{body}</article></div>", f"<form><article>{body}</article></form>",
        f"<div id='page-with-comments'>{body}</div>", f"<form>{body}</form>",
        f"<article>{body}<div class='ad'>buy now</div></article><div class='related'><article>other teaser</article></div>",
    ):
        assert html_text.main_text("<html><body>" + around.format(page) + "</body></html>", {}) == want, page
    assert html_text.main_text(f"<html><body><form id=f>{around.format(body)}</form></body></html>", {}) == want
    assert html_text.main_text(f"<div>{body}</div><div class='left-ads'>buy now now</div>", {}) == want
    weights = {"p": 0.5, "p+s": html_text._weight({}, "p+s")}
    assert weights["p+s"] < 0 and html_text.main_text(f"<div class=x-promo><p>a b</p></div><article>{body}</article>", {}) == want


# neighbours


def test_nearest_recall_and_copies(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(1200, 12)) * rng.uniform(0.5, 2, size=(1200, 1))
    x[100:500] = x[100]  # one very common vector
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(x)]
    rows += [(2000, None), (2001, [0.0] * 12), (2020, [float("nan")] * 12), (None, [1.0] * 12), (2040, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = collections.defaultdict(list)
    for r in ann.nearest(df, F.col("vec_id") % 20 == 0, shard_rows=400, query_rows=30).collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    v = x.astype(np.float32).astype(float)
    hit = 0
    for q in range(0, 1200, 20):
        scores = v @ v[q]
        want = sorted((-s, i) for i, s in enumerate(scores) if i != q)[:20]
        own = sorted(got[q])
        assert [r for r, _, _ in own] == list(range(1, 21))
        assert all(abs(s - scores[i]) < 1e-9 for _, i, s in own)
        assert [(-s, i) for _, i, s in own] == sorted((-s, i) for _, i, s in own)
        hit += len({i for _, i in want} & {i for _, i, _ in own})
    assert set(got) == set(range(0, 1200, 20)) and hit / (60 * 20) >= 0.9
    assert ann.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


# token counts


def test_line_tokens_match_library_offsets(spark):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    texts = [None, "", "\n", "one two\nthree  \n\n four", "é😀 x\ny日本", "w" * 20000 + "\n" + "b c " * 3000]
    got = collections.defaultdict(dict)
    for r in token_counts.count_tokens(frame(spark, texts), P.path("byte_bpe_50k.tiktoken"), P.PATTERN).collect():
        got[r["doc_id"]][r["section"]] = (r["start"], r["end"], r["n_tokens"])
    for i, t in enumerate(t or "" for t in texts):
        spans, at = [], 0
        for line in t.split("\n"):
            spans.append((at, min(at + len(line) + 1, len(t))))
            at += len(line) + 1
        counts = [0] * len(spans)
        for a, b in tok.encode(t, add_special_tokens=False).offsets:
            counts[max(range(len(spans)), key=lambda k: (min(b, spans[k][1]) - max(a, spans[k][0]), -k))] += 1
        assert [got[i][k] for k in range(len(spans))] == [(*s, n) for s, n in zip(spans, counts, strict=True)]


def test_rules_for_crossing_tokens():
    starts, ends = np.array([0, 3, 8, 12]), np.array([3, 8, 12, 14])
    low, high = np.array([0, 4, 9]), np.array([4, 9, 11])
    own, crosses = token_counts.attribute(starts, ends, low, high, "largest")
    assert own.tolist() == [0, 1, 2, -1] and crosses.tolist() == [False, True, True, False]
    own, _ = token_counts.attribute(starts, ends, low, high, "first")
    assert own.tolist() == [0, 0, 1, -1]


def test_packing_asks_for_ids_only():
    """Words are encoded without offsets, and a word of many texts is asked for once."""
    encode = packing.WordEncoder(P.path("word_bpe_49k.json"), 1000)

    class Fast:
        def __init__(self, tokenizer):
            self.tokenizer, self.asked = tokenizer, []

        def encode_batch_fast(self, texts, **options):
            self.asked += texts
            return self.tokenizer.encode_batch_fast(texts, **options)

    texts = ["new-word, x1 Straße 日本 Plain."] * 5 + ["", " x1\x1cx1 "]
    plain = [encode.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    encode.tokenizer = fast = Fast(encode.tokenizer)
    assert [np.frombuffer(b, dtype="<u4").tolist() for b in encode(texts)] == plain
    assert fast.asked.count("x1") == 1


def test_packing_encodes_marks_apart_from_words():
    """Marks behind a word and capitals cost no encoding of their own; all ids are those of the whole text."""
    encode = packing.WordEncoder(P.path("word_bpe_49k.json"), 50)
    asked, plain = [], encode.tokenizer
    whole = lambda t: plain.encode(t, add_special_tokens=False).ids

    class Seen:
        def encode_batch_fast(self, texts, **options):
            asked.extend(texts)
            return plain.encode_batch_fast(texts, **options)

    encode.tokenizer = Seen()
    texts = ["dble$$$ Dble,*** Ciónmenteí. ciónmenteí!! DBLE"]
    assert [np.frombuffer(b, dtype="<u4").tolist() for b in encode(texts)] == [whole(t) for t in texts]
    assert sorted(asked) == ["!!", "$$$", ",***", "."]
    assert [np.frombuffer(b, dtype="<u4").tolist() for b in encode([*texts, ""])] == [whole(texts[0]), []]  # nothing new
    encode.known, encode.old = {"": b""}, encode.known
    assert [np.frombuffer(b, dtype="<u4").tolist() for b in encode(texts)] == [whole(t) for t in texts]
    rng = random.Random(3)
    parts = ["<|endoftext|>", "<", "|>", "é", "É", "e", "\u0301", "İ", "Σ", "ß", "Ж", "日", "७", "ﷺ", "\u0958", "ª", "ǅ", "A", "z", "1", "'s", "'",
             "…", "$", "=", "\u0338", " ", "\n", "\xa0", "\x1c", "\x85", "\u2028", "\x00", "_"]
    texts = ["".join(rng.choices(parts + list(packing._MARKS), k=rng.randint(0, 30))) for _ in range(4000)]
    assert [np.frombuffer(b, dtype="<u4").tolist() for b in encode(texts)] == [whole(t) for t in texts]


# sampled pieces


def test_frequent_words_are_filtered_once(monkeypatch):
    """A full memory keeps the words that many portions use, and draws stay the same."""
    path, rng = P.path("piece_bpe_32k.model"), random.Random(2)
    texts = ["the often seen words " + " ".join("".join(rng.choices("abcdefgh", k=9)) for _ in range(10)) for _ in range(200)]
    keys = list(range(len(texts)))
    whole = [p.tolist() for p in sampled_pieces.Sampler(path)(keys, texts)]
    monkeypatch.setattr(sampled_pieces, "CACHE_PLACES", 1000)
    monkeypatch.setattr(sampled_pieces, "TOGETHER", 300)
    filtered, filter_ = collections.Counter(), sampled_pieces.Sampler._filter
    monkeypatch.setattr(sampled_pieces.Sampler, "_filter", lambda self, words: filtered.update(words) or filter_(self, words))
    draw = sampled_pieces.Sampler(path)
    assert [p.tolist() for p in draw(keys, texts)] == whole
    assert filtered["▁often"] == filtered["▁seen"] == 1 and draw.used < 2000


def test_longer_substrings_are_looked_up_only_where_a_piece_ends_so(monkeypatch):
    """Of a word without pieces of several characters only its characters and pairs are looked up; marked words split alike."""
    looked, lookup = [], sampled_pieces.Sampler._lookup
    monkeypatch.setattr(sampled_pieces.Sampler, "_lookup", lambda self, hashes: looked.append(len(hashes)) or lookup(self, hashes))
    draw = sampled_pieces.Sampler(P.path("piece_bpe_32k.model"))
    word = "\u0416\u4e5d" * 500
    assert draw.decode(next(draw([1], [word])).tolist()) == word
    assert sum(looked) <= 2 * len("\u2581" + word) + 10
    rng = random.Random(5)
    for _ in range(3000):
        text = "".join(rng.choices("a  \n\u2581b\t", k=rng.randint(1, 9)))
        marked = "\u2581" + text.replace("\u2581", sampled_pieces.KEPT).replace(" ", "\u2581")
        assert sampled_pieces._words(text) == sampled_pieces._WORD.findall(marked)


def test_pieces_round_trip_and_shares(spark):
    path, rng = P.path("piece_bpe_32k.model"), random.Random(1)
    texts = [None, "", " ", "▁", "a▁ b", "é😀\x00 \n\n", "x" * 3000, "日本語" * 40, " lead  trail "]
    texts += ["".join(rng.choice("ab ▁é\n日😀.") for _ in range(30)) for _ in range(50)]
    rows = sampled_pieces.sample_pieces(frame(spark, texts), path).collect()
    assert len(rows) == len(texts) and all(r["lossless"] for r in rows)
    draw = sampled_pieces.Sampler(path)
    one = {r["doc_id"]: r["pieces"] for r in sampled_pieces.sample_pieces(frame(spark, texts).repartition(7), path).collect()}
    assert all(one[r["doc_id"]] == r["pieces"] for r in rows)  # the same in any layout
    drawn = collections.Counter(tuple(p.tolist()) for p in draw(list(range(20000)), ["the"] * 20000))

    def ways(word):
        if not word:
            yield (), 1.0
        for n in range(1, len(word) + 1):
            if word[:n] in names:
                for rest, w in ways(word[n:]):
                    yield (names[word[:n]], *rest), w / (names[word[:n]] + 1)

    names = {draw.spelled[i].decode("utf-8", "replace").replace(" ", "▁"): i for i in range(259, len(draw.spelled))}
    shares = dict(ways("▁the"))
    for way, w in shares.items():
        assert abs(drawn[way] / 20000 - w / sum(shares.values())) < 0.02


# licenses


def test_licenses_match_brute_force(spark):
    rng = random.Random(7)
    texts = [None, "", "software license"]
    for _ in range(60):
        parts = [prose(rng, rng.randint(0, 30))]
        for _ in range(rng.randint(0, 2)):
            words = rng.choice(licenses.TEMPLATES)[1].split()
            if rng.random() < 0.4:
                words[rng.randrange(len(words))] = "changed"
            parts += [" ".join(words), prose(rng, rng.randint(20, 60))]
        texts.append("\n".join(parts))
    got = {(r["doc_id"], r["template"]): r["containment"] for r in licenses.scan(frame(spark, texts)).collect()}
    exact = set()
    for window, stride, _, members in licenses.plan(licenses.TEMPLATES, licenses.LEAST, licenses.MISS):
        for i, t in enumerate(texts):
            words, hits = licenses.words_of(t or ""), []
            for start in range(0, len(words), stride):
                runs = set(licenses.runs_of(words[start:start + window]))
                for m in members:
                    own = set(licenses.runs_of(licenses.words_of(licenses.TEMPLATES[m][1])))
                    if len(own & runs) >= licenses.LEAST * len(own):
                        hits.append((start, m, len(own & runs) / len(own)))
            for start, m, share in hits:
                if share >= max(s for a, _, s in hits if abs(a - start) <= window // 2):
                    exact.add((i, m))
    assert set(got) == exact and len(exact) > 20
    assert licenses.scan(frame(spark, [])).count() == 0


def test_licenses_find_notices_written_independently(spark):
    notices = {
        "This work is licensed under the GNU General Public License, version 3.": {"GPL-3.0"},
        "All rights reserved.": {"Proprietary"},
        "Copyright (c) 1999 Some Company, Inc.  ALL RIGHTS RESERVED": {"Proprietary"},
        "Licensed under CC BY-NC 4.0.": {"CC-BY-NC-4.0"},
        "Released under the MIT License.": {"MIT"},
        "Licensed under the Apache License, Version 2.0.": {"Apache-2.0"},
        "This work is licensed under the GNU Lesser General Public License, version 2.1.": {"LGPL-2.1"},
        "This work is licensed under the GNU Lesser General Public License, version 3.": {"LGPL-3.0"},
        "This work is licensed under the GNU Affero General Public License, version 3.": {"AGPL-3.0"},
        "# This library is free software; you can redistribute it and/or modify it under the\n# terms of the GNU Lesser General Public"
        " License as published by the Free\n# Software Foundation; either version 2.1 of the License, or any later version.": {"LGPL"},
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public"
        " License as published by the Free Software Foundation, either version 3 of the License": {"AGPL"},
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public"
        " License as published by the Free Software Foundation, either version 3 of the License": {"GPL"},
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided"
        " that the above copyright notice and this permission notice appear in all copies.": {"ISC"},
        "Licensed under CC0 1.0.": {"CC0-1.0"},
        "This is free and unencumbered software released into the public domain.": {"Unlicense"},
        "All the rights were reserved, and the license of this version is under review by the public.": set(),
    }
    rng = random.Random(11)
    texts = ["\n".join([prose(rng, 40), notice, prose(rng, rng.randint(0, 40))]) for notice in notices] + [" \n".join(notices)]
    got = collections.defaultdict(set)
    for r in licenses.scan(frame(spark, texts)).collect():
        got[r["doc_id"]].add(r["license"])
    assert {n: got[i] for i, n in enumerate(notices)} == notices
    assert {"Proprietary", "MIT", "Apache-2.0", "CC-BY-NC-4.0", "CC0-1.0", "Unlicense", "ISC"} <= got[len(notices)]


# toxicity


def test_toxicity_on_held_out_rows(spark):
    rng = random.Random(9)
    texts, labels = [None, ""], []
    for i in range(2, 402):
        toxic = i % 4 == 0
        words = prose(rng, rng.randint(20, 60)).split()
        if toxic:
            for k in range(rng.randint(1, 4)):
                words[k] = rng.choice(["vileword", "nastyword", "awfulword"]) + rng.choice(["", "s"])
        texts.append(" ".join(words))
        labels.append((i, int(toxic)))
    docs = frame(spark, texts)
    known = spark.createDataFrame(labels[:250] + [(None, 1), (9999, 1), (3, None)], "doc_id long, toxic int")
    rows = {r["doc_id"]: r for r in toxicity.toxic_scores(docs, toxicity.train(docs, known)).collect()}
    assert len(rows) == 402 and not rows[0]["toxic"] and not rows[1]["toxic"]
    held = labels[250:]
    assert sum(rows[i]["toxic"] == bool(t) for i, t in held) / len(held) >= 0.97
    nothing = toxicity.train(docs, known.limit(0))
    assert toxicity.drop_toxic(docs, nothing).count() == 402
    assert toxicity.drop_toxic(docs.limit(0), nothing).count() == 0


def test_pipeline_stages_keep_columns(spark):
    pytest.importorskip("corpus_pipeline")
    import corpus_pipeline as c

    assert [n for n, _ in c.STAGES] == ["toxicity", "exact dedup", "near dedup", "secrets", "packing"]
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in c.STAGES[:-1]:
        kept = stage(spark, docs, sf)
        assert kept.columns == docs.columns
        docs = kept
