"""Secret scans with DataFrame functions only.

Base patterns find assigned values, access keys and hex strings.  Further spans come from two character Markov models: one of
random strings, one of ordinary identifiers.  Both are bigram counts that Spark takes over all rows: digests of
their ids in several alphabets are the random strings; the different words of their texts and of the names that the Python libraries in use export, joined as names are (camel and Pascal case, snake case in both cases, dashes,
with and without numbers) and alone, are the identifiers (the mean of a model of each source).  Every token of 16 characters and more that has a letter is scored by
its log-likelihood ratio; the ratio from which it is reported is set on names made of words held out of training.  A token that overlaps a base span adds nothing.  Tokens with slashes are paths or base64: they are cut
at slashes and equals signs, ordinary parts (words by their shape or their ratio, and what a base span holds) end a run, and
every run of the other parts is judged as one token, separators counting nothing.  So a base64 key is found whole, unless a part
of it looks like a word, and a path's words are left.

Matches of one pattern and the text between them come from the same left-to-right search (`regexp_extract_all` and `split`),
so positions are running lengths in code points.  Null and empty texts have no spans; repeated rows are reported each; an
empty table gives no rows; other columns are ignored; texts of any length are read whole.
"""

from __future__ import annotations

import math
import os
import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from gleaner.llm.common import pinned

# Patterns of the contract (fixed values).
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
#: Tokens that the models judge (they need a letter; numbers and rules of dashes are none), words to learn from.
TOKEN = r"[A-Za-z0-9+_=-]{16,}"
LETTER = "[A-Za-z]"
#: The same tokens with slashes among their characters, and what parts them.  A part is ordinary with the shape of words in one
#: case (or capitalised) joined by dashes and underscores, or with less than the ratio ORDINARY and no digit or plus sign.
SLASHED = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z0-9+/_=-]{16})[A-Za-z0-9+_=-]*/[A-Za-z0-9+/_=-]*"
SEPARATOR = "[/=]"
_WORD = r"(?:(?:[A-Z]{4,}+|[A-Z]?[a-z]{4,}+)[0-9]{1,4}+|[A-Z]{2,}+|[A-Z]?[a-z]{2,}+|[A-Za-z])"
WORDS = rf"^(?=.{{4,64}}$){_WORD}(?:[-_]++(?:{_WORD}|[0-9]++))*+$"
ORDINARY = -6.0
LEAST_LENGTH = 16
IDENTIFIER = r"(?<![A-Za-z0-9_])[A-Za-z]{2,14}(?![A-Za-z0-9_])"
KINDS = ["assign", "access", "hex", "random"]
#: Share of held-out identifiers that may be reported, and the log-likelihood ratio (nats) from which a token is reported at least.
FALSE_SHARE = 0.001
LEAST_RATIO = 4.0
#: Orders of the words from which names are made; observations that a bigram's prior counts for.
SHUFFLES = 8
#: Groups of an order whose words are neighbours: sixteen, or as many as keep them at about so many words.
GROUPS, GROUP_WORDS = 16, 4096
BACK_OFF = 50


def _spans(text: Column, pattern: str, kind: int, group: int = 0, least: int = 0) -> Column:
    """Array of (start, kind, end) of the leftmost non-overlapping matches whose group has `least` characters."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    judged = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    between = F.split(text, pattern, -1)
    rows = F.arrays_zip(found.alias("m"), judged.alias("g"), F.slice(between, 1, F.size(found)).alias("b"))
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    start = F.struct(F.lit(0).alias("pos"), none.alias("out"))

    def step(acc: Column, row: Column) -> Column:
        at = acc["pos"] + F.length(row["b"])
        end = at + F.length(row["m"])
        span = F.array(F.struct(at.alias("start"), F.lit(kind).alias("kind"), end.alias("end")))
        out = F.when(F.length(row["g"]) >= least, F.concat(acc["out"], span)).otherwise(acc["out"])
        return F.struct(end.alias("pos"), out.alias("out"))

    return F.when(text.rlike(pattern), F.aggregate(rows, start, step, lambda acc: acc["out"])).otherwise(none)


def _bigrams(tokens: DataFrame) -> DataFrame:
    at = F.explode(F.sequence(F.lit(1), F.length("token") - 1))
    pairs = tokens.filter(F.length("token") > 1).select("random", "token", at.alias("i"))
    code = F.ascii(F.substring("token", F.col("i"), F.lit(1))) * 128 + F.ascii(F.substring("token", F.col("i") + 1, F.lit(1)))
    return pairs.groupBy("random", code.alias("code")).agg(F.count("*").alias("n"))


def _names(words: Column) -> Column:
    """Identifiers made of neighbouring words, in a form that hangs on them."""
    def name(i: Column) -> Column:
        a, b, c = (F.lower(F.get(words, i + k)) for k in range(3))
        form = F.pmod(F.xxhash64(a, b, c), F.lit(10))
        number = F.substring(F.abs(F.xxhash64(c, a)).cast("string"), 1, F.pmod(F.xxhash64(b), F.lit(4)).cast("int") + 1)
        snake, camel = F.concat_ws("_", a, b, c), F.concat(a, F.initcap(b), F.initcap(c))
        forms = [
            camel, F.concat(F.initcap(a), F.initcap(b), F.initcap(c)), snake, F.upper(snake), F.concat_ws("-", a, b, c), F.concat(camel, number),
            F.concat_ws("_", a, b, number), F.concat(a, F.initcap(b), number, F.initcap(c)), F.concat(a, b, c), F.initcap(a),
        ]
        return F.get(F.array(*forms), form.cast("int"))

    return F.when(F.size(words) > 2, F.transform(F.sequence(F.lit(0), F.size(words) - 3), name)).otherwise(F.array().cast("array<string>"))


def library_words() -> list[str]:
    """Words of the names that the Python libraries in use export: labelled parts of ordinary identifiers."""
    names = {n for module in (F, DataFrame, os, np, pd, pd.DataFrame) for n in dir(module)}
    return sorted({w.lower() for n in names for w in re.findall("[A-Z]?[a-z]+", n) if 2 <= len(w) <= 14})


def corpus_words(docs: DataFrame) -> DataFrame:
    """(random, word): the different lower-case words of all texts without base matches (0) and of the library (2), written once."""
    text = docs.filter(F.col("doc_id").isNotNull()).select(F.coalesce("text", F.lit("")).alias("text"))
    clean = text.filter(~(F.col("text").rlike(ASSIGN) | F.col("text").rlike(ACCESS) | F.col("text").rlike(HEX)))
    found = F.transform(F.regexp_extract_all("text", F.lit(IDENTIFIER), F.lit(0)), F.lower)
    words = clean.select(F.explode(F.array_distinct(found)).alias("word"))
    known = docs.sparkSession.createDataFrame([(w,) for w in library_words()], "word string")
    both = words.select(F.lit(0).alias("random"), "word").unionByName(known.select(F.lit(2).alias("random"), "word"))
    return pinned(both.distinct(), "secret_words")


def _identifiers(words: DataFrame, held: bool) -> DataFrame:
    """(random, token): identifiers of the words (see ``corpus_words``) for training, or of the fifth held out."""
    groups = max(GROUPS, -(-words.count() // GROUP_WORDS))
    fold = F.pmod(F.xxhash64("word"), F.lit(5))
    words = words.filter(fold == 0 if held else fold > 0)
    words = words.select("random", "word", F.explode(F.sequence(F.lit(0), F.lit(SHUFFLES - 1))).alias("nth"))
    near = F.sort_array(F.collect_list(F.struct(F.xxhash64("word", "nth", F.lit(1)).alias("h"), "word")))
    rows = words.groupBy("random", "nth", F.pmod(F.xxhash64("word", "nth"), F.lit(groups))).agg(near.alias("near"))
    names = rows.select("random", F.col("near.word").alias("words"))
    return names.select("random", F.explode(_names(F.col("words"))).alias("token")).distinct()


def _drawn(docs: DataFrame) -> DataFrame:
    """(random, token): random strings (1), from the digests of all ids."""
    picked = docs.select("doc_id").filter(F.col("doc_id").isNotNull()).distinct()
    digest = F.sha2(F.col("doc_id").cast("string"), 512)
    wide = F.regexp_replace(F.base64(F.unhex(digest)), r"\s|=", "")
    letters = F.regexp_replace(wide, "[^A-Za-z]", "")
    forms = [wide, F.regexp_replace(wide, "[+/]", ""), letters, F.lower(letters), F.lower(F.regexp_replace(wide, "[+/]", "")),
             F.upper(F.regexp_replace(wide, "[+/]", "")), F.substring(digest, 1, 24)]
    return picked.select(F.lit(1).alias("random"), F.explode(F.array(*forms)).alias("token"))


def calibrated(docs: DataFrame, ratios: list[float], false_share: float = FALSE_SHARE, words: DataFrame | None = None) -> float:
    """The ratio that `false_share` of the long identifiers of held-out words, of the worse source, exceed; LEAST_RATIO at least."""
    names = _identifiers(corpus_words(docs) if words is None else words, True)
    scores = names.filter(F.length("token") >= LEAST_LENGTH).select("random", _ratio(F.col("token"), _table(ratios)).alias("ratio"))
    found = scores.groupBy("random").agg(F.percentile_approx("ratio", 1 - false_share, 100_000).alias("at")).collect()
    return max([LEAST_RATIO, *(r["at"] for r in found)])


def markov_ratios(docs: DataFrame, words: DataFrame | None = None) -> list[float]:
    """log P(b | a, random) - log P(b | a, identifier) at index 128 a + b, from all rows; 0 between two signs.

    The digests are counted apart from the names, so that their bigrams never share a shuffle with words.
    """
    names = _identifiers(corpus_words(docs) if words is None else words, False)
    counts = {(r["random"], r["code"]): r["n"] for tokens in (names, _drawn(docs)) for r in _bigrams(tokens).collect()}
    kind = [0 if chr(a).islower() else 1 if chr(a).isupper() else 2 if chr(a).isdigit() else 3 for a in range(128)]
    size = [26, 26, 10, 5]
    first, second, kinds, turns = Counter(), Counter(), Counter(), Counter()
    for (c, code), n in counts.items():
        a, b = divmod(code, 128)
        first[c, a] += n
        second[c, b] += n
        kinds[c, kind[b]] += n
        turns[c, kind[a], kind[b]] += n

    def p(c: int, a: int, b: int) -> float:
        """Bigram share, drawn (by BACK_OFF observations) towards that of the turn from one kind of character to the other."""
        turned = sum(turns[c, kind[a], k] for k in range(4))
        turn = (turns[c, kind[a], kind[b]] + 0.5) / (turned + 2)
        alone = (second[c, b] + 0.5) / (kinds[c, kind[b]] + 0.5 * size[kind[b]])
        return (counts.get((c, 128 * a + b), 0) + BACK_OFF * turn * alone) / (first[c, a] + BACK_OFF)

    sign = lambda a: not chr(a).isalnum()
    return [0.0 if sign(a) and sign(b) else math.log(2 * p(1, a, b) / (p(0, a, b) + p(2, a, b))) for a in range(128) for b in range(128)]


def _table(ratios: list[float]) -> Column:
    return F.split(F.lit(",".join(f"{x:.4f}" for x in ratios)), ",").cast("array<double>")


def trained(docs: DataFrame) -> tuple[list[float], float]:
    """The ratios learned from `docs`, and the ratio from which to report a token."""
    words = corpus_words(docs)
    ratios = markov_ratios(docs, words)
    return ratios, calibrated(docs, ratios, words=words)


def _cut(text: Column, span: Column) -> Column:
    return F.substring(text, span["start"] + 1, span["end"] - span["start"])


def _ratio(token: Column, table: Column) -> Column:
    """Sum of the bigrams' ratios; 0 for less than two characters."""
    at = F.sequence(F.lit(1), F.length(token) - 1)
    code = lambda i: F.ascii(F.substring(token, i, F.lit(1)))
    total = F.aggregate(at, F.lit(0.0), lambda acc, i: acc + F.get(table, code(i) * 128 + code(i + 1)))
    return F.when(F.length(token) > 1, total).otherwise(0.0)


def _overlaps(span: Column, others: Column) -> Column:
    return F.exists(others, lambda b: (b["start"] < span["end"]) & (span["start"] < b["end"]))


def _runs(text: Column, span: Column, base: Column, table: Column) -> Column:
    """Array of (start, end, ratio) of the runs of a slashed token's parts that are no ordinary words; numbers count nothing."""
    place = lambda pos, part: F.struct(pos.alias("start"), (pos + F.length(part)).alias("end"))
    none = F.array().cast("array<struct<start:int,end:int,ratio:double>>")
    start = F.struct(span["start"].alias("pos"), F.lit(True).alias("cut"), none.alias("out"))

    def step(acc: Column, part: Column) -> Column:
        own = place(acc["pos"], part)
        ratio = F.when(part.rlike("^[0-9]*$"), 0.0).otherwise(_ratio(part, table))
        cut = part.rlike(WORDS) | ((ratio < ORDINARY) & ~part.rlike("[0-9+]")) | _overlaps(own, base)
        last = F.element_at(acc["out"], -1)
        new = F.struct(own["start"].alias("start"), own["end"].alias("end"), ratio.alias("ratio"))
        longer = F.struct(last["start"].alias("start"), own["end"].alias("end"), (last["ratio"] + ratio).alias("ratio"))
        extended = F.concat(F.slice(acc["out"], 1, F.size(acc["out"]) - 1), F.array(longer))
        out = F.when(cut, acc["out"]).when(acc["cut"], F.concat(acc["out"], F.array(new))).otherwise(extended)
        return F.struct((own["end"] + 1).alias("pos"), cut.alias("cut"), out.alias("out"))

    return F.aggregate(F.split(_cut(text, span), SEPARATOR, -1), start, step, lambda acc: acc["out"])


def _unused(docs: DataFrame, name: str) -> str:
    """A column name that `docs` does not have, whatever the case of its letters."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def find_secrets(docs: DataFrame, ratios: list[float], least: float = LEAST_RATIO, name: str = "secret_spans") -> DataFrame:
    """The rows with a column `name`: array of (start, kind, end), sorted; kind indexes KINDS, places are code points.

    A column of that name is replaced; all others stay.
    """
    based, taken = _unused(docs, "__base"), _unused(docs, "__taken")
    text = F.coalesce(F.col("text"), F.lit(""))
    table = _table(ratios)
    lettered = lambda s: _cut(text, s).rlike(LETTER)
    base = F.concat(_spans(text, ASSIGN, 0, 2, 6), _spans(text, ACCESS, 1), _spans(text, HEX, 2))
    found = docs.withColumn(based, base)
    runs = F.flatten(F.transform(_spans(text, SLASHED, 3), lambda s: _runs(text, s, F.col(based), table)))
    runs = F.filter(runs, lambda r: (r["end"] - r["start"] >= LEAST_LENGTH) & (r["ratio"] >= least) & lettered(r))
    span = lambda r: F.struct(r["start"].alias("start"), F.lit(3).alias("kind"), r["end"].alias("end"))
    found = found.withColumn(taken, F.concat(based, F.transform(runs, span)))
    free = F.filter(_spans(text, TOKEN, 3), lambda s: ~_overlaps(s, F.col(taken)))
    plain = F.filter(free, lambda s: lettered(s) & (_ratio(_cut(text, s), table) >= least))
    return found.withColumn(name, F.array_sort(F.concat(taken, plain))).drop(based, taken)


def redact(docs: DataFrame, ratios: list[float], least: float = LEAST_RATIO, mark: str = "[SECRET]") -> DataFrame:
    """The rows with every span (overlapping ones together) replaced by `mark`, and n_chars, if there, brought in line."""
    spans = _unused(docs, "secret_spans")
    found = find_secrets(docs, ratios, least, spans)
    start = F.struct(F.lit(0).alias("pos"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(F.col("text"), acc["pos"] + 1, s["start"] - acc["pos"])
        out = F.when(s["start"] >= acc["pos"], F.concat(acc["out"], gap, F.lit(mark))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["pos"], s["end"]).alias("pos"), out.alias("out"))

    rest = lambda acc: F.concat(acc["out"], F.substring(F.col("text"), acc["pos"] + 1, F.length("text") - acc["pos"]))
    some = F.size(spans) > 0
    clean = found.withColumn("text", F.when(some, F.aggregate(spans, start, step, rest)).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.when(some, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return clean.drop(spans)


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of find_secrets()."""
    names = F.array(*[F.lit(k) for k in KINDS])
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")
    many = lambda k: F.size(F.filter("secret_spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")
    base = F.filter("secret_spans", lambda s: s["kind"] < 3)
    return found.select(
        "doc_id", many(0), many(1), many(2), many(3), F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("secret_spans")).alias("spans"),
    )
