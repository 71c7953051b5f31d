"""Learned abbreviations and word forms, the functions for SQL, and the table of known links."""

import random

import pytest
from pyspark.sql import functions as F

from gleaner.functions import fields, sql, urls
from gleaner.functions import text as tx
from gleaner.operators import articles, cleaning, ranking, vocabulary
from gleaner.session import scratch_path
from gleaner.sources import known_links


# Sentences with abbreviations that the fixed list lacks, and the sentences that must come out.
LANGUAGES = {
    "de": ("bzw", ["Der Hund bzw. die Katze schläft", "Wir sehen den Hund und die Katze", "Die Katze sieht den Hund", "Heute schläft der Hund"]),
    "es": ("pág", ["El libro abre en pág. Siete del tomo", "La casa tiene un libro viejo", "Mi viejo libro está en la casa", "Hoy leo el tomo viejo"]),
    "fr": ("env", ["Il reste env. Trois pommes sur la table", "La table est dans la cuisine", "Une pomme tombe sur la table", "Dans la cuisine il mange une pomme"]),
    "en": ("dept", ["She leads the dept. Of trade and health", "Fast trade grows in the north", "Health is good for trade", "The north grows fast"]),
}


def corpus(spark):
    rng = random.Random(8)
    rows = []
    for lang, (_, lines) in LANGUAGES.items():
        for _ in range(60):
            rows.append((len(rows), lang, ". ".join(rng.sample(lines, 4)) + "."))
    return spark.createDataFrame(rows, "doc_id long, lang string, text string")


def test_abbreviations_outside_the_list_end_no_sentence(spark):
    docs = corpus(spark)
    learned = {r["word"] for r in vocabulary.abbreviations(docs).collect()}
    assert learned == {word for word, _ in LANGUAGES.values()}
    got = cleaning.sentences_learned(docs, "doc_id").join(docs.select("doc_id", "lang"), "doc_id").collect()
    for lang, (_, lines) in LANGUAGES.items():
        assert {r["sentence"].rstrip(".") for r in got if r["lang"] == lang} == set(lines)
    assert max(r["pos"] for r in got) == 3
    # The fixed list cuts after all four.
    assert cleaning.sentences(docs, "doc_id").count() == len(got) + docs.count()


def test_abbreviations_of_odd_corpora(spark):
    none = spark.createDataFrame([], "text string")
    assert vocabulary.abbreviation_scores(none).count() == 0
    odd = spark.createDataFrame([(None,), ("",), ("a. b. c.",), ("... 12. (x.y.)",)], "text string")
    assert {r["word"]: (r["n_stop"], r["n_plain"]) for r in vocabulary.abbreviation_scores(odd).collect()} == {
        "a": (1, 0), "b": (1, 0), "c": (1, 0), "x.y": (1, 0)}
    assert tx.abbreviation_mark(["a.b"], True).count("a[.]b") == 1
    assert spark.range(1).select(tx.split_sentences(F.lit("One abc. Two def."), []).alias("s")).first()["s"] == ["One abc.", "Two def."]


STEMS = ["cat", "dog", "storm", "river", "house", "walk", "talk", "jump", "paint", "clean"]


def test_forms_of_a_word(spark):
    verbs = STEMS[5:]
    words = [s + x for s in STEMS[:5] for x in ("", "s")] + [v + x for v in verbs for x in ("", "s", "ed", "ing")]
    words += ["bus", "gas", "painters", "painter", "cleaner", "cleaners", "talker", "talkers", "walker", "walkers", "jumper", "jumpers", "3s", "lonely"]
    table = spark.createDataFrame([(w,) for w in words * 2], "word string")
    got = {r["word"]: r["form"] for r in vocabulary.word_forms(table).collect()}
    assert {w: got.get(w) for w in ("cats", "storms", "cat", "bus", "gas", "lonely", "3s")} == {
        "cats": "cat", "storms": "storm", "cat": None, "bus": None, "gas": None, "lonely": None, "3s": None}
    for v in verbs:
        assert {got[v + x] for x in ("s", "ed", "ing", "er", "ers")} == {v}  # a form of a form is followed to its end
    assert vocabulary.word_forms(table.where("false")).count() == 0


def test_singular_and_plural_rank_as_one_word(spark):
    plural = [w + "s" for w in STEMS]
    forms = vocabulary.word_forms(spark.createDataFrame([(w,) for w in STEMS + plural], "word string"))
    docs = spark.createDataFrame([(1, "river storm rivers house storms river dog"), (2, "cat cats cat"), (3, None)], "doc_id long, text string")
    got = sorted((r["doc_id"], r["rank"], r["word"]) for r in ranking.keywords(docs, "doc_id", forms=forms).collect())
    assert got == [(1, 1, "river"), (1, 2, "house"), (1, 3, "storm"), (1, 4, "dog"), (2, 1, "cat")]
    plain = [r["word"] for r in ranking.keywords(docs, "doc_id").where("doc_id = 1").collect()]
    assert {"rivers", "storms"} <= set(plain)


@pytest.fixture(scope="module")
def texts(spark):
    odd = ["", "   ", "ab", "abc", "  x y z ", "x" * 300, "http://a.com:8/x", "ftp://", "//b.com", "Dr. Who met Mr. X. He left!\nNew 'line'. e.g. this",
           "2024-01-05T12:00:00-07:00", "2024-01-05T12:00:00", "It's \\d {x} $1 \u0001 odd. Yes?", None]
    return spark.createDataFrame([(v,) for v in odd], "v string")


def test_sql_functions_equal_the_expressions(spark, texts):
    assert set(sql.register(spark)) == set(sql.FUNCTIONS)
    v, n = F.col("v"), F.length("v")
    now, then = F.lit("2024-01-02 00:00:00").cast("timestamp"), F.lit("2024-01-01 12:34:56").cast("timestamp")
    pairs = {
        "trimmed(v)": fields.trimmed(v), "clean_body(v)": fields.clean_body(v), "clean_title(v)": fields.clean_title(v),
        "symbol_key(v)": fields.symbol_key(v), "published_time(v)": fields.published_time(v), "summary_ratio(length(v))": fields.summary_ratio(n),
        "summary_ratio(length(v) * 90)": fields.summary_ratio(n * 90), "url_host(v)": urls.url_host(v), "is_valid_url(v)": urls.is_valid_url(v),
        "resolve_host(v, 'h')": urls.resolve_host(v, F.lit("h")), "is_meaningful(v)": tx.is_meaningful(v),
        "split_sentences(v)": tx.split_sentences(v), "words(v)": tx.words(v),
        "age_hours(timestamp'2024-01-01 12:34:56', timestamp'2024-01-02 00:00:00')": fields.age_hours(then, now),
    }
    assert {name.split("(")[0] for name in pairs} == set(sql.FUNCTIONS)
    both = texts.select("v", *[F.expr(text).alias(f"s{i}") for i, text in enumerate(pairs)], *[c.alias(f"e{i}") for i, c in enumerate(pairs.values())])
    for r in both.collect():
        for i, text in enumerate(pairs):
            assert r[f"s{i}"] == r[f"e{i}"], (text, r["v"])


def test_known_links_are_only_appended_to(spark, t):
    path, stored = scratch_path(spark, "known_links"), t("fx_article")
    first = known_links.catch_up(stored.where("article_id < 1100"), path, 16)
    n = first.count()
    assert 0 < n < known_links.catch_up(stored, path, 16).count() == articles.known_links(stored).count()
    assert known_links.catch_up(stored, path, 16).count() == articles.known_links(stored).count()
    # A session that has never seen the table reads the same folder.
    other = spark.newSession()
    assert known_links.known_link_table(other, path, 16).count() == articles.known_links(stored).count()


def test_stored_links_are_not_shuffled(spark, t):
    seen = known_links.catch_up(t("fx_article"), scratch_path(spark, "known_links"), 16)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = articles.unseen_links(articles.source_from_feed(t("fx_feed")), seen)
        text = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    left, right = text[:text.index("known_links_")].rsplit("Exchange", 1)
    assert "Exchange" not in text[text.index("known_links_"):] and text.count("Exchange") == 1 and "Sort" in right
