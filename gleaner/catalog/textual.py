"""Text: normalisation, sentences, neighbours, cleaning, summaries, keywords."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner.catalog.registry import now, query
from gleaner.functions import fields, sql
from gleaner.functions import text as tx
from gleaner.operators import adjacency, cleaning, ranking, vocabulary
from gleaner.session import scratch_path, widened, written
from gleaner.sources import writers

CUTOFF = 5
SKIPPED = "|".join(tx.SKIPPED_ELEMENTS)
ABBREVIATIONS = "|".join(a.replace(".", "[.]") for a in tx.ABBREVIATIONS)
STOPPED = ", ".join(f"'{w}'" for w in tx.STOP_WORDS)

# The non-ASCII letters of the test tables and control characters that stand
# for them: the oracle's edit distance counts bytes, so each letter must be one.
LETTERS = "éóèñçüêäößíÉÈÑÓÇÄÊÜÖÍ"
STAND_INS = " || ".join(f"chr({c})" for c in [2, 3, 4, 5, 6, 7, 8, 14, 15, 16, 17, 18, 19, 20, 21, 22, 23, 24, 25, 26, 27])


def one_byte(column: str) -> str:
    return f"translate({column}, '{LETTERS}', {STAND_INS})"


def normal(column: str, entities: bool = False) -> str:
    """Oracle normalisation; all letters of the test tables are the same under NFC and NFKC."""
    bare = (
        f"regexp_replace(regexp_replace(regexp_replace({column}, '<!--.*?-->', '', 'gs'), "
        f"'(?is)<({SKIPPED})\\b[^>]*>.*?</({SKIPPED})\\s*>', '', 'g'), '<[/!?]?[a-zA-Z][^>]*>', '', 'g')")
    if entities:
        for entity, char in (("&middot;", "·"), ("&copy;", "©"), ("&quot;", '"')):
            bare = f"replace({bare}, '{entity}', '{char}')"
        bare = f"regexp_replace({bare}, '&amp;?', '&', 'g')"
    return f"nullif(nfc_normalize({bare}), '')"


def sentence_list(column: str) -> str:
    """Oracle sentence rules on a normalised text."""
    marked = f"""regexp_replace(replace({column}, chr(1), ' '), '([.!?]+["''”’»)\\]]*)(\\s)', '\\1' || chr(1) || '\\2', 'g')"""
    marked = f"regexp_replace({marked}, '(^|[^\\p{{L}}])({ABBREVIATIONS})[.]' || chr(1), '\\1\\2.', 'g')"
    pieces = f"string_split(regexp_replace({marked}, '[\\r\\n]+', chr(1), 'g'), chr(1))"
    trimmed = f"list_transform({pieces}, lambda p: regexp_replace(p, '^\\s+|\\s+$', '', 'g'))"
    return f"list_filter({trimmed}, lambda s: regexp_matches(s, '\\P{{P}}\\P{{Z}}\\P{{C}}'))"


DOCS = f"docs AS (SELECT doc_id, {normal('text')} AS text FROM documents)"
DOC_LISTS = f"{DOCS}, lists AS (SELECT doc_id, length(text) AS n_chars, {sentence_list('text')} AS ss FROM docs WHERE text IS NOT NULL)"
DOC_SENTENCES = f"""{DOC_LISTS},
sents AS (SELECT doc_id, n_chars, unnest(ss) AS sentence, unnest(generate_series(0, len(ss) - 1)) AS pos FROM lists)"""


def _docs(t):
    return widened(t("documents").select("doc_id", "text")).transform(cleaning.normalize_text)


def _sentences(t):
    return cleaning.sentences(_docs(t).where("text IS NOT NULL"), "doc_id")


# -- normalisation and sentences ---------------------------------------------------------

@query("normalize_text", f"""
SELECT 'document' AS kind, doc_id AS id, {normal('text')} AS text FROM documents
UNION ALL SELECT 'page', page_id, {normal('html', True)} FROM pages""")
def _(t):
    docs = t("documents").select(F.lit("document").alias("kind"), F.col("doc_id").alias("id"), "text")
    pages = t("pages").select(F.lit("page").alias("kind"), F.col("page_id").alias("id"), F.col("html").alias("text"))
    return cleaning.normalize_text(docs.unionByName(pages))


@query("sentences", f"WITH {DOC_SENTENCES} SELECT doc_id, CAST(pos AS INTEGER) AS pos, sentence FROM sents")
def _(t):
    return _sentences(t)


@query("sql_sentences", f"""
WITH lists AS (SELECT doc_id, {sentence_list('text')} AS ss FROM documents)
SELECT doc_id, CAST(unnest(generate_series(0, len(ss) - 1)) AS INTEGER) AS pos, unnest(ss) AS sentence FROM lists""")
def _(t):
    """The sentence rules called from a query written in SQL."""
    sql.register(t.spark)
    return t.spark.sql(
        "SELECT doc_id, posexplode(sentences) AS (pos, sentence) FROM (SELECT doc_id, split_sentences(text) AS sentences FROM {docs})",
        docs=t("documents"))


@query("abbreviation_scores", f"""
WITH {DOCS},
tokens AS (SELECT unnest(string_split_regex(text, '\\s+')) AS token FROM docs WHERE text IS NOT NULL),
words AS (SELECT lower(regexp_extract(token, '{vocabulary.TOKEN}', 1)) AS word, regexp_extract(token, '{vocabulary.TOKEN}', 2) = '.' AS stop
          FROM tokens WHERE regexp_matches(token, '{vocabulary.TOKEN}')),
counts AS (SELECT word, count(*) FILTER (stop) AS n_stop, count(*) FILTER (NOT stop) AS n_plain FROM words GROUP BY word),
whole AS (SELECT sum(n_stop) / sum(n_stop + n_plain) AS share FROM counts),
sized AS (SELECT *, length(replace(word, '.', '')) AS size FROM counts, whole WHERE n_stop > 0)
SELECT word, n_stop, n_plain,
       round(-2 * (n_stop * ln(share) + n_plain * ln(1 - share) - n_stop * ln({vocabulary.SURE}) - n_plain * ln({1 - vocabulary.SURE}))
             * exp(-CAST(size AS DOUBLE)) * (length(word) - size + 1) * pow(size, -CAST(n_plain AS DOUBLE)), 9) + 0.0 AS score
FROM sized""")
def _(t):
    """Every word that a full stop follows, with the score that makes it an abbreviation or not."""
    scores = vocabulary.abbreviation_scores(_docs(t).where("text IS NOT NULL"))
    return scores.withColumn("score", F.round("score", 9) + F.lit(0.0))


@query("explode_sentences", """
SELECT doc_id, CAST(unnest(generate_series(0, len(string_split(text, chr(10))) - 1)) AS INTEGER) AS pos,
       unnest(string_split(text, chr(10))) AS sentence FROM documents""")
def _(t):
    """Lines of each text as the sentence array."""
    return cleaning.explode_sentences(t("documents").select("doc_id", F.split("text", "\n").alias("sentences")), "doc_id")


@query("non_empty_sentences", r"""
SELECT * FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS sentence FROM documents)
WHERE regexp_matches(sentence, '\P{P}\P{Z}\P{C}')""")
def _(t):
    """Applied to single words, of which many are short or only punctuation."""
    rows = t("documents").select("doc_id", F.explode(F.split("text", " ")).alias("sentence"))
    return cleaning.non_empty_sentences(rows)


@query("rejoin_sentences", f"""
WITH {DOC_SENTENCES} SELECT doc_id, string_agg(sentence, ' ' ORDER BY pos) AS text FROM sents GROUP BY doc_id""")
def _(t):
    return cleaning.rejoin_sentences(_sentences(t), "doc_id")


# -- neighbours -----------------------------------------------------------------------------

NEIGHBOURS = """
line AS (SELECT article_id, host, 'published' AS kind, published_time AS t FROM fx_article WHERE published_time IS NOT NULL
         UNION ALL SELECT article_id, host, 'source', source_published_time FROM fx_article WHERE source_published_time IS NOT NULL
         UNION ALL SELECT article_id, host, 'entry', data_entry_time FROM fx_article),
place AS (SELECT article_id, host,
            CASE WHEN published_time IS NOT NULL THEN 'published' WHEN source_published_time IS NOT NULL THEN 'source' ELSE 'entry' END AS kind,
            coalesce(published_time, source_published_time, data_entry_time) AS t FROM fx_article),
adj AS (SELECT p.article_id AS target_id, 'before' AS side, l.article_id,
               row_number() OVER (PARTITION BY p.article_id ORDER BY l.t DESC, l.article_id) AS rank
        FROM place p JOIN line l ON l.host = p.host AND l.kind = p.kind AND l.t <= p.t AND l.article_id <> p.article_id
        QUALIFY rank <= 10
        UNION ALL
        SELECT p.article_id, 'after', l.article_id, row_number() OVER (PARTITION BY p.article_id ORDER BY l.t, l.article_id) AS rank
        FROM place p JOIN line l ON l.host = p.host AND l.kind = p.kind AND l.t >= p.t AND l.article_id <> p.article_id
        QUALIFY rank <= 5)"""

BODIES = f"""
body AS (SELECT article_id, {normal('body')} AS text FROM fx_article WHERE body IS NOT NULL),
lists AS (SELECT article_id, {sentence_list('text')} AS ss FROM body WHERE text IS NOT NULL),
sents AS (SELECT article_id, unnest(ss) AS sentence, unnest(generate_series(0, len(ss) - 1)) AS pos FROM lists)"""

# Kept target sentences: none of the target's check sentences is nearer than ten.
KEPT = f"""{NEIGHBOURS}, {BODIES},
coded AS (SELECT *, {one_byte('sentence')} AS code FROM sents),
pool AS (SELECT DISTINCT a.target_id, s.code FROM adj a JOIN coded s ON s.article_id = a.article_id),
kept AS (SELECT t.article_id AS target_id, t.pos, t.sentence FROM coded t
         WHERE NOT EXISTS (SELECT 1 FROM pool p WHERE p.target_id = t.article_id
                           AND abs(strlen(p.code) - strlen(t.code)) < 10 AND levenshtein(p.code, t.code) < 10))"""


@query("adjacent_articles", f"""
WITH {NEIGHBOURS} SELECT target_id, side, CAST(rank AS INTEGER) AS rank, article_id FROM adj""")
def _(t):
    return adjacency.adjacent_articles(t("fx_article"), t("fx_article"))


@query("k_nearest_in_time", f"""
WITH {NEIGHBOURS} SELECT target_id, count(*) FILTER (side = 'before') AS n_before, count(*) FILTER (side = 'after') AS n_after
FROM adj GROUP BY target_id""")
def _(t):
    return adjacency.adjacent_articles(t("fx_article"), t("fx_article")).groupBy("target_id").agg(
        F.count_if(F.col("side") == "before").alias("n_before"), F.count_if(F.col("side") == "after").alias("n_after"))


@query("after_then_before", f"""
WITH {NEIGHBOURS} SELECT target_id, string_agg(CAST(article_id AS VARCHAR), ',' ORDER BY side, rank) AS neighbours
FROM adj GROUP BY target_id""")
def _(t):
    placed = adjacency.place_targets(t("fx_article"), t("fx_article"))
    both = adjacency.after_then_before(F.col("after"), F.col("before"))
    return placed.where(F.size(both) > 0).select(
        F.col("article_id").alias("target_id"), F.array_join(both.cast("array<string>"), ",").alias("neighbours"))


def _pool(t, packed=False):
    articles = t("fx_article")
    table = written(cleaning.article_sentences(articles), "sentences")
    adjacent = adjacency.adjacent_articles(articles, articles, blocks=packed)
    return table, cleaning.check_sentence_pool(written(adjacent, "neighbours") if packed else adjacent, table, packed)


@query("check_sentence_pool", f"""
WITH {NEIGHBOURS}, {BODIES}
SELECT a.target_id, a.side, CAST(a.rank AS INTEGER) AS rank, a.article_id, CAST(s.pos AS INTEGER) AS pos, s.sentence
FROM adj a JOIN sents s ON s.article_id = a.article_id""")
def _(t):
    return _pool(t)[1]


def _targets(table):
    return table.select(F.col("article_id").alias("target_id"), F.posexplode("sentences").alias("pos", "sentence"))


@query("except_sentences", f"""
WITH {NEIGHBOURS}, {BODIES}
SELECT t.article_id AS target_id, CAST(t.pos AS INTEGER) AS pos, t.sentence FROM sents t
WHERE NOT EXISTS (SELECT 1 FROM adj a JOIN sents s ON s.article_id = a.article_id
                  WHERE a.target_id = t.article_id AND s.sentence = t.sentence)""")
def _(t):
    table, pool = _pool(t, packed=True)
    return cleaning.except_sentences(_targets(table), pool).select("target_id", "pos", "sentence")


@query("unique_sentences", f"WITH {KEPT} SELECT target_id, CAST(pos AS INTEGER) AS pos, sentence FROM kept")
def _(t):
    return cleaning.unique_article_sentences(t("fx_article"), t("fx_article"))


@query("unique_sentences_flat", f"WITH {KEPT} SELECT target_id, CAST(pos AS INTEGER) AS pos, sentence FROM kept")
def _(t):
    """The form for any targets and check sentences, on a pool of written sentences."""
    table, pool = _pool(t, packed=True)
    return cleaning.unique_sentences(_targets(table), pool)


@query("edit_distance", f"""
SELECT c.conv_id, c.turn, levenshtein({one_byte('c.text')}, {one_byte('n.text')}) AS distance
FROM conversations c JOIN conversations n ON n.conv_id = c.conv_id AND n.turn = c.turn + 1""")
def _(t):
    """Distance of each turn to the next one of its conversation, in code points."""
    turns = t("conversations")
    following = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("next_text"))
    return turns.join(following, ["conv_id", "turn"]).select(
        "conv_id", "turn", F.levenshtein("text", "next_text").cast("long").alias("distance"))


CLEAN = f"""{KEPT},
counts AS (SELECT a.target_id, count(*) AS n_neighbours FROM adj a GROUP BY 1),
checks AS (SELECT a.target_id, CAST(sum(len(l.ss)) AS BIGINT) AS n_check FROM adj a JOIN lists l ON l.article_id = a.article_id GROUP BY 1),
joined AS (SELECT target_id, count(*) AS n, string_agg(sentence, ' ' ORDER BY pos) AS text FROM kept GROUP BY 1),
clean AS (SELECT f.article_id, CASE WHEN c.n_neighbours >= {CUTOFF} AND k.n_check >= {CUTOFF} AND j.n >= 2 THEN j.text END AS clean_body
          FROM fx_article f LEFT JOIN counts c ON c.target_id = f.article_id LEFT JOIN checks k ON k.target_id = f.article_id
          LEFT JOIN joined j ON j.target_id = f.article_id WHERE f.body IS NOT NULL)"""


@query("clean_articles", f"WITH {CLEAN} SELECT article_id, clean_body FROM clean")
def _(t):
    return cleaning.clean_articles(t("fx_article"), t("fx_article"), CUTOFF)


@query("store_processed_text", f"""
WITH {CLEAN} SELECT 999 + row_number() OVER (ORDER BY c.article_id) AS text_id, c.article_id,
       TIMESTAMP '2024-03-01 00:00:00' AS data_entry_time, f.title, c.clean_body AS body
FROM clean c JOIN fx_article f ON f.article_id = c.article_id WHERE c.clean_body IS NOT NULL""")
def _(t):
    path = scratch_path(t.spark, "processed")
    clean = cleaning.clean_articles(t("fx_article"), t("fx_article"), CUTOFF)
    titled = clean.join(t("fx_article").select("article_id", "title"), "article_id")
    writers.store_processed_text(titled, path, now())
    return t.spark.read.parquet(path)


# -- ranking -------------------------------------------------------------------------------------

@query("summary_ratio", """
SELECT doc_id, CASE WHEN length(text) <= 280 THEN 1.0 WHEN length(text) <= 1000 THEN 0.7 WHEN length(text) <= 3000 THEN 0.5
                    WHEN length(text) <= 10000 THEN 0.3 ELSE 0.1 END::DOUBLE AS ratio FROM documents""")
def _(t):
    return t("documents").select("doc_id", fields.summary_ratio(F.length("text")).alias("ratio"))


def word_list(column: str) -> str:
    return (f"list_filter(regexp_split_to_array(lower({column}), '[^\\p{{L}}\\p{{N}}]+'), "
            f"lambda w: w <> '' AND w NOT IN ({STOPPED}))")


def _rounds(step: str) -> str:
    """Twenty rounds written out, each a table r1 .. r20."""
    return ",\n".join(
        f"r{i} AS MATERIALIZED ({step.format(previous=f'r{i - 1}')})" for i in range(1, ranking.ROUNDS + 1))


# Weights of all ordered sentence pairs, then twenty damped rounds over the pairs.
SUMMARY = f"""{DOC_SENTENCES},
worded AS (SELECT doc_id, pos, {word_list('sentence')} AS ws FROM sents),
sized AS (SELECT doc_id, count(*) AS n, sum(len(ws)) / count(*) AS mean FROM worded GROUP BY 1 HAVING count(*) > 1),
tf AS (SELECT doc_id, pos, word, CAST(count(*) AS DOUBLE) AS a
       FROM (SELECT doc_id, pos, unnest(ws) AS word FROM worded) GROUP BY ALL),
idf AS (SELECT t.doc_id, t.word, ln(1 + (s.n - count(*) + 0.5) / (count(*) + 0.5)) AS idf
        FROM tf t JOIN sized s ON s.doc_id = t.doc_id GROUP BY t.doc_id, t.word, s.n HAVING count(*) > 1),
score AS (SELECT t.doc_id, t.pos, t.word, t.a, i.idf * t.a * 2.5 / (t.a + 1.5 * (0.25 + 0.75 * len(w.ws) / s.mean)) AS b
          FROM tf t JOIN idf i ON i.doc_id = t.doc_id AND i.word = t.word JOIN sized s ON s.doc_id = t.doc_id
          JOIN worded w ON w.doc_id = t.doc_id AND w.pos = t.pos),
pairs AS (SELECT x.doc_id, x.pos AS i, y.pos AS j, sum(x.a * y.b) AS w
          FROM score x JOIN score y ON y.doc_id = x.doc_id AND y.word = x.word AND y.pos <> x.pos GROUP BY ALL),
edges AS MATERIALIZED (SELECT doc_id, i, j, w / sum(w) OVER (PARTITION BY doc_id, i) AS w FROM pairs),
nodes AS MATERIALIZED (SELECT w.doc_id, w.pos, s.n FROM worded w JOIN sized s ON s.doc_id = w.doc_id),
r0 AS (SELECT doc_id, pos, n, 1.0::DOUBLE / n AS r FROM nodes),
{_rounds('''SELECT v.doc_id, v.pos, v.n, 0.15 / v.n + 0.85 * coalesce(g.s, 0) AS r FROM nodes v LEFT JOIN
  (SELECT e.doc_id, e.j, sum(p.r * e.w) AS s FROM edges e JOIN {previous} p ON p.doc_id = e.doc_id AND p.pos = e.i GROUP BY ALL) g
  ON g.doc_id = v.doc_id AND g.j = v.pos''')},
placed AS (SELECT s.doc_id, s.pos, s.sentence, s.n_chars, count(*) OVER (PARTITION BY s.doc_id) AS n,
                  row_number() OVER (PARTITION BY s.doc_id ORDER BY round(r.r, 6) DESC, s.pos) AS place
           FROM sents s LEFT JOIN r20 r ON r.doc_id = s.doc_id AND r.pos = s.pos)
SELECT doc_id, string_agg(sentence, chr(10) ORDER BY pos) AS summary FROM placed
WHERE n = 1 OR place <= (n * CASE WHEN n_chars <= 280 THEN 10 WHEN n_chars <= 1000 THEN 7 WHEN n_chars <= 3000 THEN 5
                                  WHEN n_chars <= 10000 THEN 3 ELSE 1 END + 9) // 10
GROUP BY doc_id"""


@query("summarize", f"WITH {SUMMARY}")
def _(t):
    table = _docs(t).where("text IS NOT NULL").select(
        "doc_id", F.length("text").alias("n_chars"), tx.split_sentences(F.col("text")).alias("sentences"))
    return ranking.summarize(written(table, "sentences"), "doc_id")


KEYWORDS = f"""{DOCS},
lists AS (SELECT doc_id, {word_list('text')} AS ws FROM docs WHERE text IS NOT NULL),
places AS (SELECT doc_id, unnest(ws) AS word, unnest(generate_series(1, len(ws))) AS p FROM lists WHERE len(ws) > 0),
steps AS (SELECT a.doc_id, a.word AS u, b.word AS v FROM places a JOIN places b ON b.doc_id = a.doc_id AND b.p = a.p + 1 WHERE a.word <> b.word),
edges AS MATERIALIZED (SELECT doc_id, u, v, 1.0::DOUBLE / count(*) OVER (PARTITION BY doc_id, u) AS w
          FROM (SELECT * FROM steps UNION SELECT doc_id, v, u FROM steps)),
nodes AS MATERIALIZED (SELECT doc_id, word, count(*) OVER (PARTITION BY doc_id) AS n FROM (SELECT DISTINCT doc_id, word FROM places)),
r0 AS (SELECT doc_id, word, n, 1.0::DOUBLE / n AS r FROM nodes),
{_rounds('''SELECT v.doc_id, v.word, v.n, 0.15 / v.n + 0.85 * coalesce(g.s, 0) AS r FROM nodes v LEFT JOIN
  (SELECT e.doc_id, e.v, sum(p.r * e.w) AS s FROM edges e JOIN {previous} p ON p.doc_id = e.doc_id AND p.word = e.u GROUP BY ALL) g
  ON g.doc_id = v.doc_id AND g.v = v.word''')}
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY round(r, 6) DESC, word) AS INTEGER) AS rank, word FROM r20
QUALIFY rank <= 20"""


@query("keywords", f"WITH {KEYWORDS}")
def _(t):
    return ranking.keywords(_docs(t).where("text IS NOT NULL"), "doc_id")


def _doubled(rounds: int) -> str:
    """Forms of forms, each table twice as many steps."""
    return ",\n".join(
        f"f{i} AS (SELECT a.word, coalesce(b.form, a.form) AS form FROM f{i - 1} a LEFT JOIN f{i - 1} b ON b.word = a.form)"
        for i in range(1, rounds + 1))


FORMS = f"""{DOCS},
lists AS (SELECT doc_id, {word_list('text')} AS ws FROM docs WHERE text IS NOT NULL),
types AS MATERIALIZED (SELECT DISTINCT word FROM (SELECT unnest(ws) AS word FROM lists) WHERE regexp_matches(word, '^\\p{{L}}+$')),
cut AS (SELECT word, left(word, length(word) - k) AS stem, right(word, k) AS suffix
        FROM types, generate_series(1, {vocabulary.MAX_SUFFIX}) AS s(k) WHERE length(word) - k >= {vocabulary.MIN_STEM}),
alone AS (SELECT * FROM cut WHERE stem IN (SELECT word FROM types)),
pairs AS MATERIALIZED (SELECT * FROM alone WHERE suffix IN (SELECT suffix FROM alone GROUP BY suffix HAVING count(*) >= {vocabulary.LEAST_STEMS})),
classes AS (SELECT stem, string_agg(suffix, ',' ORDER BY suffix) AS class FROM pairs GROUP BY stem),
stems AS (SELECT stem FROM classes WHERE class IN (SELECT class FROM classes GROUP BY class HAVING count(*) >= {vocabulary.LEAST_SHARED})),
f0 AS (SELECT word, arg_max(stem, length(stem)) AS form FROM pairs WHERE stem IN (SELECT stem FROM stems) GROUP BY word),
{_doubled(vocabulary.DOUBLINGS)}"""


def _forms(t):
    words = _docs(t).where("text IS NOT NULL").select(F.explode(tx.words(F.col("text"))).alias("word"))
    return written(vocabulary.word_forms(words), "forms")


@query("word_forms", f"WITH {FORMS} SELECT word, form FROM f{vocabulary.DOUBLINGS}")
def _(t):
    """Words of all texts that are another word of them with a common suffix."""
    return _forms(t)


@query("keywords_by_form", f"WITH {FORMS}," + KEYWORDS[len(DOCS) + 1:].replace(
    f"lists AS (SELECT doc_id, {word_list('text')} AS ws FROM docs WHERE text IS NOT NULL),", "").replace(
    "places AS (SELECT doc_id, unnest(ws) AS word, unnest(generate_series(1, len(ws))) AS p FROM lists WHERE len(ws) > 0),",
    f"""spelled AS (SELECT doc_id, unnest(ws) AS word, unnest(generate_series(1, len(ws))) AS p FROM lists WHERE len(ws) > 0),
places AS MATERIALIZED (SELECT s.doc_id, coalesce(f.form, s.word) AS word, s.p FROM spelled s LEFT JOIN f{vocabulary.DOUBLINGS} f ON f.word = s.word),"""))
def _(t):
    """Keywords where the forms of a word are one word."""
    return ranking.keywords(_docs(t).where("text IS NOT NULL"), "doc_id", forms=_forms(t))
