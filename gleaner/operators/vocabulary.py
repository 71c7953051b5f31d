"""What a corpus tells about its own words: abbreviations, and which words are forms of one.

Both are learned from counts over all texts, for any language that puts blanks between words and full stops after sentences, and
need no word list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.session import written

# A word with inner full stops, perhaps a full stop after it, and marks around both.
TOKEN = r"^[^\p{L}]*(\p{L}+(?:[.]\p{L}+)*)([.]?)[^\p{L}.]*$"
# How sure a word is to be followed by a full stop if it is an abbreviation, and the score from which it counts as one.
SURE, LEAST_SCORE, LEAST_STOPS = 0.99, 0.3, 3

MIN_STEM, MAX_SUFFIX = 3, 4
# A suffix must follow so many words that stand alone, and a class of suffixes be shared by so many.
LEAST_STEMS, LEAST_SHARED = 5, 3
# Forms of forms are followed 2 ** 4 steps.
DOUBLINGS = 4


def abbreviation_scores(texts: DataFrame, column: str = "text") -> DataFrame:
    """(word, n_stop, n_plain, score) of every lower-case word that a full stop follows somewhere.

    The score is the log-likelihood ratio of "a full stop belongs to the word" against "full stops fall on words by chance", which
    is high for words that never stand without one; long words, and those seen without one, are marked down, inner full stops up.
    """
    tokens = texts.select(F.explode(F.split(column, r"\s+")).alias("token")).where(F.col("token").rlike(TOKEN))
    words = tokens.select(
        F.lower(F.regexp_extract("token", TOKEN, 1)).alias("word"), (F.regexp_extract("token", TOKEN, 2) == ".").alias("stop"))
    counts = words.groupBy("word").agg(F.count_if("stop").alias("n_stop"), F.count_if(~F.col("stop")).alias("n_plain"))
    counts = written(counts, "word_counts")
    share = counts.agg(F.sum("n_stop") / F.sum(F.col("n_stop") + F.col("n_plain"))).scalar()
    scored = counts.where("n_stop > 0").withColumn("share", share)
    return scored.select("word", "n_stop", "n_plain", _score().alias("score"))


def _score() -> Column:
    stop, plain, share = F.col("n_stop"), F.col("n_plain"), F.col("share")
    # A corpus whose words all have a full stop tells nothing.
    chance = stop * F.ln(share) + F.when(plain > 0, plain * F.ln(1 - share)).otherwise(0.0)
    sure = stop * F.ln(F.lit(SURE)) + plain * F.ln(F.lit(1 - SURE))
    size = F.length(F.replace("word", F.lit("."), F.lit("")))
    inner = F.length("word") - size
    return -2 * (chance - sure) * F.exp(-size.cast("double")) * (inner + 1) * F.pow(size, -plain)


def abbreviations(texts: DataFrame, column: str = "text", least: float = LEAST_SCORE, stops: int = LEAST_STOPS) -> DataFrame:
    """(word) of the learned abbreviations, lower case, without their last full stop."""
    scored = abbreviation_scores(texts, column)
    return scored.where((F.col("score") >= least) & (F.col("n_stop") >= stops)).select("word")


def word_forms(
    words: DataFrame, min_stem: int = MIN_STEM, max_suffix: int = MAX_SUFFIX, stems: int = LEAST_STEMS, shared: int = LEAST_SHARED,
) -> DataFrame:
    """(word, form): the words of a corpus (word, repeats allowed) that are another word with a suffix, and that word.

    A suffix counts if it follows at least ``stems`` words that also stand alone.  A word's suffixes are its class; a class counts
    if at least ``shared`` words have it.  A word that can be cut in several ways is cut at the shortest suffix, and cut again
    while its rest is a form of a further word.
    """
    types = written(words.where(F.col("word").rlike(r"^\p{L}+$")).select("word").distinct(), "word_types")
    k = F.explode(F.sequence(F.lit(1), F.lit(max_suffix))).alias("k")
    cut = types.select("word", k).where(F.length("word") - F.col("k") >= min_stem).select(
        "word", F.expr("left(word, length(word) - k)").alias("stem"), F.expr("right(word, k)").alias("suffix"))
    pairs = cut.join(types.select(F.col("word").alias("stem")), "stem", "left_semi")
    strong = pairs.groupBy("suffix").agg(F.count("*").alias("n")).where(F.col("n") >= stems).select("suffix")
    pairs = written(pairs.join(strong, "suffix", "left_semi"), "word_pairs")
    classes = pairs.groupBy("stem").agg(F.array_join(F.array_sort(F.collect_list("suffix")), ",").alias("class"))
    common = classes.groupBy("class").agg(F.count("*").alias("n")).where(F.col("n") >= shared).select("class")
    stems_ = classes.join(common, "class", "left_semi").select("stem")
    longest = F.max_by("stem", F.length("stem")).alias("form")
    forms = written(pairs.join(stems_, "stem", "left_semi").groupBy("word").agg(longest), "word_forms")
    for _ in range(DOUBLINGS):
        again = forms.select(F.col("word").alias("form"), F.col("form").alias("next"))
        forms = written(forms.join(again, "form", "left").select("word", F.coalesce("next", "form").alias("form")), "word_forms")
    return forms


def in_base_forms(worded: DataFrame, key: str, forms: DataFrame) -> DataFrame:
    """(key, w): word lists with each word replaced by the word it is a form of."""
    tokens = worded.select(key, F.posexplode("w").alias("p", "word")).join(forms, "word", "left")
    ordered = F.array_sort(F.collect_list(F.struct("p", F.coalesce("form", "word").alias("word"))))
    return tokens.groupBy(key).agg(F.transform(ordered, lambda s: s["word"]).alias("w"))
