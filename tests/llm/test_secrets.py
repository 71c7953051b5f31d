"""Secret scan against a brute force in Python."""

import hashlib
import random
import re
import string

import pytest
from pyspark.sql import functions as F

from gleaner.llm import secrets

ASSIGN = re.compile(
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def brute(text):
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(spans)


TEXTS = [
    None, "", "plain words only", "é😀 password=abcdef x", "token: ab", "token:token:abcdefgh", "API_KEY = 'abc.def/1' apikey:xyz",
    "PASSWD=\"" + "0123456789abcdef" * 2 + "\"", "AKIA" + "A" * 15, "AKIA" + "B7" * 8 + "é", "zAKIAAKIA" + "C" * 16,
    "f" * 23 + "g" + "e" * 24, "password=a " * 3 + "secret=bbbbbb\n" * 50, "token=abcdefg " * 2 + "퟿" + "a" * 5000,
    "word " * 30000 + "secret:qwerty1", "key Zx8vqLw0Tb+9sVfYk3RmPa7JdHcE2uNg5 end", "key Zx8vqLw0Tb+9sVfYk3RmPa7JdHcE2uNg5 end",
    "https://www.example.com/one/two/three/four/five/six/seven " + "=" * 60,
]


@pytest.fixture(scope="module")
def found(spark):
    words = "ordinary_identifier reader connection configuration value of the internationalisation table"
    rows = [(i, t, 7) for i, t in enumerate(TEXTS)] + [(100 + i, f"{words} {i}", 7) for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kind int")
    ratios = secrets.markov_ratios(docs)
    return docs, ratios, {r["doc_id"]: r for r in secrets.digest(secrets.find_secrets(docs, ratios)).collect()}


def test_base_spans_match_brute_force(found):
    for i, text in enumerate(TEXTS):
        base = ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in brute(text))
        row = found[2][i]
        assert row["base_sha256"] == hashlib.sha256(base.encode()).hexdigest(), text[:80]
        assert [row["n_assign"], row["n_access"], row["n_hex"]] == [sum(k == n for _, k, _ in brute(text)) for n in range(3)]
        assert [x for x in row["spans"].split(",") if x and not x.startswith("random")] == [x for x in base.split(",") if x]


def test_model_finds_random_and_leaves_identifiers(found):
    rows = found[2]
    assert rows[15]["spans"] == "random:4:37" == rows[16]["spans"]
    assert all(not rows[100 + i]["spans"] for i in range(50))


def test_redaction_removes_every_span(found, spark):
    docs, ratios, _ = found
    out = {r["doc_id"]: r for r in secrets.redact(docs.withColumn("n_chars", secrets.F.length("text").cast("long")), ratios).collect()}
    assert out[0]["text"] is None and out[3]["text"] == "é😀 [SECRET] x" and out[3]["n_chars"] == len("é😀 [SECRET] x")
    for i, text in enumerate(TEXTS):
        assert not brute(out[i]["text"])
        assert bool(brute(text)) <= ("[SECRET]" in (out[i]["text"] or ""))


def test_keys_with_slashes_are_found_whole_and_paths_left(spark):
    ratios = secrets.markov_ratios(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    plain, one, two = "Zx8vqLw0Tb+9sVfYk3RmPa7JdHcE2uNg5", "Zx8vqLw0Tb+9sVf/k3RmPa7JdHcE2uNg5Qx1Vb7d", "wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY"
    fine = "Zx8vqLw0Tb/9sVfYk3Rm/Pa7JdHcE2u"  # no part of 20 characters
    keyed = [
        ("aws_secret_access_key = {} end", two), ("aws_secret_access_key={} end", two), ("é😀 {}", one), ("{}==", fine), ("/{}/x", one),
        ("config/production/{}/internal/files", fine), ("cache/objects/{}/internal/repository", plain), ("0123456789abcdef01234567/{}", plain),
    ]
    paths = [
        "/usr/share/doc/python3/dist-packages/README/CHANGELOG", "2024/05/12/some-title-of-the-post-with-10-things/index.html",
        "src/main/java/com/acme/connection/configuration7", "v1/orders/12345/67890/2024/11/30/x", "https://www.example.com/" + "one/" * 3000 + "1",
    ]
    rows = [(i, text.format(key)) for i, (text, key) in enumerate(keyed)] + [(100 + i, p) for i, p in enumerate(paths)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_chars", secrets.F.length("text").cast("long"))
    spans = {r["doc_id"]: r["spans"].split(",") for r in secrets.digest(secrets.find_secrets(docs, ratios)).collect()}
    clean = {r["doc_id"]: r["text"] for r in secrets.redact(docs, ratios).collect()}
    for i, (text, key) in enumerate(keyed):
        own = [tuple(map(int, x.split(":")[1:])) for x in spans[i] if x.startswith("random")]
        at = text.index("{}")
        assert any(a <= at and at + len(key) <= b for a, b in own) and len(own) == 1, (text, spans[i])
        assert not any(part in clean[i] for part in key.split("/"))
    assert clean[0] == "aws_secret_access_key = [SECRET] end" and clean[1] == "aws_secret_access_key=[SECRET] end"
    assert clean[5] == "config/production/[SECRET]/internal/files" and clean[6] == "cache/objects/[SECRET]/internal/repository"
    assert [clean[100 + i] for i in range(len(paths))] == paths


def test_error_rates_on_unseen_names_and_keys(spark):
    rng = random.Random(4)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = secrets.trained(docs)
    words = set("""backoff hook yaml proxy await buffer registry thread span retry server http vector builder factory listener observer
        adapter widget layout render reducer dispatch validator session cookie tracer metric handler timeout encoder payload""".split())
    words = sorted(words - set(secrets.library_words()))
    assert len(words) >= 15
    names = []
    while len(names) < 2000:
        w = rng.choices(words, k=rng.randint(2, 5))
        camel = w[0] + "".join(x.title() for x in w[1:])
        name = rng.choice([camel, camel[0].upper() + camel[1:], "_".join(w), "_".join(w).upper(), "-".join(w)]) + rng.choice(["", str(rng.randint(0, 9999))])
        names += [name] if len(name) >= 16 else []
    kinds = {
        "mixed": string.ascii_letters + string.digits, "letters": string.ascii_letters, "small": string.ascii_lowercase + string.digits,
        "url": string.ascii_letters + string.digits + "+_",
    }
    rows = [(k, "name", n) for k, n in enumerate(names)]
    for kind, signs in kinds.items():
        rows += [(k, kind, "".join(rng.choices(signs, k=16))) for k in range(500)]
    found = secrets.find_secrets(spark.createDataFrame(rows, "doc_id long, kind string, text string"), *model)
    share = {r["kind"]: r["share"] for r in found.groupBy("kind").agg(F.avg((F.size("secret_spans") > 0).cast("int")).alias("share")).collect()}
    assert share.pop("name") < 0.01 and min(share.values()) > 0.95, share


def test_redact_keeps_clashing_columns_and_needs_no_count(spark, found):
    docs = spark.createDataFrame([(1, "password=abcdef x", "own", "b", "t"), (1, None, "own", "b", "t")], "doc_id long, text string, secret_spans string, __base string, __taken string")
    out = secrets.redact(docs, found[1])
    assert out.columns == docs.columns
    assert sorted(map(str, out.collect())) == sorted(map(str, docs.replace("password=abcdef x", "[SECRET] x").collect()))


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert secrets.calibrated(docs, secrets.markov_ratios(docs)) >= secrets.LEAST_RATIO
    assert secrets.find_secrets(docs, secrets.markov_ratios(docs)).count() == 0


def test_models_learn_from_every_row(spark):
    """Words and ids of every row count, however many rows there are."""
    rows = [(i, "alpha beta gamma delta epsilon") for i in range(700)]
    words = "".join(chr(97 + i) for i in range(26))
    rows += [(700 + i, f"q{words[i]}zx q{words[i]}xz Q{words[i]}zx") for i in range(26)] + [(None, "unread"), (999, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = {r["word"] for r in secrets.corpus_words(docs).where("random = 0").collect()}
    assert known == {"alpha", "beta", "gamma", "delta", "epsilon"} | {f"q{c}{e}" for c in words for e in ("zx", "xz")}
    assert secrets._drawn(docs).count() == 7 * 727
