"""Landed threads, comment trees and the forum job against recursive definitions."""

import datetime
import json
import os
import random

from pyspark.sql import functions as F

from gleaner.operators import forum, threads
from gleaner.plans import jobs as plans
from gleaner.session import Scratch, path_exists, scratch_path, written

NOW = datetime.datetime(2024, 3, 1)
EXTRA = ("permalink STRING, reddit_id STRING, parent_id STRING, created_time TIMESTAMP, user_name STRING, body STRING, "
         "body_html STRING, up_votes INT, down_votes INT, is_deleted BOOLEAN")


def listing(children):
    return {"kind": "Listing", "data": {"children": children}}


def comment(name, replies=(), **data):
    return {"kind": "t1", "data": {"id": name, "parent_id": "t1_p", "replies": listing(list(replies)) if replies else "", **data}}


def more(name, children, depth=None):
    return {"kind": "more", "data": {"id": name, "children": children, **({} if depth is None else {"depth": depth})}}


def thread(comments, *posts):
    return json.dumps([listing([{"kind": "t3", "data": p} for p in (posts or ({"name": "t3_a", "num_comments": 5},))]), listing(comments)])


def flattened(nodes, depth=1):
    own = [n for n in nodes if n["kind"] == "t1"]
    out = [(n["data"]["id"], depth) for n in own]
    for n in own:
        if n["data"]["replies"]:
            out += flattened(n["data"]["replies"]["data"]["children"], depth + 1)
    return out


def grown(rng, name, depth):
    nodes = []
    for i in range(rng.choice([0, 1, 1, 2, 3]) if depth else 0):
        nodes.append(comment(f"{name}.{i}", grown(rng, f"{name}.{i}", depth - 1)))
        if rng.random() < 0.2:
            nodes.append(more(f"m{name}.{i}", ["x"] * rng.randint(0, 3)))
    return nodes


def landed(spark, texts):
    return spark.createDataFrame([(f"/p/{i}", t) for i, t in enumerate(texts)], "permalink string, value string")


def test_threads_of_any_depth(spark):
    rng = random.Random(5)
    chain = []
    for i in range(50, 0, -1):
        chain = [comment(f"c{i}", chain), comment(f"d{i}")]
    trees = [chain, [], *[grown(rng, f"t{k}", 14) for k in range(30)]]
    parsed = threads.parse_threads(landed(spark, [thread(t) for t in trees]))
    rows = threads.thread_comments(threads.thread_nodes(parsed)).collect()
    for k, tree in enumerate(trees):
        got = sorted((r["pos"], r["reddit_id"], r["depth"]) for r in rows if r["permalink"] == f"/p/{k}")
        assert got == [(pos, *c) for pos, c in enumerate(flattened(tree), 1)]
    assert max(r["depth"] for r in rows) == 50


def test_fields_of_comments_and_posts(spark):
    full = comment("c", created_utc=1704067200.9, author="ann", body="hi", body_html="<p>hi</p>", ups=3, downs=1)
    gone = comment("g", body="[deleted]", ups=None)
    post = {"name": "t3_x", "title": "T", "permalink": "/other", "num_comments": 7, "selftext": "[deleted]", "created_utc": 1704067200.0}
    parsed = threads.parse_threads(landed(spark, [thread([full, gone, more("m", ["a", "b"])], post)]))
    rows = {r["reddit_id"]: r for r in threads.thread_comments(threads.thread_nodes(parsed)).collect()}
    assert rows["c"]["created_time"] == datetime.datetime(2024, 1, 1) and not rows["c"]["is_deleted"]
    assert (rows["c"]["user_name"], rows["c"]["body"], rows["c"]["body_html"], rows["c"]["up_votes"], rows["c"]["down_votes"]) == (
        "ann", "hi", "<p>hi</p>", 3, 1)
    assert rows["g"]["is_deleted"] and rows["g"]["up_votes"] == 0 and rows["g"]["created_time"] is None
    got = threads.thread_posts(parsed).first()
    assert (got["permalink"], got["reddit_id"], got["num_comments"], got["more_children"], got["is_deleted"]) == ("/p/0", "t3_x", 7, 2, True)


def test_odd_threads(spark):
    texts = ["{broken", None, "", "[]", "{}", "7", '[{"data": {"children": "no list"}}, 3]', thread([], {"name": "a"}, {"name": "b"}),
             thread([comment("c")]), '[{"data":{"children":[{"kind":"t3","data":{}}]}}]']
    parsed = threads.parse_threads(landed(spark, texts))
    faults = {r["permalink"]: r["fault"] for r in threads.rejected_threads(parsed).collect()}
    assert faults == {"/p/0": "broken", "/p/1": "broken", "/p/2": "broken", "/p/3": "no post", "/p/4": "no post", "/p/5": "no post",
                      "/p/6": "no post", "/p/7": "several posts"}
    assert [r["reddit_id"] for r in threads.thread_comments(threads.thread_nodes(parsed)).collect()] == ["c"]
    assert threads.thread_nodes(parsed.where("false")).count() == 0
    assert threads.thread_posts(parsed).count() == 2


# -- trees by pointer doubling ------------------------------------------------------------


def tree_rows(spark, rows):
    return spark.createDataFrame(rows, "comment_id long, submission_id long, parent_id long")


def test_a_chain_of_a_thousand_takes_few_rounds(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(forum, "scratch_path", lambda s, label: seen.append(scratch_path(s, label)) or seen[-1])
    rows = [(i, 1, i - 1 if i else None) for i in range(1000)]
    got = forum.flatten_comments(tree_rows(spark, rows)).orderBy("pos").collect()
    assert [(r["comment_id"], r["depth"], r["pos"]) for r in got] == [(i, i + 1, i + 1) for i in range(1000)]
    rounds = [f for f in os.listdir(seen[0].removeprefix("file:")) if f.startswith("round=")]
    assert len(rounds) - 1 <= 12


def test_trees_match_recursion(spark):
    rng = random.Random(9)
    parents = {i: None if i < 3 or rng.random() < 0.05 else rng.randrange(max(0, i - 12), i) for i in range(400)}
    rows = [(i, 7, p) for i, p in parents.items()]
    children = {}
    for i, p in parents.items():
        children.setdefault(p, []).append(i)

    def walk(own, depth):
        out = [(i, depth) for i in own]
        for i in own:
            out += walk(children.get(i, []), depth + 1)
        return out

    got = forum.flatten_comments(tree_rows(spark, rows)).orderBy("pos").collect()
    assert [(r["comment_id"], r["depth"]) for r in got] == walk(children[None], 1)


def test_orphans_and_circles(spark):
    rows = [(1, 1, None), (2, 1, 1), (3, 1, 99), (4, 1, 3), (5, 1, 4), (6, 1, 6), (7, 1, 6), (8, 1, 9), (9, 1, 10), (10, 1, 8), (11, 1, 9),
            *[(i, 2, i - 1) for i in range(200, 260)]]
    table = tree_rows(spark, rows)
    faults = {r["comment_id"]: r["fault"] for r in forum.rejected_comments(table).collect()}
    assert faults == {3: "orphan", 4: "orphan", 5: "orphan", 6: "cycle", 7: "cycle", 8: "cycle", 9: "cycle", 10: "cycle", 11: "cycle",
                      **{i: "orphan" for i in range(200, 260)}}
    assert sorted(r["comment_id"] for r in forum.flatten_comments(table).collect()) == [1, 2]
    assert forum.flatten_comments(table.where("false")).count() == 0


# -- the job ------------------------------------------------------------------------------


def test_forum_job_with_threads_runs_twice(spark):
    store = plans.Store(spark, scratch_path(spark, "store"))
    big = [more("big", [f"x{i:03}" for i in range(230)]), more("big", ["x000", "x001"])]
    texts = [
        thread([comment("a", [comment("b")]), comment("c"), *big], {"name": "t3_0", "num_comments": 100, "score": 1}),
        thread([comment("d"), more("small", ["y1", "y2"])], {"name": "t3_1", "num_comments": 1, "score": 90}),
        thread([comment("e")], {"name": "t3_2", "num_comments": 1, "score": 1}),
        "{broken", thread([comment("f")], {"name": "t3_4", "num_comments": 99}), thread([], {"name": "x"}, {"name": "y"}),
        thread([comment("h"), more("z", ["z1"])], {"name": "t3_6", "num_comments": 50, "score": 9}),
    ]
    lines = landed(spark, texts)
    due = spark.createDataFrame([(f"/p/{i}",) for i in (0, 1, 2, 3, 5, 6)], "permalink string")
    later = spark.createDataFrame([("/p/0", "k", "t1_a", NOW, "u", "more", None, 0, 0, False)], EXTRA)
    added = plans.harvest_threads(store, due, lines, later, 50, F.lit(NOW))
    assert sorted((r["permalink"], r["submission_id"]) for r in added.collect()) == [("/p/0", 1000), ("/p/1", 1001), ("/p/6", 1002)]
    stored = spark.read.parquet(store.path("comments")).orderBy("comment_id").collect()
    assert [(r["comment_id"], r["submission_id"], r["reddit_id"]) for r in stored] == [
        (1000, 1000, "a"), (1001, 1000, "c"), (1002, 1000, "b"), (1003, 1000, "k"), (1004, 1001, "d"), (1005, 1002, "h")]
    fetches = spark.read.parquet(store.path("fetches")).orderBy("batch_no").collect()
    assert [(r["permalink"], r["more_id"], r["batch_no"], r["n_ids"]) for r in fetches] == [("/p/0", "big", i, n) for i, n in enumerate((100, 100, 30))]
    assert fetches[2]["batch"].startswith("x200,x201,")
    rejected = {r["permalink"]: r["fault"] for r in spark.read.parquet(store.path("rejected_threads")).collect()}
    assert rejected == {"/p/3": "broken", "/p/5": "several posts"}
    assert store.summary().first().asDict() == {"rejected_threads": 2, "submissions": 3, "comments": 6, "fetches": 3}

    before = {n: sorted(map(tuple, spark.read.parquet(store.path(n)).collect()), key=repr) for n in ("submissions", "comments", "fetches", "rejected_threads")}
    plans.harvest_threads(store, due, lines, later, 50, F.lit(NOW))
    for name, rows in before.items():
        assert sorted(map(tuple, spark.read.parquet(store.path(name)).collect()), key=repr) == rows
    assert set(store.counts.values().values()) == {0}


def test_scratch_tables_are_deleted(spark):
    with Scratch(spark) as scratch:
        table = tree_rows(spark, [(1, 1, None), (2, 1, 1)])
        assert forum.flatten_comments(table).count() == 2
        with Scratch(spark) as inner:
            written(table, "inner")
        kept = [p for p in scratch.paths if path_exists(spark, p)]
        assert len(kept) == len(scratch.paths) > 1 and not path_exists(spark, inner.paths[0])
    assert not any(path_exists(spark, p) for p in scratch.paths)
    before = len(scratch.paths)
    written(table, "outside")
    assert len(scratch.paths) == before
