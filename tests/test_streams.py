"""Streams with keyed state over several micro-batches, against definitions that see all rows at once."""

import datetime
import random

from pyspark.sql import functions as F

from gleaner.session import scratch_path
from gleaner.streaming import jobs, state

START = datetime.datetime(2024, 1, 1)


def minutes(n):
    return START + datetime.timedelta(minutes=n)


def land(spark, batches, schema):
    """One file per batch, read one per trigger."""
    path = scratch_path(spark, "landed")
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    return jobs.landed(spark, path, schema, 1)


def test_release_by_timers(spark):
    """Out of order, late and due on arrival; the last batch's clock counts; null times are set aside."""
    rng = random.Random(2)
    rows = [(f"/p/{i}", minutes(rng.randint(0, 400)) + datetime.timedelta(microseconds=rng.randint(0, 999_999)),
             minutes(rng.randint(0, 400))) for i in range(120)]
    rows += [("/null/1", None, minutes(5)), ("/null/2", minutes(5), None), (None, minutes(5), minutes(5)), ("/edge", minutes(340), minutes(1))]
    rows += [("/clock", minutes(9999), minutes(400))]
    batches = [rows[i::5] for i in range(5)]
    out, checkpoint = jobs.stream_paths(spark, "released")
    stream = land(spark, batches, "permalink string, created_time timestamp, arrived timestamp")
    jobs.stream_delayed_release(stream, 1.0, out, checkpoint)
    want = sorted((p, c) for p, c, a in rows if p and c and a and c + datetime.timedelta(hours=1) <= minutes(400))
    got = sorted((r["permalink"], r["created_time"]) for r in spark.read.parquet(f"{out}/released").collect())
    assert got == want and ("/edge", minutes(340)) in got and 60 < len(got) < 121
    assert spark.read.parquet(f"{out}/rejected").count() == 3


def test_timers_follow_the_time_and_not_the_posts():
    """One timer for a key's rows of a batch; a firing lets all go that are due and waits for the next."""
    from types import SimpleNamespace as N

    held, timers = [], []
    waiting = N(appendList=held.extend, get=lambda: iter(list(held)), clear=held.clear, put=lambda rows: held.__setitem__(slice(None), rows))
    processor = state.ReleaseWhenDue()
    processor.init(N(getListState=lambda *_: waiting, registerTimer=timers.append))
    rows = [{"permalink": f"/p/{i}", "created_us": i, "due_ms": 1000 + i} for i in range(100)]
    assert list(processor.handleInputRows((0, 0), iter(rows), None)) == [] and timers == [1000]
    fire = lambda at, clock: [
        r["permalink"] for r in processor.handleExpiredTimer(
            (0, 0), N(getCurrentWatermarkInMs=lambda: clock), N(getExpiryTimeInMs=lambda: at))]
    assert fire(1000, 1039) == [f"/p/{i}" for i in range(40)] and timers == [1000, 1040]
    assert fire(1040, 2000) == [f"/p/{i}" for i in range(40, 100)] and timers == [1000, 1040] and held == []


def accepted_one_by_one(batches):
    taken, out = set(), []
    for rows in batches:
        for item, link, canonical, when in sorted(rows, key=lambda r: (r[3], r[1], r[0])):
            own = {x for x in (link, canonical) if x}
            if not own & taken:
                out.append(item)
                taken |= own
    return sorted(out)


def test_accepting_across_batches(spark):
    """Chains of shared links cross batches; a rejected row blocks nothing."""
    rng = random.Random(4)
    batches, n = [], 0
    for b in range(4):
        rows = []
        for _ in range(40):
            rows.append((f"i{n:03}", f"l/{rng.randint(0, 90)}", rng.choice([None, "", f"l/{rng.randint(0, 90)}"]), minutes(rng.randint(0, 9) + 10 * b)))
            n += 1
        batches.append(rows)
    batches[3].append(("none", "", None, minutes(35)))
    out, checkpoint = jobs.stream_paths(spark, "articles")
    stream = land(spark, batches, "item_no string, link string, canonical_link string, source_published_time timestamp")
    jobs.stream_dedup_articles(stream, out, checkpoint)
    assert sorted(r["item_no"] for r in spark.read.parquet(f"{out}/accepted").collect()) == accepted_one_by_one(batches)
    claims = [r["link"] for r in spark.read.parquet(f"{out}/claims").collect()]
    assert len(claims) == len(set(claims)) > 40


def test_lists_of_touched_keys(spark):
    rng = random.Random(6)
    rows = [(rng.choice(["hot", "hot", "hot", "a", "b", None]), rng.choice([None, *range(30)]), i, minutes(rng.randint(0, 50))) for i in range(300)]
    rows += [("once", 1, 1000, minutes(1))]
    batches = [rows[200:], rows[:100], rows[100:200]]
    out, checkpoint = jobs.stream_paths(spark, "lists")
    jobs.stream_capped_list(land(spark, batches, "k string, score int, id int, ts timestamp"), "k", ["score", "id"], 4, out, checkpoint)
    got = {}
    for r in jobs.read_capped_lists(spark, out, "k").orderBy("rank").collect():
        got.setdefault(r["k"], []).append((r["score"], r["id"], r["ts"]))
    for key in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1] is not None, r[1] or 0, r[2]), reverse=True)
        assert got[key] == [(s, i, t) for _, s, i, t in own[:4]]
    assert spark.read.parquet(out).where("k = 'once'").select("batch").distinct().count() == 1
    compacted = scratch_path(spark, "compacted")
    jobs.compact_capped_lists(spark, out, "k", compacted)
    assert spark.read.parquet(compacted).count() == sum(map(len, got.values()))


def test_a_list_holds_at_least_one_row(spark):
    out, checkpoint = jobs.stream_paths(spark, "lists")
    jobs.stream_capped_list(land(spark, [[("a", 1)], [("a", 2)]], "k string, n int"), "k", ["n"], 0, out, checkpoint)
    assert [(r["n"], r["rank"]) for r in jobs.read_capped_lists(spark, out, "k").collect()] == [(2, 1)]


def test_claims_are_stored_unasked():
    """One call of the state per key and batch."""
    class State:
        def __init__(self):
            self.value, self.calls = None, []

        def exists(self):
            self.calls.append("exists")
            return self.value is not None

        def update(self, value):
            self.calls.append("update")
            self.value = value

    links, claim, ask = state.KnownLinks(), {"is_claim": True, "row_key": None}, {"is_claim": False, "row_key": "a"}
    links.known = kept = State()
    answers = [[tuple(r) for r in links.handleInputRows(("x",), iter(rows), None)] for rows in ([ask], [claim], [ask], [ask, claim])]
    assert answers == [[("a", False)], [], [("a", True)], [("a", True)]]
    assert kept.calls == ["exists", "update", "exists", "update"]
