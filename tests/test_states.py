"""Budgets in batches and streams, version histories, concurrent commits, manifests and proofs of cover."""

import hashlib
import random
import threading
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from sievework.operators import cover, history, merkle, quota
from sievework.plans.states import attempts
from sievework.streaming import commits
from sievework.streaming import history as stored
from sievework.streaming import quota as streamed

ARGS = ("key", ["seq"], "model", "status", "m1", 6)


def walk(rows, cap=6):
    state, out = defaultdict(lambda: [0, False, set()]), {}
    for key, seq, model, status in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        s, first = state[key], model in (None, "m1")
        if s[1] or s[0] >= cap:
            out[seq] = "refused"
        elif not first and model in s[2]:
            out[seq] = "skipped"
        elif status == 503:
            out[seq] = "refunded"
        elif status == 429 and not first:
            s[2].add(model)
            out[seq] = "fallback_spent"
        else:
            s[0] += 1
            s[1] = status == 429
            out[seq] = {200: "admitted", 429: "exhausted"}.get(status, "error")
    return out, {k: (s[0], s[1], sorted(s[2])) for k, s in state.items()}


def calls(n=1500):
    r = random.Random(9)
    return [(r.choice("abcdefghijklmnopqrstuvwxyz"), i, r.choice(("m1", "m1", "m2", "m3", None)), r.choice((200, 200, 503, 503, 503, 429, 403, None) if r.random() < 0.5 else (503, 503, 200))) for i in range(n)]


SHAPE = "key string, seq long, model string, status int"


def test_budget_equals_the_walk(spark):
    rows = calls()
    got = quota.outcomes(spark.createDataFrame(rows, SHAPE), *ARGS)
    want, states = walk(rows)
    assert {x.seq: x.outcome for x in got.collect()} == want and set(want.values()) == {"admitted", "refunded", "fallback_spent", "exhausted", "error", "skipped", "refused"}
    assert {x.key: (x.calls, x.exhausted, x.spent) for x in quota.budgets(got, "key", "model").collect()} == states
    assert quota.outcomes(spark.createDataFrame([], SHAPE), *ARGS).count() == 0


def test_budget_of_a_stream_in_three_batches_equals_the_batch(spark, tmp_path):
    events = attempts(spark.read.parquet("/root/testdata/sf0.001/events.parquet"))
    cuts = [events.filter("event_id < 300"), events.filter("event_id >= 300 and event_id < 301"), events.filter("event_id >= 301")]
    was = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    try:
        for i, part in enumerate(cuts):
            part.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in/{i}")
            stream = spark.readStream.schema(events.schema).parquet(f"{tmp_path}/in/*")
            told = streamed.outcomes(stream, "day", ["ts", "event_id"], "model", "status", "m1", 10)
            told.writeStream.outputMode("append").option("checkpointLocation", f"{tmp_path}/check").trigger(availableNow=True).format("parquet").start(f"{tmp_path}/out").awaitTermination()
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", was)
    batch = quota.outcomes(events, "day", ["ts", "event_id"], "model", "status", "m1", 10)
    pairs = lambda df: sorted((x.event_id, x.outcome) for x in df.select("event_id", "outcome").collect())
    got = pairs(spark.read.parquet(f"{tmp_path}/out"))
    assert got == pairs(batch) and len(got) == events.count() and len({o for _, o in got}) > 4


def snapshots(seed=1, n=7):
    r, now, out = random.Random(seed), {}, []
    for _ in range(n):
        for k in range(30):
            x = r.random()
            if x < 0.15:
                now.pop(k, None)
            elif x < 0.4:
                now[k] = (r.choice(("a", "b", None)), r.randint(0, 2))
        out.append(dict(now))
    return out


def test_intervals_give_every_snapshot_back(spark):
    snaps = snapshots()
    rows = [(k, v, *c) for v, s in enumerate(snaps) for k, c in s.items()]
    got = history.intervals(spark.createDataFrame(rows + rows[:3], "k int, v int, a string, b int"), "k", "v", ["a", "b"]).collect()
    for v, s in enumerate(snaps):
        assert {x.k: (x.a, x.b) for x in got if x.first <= v <= x.last} == s
    starts = sum(v == 0 or snaps[v - 1].get(k) != c for v, s in enumerate(snaps) for k, c in s.items())
    assert len(got) == starts < len(rows)


def test_stored_history_grows_with_changes(spark, tmp_path):
    snaps, root = snapshots(3), f"{tmp_path}/h"
    snaps = [*snaps, snaps[-1], {}]
    for v, s in enumerate(snaps):
        assert stored.append(root, spark.createDataFrame([(k, *c) for k, c in s.items()], "k int, a string, b int"), "k", ["a", "b"]) == v
    for v, s in enumerate(snaps):
        assert {x.k: (x.a, x.b) for x in stored.as_of(spark, root, "k", ["a", "b"], v).collect()} == s
    changed = sum(len({k for k in {*a, *b} if a.get(k) != b.get(k)}) for a, b in zip([{}, *snaps], snaps, strict=False))
    log = stored.log(spark, root)
    assert log.count() == changed and log.filter("version = 7").count() == 0
    spans = history.spans(log, "k", ["a", "b"]).collect()
    for v, s in enumerate(snaps):
        assert {x.k: (x.a, x.b) for x in spans if x.first <= v and (x.last is None or v <= x.last)} == s


BASE = "id string, title string, note string, seq long"


def rows_of(df):
    return {x.id: (x.title, x.note) for x in df.collect()}


def test_writers_at_once_lose_nothing(spark, tmp_path):
    root = f"{tmp_path}/t"
    commits.merge(root, spark.createDataFrame([(f"k{i}", "t", None, i) for i in range(40)], BASE), "id", ["note"], "seq", ["title"], buckets=8)
    meet, errors = threading.Barrier(4, timeout=120), []

    def write(n):
        once = iter((True,))
        try:
            batch = spark.createDataFrame([(f"w{n}-{i}", "t", None, i) for i in range(5)] + [(f"k{n}", "t", f"note {n}", 9)], BASE)
            # all four have merged with version 0 before the first commits
            commits.merge(root, batch, "id", ["note"], "seq", ["title"], buckets=8, between=lambda: next(once, None) and meet.wait())
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    threads = [threading.Thread(target=write, args=(n,)) for n in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors and commits.newest(spark, root) == 4
    got = rows_of(commits.table(spark, root))
    assert got == {**{f"k{i}": ("t", f"note {i}" if i < 4 else None) for i in range(40)}, **{f"w{n}-{i}": ("t", None) for n in range(4) for i in range(5)}}
    assert rows_of(commits.table(spark, root, 0)) == {f"k{i}": ("t", None) for i in range(40)}


def test_a_batch_rewrites_its_buckets_only_and_bad_ones_nothing(spark, tmp_path):
    root, args = f"{tmp_path}/t", ("id", ["note"], "seq", ["title"])
    assert commits.table(spark, root) is None
    commits.merge(root, spark.createDataFrame([(f"k{i}", "t", None, i) for i in range(100)], BASE), *args, buckets=16)
    commits.merge(root, spark.createDataFrame([("k1", None, "n", 1)], BASE), *args)
    a, b = (commits.entry(spark, root, n)["buckets"] for n in (0, 1))
    assert sum(a[k] != b[k] for k in a) == 1 and a.keys() == b.keys()
    assert rows_of(commits.table(spark, root))["k1"] == ("t", "n")
    assert not commits.put(spark, root, 1, {}) and commits.entry(spark, root, 1)["buckets"] == b
    bad = spark.createDataFrame([("k2", "other", None, 1)], BASE)
    with pytest.raises(ValueError, match="provenance"):
        commits.merge(root, bad, "id", ["title"], "seq", ["title"])
    assert commits.newest(spark, root) == 1
    assert commits.merge(root, spark.createDataFrame([], BASE), *args, mark=("q", 3)) == 2
    assert commits.merge(root, bad, *args, mark=("q", 3)) == 2  # a batch that was taken is not taken again
    assert commits.merge(root, spark.createDataFrame([("k1", None, "m", 1)], BASE), *args) == 3
    assert commits.swept(spark, root, 1) == 1 and rows_of(commits.table(spark, root))["k1"] == ("t", "m") and commits.newest(spark, root) == 3


def test_commits_behind_a_stream(spark, tmp_path):
    root = f"{tmp_path}/t"
    spark.createDataFrame([(f"k{i}", "t", None, i) for i in range(10)], BASE).write.json(f"{tmp_path}/in")
    for _ in range(2):
        stream = spark.readStream.schema(BASE).json(f"{tmp_path}/in")
        stream.writeStream.foreachBatch(commits.sink(root, "id", ["note"], "seq", ["title"], 4)).option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start().awaitTermination()
    assert commits.newest(spark, root) == 0 and commits.table(spark, root).count() == 10


def test_root_under_any_partitioning_and_differences(spark):
    r = random.Random(6)
    rows = [(hashlib.sha1(str(i).encode()).hexdigest()[:20], r.choice(("x", "", None)), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "id string, a string, b int")
    root = lambda d: d.filter("level = 0").first().digest
    one = merkle.tree(df, "id", ["a", "b"], 2)
    assert root(one) == root(merkle.tree(df.repartition(9).orderBy("b"), "id", ["a", "b"], 2))
    changed = [(k, "y" if i == 5 else a, b) for i, (k, a, b) in enumerate(rows) if i != 7] + [("00" * 10, "new", 1)]
    other = spark.createDataFrame(changed, "id string, a string, b int")
    two = merkle.tree(other, "id", ["a", "b"], 2)
    assert root(one) != root(two)
    nodes = {x.prefix for x in merkle.unequal(one, two, 2).collect()}
    assert nodes == {rows[5][0][:4], rows[7][0][:4], "0000"}
    assert sorted(tuple(x) for x in merkle.differing(df, other, "id", ["a", "b"], 2).collect()) == sorted([(rows[5][0], "changed"), (rows[7][0], "lost"), ("00" * 10, "added")])
    assert merkle.differing(df, df, "id", ["a", "b"], 2).count() == 0
    swapped = spark.createDataFrame([(k, None if a == "" else "" if a is None else a, b) for k, a, b in rows], "id string, a string, b int")
    assert merkle.differing(df, swapped, "id", ["a", "b"], 2).count() == sum(a in ("", None) for _, a, _ in rows)
    assert merkle.differing(df.limit(0), df.limit(0), "id", ["a", "b"], 2).count() == 0


def test_gaps_equal_sets(spark):
    r = random.Random(7)
    wanted = [(s, r.randint(0, 5), r.randint(4, 60)) for s in "abcdefgh"] + [("none", 1, 4), ("empty", 3, 2)]
    read = [(s, lo, lo + r.randint(-1, 9)) for s in "abcdefgh" for lo in (r.randint(-5, 60) for _ in range(r.randint(1, 12)))] + [("other", 1, 2), (None, 1, 2), ("a", None, 3)]
    df = lambda rows: spark.createDataFrame(rows, "source string, lo int, hi int")
    got = cover.gaps(df(read), df(wanted), "source").collect()
    missing = {(s, p) for s, lo, hi in wanted for p in range(lo, hi + 1)} - {(s, p) for s, lo, hi in read if lo is not None for p in range(lo, hi + 1)}
    assert {(x.source, p) for x in got for p in range(x.lo, x.hi + 1)} == missing
    assert all((x.source, x.hi + 1) not in missing and (x.source, x.lo - 1) not in missing for x in got)


def test_a_planted_gap_is_told_with_its_bounds(spark):
    df = lambda rows: spark.createDataFrame(rows, "source string, lo int, hi int")
    wanted = df([("a", 1, 30), ("b", 1, 30), ("c", 1, 30)])
    read = df([("a", 1, 10), ("a", 11, 20), ("a", 15, 30), ("b", 1, 12), ("b", 15, 40), ("c", 1, 30)])
    assert [tuple(x) for x in cover.gaps(read, wanted, "source").collect()] == [("b", 13, 14)]
    failed = spark.createDataFrame([("c",)], "source string")
    assert sorted(tuple(x) for x in cover.proven(read, wanted, "source", failed).collect()) == [("a", 0, 0, 0, True), ("b", 1, 2, 0, False), ("c", 0, 0, 1, False)]
