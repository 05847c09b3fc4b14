"""Feeds and histories: golden cases, brute force on random logs, algebraic properties."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import apply as ap
from tidemark.operators import feed, history

T0 = datetime(2024, 1, 1)
LOG = "id long, v string, op string, n long, ver long, ts timestamp_ntz"


def random_log(seed, rows=400, keys=25, versions=12):
    """Half of the changes are of key 0."""
    rnd = random.Random(seed)
    out = []
    for n in range(rows):
        k = 0 if rnd.random() < 0.5 else rnd.randrange(keys)
        ver = n * versions // rows
        out.append((k, f"v{rnd.randrange(4)}", rnd.choice("ccurdd"), n, ver, T0 + timedelta(hours=ver, seconds=n)))
    return out


def replay(log, upto):
    state = {}
    for k, v, op, _, ver, _ in log:
        if ver > upto:
            break
        if op == "d":
            state.pop(k, None)
        else:
            state[k] = v
    return state


def build(spark, log, bucket=None):
    return feed.from_changes(spark.createDataFrame(log, LOG), ["id"], ["v"], ["n"], "ver", "ts", bucket=bucket)


def as_dict(df):
    rows = df.select("id", "v").collect()
    assert len({r.id for r in rows}) == len(rows)
    return {r.id: r.v for r in rows}


@pytest.fixture(scope="module", params=[1, 2])
def case(request, spark):
    log = random_log(request.param)
    return log, build(spark, log).cache()


def test_every_version_replays(case):
    log, f = case
    for v in (0, 5, 11):
        assert as_dict(feed.as_of_version(f, ["id"], v)) == replay(log, v)
    assert as_dict(feed.current(f, ["id"])) == replay(log, 99)


def test_as_of_timestamp(case):
    log, f = case
    ends = [max(r[5] for r in log if r[4] == v) for v in range(12)]
    assert as_dict(feed.as_of_timestamp(f, ["id"], ends[4])) == replay(log, 4)
    assert as_dict(feed.as_of_timestamp(f, ["id"], ends[4] - timedelta(microseconds=1))) == replay(log, 3)


def test_bucketed_feed_is_the_same(spark, case):
    log, f = case
    cut = build(spark, log, F.floor(F.col("ver") / 5))
    assert cut.exceptAll(f).isEmpty() and f.exceptAll(cut).isEmpty()


def test_commit_time_from_the_log(spark, case):
    log, f = case
    ends = {v: max(r[5] for r in log if r[4] == v) for v in range(12)}
    times = spark.createDataFrame(list(ends.items()), "ver long, done timestamp_ntz")
    d = spark.createDataFrame(log, LOG).join(times, "ver")
    got = feed.from_changes(d, ["id"], ["v"], ["n"], "ver", "ts", committed="done")
    assert got.exceptAll(f).isEmpty() and f.exceptAll(got).isEmpty()


def test_incremental_is_the_state_difference(case):
    log, f = case
    for lo, hi in [(2, 6), (0, 11), (7, 8)]:
        a, b = replay(log, hi), replay(log, lo)
        want = {k: v for k, v in a.items() if k not in b or b[k] != v}
        assert as_dict(feed.incremental(f, ["id"], lo, hi)) == want
    assert feed.incremental(f, ["id"], 5, 5).isEmpty()


def test_restore_and_expire(spark, case):
    log, f = case
    undo = feed.restore_changes(f, ["id"], 4, datetime(2024, 3, 1))
    both = f.unionByName(undo)
    assert as_dict(feed.current(both, ["id"])) == replay(log, 4)
    assert {r[0] for r in undo.select("_commit_version").distinct().collect()} <= {12}
    limit = T0 + timedelta(hours=6)
    kept = feed.expire(f, ["id"], limit)
    assert as_dict(feed.current(kept, ["id"])) == replay(log, 99)
    assert as_dict(feed.as_of_version(kept, ["id"], 8)) == replay(log, 8)
    assert kept.filter(F.col("_commit_timestamp") < F.lit(limit)).filter("_change_type != 'insert'").isEmpty()


def test_live_rows_without_replay(case):
    log, f = case
    info = feed.table_info(f, ["id"]).first()
    assert info.live_rows == len(replay(log, 99)) and info.latest_version == 11 and info.change_feed_enabled


def test_updates_come_in_pairs(case):
    _, f = case
    n = {r["_change_type"]: r.changes for r in feed.summary(f).collect()}
    assert n["update_preimage"] == n["update_postimage"]
    assert feed.stats(f).first().updates == n["update_postimage"]
    assert feed.updates(f).count() == 2 * n["update_postimage"]
    assert feed.postimages(f).count() == n["insert"] + n["update_postimage"]


def test_version_and_time_ranges(case):
    _, f = case
    assert {r[0] for r in feed.between_versions(f, 3, 5).select("_commit_version").distinct().collect()} == {3, 4, 5}
    assert feed.between_versions(f, 10).count() == feed.latest_versions(f, 2).count()
    assert feed.latest_versions(f, 99).count() == f.count()
    at = T0 + timedelta(hours=3)
    assert feed.between_timestamps(f, at).count() == f.filter(F.col("_commit_timestamp") >= F.lit(at)).count()


def test_bookmarks(spark, case):
    _, f = case
    marks = spark.createDataFrame([("a", 9)], "reader string, last_version long")
    assert {r[0] for r in feed.new_changes(f, marks, "a").select("_commit_version").distinct().collect()} == {10, 11}
    assert feed.new_changes(f, marks, "new reader").count() == f.count()
    moved = feed.advance_bookmark(f, marks, "a")
    assert feed.new_changes(f, moved, "a").isEmpty()
    later = {r.reader: r.last_version for r in feed.advance_bookmark(f, moved, "b").collect()}
    assert later == {"a": 11, "b": 11}


def test_audit_trail(spark):
    log = [(1, v, "u" if n else "c", n, n, T0 + timedelta(hours=n)) for n, v in enumerate([10, 15, 12])]
    log.append((1, 0, "d", 3, 3, T0 + timedelta(hours=3)))
    c = spark.createDataFrame(log, LOG.replace("v string", "v long"))
    f = feed.from_changes(c, ["id"], ["v"], ["n"], "ver", "ts")
    got = feed.audit_trail(f, ["id"], "v").orderBy("step").collect()
    assert [(r.step, r.previous_value, r.delta) for r in got] == [(1, None, None), (2, 10, 5), (3, 15, -3), (4, 12, None)]


def test_batches(spark):
    d = spark.range(1050).select(F.col("id"))
    n = feed.batched(d, ["id"], 100, F.floor(F.col("id") / 64)).groupBy("batch_id").count().collect()
    assert sorted((r.batch_id, r["count"]) for r in n) == [(i, 100) for i in range(10)] + [(10, 50)]


def test_process(spark, case):
    _, f = case
    r = feed.process_status(f, lambda d: d.filter("_change_type = 'delete'")).first()
    assert r.status == "success" and r.rows_in == f.count() and r.rows_out == feed.deletes(f).count()
    assert feed.process_status(f.limit(0), lambda d: d).first().status == "no_changes"


def test_schema_of(spark):
    s = feed.schema_of(spark.createDataFrame([(1, "a")], "id long, v string"))
    assert s.names == ["id", "v", "_change_type", "_commit_version", "_commit_timestamp"]
    assert not s["_change_type"].nullable


# histories


def versions(spark, n=6):
    rows = [(i, T0 + timedelta(days=i), ["WRITE", "MERGE", "DELETE"][i % 3]) for i in range(n)]
    return spark.createDataFrame(rows, "version long, timestamp timestamp_ntz, operation string")


def test_as_of(spark):
    h = versions(spark)
    assert history.as_of(h, T0 + timedelta(days=3, hours=5)).first().version == 3
    assert history.as_of(h, T0 - timedelta(days=1)).first().version is None
    assert history.as_of(h, T0 - timedelta(days=1), earliest_if_before=True).first().version == 0


def test_as_of_many(spark):
    h = versions(spark)
    probes = spark.createDataFrame([(i, T0 + timedelta(hours=7 * i - 20)) for i in range(30)], "id long, at timestamp_ntz")
    for unit in ("day", "hour", "minute"):
        got = {r.id: r.version for r in history.as_of_many(probes, h, "at", unit).collect()}
        for i in range(30):
            hours = 7 * i - 20
            assert got[i] == (None if hours < 0 else min(5, hours // 24)), (unit, i)


def test_ranges_and_counts(spark):
    h = versions(spark)
    assert [r.version for r in history.latest(h, 2).collect()] == [5, 4]
    assert history.between(h, 2, 4).count() == 3 and history.between(h, 4).count() == 2
    assert history.since(h, T0 + timedelta(days=4)).count() == 2
    r = history.range_for_period(h, T0 + timedelta(days=1), T0 + timedelta(days=2, hours=3)).first()
    assert (r.first_version, r.last_version) == (1, 2)
    empty = history.range_for_period(h, T0 + timedelta(days=50), T0 + timedelta(days=60)).first()
    assert (empty.first_version, empty.last_version) == (None, None)
    s = history.operations_summary(h, 0, 5).first()
    assert (s.versions, s.writes, s.deletes) == (6, 4, 2)
    assert {r.operation: r.versions for r in history.operation_counts(h).collect()} == {"WRITE": 2, "MERGE": 2, "DELETE": 2}
    c = history.compare(h, 4, 1).first()
    assert (c.first_operation, c.second_operation, c.versions_between, c.seconds_apart) == ("MERGE", "MERGE", 2, -3 * 86400.0)
    st = history.statistics(h).first()
    assert (st.entries, st.first_id, st.last_id, st.span_seconds) == (6, 0, 5, 5 * 86400.0)
    assert st.operations == {"WRITE": 2, "MERGE": 2, "DELETE": 2}


def tree(spark):
    """1-2-3-...-20 in a line, 30 and 31 branch off from 5."""
    rows = [(i, i - 1 if i > 1 else None, T0 + timedelta(hours=i)) for i in range(1, 21)]
    rows += [(30, 5, T0 + timedelta(hours=30)), (31, 30, T0 + timedelta(hours=31))]
    return spark.createDataFrame(rows, "snapshot_id long, parent_snapshot_id long, timestamp timestamp_ntz")


def test_chain_and_ancestors(spark):
    t = tree(spark)
    ids = lambda d: sorted(r.snapshot_id for r in d.collect())
    assert ids(history.chain(t, 31)) == [1, 2, 3, 4, 5, 30, 31]
    assert ids(history.chain(t, 31, 4)) == [4, 5, 30, 31]
    assert ids(history.chain(t, 31, 4, include_start=False)) == [5, 30, 31]
    assert ids(history.chain(t, 20, 20)) == [20]
    assert ids(history.chain(t, 31, 6)) == [1, 2, 3, 4, 5, 30, 31]
    assert history.is_ancestor(t, 5, 31).first()[0] is True
    assert history.is_ancestor(t, 6, 31).first()[0] is False
    assert history.is_ancestor(t, 31, 31).first()[0] is True
    assert history.pending_snapshots(t, 31, 4).first().pending == 3
    assert history.range_statistics(t, 20, 15).first().snapshots == 6


def test_history_from_feed(spark, case):
    log, f = case
    h = {r.version: r for r in history.from_changes(f).collect()}
    assert set(h) == {r[0] for r in f.select("_commit_version").distinct().collect()}
    n = f.filter("_commit_version = 3 and _change_type = 'insert'").count()
    assert h[3].metrics["inserted"] == str(n)


def test_pending_versions(spark):
    marks = spark.createDataFrame([("a", 2), ("b", 5)], "reader string, last_version long")
    got = {r.reader: r.pending for r in history.pending(versions(spark), marks).collect()}
    assert got == {"a": 3, "b": 0}


def test_apply_feed_to_another_table(spark, case):
    """Handing new images and deletes on keeps a copy in step."""
    log, f = case
    copy = feed.as_of_version(f, ["id"], 5)
    later = f.filter("_commit_version > 5 and _change_type != 'update_preimage'").withColumn(
        "op", F.when(F.col("_change_type") == "delete", "d").otherwise("u")
    )
    assert as_dict(ap.apply_changes(copy, later, ["id"], ["_commit_version"])) == replay(log, 99)
