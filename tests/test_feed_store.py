"""The stored feed: every state replays, reads open only the stretches they need, failed appends stay unseen."""

import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from test_feed_history import LOG, T0, as_dict, build, random_log, replay

from tidemark.operators import feed, history
from tidemark.sinks import feed_store
from tidemark.sinks.feed_store import FeedStore

CUTS = [(0, 2), (3, 5), (6, 8), (9, 11)]


def opened(df):
    """Folders of the stretches and bases that a read opens."""
    return {"/".join(f.split("/")[-3:-1]) for f in df.inputFiles()}


def stretches(store):
    """Name of the stretch that holds each version."""
    return {r.version: f"changes/{r.stretch}" for r in store.ledger().collect()}


def rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


@pytest.fixture(params=[1])
def case(request, spark, folder):
    log = random_log(request.param)
    f = build(spark, log).cache()
    store = FeedStore(spark, folder(f"store{request.param}"), ["id"])
    for lo, hi in CUTS:
        assert store.append(feed.between_versions(f, lo, hi)) == hi - lo + 1
    return log, f, store


def test_every_version_replays_with_and_without_bases(case):
    log, f, store = case
    for base in (None, 4):
        if base is not None:
            assert store.add_base(base) == base
        for v in range(12):
            assert as_dict(store.as_of(v)) == replay(log, v)
        assert as_dict(store.as_of()) == replay(log, 99)
    assert store.as_of(-1).count() == 0


def test_reads_open_what_they_need(case):
    log, f, store = case
    of = stretches(store)
    assert len(set(of.values())) == len(CUTS)
    assert opened(store.changes(4, 7)) == {of[4], of[7]}
    assert opened(store.changes_by_time(T0 + timedelta(hours=6), T0 + timedelta(hours=6, minutes=59))) == {of[6]}
    assert opened(store.incremental(8, 11)) == {of[9]}
    assert opened(store.latest_changes(2)) == {of[11]}
    assert opened(store.as_of(4)) == {of[0], of[4]}
    store.add_base(4)
    base = "bases/" + store.bases().first().folder
    assert opened(store.as_of(5)) == {base, of[5]} and opened(store.as_of(4)) == {base} and opened(store.as_of(7)) == {base, of[5], of[7]}
    assert opened(store.as_of(3)) == {of[0], of[3]}
    assert opened(store.as_of_time(T0 + timedelta(hours=5, minutes=59))) == {base, of[5]}
    # histories, statistics and estimates open the ledger and the list of bases only
    for df in (store.history(), store.change_stats(), store.estimate(3, 9)):
        assert {f.split("/")[-2] for f in df.inputFiles()} <= {"ledger", "base_log"}


def test_reads_equal_those_of_the_feed(case):
    log, f, store = case
    t = lambda h: T0 + timedelta(hours=h, seconds=17)
    store.add_base(5)
    assert rows(store.changes()) == rows(f) and rows(store.changes(3, 7)) == rows(feed.between_versions(f, 3, 7))
    assert rows(store.changes(40)) == [] and store.changes(40).columns == f.columns
    for lo, hi in ((0, 5), (4, 4), (7, None), (30, 40)):
        assert rows(store.changes_by_time(t(lo), None if hi is None else t(hi))) == rows(feed.between_timestamps(f, t(lo), None if hi is None else t(hi)))
        assert rows(store.incremental_by_time(t(lo), None if hi is None else t(hi))) == rows(feed.incremental_by_time(f, ["id"], t(lo), None if hi is None else t(hi)))
    for lo, hi in ((3, 8), (8, None), (11, None)):
        assert rows(store.incremental(lo, hi)) == rows(feed.incremental(f, ["id"], lo, hi))
    assert rows(store.incremental(2, 9, "v <> 'v1'")) == rows(feed.incremental(f, ["id"], 2, 9, "v <> 'v1'"))
    for h in (-1, 5, 99):
        assert rows(store.as_of_time(t(h))) == rows(feed.as_of_timestamp(f, ["id"], t(h)))
    assert rows(store.latest_changes(3)) == rows(feed.latest_versions(f, 3))
    assert rows(store.history().withColumn("metrics", F.to_json("metrics"))) == rows(history.from_changes(f).withColumn("metrics", F.to_json("metrics")))
    assert rows(store.change_stats()) == rows(feed.stats(f))
    for lo, hi in ((None, None), (2, 7), (6, 6)):
        e = store.estimate(lo, hi).first()
        part = feed.between_versions(f, lo or 0, hi)
        assert (e.planned_changes, e.table_rows) == (part.count(), len(replay(log, 99 if hi is None else hi)))
        assert e.versions == part.select("_commit_version").distinct().count()


def test_retention_keeps_the_states_after_it(case, monkeypatch):
    log, f, store = case
    limit = T0 + timedelta(hours=7)
    with monkeypatch.context() as m:  # the run ends after the horizon was set and before anything is removed
        m.setattr(feed_store.lineage, "remove", lambda *_: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            store.expire(limit)
    for _ in range(2):
        store.expire(limit)
        assert store.horizon() == 6
        for v in (6, 8, 11):
            assert as_dict(store.as_of(v)) == replay(log, v)
        with pytest.raises(ValueError):
            store.as_of(5)
        assert rows(store.changes()) == rows(feed.between_versions(f, 7))
        assert store.ledger().agg(F.min("version")).first()[0] == 7
    assert len(os.listdir(f"{store.root}/changes")) == 2 and len(os.listdir(f"{store.root}/bases")) == 1
    assert store.expire(T0) is None
    store.expire(T0 + timedelta(days=9))
    assert as_dict(store.as_of()) == replay(log, 99) and store.changes().count() == 0 and store.latest_version() == 11
    more = build(store.spark, [*log, (77, "new", "c", 10_000, 12, T0 + timedelta(hours=12))])
    store.append(feed.between_versions(more, 12))
    assert as_dict(store.as_of()) == replay(log, 99) | {77: "new"}


def test_an_append_that_fails_is_not_seen_and_can_be_repeated(spark, folder, monkeypatch):
    log = random_log(5)
    f = build(spark, log).cache()
    store = FeedStore(spark, folder(), ["id"])
    store.append(feed.between_versions(f, 0, 5))
    with monkeypatch.context() as m:  # after the changes were written, before the ledger was
        m.setattr(feed_store.FeedStore, "latest_version", lambda _: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            store.append(feed.between_versions(f, 6))
    assert as_dict(store.as_of()) == replay(log, 5) and len(os.listdir(f"{store.root}/changes")) == 2
    store.append(feed.between_versions(f, 6))
    assert as_dict(store.as_of()) == replay(log, 99) and rows(store.changes()) == rows(f)
    with pytest.raises(ValueError):
        store.append(feed.between_versions(f, 11))
    assert rows(store.changes()) == rows(f)


def test_empty_store_null_keys_and_two_keys(spark, folder):
    store = FeedStore(spark, folder("none"), ["id"])
    assert store.latest_version() is None and store.history().count() == 0 and store.add_base() is None and store.expire(T0) is None
    schema = "a long, b string, v string, _change_type string, _commit_version long, _commit_timestamp timestamp"
    at = datetime(2024, 1, 1)
    data = [(1, "x", "1", "insert", 0, at), (None, "x", "2", "insert", 0, at), (1, None, "3", "insert", 0, at), (None, "x", "2", "update_preimage", 1, at), (None, "x", "4", "update_postimage", 1, at), (1, None, "3", "delete", 1, at)]
    f = spark.createDataFrame(data, schema)
    store = FeedStore(spark, folder("two"), ["a", "b"])
    store.append(f.filter("_commit_version = 0"))
    store.add_base()
    store.append(f.filter("_commit_version = 1"))
    assert {tuple(r) for r in store.as_of().collect()} == {(1, "x", "1"), (None, "x", "4")}
    assert store.append(f.limit(0)) == 0


def test_files_of_a_stretch_are_cut_by_version(spark, folder):
    rnd = random.Random(1)
    log = [(rnd.randrange(500), f"v{n}", "c", n, n // 100, T0 + timedelta(seconds=n)) for n in range(4000)]
    store = FeedStore(spark, folder(), ["id"])
    store.append(feed.from_changes(spark.createDataFrame(log, LOG), ["id"], ["v"], ["n"], "ver", "ts"), files=8)
    ends = store.changes().groupBy(F.col("_metadata.file_path").alias("f")).agg(F.min("_commit_version").alias("a"), F.max("_commit_version").alias("b")).orderBy("a").collect()
    assert len(ends) == 8 and all(x.b <= y.a for x, y in zip(ends, ends[1:]))


def test_row_estimate_reads_no_column(spark, folder):
    spark.range(1000).selectExpr("id", "id * 2 AS x").repartition(3).write.parquet(folder())
    e = feed.row_estimate(spark.read.parquet(folder()))
    assert tuple(e.first()) == (1000, False)
    assert "ReadSchema: struct<>" in e._jdf.queryExecution().toString()
