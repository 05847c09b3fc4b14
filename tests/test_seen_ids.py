"""Re-deliveries of any age: Bloom filters, the buckets that are opened, repeated micro-batches, merges."""

import random

import numpy as np
import pytest
from test_keyed_streams import put, source

from tidemark.functions import lineage
from tidemark.sinks import seen_ids
from tidemark.sinks.seen_ids import SeenIds
from tidemark.streaming import streams

ROW = "id string, n int"


def test_filters_hold_what_they_were_built_from():
    rng = np.random.default_rng(1)
    for n in (0, 1, 7, 1000, 20_000):
        h = rng.integers(-(2**63), 2**63 - 1, n, np.int64)
        f = seen_ids.bloom(h)
        assert seen_ids.may_hold(f, h).all() and len(f) == max(32, -(-n * 10 // 8))
        assert seen_ids.may_hold(f, rng.integers(-(2**63), 2**63 - 1, 20_000, np.int64)).mean() < 0.02


def run(spark, src, store, out, check):
    q = streams.dedupe_for_good(source(spark, src, ROW), store, out, check)
    q.awaitTermination()
    assert q.exception() is None


def test_a_repeat_long_after_is_dropped_and_few_buckets_are_read(spark, folder):
    src, out, check, root = folder("src"), folder("out"), folder("check"), folder("ids")
    store = SeenIds(spark, root, "id", buckets=16)
    got = lambda: sorted((r.id or "", r.n) for r in spark.read.schema(ROW).parquet(out).collect())
    put(spark, src, [(f"e{k}", k) for k in range(2000)], ROW)
    run(spark, src, store, out, check)
    assert store.opened == [] and len(got()) == 2000
    # a new id twice, an old one twice, and rows without an id
    put(spark, src, [("new", 1), ("new", 1), ("e5", 5), ("e5", 5), (None, 1), (None, 1), ("", 2)], ROW)
    run(spark, src, store, out, check)
    assert got() == sorted([(f"e{k}", k) for k in range(2000)] + [("new", 1), ("", 1), ("", 1), ("", 2)])
    assert 1 <= len(store.opened) <= 2 and {n for n, _ in store.opened} == {0}
    # batches of new ids, then a merge: the old id is still known, from the merged bucket
    for b in range(3):
        put(spark, src, [(f"b{b}-{k}", k) for k in range(50)], ROW)
        run(spark, src, store, out, check)
    assert store.merge() == 3 and store.merge() == 3
    assert sorted(n for n, in store.filters().select("segment").distinct().collect()) == [3, 4]
    before = got()
    put(spark, src, [("e5", 5), ("new", 1), ("b0-7", 7), ("b2-9", 9)], ROW)
    run(spark, src, SeenIds(spark, root, "id", buckets=16), out, check)
    assert got() == before
    put(spark, src, [("last", 0)], ROW)
    run(spark, src, store, out, check)
    assert store.merge() == 5  # removes what the first merge had covered
    assert sorted(n for n, _ in lineage.numbered_folders(spark, f"{root}/buckets=16/ids", "segment")) == [4, 5, 6]
    put(spark, src, [("e1999", 1), ("b1-0", 0), ("last", 0)], ROW)
    run(spark, src, store, out, check)
    assert got() == sorted([*before, ("last", 0)])


def test_random_batches_against_a_set(spark, folder):
    rng, seen, store = random.Random(3), set(), SeenIds(spark, folder("ids"), "id", buckets=4)
    for n in range(6):
        rows = [(f"k{rng.randrange(120)}", n) for _ in range(rng.choice([0, 1, 40]))]
        batch = spark.createDataFrame(rows, ROW)
        want = {i for i, _ in rows} - seen
        for _ in range(2):  # the second time as after a crash: its own segment is there, and not seen
            fresh = store.unseen(batch, n)
            ids = [r.id for r in fresh.collect()]
            assert sorted(ids) == sorted(want)
            store.add(spark.createDataFrame([(i, n) for i in ids], ROW), n)
        seen |= want
        if n == 3:
            store.merge()


def test_buckets_stay(spark, folder):
    root = folder("ids")
    SeenIds(spark, root, "id", buckets=4).add(spark.createDataFrame([("a", 1)], ROW), 0)
    with pytest.raises(ValueError, match="4 buckets"):
        SeenIds(spark, root, "id", buckets=8)
