"""Collapsing and applying changes: golden transactions, properties on random histories, hot keys."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import apply as ap
from tidemark.operators import diff, feed

CHANGES = "id long, v string, op string, n long"


def run(spark, base, changes, **kw):
    b = spark.createDataFrame(base, "id long, v string")
    c = spark.createDataFrame(changes, CHANGES)
    return {r.id: r.v for r in ap.apply_changes(b, c, ["id"], ["n"], **kw).collect()}


@pytest.mark.parametrize("strategy", ["probe", "merge"])
@pytest.mark.parametrize(
    "base,changes,want",
    [
        ([], [(1000, "99.99", "c", 1), (1001, "149.99", "c", 2), (1000, "89.99", "u", 3)], {1000: "89.99", 1001: "149.99"}),
        ([], [(1000, "a", "c", 1), (1000, "b", "u", 2), (1001, "c", "c", 3), (1000, None, "d", 4)], {1001: "c"}),
        ([(1, "100")], [(1, str(100 - i), "u", i) for i in range(10)], {1: "91"}),
        ([(1, "a")], [(1, None, "d", 1), (1, "b", "c", 2)], {1: "b"}),
        ([(1, "a")], [(2, None, "d", 1)], {1: "a"}),
        ([(1, "a")], [(1, "r", "r", 1)], {1: "r"}),
        ([(0, "zero")], [(0, "new", "u", 1)], {0: "new"}),
    ],
)
def test_transactions(spark, strategy, base, changes, want):
    assert run(spark, base, changes, strategy=strategy) == want


def test_order_is_required(spark):
    with pytest.raises(ValueError):
        ap.latest_per_key(spark.range(1), ["id"], [])


@pytest.mark.parametrize("strategy", ["probe", "merge"])
def test_random_history_matches_replay(spark, strategy):
    rnd = random.Random(7)
    base = [(k, f"b{k}") for k in range(30)]
    changes = [(rnd.choice([0, 0, rnd.randrange(50)]), f"v{n}", rnd.choice("curd"), n) for n in range(500)]
    want = dict(base)
    for k, v, op, _ in changes:
        if op == "d":
            want.pop(k, None)
        else:
            want[k] = v
    rnd.shuffle(changes)
    assert run(spark, base, changes, strategy=strategy) == want
    # applying the batch twice changes nothing
    assert run(spark, list(want.items()), changes, strategy=strategy) == want


@pytest.mark.parametrize("strategy", ["probe", "merge"])
def test_soft_delete(spark, strategy):
    b = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id long, v string")
    c = spark.createDataFrame([(1, None, "d", 1), (2, "x", "u", 2), (9, None, "d", 3), (4, "n", "c", 4)], CHANGES)
    got = ap.apply_changes(b, c, ["id"], ["n"], on_delete="mark", strategy=strategy)
    assert sorted(tuple(r) for r in got.select("id", "v", "is_deleted").collect()) == [
        (1, "a", True), (2, "x", False), (3, "c", False), (4, "n", False)]


def test_hot_key_sends_one_row_per_task(spark):
    """A third of the changes are of one key; the group limit sits below the exchange."""
    d = spark.range(0, 30000, 1, 8).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("n"))
    last = ap.latest_per_key(d, ["k"], ["n"])
    plan = last._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange hashpartitioning") < plan.rindex("WindowGroupLimit")
    assert last.filter("k = 0").first()["n"] == 29997 and last.count() == 20001


def test_probe_does_not_shuffle_the_table_for_a_small_batch(spark, folder):
    spark.range(100000).selectExpr("id", "cast(id as string) v").write.parquet(folder("base"))
    base = spark.read.parquet(folder("base"))
    c = spark.createDataFrame([(5, "x", "u", 1), (7, None, "d", 2)], CHANGES)
    got = ap.apply_changes(base, c, ["id"], ["n"])
    assert got.count() == 99999
    got.collect()
    assert "BroadcastHashJoin" in got._jdf.queryExecution().executedPlan().toString()


def test_delete_where_keeps_unknown(spark):
    d = spark.createDataFrame([(1, 10), (2, None), (3, 99)], "id int, v int")
    assert sorted(r.id for r in ap.delete_where(d, "v < 50").collect()) == [2, 3]


def test_replace_upsert_delete_evolve(spark):
    b = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    n = spark.createDataFrame([(2, "x"), (3, "y")], "id long, v string")
    assert {r.id: r.v for r in ap.upsert(b, n, ["id"]).collect()} == {1: "a", 2: "x", 3: "y"}
    assert [r.id for r in ap.delete_keys(b, n, ["id"]).collect()] == [1]
    assert {r.id: r.v for r in ap.replace_where(b, n, "id = 2").collect() if r.id != 2} == {1: "a", 3: "y"}
    e = ap.append_evolving(b, n.withColumn("w", F.lit(1)))
    assert e.columns == ["id", "v", "w"] and e.filter("w is null").count() == 2


def states(spark, seed):
    rnd = random.Random(seed)
    one = {k: rnd.choice(["a", "b", None]) for k in range(60) if rnd.random() < 0.7}
    two = {k: rnd.choice(["a", "b", None]) for k in range(60) if rnd.random() < 0.7}
    return [spark.createDataFrame(list(x.items()), "id long, v string") for x in (one, two)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_apply_after_diff_gives_after(spark, seed):
    before, after = states(spark, seed)
    d = diff.snapshot_diff(before, after, ["id"], images=False)
    ops = d.select("id", "v", F.when(F.col("_change_type") == "delete", "d").otherwise("u").alias("op"), F.lit(1).alias("n"))
    got = ap.apply_changes(before, ops, ["id"], ["n"])
    assert got.exceptAll(after).isEmpty() and after.exceptAll(got).isEmpty()
    assert diff.snapshot_diff(after, after, ["id"]).isEmpty()


@pytest.mark.parametrize("seed", [4, 5])
def test_diff_by_hash_equals_diff_by_rows(spark, seed):
    before, after = states(spark, seed)
    rows = diff.snapshot_diff(before, after, ["id"])
    hashed = diff.snapshot_diff(before, after, ["id"], strategy="hashes")
    assert rows.count() > 0 and rows.exceptAll(hashed).isEmpty() and hashed.exceptAll(rows).isEmpty()


def test_merge_latest(spark):
    rnd = random.Random(11)
    rows = [(rnd.randrange(40), f"v{n}", n) for n in range(300)]
    d = spark.createDataFrame(rows, "id long, v string, n long")
    cut = d.filter("n % 2 = 0")
    base = ap.latest_per_key(cut, ["id"], ["n"])
    got = ap.merge_latest(base, d.filter("n % 2 = 1"), ["id"], ["n"])
    want = ap.latest_per_key(d, ["id"], ["n"])
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_diff_images_and_null_values(spark):
    b = spark.createDataFrame([(1, None), (2, "x"), (3, "z")], "id long, v string")
    a = spark.createDataFrame([(1, None), (2, None), (4, "n")], "id long, v string")
    got = sorted((r.id, r.v, r["_change_type"]) for r in diff.snapshot_diff(b, a, ["id"]).fillna("~").collect())
    assert got == [(2, "x", "update_preimage"), (2, "~", "update_postimage"), (3, "z", "delete"), (4, "n", "insert")]


def test_current_of_changes(spark):
    c = spark.createDataFrame([(1, "a", "c", 1), (1, None, "d", 2), (2, "b", "r", 3)], CHANGES)
    assert [r.id for r in feed.current_of_changes(c, ["id"], ["n"]).collect()] == [2]
