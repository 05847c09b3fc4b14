"""Checksum trees, tables clustered on several columns, renames by content."""

import datetime as dt
import json
import os
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from test_oracle import SF

from tidemark.operators import diff, schema, tree
from tidemark.sinks import writers

SMALL = {"leaf_bits": 3, "levels": 3}


def numbers(spark, n, change=()):
    v = F.when(F.col("id").isin(list(change)), F.lit("other")).otherwise(F.concat(F.lit("v"), "id"))
    return spark.range(n).withColumn("v", v)


def scanned(df):
    """Rows that the scans of a frame handed on, by its plan's metrics."""
    df.collect()
    plan, out = df._jdf.queryExecution().executedPlan().toString(), 0
    leaves = [df._jdf.queryExecution().executedPlan().executedPlan()] if "AdaptiveSparkPlan" in plan else [df._jdf.queryExecution().executedPlan()]
    while leaves:
        node = leaves.pop()
        name = node.nodeName()
        if name.startswith("Scan parquet") and "v#" in node.toString():  # not those of the trees
            out += node.metrics().apply("numOutputRows").value()
        if name.endswith("QueryStage"):
            leaves.append(node.plan())
        kids = node.children()
        leaves += [kids.apply(k) for k in range(kids.size())]
    return out


def test_tree_finds_what_differs_and_reads_little(spark, folder):
    a, b = folder("a"), folder("b")
    changed = [5, 4_000, 4_001, 19_999]
    numbers(spark, 20_000).repartitionByRange(20, "id").sortWithinPartitions("id").write.parquet(a)
    numbers(spark, 20_000, changed).filter("id <> 77").repartitionByRange(20, "id").sortWithinPartitions("id").write.parquet(b)
    ta, tb = folder("ta"), folder("tb")
    a, b = spark.read.parquet(a), spark.read.parquet(b)
    for df, path in ((a, ta), (b, tb)):
        tree.build(df, "id", **SMALL).write.partitionBy("level").parquet(path)
    ta, tb = spark.read.parquet(ta), spark.read.parquet(tb)
    leaves = tree.differing(ta, tb, 3)
    assert sorted((r.node, r.rows_a, r.rows_b) for r in leaves.collect()) == [(0, 8, 8), (9, 8, 7), (500, 8, 8), (2499, 8, 8)]
    assert tree.ranges(leaves, **SMALL) == [(0, 7), (72, 79), (4000, 4007), (19992, 19999)]
    assert tree.ranges(leaves, **SMALL, most=3) == [(0, 511), (3584, 4095), (19968, 20479)]
    few = tree.compare(a, b, ta, tb, "id", **SMALL)
    assert scanned(few[0]) < 20_000 / 5 and few[0].count() == 32
    got = diff.paired(*few, ["id"]).select("id", "kind").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, diff.paired(a, b, ["id"]).select("id", "kind").collect()))
    assert len(got) == 5


def test_trees_add_up(spark):
    rows = [(-9, "x"), (-1, None), (0, ""), (0, ""), (None, "n"), (63, "y"), (2**40, "z")]
    df = spark.createDataFrame(rows, "id long, v string")
    parts = [spark.createDataFrame(rows[k : k + 2], df.schema) for k in range(0, 7, 2)]
    whole = tree.build(df, "id", **SMALL)
    assert tree.differing(whole, tree.combine(*[tree.build(p, "id", **SMALL) for p in parts]), 3).count() == 0
    gone = tree.build(parts[2], "id", **SMALL, sign=-1)
    left = tree.build(df.filter("id <= 0 or id > 100"), "id", **SMALL)
    assert tree.differing(tree.combine(whole, gone), left, 3).count() == 0
    again = tree.build(df.union(df.filter("id = 0").limit(1)), "id", **SMALL)
    assert [r.node for r in tree.differing(whole, again, 3).collect()] == [0]
    null = tree.build(spark.createDataFrame([*rows[:4], (None, "other"), *rows[5:]], df.schema), "id", **SMALL)
    leaves = tree.differing(whole, null, 3)
    assert [r.node for r in leaves.collect()] == [None]
    assert [r.v for r in tree.rows_in(df, "id", leaves, tree.ranges(leaves, **SMALL), 3).collect()] == ["n"]
    empty = tree.build(df.limit(0), "id", **SMALL)
    assert empty.count() == 0 and tree.differing(whole, empty, 3).agg(F.sum("rows_a")).first()[0] == 7
    with pytest.raises(TypeError):
        tree.build(df, "v")


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz"])
def test_trees_over_times(spark, kind):
    rows = [(dt.datetime(2024, 1, 1) + dt.timedelta(hours=31 * k, microseconds=k), k) for k in range(40)]
    df = spark.createDataFrame(rows, "at timestamp_ntz, v int").withColumn("at", F.col("at").cast(kind))
    other = df.withColumn("v", F.when(F.col("v") == 17, -1).otherwise(F.col("v")))
    shape = {"leaf_bits": 0 if kind == "date" else 4, "levels": 4}
    few = tree.compare(df, other, *[tree.build(d, "at", **shape) for d in (df, other)], "at", **shape)
    assert [[r.v for r in d.collect()] for d in few] == [[17], [-1]]


@pytest.mark.parametrize(("columns", "share"), [(["n", "x"], 0.35), (["n", "s", "x"], 0.6)])
def test_cluster_skips_files_on_either_column(spark, folder, columns, share):
    rng, path = random.Random(4), folder()
    rows = [(k, rng.randrange(10_000), "".join(rng.choices("abcdefgh", k=6)), None if k % 10 == 0 else rng.random() ** 6) for k in range(20_000)]
    df = spark.createDataFrame(rows, "id int, n int, s string, x double")
    writers.cluster(df, path, columns, files=64)
    back = spark.read.parquet(path)
    assert back.exceptAll(df).count() == 0 and back.count() == 20_000
    files = [r[0] for r in back.select(F.input_file_name()).distinct().collect()]
    bounds = []
    for f in files:
        g = pq.ParquetFile(f.removeprefix("file://")).metadata.row_group(0)
        bounds.append({g.column(c).path_in_schema: (g.column(c).statistics.min, g.column(c).statistics.max) for c in range(g.num_columns) if g.column(c).statistics.has_min_max})
    for column in columns:  # over values of the table itself; without clustering nearly all files are touched
        values = [v for r in rows[::97] if (v := r["_nsx".index(column)]) is not None]
        touched = [sum(b[column][0] <= v <= b[column][1] for b in bounds if column in b) for v in values]
        assert len(files) > 50 and sum(touched) / len(touched) < share * len(files), column


@pytest.mark.parametrize("write", [lambda d, p, **t: writers.cluster(d, p, ["x", "y"], **t), lambda d, p, **t: writers.compact(d, p, order_by=["x"], **t)])
def test_small_files_share_tasks(spark, folder, write):
    """Tasks, and blocks shuffled to them, are few however many files are written."""
    rows = spark.range(60_000, numPartitions=4).selectExpr("id", "hash(id) % 1000 AS x", "xxhash64(id) % 100000 AS y")
    rows.write.parquet(src := folder("src"))
    df = spark.read.parquet(src)
    want = 200
    size = sum(os.path.getsize(f"{src}/{f}") for f in os.listdir(src) if f.endswith(".parquet"))
    write(df, path := folder("out"), target_bytes=-(-size // want))
    files = [f for f in os.listdir(path) if f.endswith(".parquet")]
    tasks = {f.split("-")[1] for f in files}
    assert want - 10 <= len(files) <= want + len(tasks) and len(tasks) <= 8
    assert max(pq.ParquetFile(f"{path}/{f}").metadata.num_rows for f in files) <= 60_000 // want + 1
    back = spark.read.parquet(path)
    assert back.exceptAll(df).isEmpty() and back.count() == 60_000
    widths = [b - a for a, b in back.groupBy(F.input_file_name()).agg(F.min("x").alias("a"), F.max("x").alias("b")).select("a", "b").collect()]
    assert sum(widths) / len(widths) < 500  # of 2000


@pytest.mark.parametrize("values", [[None, 3.0, float("nan"), -1.0, 3.0, 7.0] * 40, list(range(500)), [5] * 30 + [None] * 200])
def test_curve_counts_the_limits_passed(spark, values):
    df = spark.createDataFrame([(k, None if v is None else float(v)) for k, v in enumerate(values)], "id int, v double")
    got = {r.id: r.c for r in df.withColumn("c", writers.interleaved(df, ["v"], bits=4)).collect()}
    limits = df.agg(F.percentile_approx(F.coalesce("v", F.lit(float("-inf"))), [k / 16 for k in range(1, 16)], 160)).first()[0]
    above = lambda x, v: v != v or x <= v  # noqa: E731  NaN is above all
    assert got == {k: sum(above(x, float("-inf") if v is None else float(v)) for x in limits) for k, v in enumerate(values)}


def test_cluster_of_one_value_nulls_and_none(spark, folder):
    same = spark.createDataFrame([(1, "x")] * 500 + [(None, None)] * 20, "a int, b string")
    writers.cluster(same, path := folder("a"), ["a", "b"], files=4)
    assert spark.read.parquet(path).groupBy("a", "b").count().orderBy(F.desc("count")).collect() == [(1, "x", 500), (None, None, 20)]
    writers.cluster(same.limit(0), path := folder("b"), ["a", "b"], files=4)
    assert spark.read.parquet(path).count() == 0
    with pytest.raises(ValueError):
        writers.interleaved(same, ["a"], bits=3)


def events(spark, versions):
    rows = [("t", v, json.dumps(row)) for v, part in versions.items() for row in part]
    return spark.createDataFrame(rows, "t string, v int, j string").repartition(5)


def found(spark, versions):
    e = events(spark, versions)
    changes = schema.detect_changes(schema.observed(e, "j", "t", "v"))
    return {r.old_name: r.new_name for r in schema.renames_by_content(changes, schema.profiles(e, "j", "t", "v")).collect()}


def test_two_renames_in_crossed_name_order(spark):
    rng = random.Random(5)
    zips, towns = [f"{rng.randrange(10**5):05}" for _ in range(300)], ["".join(rng.choices("aeioulmnrst", k=7)).title() for _ in range(300)]
    old = [{"zip": z, "city": c, "n": 1} for z, c in zip(zips, towns)]
    new = [{"post_code": z, "town": c, "n": 1} for z, c in zip(zips, towns)]
    assert found(spark, {1: old, 2: new}) == {"zip": "post_code", "city": "town"}
    # other values of the same shapes, and a new column that is like neither
    more = [{"post_code": f"{rng.randrange(10**5):05}", "town": "".join(rng.choices("aeioulmnrst", k=9)).title(), "mail": f"{c}@example.com"} for c in towns]
    assert found(spark, {1: old, 2: more}) == {"zip": "post_code", "city": "town"}
    assert found(spark, {1: old, 2: [{"n": 1, "mail": f"{c}@example.com"} for c in towns]}) == {}


def test_merged_profiles_are_those_of_all_rows(spark):
    rows = {1: [{"a": k % 7, "b": None if k % 3 else "x"} for k in range(90)], 2: [{"a": k} for k in range(50)]}
    e = events(spark, rows)
    first, second = (schema.profiles(e.filter(F.crc32("j") % 2 == k), "j", "t", "v") for k in (0, 1))
    merged = schema.merge_profiles(first, second)
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, schema.profiles(e, "j", "t", "v").collect()))
