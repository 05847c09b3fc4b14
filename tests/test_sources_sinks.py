"""Readers, writers and generated rows."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from tidemark.functions import lineage
from tidemark.operators import diff, quality
from tidemark.sinks import writers
from tidemark.sources import gen, readers


def test_stream_options():
    o = readers._options("kafka", None, "earliest", {"subscribe": "t"})
    assert o == {"startingOffsets": "earliest", "failOnDataLoss": "true", "subscribe": "t"}
    assert readers._options("kafka", 9, "earliest", {}, False) == {"startingOffsets": "earliest", "failOnDataLoss": "false", "maxOffsetsPerTrigger": "9"}
    assert readers._options("parquet", None, "earliest", {}) == {}
    assert readers._options("kafka", 5, "latest", {})["startingOffsets"] == "latest"
    assert readers._options("parquet", 7, "earliest", {}) == {"maxFilesPerTrigger": "7"}
    with pytest.raises(ValueError):
        readers._options("kafka", None, "middle", {})


def test_poll_pushes_its_filter(spark, folder):
    spark.range(100).selectExpr("id", "timestamp_micros(id) at").write.parquet(folder())
    d = spark.read.parquet(folder())
    new = readers.poll_by_column(d, "id", 89)
    assert new.count() == 10 and readers.next_bookmark(new, "id").first().bookmark == 99
    assert "GreaterThan(id,89)" in new._jdf.queryExecution().executedPlan().toString()


def test_stored_feed_prunes_versions(spark, folder):
    f = spark.range(100).select("id", F.lit("insert").alias("_change_type"), (F.col("id") % 10).alias("_commit_version"),
                                F.current_timestamp().alias("_commit_timestamp"))
    writers.append_feed(f, folder())
    got = readers.change_feed(spark, folder(), start=3, end=4)
    assert got.count() == 20 and dict(got.dtypes)["_commit_version"] == "bigint"
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_commit_version" in plan


def test_partitioned_write_makes_few_files(spark, folder):
    """Nine tenths of the rows are of one value; each value gets its own few files."""
    d = spark.range(0, 20000, 1, 16).select("id", F.when(F.col("id") % 10 == 0, F.col("id") % 7).otherwise(99).alias("p"))
    writers.append(d, folder(), partition_by=["p"], sort_by=["id"])
    assert spark.read.parquet(folder()).count() == 20000
    assert len(glob.glob(folder() + "/p=*/*.parquet")) <= 16


def test_time_buckets(spark, folder):
    d = spark.createDataFrame([(1, "2024-01-31"), (2, "2024-02-01"), (3, "2024-02-29")], "id int, day string")
    d = d.withColumn("day", F.to_date("day"))
    writers.time_partitioned(d, folder(), "day", "month")
    got = spark.read.parquet(folder()).groupBy("day_month").count().collect()
    assert {str(r.day_month): r["count"] for r in got} == {"2024-01-01": 1, "2024-02-01": 2}
    with pytest.raises(ValueError):
        writers.time_bucket(d, "day", "week")


def test_compact_spreads_a_hot_value(spark, folder):
    d = spark.range(9000).select("id", F.when(F.col("id") % 3 > 0, 5).otherwise(F.col("id")).alias("k"))
    writers.compact(d, folder(), 4, ["k"])
    per_file = spark.read.parquet(folder()).groupBy(F.input_file_name()).count().collect()
    assert len(per_file) == 4 and max(r["count"] for r in per_file) < 4500
    assert spark.read.parquet(folder()).exceptAll(d).isEmpty()


def test_versions_show_up_when_complete(spark, folder):
    root = folder()
    assert writers.versions(spark, root) == []
    writers.write_version(spark.range(3), root, 1)
    # a write that failed before it was logged
    spark.range(4).write.parquet(f"{root}/version=2")
    assert writers.versions(spark, root) == [1] and writers.read_version(spark, root).count() == 3
    writers.write_version(spark.range(5), root, 2)
    assert writers.versions(spark, root) == [1, 2] and writers.read_version(spark, root).count() == 5
    assert writers.read_version(spark, root, 1).count() == 3
    with pytest.raises(FileNotFoundError):
        writers.read_version(spark, root, 9)


def test_replace_partitions(spark, folder):
    writers.append(spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string"), folder(), partition_by=["p"])
    writers.replace_partitions(spark.createDataFrame([(9, "b")], "v int, p string"), folder(), ["p"])
    assert {(r.v, r.p) for r in spark.read.parquet(folder()).collect()} == {(1, "a"), (9, "b")}


def test_tables_come_and_go(spark, folder):
    schema = spark.range(1).schema
    writers.ensure_table(spark, "shop_db.t1", schema, path=folder())
    spark.range(4).write.insertInto("shop_db.t1")
    writers.ensure_table(spark, "shop_db.t1", schema)
    assert spark.table("shop_db.t1").count() == 4
    writers.drop_table(spark, "shop_db.t1")
    writers.drop_table(spark, "shop_db.t1")
    assert not spark.catalog.tableExists("shop_db.t1")


def test_bucketed_table_is_not_shuffled_again(spark, folder):
    from tidemark.operators import apply as ap

    base = spark.range(1000).selectExpr("id", "cast(id as string) v")
    writers.save_bucketed(base, "bucketed_base", ["id"], 8, path=folder())
    assert len(glob.glob(folder() + "/*.parquet")) == 8
    table = spark.table("bucketed_base")
    c = spark.createDataFrame([(5, "x", "u", 1), (7, None, "d", 2), (2000, "n", "c", 3)], "id long, v string, op string, n long")
    got = ap.apply_changes(table, c, ["id"], ["n"], strategy="merge")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" in plan
    assert got.count() == 1000 and {r.v for r in got.filter("id in (5, 7, 2000)").collect()} == {"x", "n"}
    writers.drop_table(spark, "bucketed_base")


def test_file_changes(spark, folder):
    spark.range(10).coalesce(1).write.parquet(folder())
    old = lineage.cut(diff.file_listing(spark.read.parquet(folder())))
    spark.range(10).coalesce(1).write.mode("append").parquet(folder())
    new = diff.file_listing(spark.read.parquet(folder()))
    assert [r.change for r in diff.files(old, new).collect()] == ["added"]
    assert [r.change for r in diff.files(new, old).collect()] == ["deleted"]


def test_checkpoint_goes_to_the_named_folder(spark):
    assert lineage.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert lineage.cut(spark.range(5)).count() == 5


def test_generated_rows_are_stable_and_follow_the_shares(spark):
    ids = spark.range(20000)
    c = gen.table("customers", ids)
    again = gen.table("customers", ids.repartition(5))
    assert c.exceptAll(again).isEmpty()
    assert not c.exceptAll(gen.table("customers", ids, seed=1)).isEmpty()
    share = {r.customer_tier: r["count"] / 20000 for r in c.groupBy("customer_tier").count().collect()}
    assert abs(share["Bronze"] - 0.4) < 0.02 and abs(share["Platinum"] - 0.1) < 0.02
    assert abs(c.filter("phone is null").count() / 20000 - 0.3) < 0.02
    p = gen.table("products", ids)
    assert p.filter("cost > price or cost <= 0").isEmpty()
    moves = gen.table("inventory", ids.withColumn("product", F.col("id") % 10), product="product")
    assert quality.check_rules(moves, quality.INVENTORY_RULES).filter("failures > 0").isEmpty()
    assert moves.groupBy("transaction_type").count().count() == 3
    assert gen.table("suppliers", ids).select("email").distinct().count() == 20000
    items = gen.table("order_items", ids.selectExpr("id", "id o", "id p"), order="o", product="p")
    assert items.filter("quantity not between 1 and 10").isEmpty()


def test_compact_counts_files_by_their_size_on_disk(spark, folder):
    spark.range(20_000).selectExpr("id", "id % 7 AS k").repartition(10).write.parquet(folder("a b"))
    df = spark.read.parquet(folder("a b"))
    size = sum(os.path.getsize(f"{folder('a b')}/{f}") for f in os.listdir(folder("a b")) if f.endswith(".parquet"))
    joined = df.join(df.withColumnRenamed("id", "other"), "k").filter("id < 3 and other < 3")
    for n, frame in enumerate((df, joined)):  # the planner takes a join for the product of its sides
        writers.compact(frame, folder(f"out{n}"), order_by=["k"], target_bytes=size // 3 + 1)
        assert sum(f.endswith(".parquet") for f in os.listdir(folder(f"out{n}"))) <= 3
    with pytest.raises(ValueError):
        writers.compact(spark.range(5), folder("out9"))
