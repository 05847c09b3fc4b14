"""Answers where there is little to go by: null ops, missing times, nothing to compare, empty windows, mixed types."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import checksum
from tidemark.operators import apply, feed, lag, metrics, quality, schema


@pytest.mark.parametrize("strategy", ["probe", "merge"])
@pytest.mark.parametrize("on_delete", ["remove", "mark"])
def test_events_without_a_known_op_change_nothing(spark, strategy, on_delete):
    base = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, v string")
    changes = spark.createDataFrame([(1, "x", None, 1), (2, "y", "u", 1), (2, None, "t", 2), (3, None, "d", 1), (3, "z", "?", 2)], "id int, v string, op string, lsn int")
    got = apply.apply_changes(base, changes, ["id"], ["lsn"], strategy=strategy, on_delete=on_delete)
    live = got if on_delete == "remove" else got.filter("not is_deleted")
    assert sorted((r.id, r.v) for r in live.collect()) == [(1, "a"), (2, "y")]
    known, other = apply.split_by_op(changes)
    assert (known.count(), other.count()) == (2, 3)
    state = feed.current_of_changes(changes, ["id"], ["lsn"])
    assert [(r.id, r.v) for r in state.collect()] == [(2, "y")]


def test_lag_without_a_time_is_unknown(spark):
    rows = [("a", dt.datetime(2024, 1, 1), None), ("b", dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 1)), ("c", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 0, 1))]
    d = spark.createDataFrame(rows, "k string, e timestamp_ntz, p timestamp_ntz").withColumn("lag", lag.of("e", "p"))
    assert {r.k: (r.lag, r.lag_status) for r in lag.check(d, "lag", 30.0).collect()} == {"a": (None, "skipped"), "b": (0.0, "passed"), "c": (60.0, "failed")}


def test_a_source_that_never_arrived_fails(spark):
    s = spark.createDataFrame([("a", dt.datetime(2024, 1, 1)), ("b", dt.datetime(2024, 1, 1))], "k string, ts timestamp_ntz")
    got = {r.k: (r.lag_seconds, r.status) for r in lag.between_tables(s, s.filter("k = 'a'"), "ts", "ts", ["k"]).collect()}
    assert got == {"a": (0.0, "passed"), "b": (None, "failed")}


def test_booleans_are_no_numbers(spark):
    rows = [("t", 1, '{"f": true, "g": true, "h": 5}'), ("t", 1, '{"f": 5, "g": false, "h": 1.5}')]
    got = schema.observed(spark.createDataFrame(rows, "t string, v int, j string"), "j", "t", "v")
    assert {r.column: r.type for r in got.collect()} == {"f": "VARCHAR", "g": "BOOLEAN", "h": "DOUBLE"}


def test_batches_of_rows_without_a_time(spark):
    rows = [(k, None if k < 3 else dt.datetime(2024, 1, 1, 0, k)) for k in range(9)]
    d = spark.createDataFrame(rows, "id int, ts timestamp_ntz")
    got = feed.batched(d, ["ts", "id"], 3, F.date_trunc("minute", F.col("ts")))
    assert [(r.batch_id, r.n) for r in got.groupBy("batch_id").agg(F.count("*").alias("n")).orderBy("batch_id").collect()] == [(0, 3), (1, 3), (2, 3)]


def test_nothing_compared_is_not_passed(spark):
    a, b = spark.createDataFrame([(1, "x")], "id int, v string"), spark.createDataFrame([(2, "x")], "id int, v string")
    assert [(r.status, r.checked) for r in quality.fields_match(a, b, ["id"], ["v"]).collect()] == [("failed", 0)]
    assert [r.status for r in quality.fields_match(a.limit(0), b, ["id"], ["v"]).collect()] == ["skipped"]
    assert {r.status for r in quality.check_rules(a.limit(0), [quality.Rule("r", "v = 'x'")]).collect()} == {"skipped"}
    assert {r.status for r in quality.completeness(a.limit(0), ["v"]).collect()} == {"skipped"}
    cross = quality.check_cross_rule(a, b.withColumnsRenamed({"id": "pid", "v": "w"}), "id", "pid", quality.Rule("r", "v = w"))
    assert [r.status for r in cross.collect()] == ["skipped"]


def test_windows_without_events_are_stalled(spark):
    rows = [("a", dt.datetime(2024, 1, 1, 0, 0))] * 40 + [("a", dt.datetime(2024, 1, 1, 1, 0))] * 40 + [(None, dt.datetime(2024, 1, 1, 1, 0))]
    d = spark.createDataFrame(rows, "k string, ts timestamp_ntz")
    got = metrics.rate(d, "ts", ["k"]).collect()
    assert [r.events for r in sorted((r for r in got if r.k), key=lambda r: r.window_start)] == [40] + [0] * 11 + [40]
    assert {r.status for r in got if r.events == 0} == {"stalled"}
    more = metrics.rate(d, "ts", ["k"], until=F.lit("2024-01-01 02:00:00")).filter("k is null").collect()
    assert sorted((r.events for r in more), reverse=True) == [1] + [0] * 12


def test_row_texts_tell_values_apart(spark):
    rows = [("x|b=y", "z"), ("x", "y|b=z"), (None, "z"), ("\\N", "z"), ("-", "z"), ("", "z"), ("1:x", "z")]
    d = spark.createDataFrame(rows, "a string, b string")
    assert d.select(checksum.row_text(["a", "b"])).distinct().count() == len(rows)
    assert d.select(checksum.row_checksum(["a", "b"])).distinct().count() == len(rows)
