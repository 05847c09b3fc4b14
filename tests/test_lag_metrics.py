"""Lag, freshness, counters and alert conditions."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import lag, metrics

T0 = datetime(2024, 1, 15, 10, 0)


def at(minutes):
    return T0 + timedelta(minutes=minutes)


def test_lag_is_never_negative(spark):
    d = spark.createDataFrame([(at(0), T0 + timedelta(seconds=5.5)), (at(1), at(0))], "a timestamp_ntz, b timestamp_ntz")
    assert [r[0] for r in d.select(lag.of("a", "b")).collect()] == [5.5, 0.0]


def test_check(spark):
    d = spark.createDataFrame([(8.5,), (31.0,), (2.0,)], "s double")
    got = [(r.lag_status, round(r.percent_of_threshold, 1)) for r in lag.check(d, "s", 30.0, 10.0).collect()]
    assert got == [("passed", 28.3), ("failed", 103.3), ("passed", 6.7)]
    assert [r.lag_status for r in lag.check(d, "s", 30.0, 5.0).collect()] == ["warning", "failed", "passed"]
    assert lag.check(d, "s", 0.0).first().lag_status == "failed"
    assert [r.lag_status for r in lag.check(d, "s").collect()] == ["failed", "failed", "passed"]


def test_batch(spark):
    d = spark.createDataFrame([(1.0,), (2.0,), (10.0,)], "s double")
    r = lag.batch(d, "s", threshold=5).first()
    assert (r.status, r.events, r.min_lag, r.max_lag) == ("failed", 3, 1.0, 10.0)
    assert lag.batch(d.limit(0), "s").first().status == "skipped"


def test_staleness(spark):
    d = spark.createDataFrame([("old", at(-10)), ("new", at(-1))], "p string, ts timestamp_ntz")
    got = {r.p: r.status for r in lag.staleness(d, "ts", F.lit(T0).cast("timestamp_ntz"), ["p"]).collect()}
    assert got == {"old": "warning", "new": "passed"}


def test_trend(spark):
    d = spark.createDataFrame([(at(i), 2.0 + 0.5 * i) for i in range(4)], "ts timestamp_ntz, s double")
    r = lag.trend(d, "ts", "s").first()
    assert (r.direction, round(r.slope_per_minute, 9), r.avg_lag, r.max_lag, r.min_lag) == ("increasing", 0.5, 2.75, 3.5, 2.0)
    assert lag.trend(d.withColumn("s", F.lit(1.0)), "ts", "s").first().direction == "stable"


def test_offsets_and_counts(spark):
    ends = spark.createDataFrame([("t", 0, 9), ("t", 1, 4)], "topic string, partition int, offset long")
    pos = spark.createDataFrame([("t", 0, 7)], "topic string, partition int, position long")
    assert {r.partition: r.lag for r in lag.offsets(ends, pos).collect()} == {0: 3, 1: 5}
    assert lag.by_count(spark.range(200), spark.range(99)).first().status == "warning"
    assert lag.by_count(spark.range(200), spark.range(100)).first().status == "passed"


def test_between_tables_without_groups(spark):
    s = spark.createDataFrame([(at(5),), (at(2),)], "ts timestamp_ntz")
    d = spark.createDataFrame([(at(1),)], "ts timestamp_ntz")
    assert lag.between_tables(s, d, "ts", "ts").first().lag_seconds == 240.0


@pytest.mark.parametrize("bucket", [None, "hour", "minute"])
def test_sustained(spark, bucket):
    values = [1, 11, 12, 13, 2, 50, 11, None, 11, 11, 11, 11]
    d = spark.createDataFrame([("p", at(i), v) for i, v in enumerate(values)], "p string, ts timestamp_ntz, s int")
    cut = F.date_trunc(bucket, F.col("ts")) if bucket else None
    got = metrics.sustained(d, ["p"], "ts", "s > 10", 120, cut).orderBy("started").collect()
    assert [(r.started, r.samples, r.lasted_seconds) for r in got] == [(at(1), 3, 120.0), (at(8), 4, 180.0)]


@pytest.mark.parametrize("bucket", [None, "hour", "minute"])
def test_increase_with_restart(spark, bucket):
    values = [5, 7, 9, 2, 3, 3]
    d = spark.createDataFrame([("p", at(10 * i), v) for i, v in enumerate(values)], "p string, ts timestamp_ntz, n int")
    cut = F.date_trunc(bucket, F.col("ts")) if bucket else None
    got = metrics.increase(d, ["p"], "ts", "n", "1 hour", cut).first()
    assert got["increase"] == 2 + 2 + 2 + 1 + 0


def test_histogram(spark):
    d = spark.createDataFrame([(0.05,), (0.1,), (7.0,), (99.0,), (None,)], "v double")
    got = {r.le: r["count"] for r in metrics.histogram(d, "v", (0.1, 10.0)).collect()}
    assert got == {0.1: 2, 10.0: 3, None: 4}


def test_health(spark):
    rows = [("a", "db", "unhealthy", 1), ("a", "db", "healthy", 2), ("a", "log", "healthy", 1), ("b", "db", "degraded", 1),
            ("b", "log", "healthy", 1), ("c", "db", "unhealthy", 1), ("c", "log", "degraded", 1)]
    d = spark.createDataFrame(rows, "p string, c string, s string, n int")
    got = {r.p: r.health for r in metrics.health(d, ["p"], "c", "s", ["n"]).collect()}
    assert got == {"a": "healthy", "b": "degraded", "c": "unhealthy"}


def test_rate_and_throughput(spark):
    d = spark.createDataFrame([(at(i / 60),) for i in range(40)], "ts timestamp_ntz")
    r = metrics.rate(d, "ts").first()
    assert (r.events, r.status) == (40, "low")
    runs = spark.createDataFrame([("p", 0, 0, at(0), at(1)), ("p", 120, 6, at(1), at(2))],
                                 "p string, n long, e long, s timestamp_ntz, t timestamp_ntz")
    r = metrics.throughput(runs, ["p"], "n", "e", "s", "t").first()
    assert (r.rows_per_second, r.error_rate) == (1.0, 0.05)
    assert metrics.event_counts(runs, ["p"]).first().total == 2
