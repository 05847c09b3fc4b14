"""Queries: lag, freshness, counters, histograms, rates and alert conditions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import lag, metrics
from tidemark.plans import inputs as i
from tidemark.plans.catalog import query

NOW = "2024-01-30 12:00:00"


def _now():
    return F.lit(NOW).cast("timestamp_ntz")


@query(
    "l1_event_lag",
    f"""SELECT event_id, CASE WHEN s < 0 THEN 0.0::DOUBLE ELSE s END AS lag_seconds FROM (
      SELECT event_id, round((epoch_us(TIMESTAMP '{NOW}') - epoch_us(CASE WHEN event_id % 7 <> 0 THEN ts END)) / 1e6, 3) AS s FROM events)""",
)
def event_lag(spark, sf):
    e = i.read(spark, sf, "events")
    seen = F.when(F.col("event_id") % 7 != 0, F.col("ts"))  # one in seven has no time
    return e.select("event_id", F.round(lag.of(seen, _now()), 3).alias("lag_seconds"))


@query(
    "l2_lag_check",
    """SELECT event_id, value, CASE WHEN value IS NULL THEN 'skipped' WHEN value > 60 THEN 'failed' WHEN value > 20 THEN 'warning'
      ELSE 'passed' END AS lag_status, round(100.0 * value / 60.0, 6) AS percent_of_threshold FROM (
      SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN value END AS value FROM events)""",
)
def lag_check(spark, sf):
    value = F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("value")  # one in seven has none
    d = lag.check(i.read(spark, sf, "events").select("event_id", value), "value", 60.0, 20.0)
    return d.withColumn("percent_of_threshold", F.round("percent_of_threshold", 6))


BATCH_SQL = """SELECT event_type, count(value) AS events, round(avg(value), 9) AS avg_lag, min(value) AS min_lag, max(value) AS max_lag,
  CASE WHEN max(value) <= 350 THEN 'passed' ELSE 'failed' END AS status FROM events GROUP BY 1"""


@query("l3_batch_lag", BATCH_SQL)
def batch_lag(spark, sf):
    d = lag.batch(i.read(spark, sf, "events"), "value", ["event_type"], 350.0)
    return d.withColumn("avg_lag", F.round("avg_lag", 9))


@query("a11_lag_summary", BATCH_SQL.replace("event_type, ", "").replace(" GROUP BY 1", ""))
def lag_summary(spark, sf):
    d = lag.batch(i.read(spark, sf, "events"), "value", threshold=350.0)
    return d.withColumn("avg_lag", F.round("avg_lag", 9))


@query(
    "l4_staleness",
    f"""SELECT user_id, last_event, round(s, 3) AS seconds_since, CASE WHEN s <= 86400 THEN 'passed' ELSE 'warning' END AS status FROM (
      SELECT user_id, max(ts) AS last_event, (epoch_us(TIMESTAMP '{NOW}') - epoch_us(max(ts))) / 1e6 AS s FROM events GROUP BY 1)""",
)
def staleness(spark, sf):
    d = lag.staleness(i.read(spark, sf, "events"), "ts", _now(), ["user_id"], minutes=1440)
    return d.withColumn("seconds_since", F.round("seconds_since", 3))


@query(
    "l5_lag_trend",
    """SELECT event_type, window_start, samples, round(slope, 6) AS slope_per_minute, round(a, 9) AS avg_lag, lo AS min_lag, hi AS max_lag,
      CASE WHEN slope > 1e-9 THEN 'increasing' WHEN slope < -1e-9 THEN 'decreasing' ELSE 'stable' END AS direction FROM (
      SELECT event_type, time_bucket(INTERVAL '6 hours', ts) AS window_start, count(*) AS samples, avg(value) AS a,
        min(value) AS lo, max(value) AS hi,
        CASE WHEN count(*) > 1 THEN regr_slope(value, (epoch_us(ts) - epoch_us(date_trunc('day', ts))) / 6e7) END AS slope FROM events GROUP BY 1, 2)""",
)
def lag_trend(spark, sf):
    d = lag.trend(i.read(spark, sf, "events"), "ts", "value", "6 hours", ["event_type"])
    return d.withColumns(
        {"slope_per_minute": F.round("slope_per_minute", 6), "avg_lag": F.round("avg_lag", 9), "window_start": i.wall("window_start")}
    )


@query(
    "l6_event_rate",
    """WITH c AS (SELECT event_type, time_bucket(INTERVAL '5 minutes', ts) AS w, count(*) AS n FROM events GROUP BY 1, 2),
      s AS (SELECT event_type, unnest(generate_series(min(w), greatest(max(w), TIMESTAMP '2024-01-31'), INTERVAL '5 minutes')) AS w FROM c GROUP BY 1)
    SELECT event_type, w AS window_start, coalesce(n, 0) AS events, coalesce(n, 0) / 300.0 AS events_per_second, CASE WHEN coalesce(n, 0) / 300.0 < 0.1
      THEN 'stalled' WHEN n / 300.0 < 10 THEN 'low' ELSE 'ok' END AS status FROM s LEFT JOIN c USING (event_type, w)""",
)
def event_rate(spark, sf):
    d = metrics.rate(i.read(spark, sf, "events"), "ts", ["event_type"], until=F.lit("2024-01-31 00:00:00"))
    return d.withColumn("window_start", i.wall("window_start"))


@query(
    "l7_sustained_lag",
    """SELECT source_name, min(run_at) AS started, max(run_at) AS ended, count(*) AS samples,
      (epoch_us(max(run_at)) - epoch_us(min(run_at))) / 1e6 AS lasted_seconds FROM (
      SELECT *, sum(CASE WHEN lag_seconds > 20 THEN 0 ELSE 1 END) OVER (PARTITION BY source_name ORDER BY run_at) AS island FROM runs)
    WHERE lag_seconds > 20 GROUP BY source_name, island HAVING epoch_us(max(run_at)) - epoch_us(min(run_at)) >= CAST(7200000000 AS BIGINT)""",
    ("runs",),
)
def sustained_lag(spark, sf):
    return metrics.sustained(
        i.runs(spark, sf), ["source_name"], "run_at", "lag_seconds > 20", 7200, F.date_trunc("day", F.col("run_at"))
    )


@query(
    "l8_counter_increase",
    """SELECT source_name, time_bucket(INTERVAL '12 hours', run_at) AS window_start, CAST(sum(CASE WHEN prev IS NULL THEN 0 WHEN processed >= prev
      THEN processed - prev ELSE processed END) AS BIGINT) AS increase FROM (
      SELECT *, lag(processed) OVER (PARTITION BY source_name ORDER BY run_at) AS prev FROM runs) GROUP BY 1, 2""",
    ("runs",),
)
def counter_increase(spark, sf):
    d = metrics.increase(
        i.runs(spark, sf), ["source_name"], "run_at", "processed", "12 hours", F.date_trunc("day", F.col("run_at"))
    )
    return d.withColumn("window_start", i.wall("window_start"))


@query(
    "l9_lag_between_tables",
    """SELECT *, CASE WHEN lag_seconds <= 86400 THEN 'passed' ELSE 'failed' END AS status FROM (
      SELECT event_type, s AS source_latest, d AS dest_latest, CASE WHEN s < d THEN 0.0::DOUBLE ELSE (epoch_us(s) - epoch_us(d)) / 1e6 END AS lag_seconds FROM (
      SELECT event_type, max(ts) AS s, max(ts) FILTER (WHERE ts < TIMESTAMP '2024-01-28' AND event_type <> 'signup') AS d FROM events GROUP BY 1))""",
)
def lag_between_tables(spark, sf):
    e = i.read(spark, sf, "events")
    # nothing of one type has arrived
    dest = e.filter((F.col("ts") < F.expr("timestamp_ntz'2024-01-28'")) & (F.col("event_type") != "signup"))
    return lag.between_tables(e, dest, "ts", "ts", ["event_type"], 86400.0)


@query(
    "l11_lag_by_count",
    """SELECT count(*) AS source_rows, count(*) FILTER (WHERE ts < TIMESTAMP '2024-01-28') AS captured_rows,
      CASE WHEN count(*) > count(*) FILTER (WHERE ts < TIMESTAMP '2024-01-28') + 100 THEN 'warning' ELSE 'passed' END AS status FROM events""",
)
def lag_by_count(spark, sf):
    e = i.read(spark, sf, "events")
    return lag.by_count(e, e.filter(F.col("ts") < F.expr("timestamp_ntz'2024-01-28'")), 100)


@query(
    "a12_consumer_lag",
    """SELECT topic, part AS "partition", max(off) + 1 AS end_offset, coalesce(max(off) FILTER (WHERE ts < TIMESTAMP '2024-01-28') + 1, 0)
      AS position, max(off) + 1 - coalesce(max(off) FILTER (WHERE ts < TIMESTAMP '2024-01-28') + 1, 0) AS lag FROM offs GROUP BY 1, 2""",
    ("offs",),
)
def consumer_lag(spark, sf):
    return lag.offsets(i.messages_by_type(spark, sf), i.positions(spark, sf))


@query(
    "a13_throughput",
    """SELECT source_name, CAST(sum(processed) AS BIGINT) AS processed, CAST(sum(errors) AS BIGINT) AS errors,
      (epoch_us(max(run_at)) - epoch_us(min(run_at))) / 1e6 AS seconds, round(sum(processed) / ((epoch_us(max(run_at)) - epoch_us(min(run_at))) / 1e6), 9)
      AS rows_per_second, round(sum(errors) / greatest(sum(processed), 1), 9) AS error_rate FROM runs GROUP BY 1""",
    ("runs",),
)
def throughput(spark, sf):
    d = metrics.throughput(i.runs(spark, sf), ["source_name"], "processed", "errors", "run_at", "run_at")
    return d.withColumns({"rows_per_second": F.round("rows_per_second", 9), "error_rate": F.round("error_rate", 9)})


@query(
    "a15_event_counters",
    "SELECT event_type, tbl, op, count(*) AS total FROM chg GROUP BY 1, 2, 3",
    ("chg",),
)
def event_counters(spark, sf):
    return metrics.event_counts(i.changes(spark, sf), ["event_type", "tbl", "op"])


@query(
    "a15_gauges",
    "SELECT event_type, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY 1",
)
def gauges(spark, sf):
    return metrics.gauges(i.read(spark, sf, "events"), ["event_type"], "value", i.ORDER)


@query(
    "a16_histogram",
    """SELECT event_type, le, total, count(*) FILTER (WHERE le IS NULL OR value <= le) AS "count", round(sum(value), 2) AS value_sum FROM (
      SELECT event_type, value, count(*) OVER (PARTITION BY event_type) AS total FROM events),
      (VALUES (0.1::DOUBLE), (0.5), (1.0), (5.0), (10.0), (30.0), (60.0), (120.0), (300.0), (NULL)) b(le) GROUP BY 1, 2, 3""",
)
def histogram(spark, sf):
    d = metrics.histogram(i.read(spark, sf, "events"), "value", metrics.LONG_DURATION_BUCKETS, ["event_type"])
    return d.withColumn("value_sum", F.round("value_sum", 2))


@query(
    "a19_health",
    """SELECT op, CASE WHEN bool_and(s = 'healthy') THEN 'healthy' WHEN bool_or(s = 'unhealthy') THEN 'unhealthy' ELSE 'degraded' END AS health,
      count(*) AS components FROM (
      SELECT op, user_id, arg_max(CASE WHEN value > 200 THEN 'unhealthy' WHEN value > 80 THEN 'degraded' ELSE 'healthy' END, (ts, event_id)) AS s
      FROM chg GROUP BY 1, 2) GROUP BY 1""",
    ("chg",),
)
def health(spark, sf):
    v = F.col("value")
    d = i.changes(spark, sf).withColumn(
        "status", F.when(v > 200, "unhealthy").when(v > 80, "degraded").otherwise("healthy")
    )
    return metrics.health(d, ["op"], "user_id", "status", i.ORDER)
