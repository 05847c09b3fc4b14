"""Queries: streaming jobs over the event files, run to the end of the available data."""

from __future__ import annotations

import math
import time

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions import lineage, ordered
from tidemark.operators import envelope, quality, transform
from tidemark.plans import inputs as i
from tidemark.plans.catalog import query
from tidemark.plans.q_tables import CURRENT_SQL
from tidemark.sources import readers
from tidemark.sinks.seen_ids import SeenIds
from tidemark.streaming import keyed, streams

FLAT_ROW = ["user_id", "event_type", "value", "props"]


def _stream(spark, sf, name="events"):
    schema = i.read(spark, sf, name).schema
    return readers.change_stream(spark, "parquet", f"{sf}/{name}.parquet*", schema)


def _messages(spark, sf):
    """Stream of flat JSON messages."""
    c = i.changes_of(_stream(spark, sf))
    return c.select(
        i.flat_text().cast("binary").alias("value"), F.lit("shop.users").alias("topic"), F.col("event_id").alias("offset")
    )


def _done(q):
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


@query(
    "s1_change_stream",
    "SELECT * FROM events",
)
def change_stream(spark, sf):
    out, check = lineage.scratch(spark), lineage.scratch(spark)
    _done(streams.append_to(_stream(spark, sf), out, check, every=None))
    return spark.read.parquet(out)


@query(
    "m1_append_job",
    """SELECT user_id, value, op AS __op, event_id AS __lsn FROM chg WHERE op <> 'd'""",
    ("chg",),
)
def append_job(spark, sf):
    """Source -> parse -> drop deletes -> project -> append, checkpointed."""
    out, check = lineage.scratch(spark), lineage.scratch(spark)
    steps = [
        lambda d: envelope.parse_flat(d, i.ROW),
        transform.drop_deletes,
        lambda d: d.select("user_id", "value", "__op", "__lsn"),
    ]
    _done(streams.run_append(_messages(spark, sf), steps, out, check))
    return spark.read.parquet(out)


@query(
    "p14_streaming_projection",
    """SELECT c_custkey AS customer_id, substr(c_name, 1, 8) AS full_name, c_mktsegment AS customer_tier, c_acctbal AS lifetime_value,
      'INSERT' AS _cdc_operation, 'customers_to_lake' AS _pipeline_id FROM customer""",
)
def streaming_projection(spark, sf):
    out, check = lineage.scratch(spark), lineage.scratch(spark)
    c = _stream(spark, sf, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.expr("substring(c_name, 1, 8)").alias("first_name"),
        F.col("c_mktsegment").alias("customer_tier"), F.col("c_acctbal").alias("lifetime_value"),
    )
    d = transform.add_metadata(transform.customer_analytics(c), "customers_to_lake", 0)
    _done(streams.append_to(d, out, check, every=None))
    return spark.read.parquet(out).select(
        "customer_id", "full_name", "customer_tier", "lifetime_value", "_cdc_operation", "_pipeline_id"
    )


@query(
    "k6_streaming_append_by_partition",
    "SELECT * FROM events",
)
def streaming_append_by_partition(spark, sf):
    out, check = lineage.scratch(spark), lineage.scratch(spark)
    e = _stream(spark, sf)
    _done(streams.append_to(e, out, check, every=None, partition_by=["event_type"]))
    return spark.read.parquet(out).select(*e.columns)


@query("m2_streaming_upsert", CURRENT_SQL, ("chg",))
def streaming_upsert(spark, sf):
    root, check = lineage.scratch(spark), lineage.scratch(spark)
    columns = ["user_id", *i.FEED_ROW]
    _done(streams.upsert_to(i.changes_of(_stream(spark, sf)), root, check, i.KEYS, i.ORDER, columns))
    streams.fold(spark, root, i.KEYS, i.ORDER)
    return streams.read_upserted(spark, root, i.KEYS, i.ORDER, columns)


@query(
    "s18_fan_out",
    "SELECT CASE WHEN tbl = 'users' THEN tbl ELSE '__rest' END AS table_name, tbl AS source_table, event_id FROM chg",
    ("chg",),
)
def fan_out(spark, sf):
    out, check = lineage.scratch(spark), lineage.scratch(spark)
    c = i.changes_of(_stream(spark, sf)).select("event_id", "tbl")
    _done(streams.fan_out(c, "tbl", ["users"], out, check))
    return spark.read.parquet(out).select("table_name", "source_table", "event_id")


@query("m4_streaming_dedupe", "SELECT event_id, user_id FROM events")
def streaming_dedupe(spark, sf):
    """Every event is delivered twice and kept once."""
    out, check = lineage.scratch(spark), lineage.scratch(spark)
    e = _stream(spark, sf).select("event_id", "user_id", i.utc("ts").alias("at"))
    twice = e.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    once = streams.dedupe(twice, ["event_id"], "at", "1 hour").select("event_id", "user_id")
    _done(streams.append_to(once, out, check, every=None))
    return spark.read.parquet(out)


@query("m4_dedupe_beyond_watermark", "SELECT event_id, user_id FROM events")
def dedupe_beyond_watermark(spark, sf):
    """All events are delivered again after the first delivery has ended, in other micro-batches, and dropped."""
    src, out, check, ids = (lineage.scratch(spark) for _ in range(4))
    events = i.read(spark, sf, "events").select("event_id", "user_id")
    store = SeenIds(spark, ids, "event_id")
    for _ in range(2):
        events.write.mode("append").parquet(src)
        feed = readers.change_stream(spark, "parquet", src, events.schema)
        _done(streams.dedupe_for_good(feed, store, out, check))
    return spark.read.parquet(out).select("event_id", "user_id")


COUNTS_SQL = """SELECT time_bucket(INTERVAL '1 day', ts) AS window_start, time_bucket(INTERVAL '1 day', ts) + INTERVAL '1 day' AS window_end,
  op, count(*) AS events FROM chg GROUP BY 1, 2, 3"""


@query(
    "m3_windows_after_watermark",
    f"""SELECT * FROM ({COUNTS_SQL}) WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL '1 hour'""",
    ("chg",),
)
def windows_after_watermark(spark, sf):
    """Only windows that the watermark has closed are written."""
    out, check = lineage.scratch(spark), lineage.scratch(spark)
    c = i.changes_of(_stream(spark, sf)).select("op", i.utc("ts").alias("at"))
    _done(streams.append_to(streams.counts(c, "at", ["op"], "1 day", delay="1 hour"), out, check, every=None))
    return _walls(spark.read.parquet(out))


def _walls(d):
    return d.withColumns({"window_start": i.wall("window_start"), "window_end": i.wall("window_end")})


@query("m5_window_counts", COUNTS_SQL, ("chg",))
def window_counts(spark, sf):
    c = i.changes(spark, sf)
    return _walls(streams.counts(c, "ts", ["op"], "1 day"))


@query(
    "m5_sliding_counts",
    """SELECT w AS window_start, w + INTERVAL '2 hours' AS window_end, event_type, count(*) AS events FROM (
      SELECT event_type, unnest([time_bucket(INTERVAL '1 hour', ts), time_bucket(INTERVAL '1 hour', ts) - INTERVAL '1 hour']) AS w
      FROM events) GROUP BY 1, 2, 3""",
)
def sliding_counts(spark, sf):
    e = i.read(spark, sf, "events")
    return _walls(streams.counts(e, "ts", ["event_type"], "2 hours", "1 hour"))


SESSIONS_SQL = """SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL '6 hours' AS session_end, count(*) AS events FROM (
      SELECT *, sum(CASE WHEN ts < prev + INTERVAL '6 hours' THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM (
        SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events)) GROUP BY user_id, s"""


@query("m6_sessions", SESSIONS_SQL)
def sessions(spark, sf):
    return _sessions(spark, sf, ordered.HOT_ROWS)


@query("m6_sessions_cut", SESSIONS_SQL)
def sessions_cut(spark, sf):
    """Every group's events are cut by the hour, as those of a hot group are."""
    return _sessions(spark, sf, 0)


def _sessions(spark, sf, hot_rows):
    hour = F.date_trunc("hour", F.col("ts"))
    d = streams.sessions(i.read(spark, sf, "events"), "ts", ["user_id"], "6 hours", bucket=hour, hot_rows=hot_rows)
    return d.withColumns({"session_start": i.wall("session_start"), "session_end": i.wall("session_end")})


@query("m7_restart_from_checkpoint", "SELECT event_id, user_id FROM events")
def restart_from_checkpoint(spark, sf):
    """Two runs on one checkpoint: the second one finds nothing new, nothing is lost or doubled."""
    out, check = lineage.scratch(spark), lineage.scratch(spark)
    for _ in range(2):
        _done(streams.append_to(_stream(spark, sf).select("event_id", "user_id"), out, check, every=None))
    return spark.read.parquet(out)


def _in_files(spark, sf, files):
    """The events as a folder of several files, and a stream over it that takes one file at a time."""
    e, src = i.read(spark, sf, "events"), lineage.scratch(spark)
    e.repartition(files, "event_id").write.parquet(src)
    return readers.change_stream(spark, "parquet", src, e.schema, limit=1)


@query("m9_progress_metrics", "SELECT count(*) AS input_rows, CAST(12 AS BIGINT) AS batches FROM events")
def progress_metrics(spark, sf):
    """Rows of all micro-batches of a run, as its listener saw them."""
    out, check = lineage.scratch(spark), lineage.scratch(spark)
    with streams.ProgressLog(spark, lineage.scratch(spark), every=5) as log:
        _done(streams.append_to(_in_files(spark, sf, 12), out, check, every=None))
    seen = log.rows().filter("input_rows > 0")
    return seen.agg(F.sum("input_rows").alias("input_rows"), F.count_distinct("batch_id").alias("batches"))


@query("m10_bounded_run", "SELECT event_id, ts FROM events")
def bounded_run(spark, sf):
    out, check = lineage.scratch(spark), lineage.scratch(spark)
    _done(streams.feed_to(_stream(spark, sf).select("event_id", "ts"), out, check))
    return spark.read.parquet(out).select("event_id", "ts")


@query("k7_micro_batches", "SELECT event_id, user_id, event_type, CAST(6 AS BIGINT) AS batches FROM events")
def micro_batches(spark, sf):
    """One file a batch and a time between batches; the run ends when all files are through."""
    out, check = lineage.scratch(spark), lineage.scratch(spark)
    q = streams.feed_to(_in_files(spark, sf, 6).select("event_id", "user_id", "event_type"), out, check, every="1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    rows = spark.read.parquet(out)
    return rows.select("event_id", "user_id", "event_type", rows.select(F.count_distinct("batch_id").alias("n")).scalar().alias("batches"))


@query(
    "p9_counted_in_the_write",
    """SELECT event_id, value, (SELECT count(*) FROM events) AS seen, (SELECT count(*) FROM events WHERE NOT coalesce(value >= 5, false)) AS skipped
    FROM events WHERE value >= 5""",
)
def counted_in_the_write(spark, sf):
    """Events below a value are skipped; seen and skipped rows are counted by the pass that writes the others."""
    out, check = lineage.scratch(spark), lineage.scratch(spark)
    bad = ~F.coalesce(F.col("value") >= 5, F.lit(False))
    with streams.ProgressLog(spark, lineage.scratch(spark)) as log:
        e = streams.counted(_in_files(spark, sf, 4).select("event_id", "value"), "events", skipped=bad)
        _done(streams.append_to(e.filter(~bad), out, check, every=None))
    counts = log.counts("events", "rows", "skipped")
    rows = spark.read.parquet(out)
    return rows.select("*", counts.select("rows").scalar().alias("seen"), counts.select("skipped").scalar().alias("skipped"))


@query(
    "k7_size_or_time",
    """SELECT lane, batch, CASE WHEN (batch + 1) * 700 <= n THEN 'size' ELSE 'time' END AS closed_by, least(700, n - batch * 700) AS events, lane_ids
    FROM (SELECT event_type AS lane, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS lane_ids, unnest(range(0, (count(*) + 699) // 700)) AS batch
      FROM events GROUP BY 1)""",
)
def size_or_time(spark, sf):
    """Batches of 700 events per type; what is left over is handed on when its time has come. The sum of the ids shows that
    each event is in one batch."""
    out, check = lineage.scratch(spark), lineage.scratch(spark)
    e = _stream(spark, sf).select("event_id", "event_type")
    _until(streams.feed_to(keyed.batches(e, "event_type", 700, 1000), out, check, every="1 second", batch_column="written"), out, i.read(spark, sf, "events"))
    rows = spark.read.parquet(out)
    per = rows.groupBy(F.col("batch_lane").alias("lane"), "batch", "closed_by").agg(F.count("*").alias("events"), F.sum("event_id").alias("ids"))
    return per.select("lane", "batch", "closed_by", "events", F.sum("ids").over(Window.partitionBy("lane")).alias("lane_ids"))


def _until(query, out, events, seconds=120):
    """Let a stream with timers, which always has a next batch, run until it has handed on as many rows as there are events. A
    micro-batch takes the time it needs; the run fails once micro-batches have brought no row for so many seconds."""
    want, got, seen, end = events.count(), 0, None, math.inf
    try:
        while query.isActive:
            last = query.lastProgress
            if last is not None and last.timestamp != seen:  # a micro-batch has ended
                written = [path for _, path in lineage.numbered_folders(events.sparkSession, out, "written")]
                rows = events.sparkSession.read.schema("event_id bigint").parquet(out).count() if written else 0
                if rows >= want:
                    return
                end = math.inf if rows > got else min(end, time.monotonic() + seconds)
                if time.monotonic() >= end:
                    break
                got, seen = rows, last.timestamp
            time.sleep(0.5)
        raise query.exception() or TimeoutError("rows are still waiting")
    finally:
        query.stop()


PREVIOUS_SQL = """SELECT event_id, lag(event_type) OVER w AS old_type, lag(value) OVER w AS old_value
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)"""


@query("w2_streaming_before_image", PREVIOUS_SQL)
def streaming_before_image(spark, sf):
    """Previous event of each user across micro-batches: the events come by days, and the files of some days, written by as many
    tasks as read them, are one micro-batch of a stream that goes on from its checkpoint."""
    out, check, src = lineage.scratch(spark), lineage.scratch(spark), lineage.scratch(spark)
    e = i.read(spark, sf, "events").select("event_id", "user_id", "ts", "event_type", "value")
    for lo, hi in (("2023-01-01", "2024-01-11"), ("2024-01-11", "2024-01-21"), ("2024-01-21", "2030-01-01")):
        e.filter((F.col("ts") >= F.lit(lo).cast("timestamp_ntz")) & (F.col("ts") < F.lit(hi).cast("timestamp_ntz"))).write.mode("append").parquet(src)
        s = readers.change_stream(spark, "parquet", src, e.schema)
        d = keyed.previous_image(s, ["user_id"], ["ts", "event_id"], ["event_type", "value"])
        _done(streams.append_to(d.select("event_id", F.col("before.event_type").alias("old_type"), F.col("before.value").alias("old_value")), out, check, every=None))
    return spark.read.parquet(out)


@query("z2_callback_stops", "SELECT event_id, value, true AS stopped, false AS stopped_again FROM events")
def callback_stops(spark, sf):
    """A callback keeps the batches it sees and ends the run at the third one; the next run on the checkpoint goes on."""
    check, out = lineage.scratch(spark), lineage.scratch(spark)

    def keep(last):
        def one(batch, batch_id):
            batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
            return batch_id == last

        return one

    stream = _in_files(spark, sf, 6).select("event_id", "value")
    stopped = [streams.run_until(stream, keep(last), check) for last in (2, -1)]
    flags = [F.lit(s).alias(n) for n, s in zip(("stopped", "stopped_again"), stopped)]
    return spark.read.parquet(out).select("event_id", "value", *flags)


@query(
    "v13_streaming_validation",
    """SELECT r AS rule, count(*) AS checked, count(*) FILTER (WHERE CASE r WHEN 'value_below_300' THEN NOT value < 300
      ELSE user_id IS NULL END) AS failures FROM events, (VALUES ('value_below_300'), ('user_present')) t(r) GROUP BY 1""",
)
def streaming_validation(spark, sf):
    out, check = lineage.scratch(spark), lineage.scratch(spark)
    rules = [quality.Rule("value_below_300", "value < 300"), quality.Rule("user_present", "user_id is not null")]
    _done(streams.validate_to(_stream(spark, sf), lambda b: quality.check_rules(b, rules), out, check))
    d = spark.read.parquet(out).groupBy("rule")
    return d.agg(F.sum("checked").alias("checked"), F.sum("failures").alias("failures"))


@query(
    "z2_for_each_batch",
    """SELECT event_id, len(list_distinct(string_split(event_type, ''))) + length(CAST(event_id AS VARCHAR)) > 7 AS handled FROM events""",
)
def for_each_batch(spark, sf):
    """The user's function sees the events of the stream many at a time."""
    out, check = lineage.scratch(spark), lineage.scratch(spark)
    e = _stream(spark, sf).select("event_id", "event_type")
    letters = lambda pdf: pdf["event_type"].map(lambda t: len(set(t))) + pdf["event_id"].astype(str).str.len() > 7
    _done(streams.append_to(streams.handle_batches(e, letters, ["event_id"]), out, check, every=None))
    return spark.read.parquet(out)


@query("z2_for_each_event", "SELECT event_id, value > 20 AND event_type <> 'error' AS handled FROM events")
def for_each_event(spark, sf):
    """The user's function sees every event of the stream."""
    out, check = lineage.scratch(spark), lineage.scratch(spark)
    e = _stream(spark, sf).select("event_id", "event_type", "value")
    seen = streams.handle(e, lambda row: row["value"] > 20 and row["event_type"] != "error", ["event_id"])
    _done(streams.append_to(seen, out, check, every=None))
    return spark.read.parquet(out)


@query("k19_replayed_upsert", CURRENT_SQL, ("chg",))
def replayed_upsert(spark, sf):
    """The whole stream is applied again with a lost checkpoint; the table stays the same."""
    root = lineage.scratch(spark)
    columns = ["user_id", *i.FEED_ROW]
    for _ in range(2):
        c = i.changes_of(_stream(spark, sf))
        _done(streams.upsert_to(c, root, lineage.scratch(spark), i.KEYS, i.ORDER, columns))
    return streams.read_upserted(spark, root, i.KEYS, i.ORDER, columns)
