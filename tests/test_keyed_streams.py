"""Streams with state per key: batches by size or time, live alerts, previous images; bases cut by key buckets."""

import os
import time
import uuid

import pandas as pd
import pytest
from pyspark.sql import GroupedData
from pyspark.sql import functions as F
from test_streaming import changes, stream, table

from tidemark.operators import feed
from tidemark.plans import q_stream
from tidemark.sinks import writers
from tidemark.streaming import keyed, streams

ROW = "id long, lane string, at timestamp, x decimal(10,2), b boolean"


def put(spark, path, rows, schema=ROW):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def source(spark, path, schema=ROW):
    return spark.readStream.schema(spark.createDataFrame([], schema).schema).parquet(path)


def wait_for(query, done, seconds=60):
    end = time.monotonic() + seconds
    while not done():
        assert query.isActive and time.monotonic() < end, query.exception() or "too late"
        time.sleep(0.3)


def found(spark, path, schema):
    return spark.read.schema(schema).parquet(path).collect() if os.path.isdir(path) else []


def test_batches_close_by_size_or_time_and_survive_a_restart(spark, folder):
    src, out, check = folder("src"), folder("out"), folder("check")
    make = lambda lane, ids: [(k, lane, None, None, k % 2 == 0) for k in ids]
    put(spark, src, make("fast", range(25)) + make("slow", range(100, 103)))
    got = lambda: found(spark, out, ROW + ", batch bigint, closed_by string")

    def start(wait):
        return streams.feed_to(keyed.batches(source(spark, src), "lane", 10, wait), out, check, every="500 milliseconds", batch_column="written")

    q = start(3_600_000)
    wait_for(q, lambda: len(got()) == 20)
    assert sorted(r.id for r in got()) == sorted(r.id for r in got() if r.lane == "fast" and r.closed_by == "size") and len(got()) == 20
    q.stop()  # eight rows wait in the checkpoint
    put(spark, src, make("slow", range(103, 112)) + make("fast", [25]))  # a timer is set anew when a row comes
    q = start(1500)
    try:
        wait_for(q, lambda: len(got()) == 38)
    finally:
        q.stop()
    rows = got()
    assert sorted(r.id for r in rows) == [*range(26), *range(100, 112)] and all(r.b == (r.id % 2 == 0) and r.x is None for r in rows)
    by = {}
    for r in rows:
        by.setdefault((r.lane, r.batch, r.closed_by), []).append(r.id)
    assert {k: len(v) for k, v in by.items()} == {("fast", 0, "size"): 10, ("fast", 1, "size"): 10, ("fast", 2, "time"): 6, ("slow", 0, "size"): 10, ("slow", 1, "time"): 2}


@pytest.mark.parametrize("size, chars", [(1, 1 << 24), (7, 300), (15_000, 1 << 24)])
def test_batches_of_busy_lanes_come_as_packets(spark, folder, monkeypatch, size, chars):
    """Every row is in one batch whatever packets hold, and the one task of a lane is handed packets, not rows."""
    counts, calls = {None: 3, "": 14, "busy": 31_000, "a\nb": 5}, folder("calls")
    os.mkdir(calls)
    lanes = [lane for lane, n in counts.items() for _ in range(n)]
    rows = [(k, lane, None, None, True) for k, lane in enumerate(lanes)]
    spark.createDataFrame(rows, ROW).repartition(3).write.parquet(folder("src"))
    monkeypatch.setattr(keyed, "PACKET_CHARS", chars, raising=False)
    with_state = GroupedData.applyInPandasWithState

    def counting(self, run, *args):
        def spy(key, parts, state):
            parts = list(parts)
            with open(f"{calls}/{uuid.uuid4()}", "w") as f:
                f.write(str(sum(map(len, parts))))
            yield from run(key, iter(parts), state)

        return with_state(self, spy, *args)

    monkeypatch.setattr(GroupedData, "applyInPandasWithState", counting)
    q = streams.feed_to(keyed.batches(source(spark, folder("src")), "lane", size, 500), folder("out"), folder("check"), every="500 milliseconds", batch_column="written")
    got = lambda: found(spark, folder("out"), ROW + ", batch_lane string, batch bigint, closed_by string")
    try:
        wait_for(q, lambda: len(got()) >= len(rows))
    finally:
        q.stop()
    assert sorted((r.id, r.lane, r.batch_lane) for r in got()) == [(k, lane, lane) for k, lane in enumerate(lanes)]
    want = {(lane, b): (min(size, n - b * size), "size" if (b + 1) * size <= n else "time") for lane, n in counts.items() for b in range(-(-n // size))}
    by = {}
    for r in got():
        by.setdefault((r.lane, r.batch), []).append(r.closed_by)
    assert {k: (len(v), *set(v)) for k, v in by.items()} == want
    most = max(int(open(f"{calls}/{f}").read()) for f in os.listdir(calls))
    assert most <= (12 if chars > 300 else 7000)


def test_rows_that_wait_are_handed_on_before_newer_packets(spark, folder):
    src, check = folder("src"), folder("check")
    put(spark, src, [(k, "x", None, None, True) for k in range(4)])
    q = streams.feed_to(keyed.batches(source(spark, src), "lane", 10, 3_600_000), folder("out"), check, every="500 milliseconds", batch_column="written")
    got = lambda: found(spark, folder("out"), ROW + ", batch bigint, closed_by string")
    try:
        wait_for(q, lambda: os.path.exists(f"{check}/commits/0"))
        put(spark, src, [(k, "x", None, None, True) for k in range(4, 64)])
        wait_for(q, lambda: len(got()) == 60)
    finally:
        q.stop()
    assert sorted(r.batch for r in got()) == [b for b in range(6) for _ in range(10)]
    assert {0, 1, 2, 3} <= {r.id for r in got() if r.batch == 0}


def test_a_micro_batch_takes_the_time_it_needs(spark, folder):
    """The wait for rows ends when micro-batches bring none, not after a time for the whole work."""
    schema = "event_id long, event_type string"
    rows = spark.range(40, numPartitions=1).selectExpr("id AS event_id", "'a' AS event_type")
    rows.write.parquet(folder("src"))

    def slow(parts):
        for part in parts:
            time.sleep(3)
            yield part

    def run(name, events):
        q = streams.feed_to(keyed.batches(events, "event_type", 10, 500), folder(name), folder(f"check_{name}"), every="500 milliseconds", batch_column="written")
        q_stream._until(q, folder(name), rows, seconds=1)
        assert not q.isActive

    run("whole", source(spark, folder("src"), schema).mapInPandas(slow, schema))
    assert spark.read.parquet(folder("whole")).count() == 40
    with pytest.raises(TimeoutError):
        run("part", source(spark, folder("src"), schema).filter("event_id < 30"))


def test_alerts_come_by_the_clock_and_clear_with_the_next_event(spark, folder):
    schema = "key string, v double, at timestamp"
    src, out = folder("src"), folder("out")
    when = lambda n: spark.sql(f"select timestamp_seconds(1704067200 + {n})").first()[0]
    put(spark, src, [("a", 50.0, when(0)), ("b", 1.0, when(0)), ("c", None, when(0))], schema)
    quiet = keyed.silence(source(spark, src, schema), "key", 2000)
    high = keyed.sustained(source(spark, src, schema), "key", "v", "at", 10.0, 2000)
    queries = [streams.feed_to(d, f"{out}/{n}", folder(f"check{n}"), every="500 milliseconds") for n, d in (("quiet", quiet), ("high", high))]
    got = lambda n: sorted((r.key, r.status) for r in found(spark, f"{out}/{n}", "key string, status string, at timestamp, value double"))
    silent = [(k, "FIRING") for k in "abc"]
    try:
        # nothing arrives any more
        wait_for(queries[0], lambda: got("quiet") == silent)
        wait_for(queries[1], lambda: got("high") == [("a", "FIRING")])
        put(spark, src, [("a", 60.0, when(-5)), ("a", 10.0, when(9))], schema)
        wait_for(queries[1], lambda: got("high") == [("a", "FIRING"), ("a", "RESOLVED")])
        wait_for(queries[0], lambda: ("a", "RESOLVED") in got("quiet"))
    finally:
        for q in queries:
            q.stop()
    assert [x for x in got("quiet") if x[0] != "a"] == silent[1:]


@pytest.mark.parametrize("cuts", [[0, 60], [0, 7, 31, 60]])
def test_previous_images_equal_the_batch_answer_over_a_restart(spark, folder, cuts):
    src, out, check = folder("src"), folder("out"), folder("check")
    for lo, hi in zip(cuts, cuts[1:]):
        changes(spark, lo, hi).coalesce(1).write.mode("append").parquet(src)
        d = keyed.previous_image(stream(spark, src), ["id"], ["n"], ["v", "at"])
        streams.append_to(d, out, check, every=None).awaitTermination()
    got = {r.n: (r.before and (r.before.v, r.before["at"]), r.id, r.v, r.op) for r in spark.read.parquet(out).collect()}
    last, want = {}, {}
    for r in changes(spark, 0, 60).orderBy("n").collect():
        want[r.n] = (last.get(r.id), r.id, r.v, r.op)
        last[r.id] = (r.v, r["at"])
    assert got == want


@pytest.mark.parametrize("kind", ["numbers", "texts"])
def test_rows_of_a_key_in_order(kind):
    n, t = [3, 1, None, 1, 3, None, 2], pd.to_datetime(["2024-01-02", "2024-01-03", "2024-01-01", None, "2024-01-02", "2024-01-01", None])
    rows = pd.DataFrame({"o0": n if kind == "numbers" else [None if x is None else str(x) for x in n], "o1": t}, index=range(10, 17))
    want = rows.reset_index(drop=True).sort_values(["o0", "o1"], kind="stable").index.tolist()
    assert keyed._ordered(rows, ["o0", "o1"]).tolist() == want == [1, 3, 6, 0, 4, 2, 5]


def test_previous_images_of_many_files(spark, folder, monkeypatch):
    """Days are written by as many tasks as read them, and are a micro-batch each."""
    rows = spark.range(400, numPartitions=4).selectExpr("id AS event_id", "id % 7 AS user_id", "timestamp_ntz '2024-01-01' + make_dt_interval(0, id * 37 % 719) AS ts", "concat('t', id % 5) AS event_type", "id / 4 AS value")
    rows.write.parquet(f"{folder('sf')}/events.parquet")
    made, scratch = [], q_stream.lineage.scratch
    monkeypatch.setattr(q_stream.lineage, "scratch", lambda s: made.append(scratch(s)) or made[-1])
    got = {r.event_id: (r.old_type, r.old_value) for r in q_stream.streaming_before_image(spark, folder("sf")).collect()}
    last, want = {}, {}
    for r in rows.orderBy("ts", "event_id").collect():
        want[r.event_id] = last.get(r.user_id, (None, None))
        last[r.user_id] = (r.event_type, r.value)
    assert got == want
    _, check, src = made[:3]
    assert sorted(f for f in os.listdir(f"{check}/commits") if f.isdigit()) == ["0", "1", "2"]
    assert len([f for f in os.listdir(src) if f.endswith(".parquet")]) > 6


def test_fold_rewrites_touched_buckets_only(spark, folder, monkeypatch):
    src, root, check = folder("src"), folder("root"), folder("check")
    args = dict(keys=["id"], order_by=["n"])

    def more(df):
        df.coalesce(1).write.mode("append").parquet(src)
        streams.upsert_to(stream(spark, src), root, check, columns=["id", "v"], **args).awaitTermination()

    def files():
        return {os.path.join(d, f) for d, _, names in os.walk(f"{root}/buckets") for f in names if f.endswith(".parquet")}

    read = lambda: table(streams.read_upserted(spark, root, columns=["id", "v"], **args))
    everything = changes(spark, 0, 200)
    more(everything)
    assert streams.fold(spark, root, buckets=8, **args) == 0
    first = files()
    touched = {f.split("key_bucket=")[1].split("/")[0] for f in first}
    assert len(touched) > 4
    one = spark.createDataFrame([(3, "new", "u", 1000)], "id long, v string, op string, n long").withColumn("at", F.lit("2024-02-01").cast("timestamp"))
    more(one)
    want = table(feed.current_of_changes(everything.unionByName(one), ["id"], ["n"]).select("id", "v"))
    with monkeypatch.context() as m:  # the run ends after the bucket was written and before the list was
        m.setattr(writers, "write_version", lambda *_: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            streams.fold(spark, root, **args)
    assert read() == want and first <= files()
    assert streams.fold(spark, root, **args) == 1
    assert read() == want and first <= files()  # readers of the base before still find theirs
    new = files() - first
    assert len({f.split("key_bucket=")[1].split("/")[0] for f in new}) == 1 and all("fold_id=1/" in f for f in new)
    more(one.withColumns({"v": F.lit("newer"), "n": F.lit(1001).cast("long")}))
    streams.fold(spark, root, **args)
    assert read() == want | {3: "newer"}
    assert len(first - files()) == 1 and new <= files()  # the first file of the touched bucket is gone, all others are as they were
    streams.fold(spark, root, forget=F.lit(True), whole=True, **args)
    assert read() == want | {3: "newer"}


def test_counts_come_with_the_write(spark, folder):
    src, out, check = folder("src"), folder("out"), folder("check")
    for lo, hi in [(0, 50), (50, 120)]:
        changes(spark, lo, hi).coalesce(1).write.mode("append").parquet(src)
    good = F.col("op") != "d"
    with streams.ProgressLog(spark, folder("log")) as log:
        d = streams.counted(stream(spark, src), "seen", bad=~good, of_zero=F.col("id") == 0).filter(good)
        q = streams.append_to(d, out, check, every=None)
        q.awaitTermination()
    plan = q._jsq.streamingQuery().lastExecution().executedPlan().toString()
    assert plan.count("FileScan") + plan.count("MicroBatchScan") == 1
    rows = changes(spark, 0, 120)
    want = (120, rows.filter(~good).count(), rows.filter("id = 0").count())
    assert tuple(log.counts("seen", "rows", "bad", "of_zero").first()) == want
    assert spark.read.parquet(out).count() == 120 - want[1]


def test_progress_rows_wait_until_they_are_written(spark, folder, monkeypatch):
    log = streams.ProgressLog(spark, folder("log"))
    log.waiting = [("r", 1, "t", 5, 1.0, "{}")]
    with monkeypatch.context() as m:
        m.setattr(spark, "createDataFrame", lambda *_: (_ for _ in ()).throw(OSError("gone")), raising=False)
        with pytest.raises(OSError):
            log.flush()
    assert len(log.waiting) == 1
    assert log.rows().count() == 1 and log.waiting == []
