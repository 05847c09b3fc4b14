"""Streams over files: equal to the batch result, restartable, replayable, exact under late data."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import apply as ap
from tidemark.operators import feed, quality
from tidemark.sources import readers
from tidemark.streaming import streams

SCHEMA = "id long, v string, op string, n long, at timestamp"


def changes(spark, lo, hi, seed=3):
    rnd = random.Random(seed)
    rows = [(0 if rnd.random() < 0.3 else rnd.randrange(20), f"v{n}", rnd.choice("cuurd"), n) for n in range(hi)][lo:]
    d = spark.createDataFrame(rows, "id long, v string, op string, n long")
    return d.withColumn("at", F.timestamp_seconds(F.lit(1704067200) + F.col("n") * 60))


def stream(spark, path, files=1):
    return readers.change_stream(spark, "parquet", path, spark.createDataFrame([], SCHEMA).schema, limit=files)


def table(d):
    return {r.id: r.v for r in d.collect()}


def test_upsert_equals_batch_and_survives_restart(spark, folder):
    src, root, check = folder("src"), folder("root"), folder("check")
    args = dict(keys=["id"], order_by=["n"])
    for lo, hi in [(0, 100), (100, 200), (200, 300)]:
        changes(spark, lo, hi).coalesce(1).write.mode("append").parquet(src)
        streams.upsert_to(stream(spark, src), root, check, columns=["id", "v"], **args).awaitTermination()
    want = table(feed.current_of_changes(changes(spark, 0, 300), ["id"], ["n"]).select("id", "v"))
    got = streams.read_upserted(spark, root, columns=["id", "v"], **args)
    assert table(got) == want
    assert streams.fold(spark, root, **args) == 2
    assert table(streams.read_upserted(spark, root, columns=["id", "v"], **args)) == want
    # late changes lose, new ones win, also against the folded base
    late = changes(spark, 0, 300).filter("n < 150").unionByName(changes(spark, 300, 330))
    late.coalesce(1).write.mode("append").parquet(src)
    streams.upsert_to(stream(spark, src), root, check, columns=["id", "v"], **args).awaitTermination()
    want = table(feed.current_of_changes(changes(spark, 0, 330), ["id"], ["n"]).select("id", "v"))
    assert table(streams.read_upserted(spark, root, columns=["id", "v"], **args)) == want
    streams.fold(spark, root, **args)
    assert table(streams.read_upserted(spark, root, columns=["id", "v"], **args)) == want


def test_folds_between_batches_remove_what_they_cover(spark, folder, monkeypatch):
    src, root, check = folder("src"), folder("root"), folder("check")
    args = dict(keys=["id"], order_by=["n"])

    def numbers(part, name):
        return sorted(n for n, _ in streams.lineage.numbered_folders(spark, f"{root}/{part}", name))

    for k in range(4):
        changes(spark, 50 * k, 50 * k + 50).coalesce(1).write.mode("append").parquet(src)
        streams.upsert_to(stream(spark, src), root, check, columns=["id", "v"], **args).awaitTermination()
        if k == 2:  # the run ends after the base was listed and before anything is removed
            with monkeypatch.context() as m:
                m.setattr(streams.lineage, "remove", lambda *_: (_ for _ in ()).throw(OSError("gone")))
                with pytest.raises(OSError):
                    streams.fold(spark, root, **args)
        else:
            assert streams.fold(spark, root, **args) == k
        want = table(feed.current_of_changes(changes(spark, 0, 50 * k + 50), ["id"], ["n"]).select("id", "v"))
        assert table(streams.read_upserted(spark, root, columns=["id", "v"], **args)) == want
    assert numbers("delta", "batch_id") == [3] and numbers("base", "version") == [2, 3]
    streams.fold(spark, root, forget=F.col("n") < 1000, **args)
    assert table(streams.read_upserted(spark, root, columns=["id", "v"], **args)) == want


def test_append_restart_without_loss_or_doubles(spark, folder):
    src, out, check = folder("src"), folder("out"), folder("check")
    for lo, hi in [(0, 50), (50, 120)]:
        changes(spark, lo, hi).coalesce(1).write.mode("append").parquet(src)
        streams.append_to(stream(spark, src), out, check, every=None).awaitTermination()
        streams.append_to(stream(spark, src), out, check, every=None).awaitTermination()
    got = [r.n for r in spark.read.parquet(out).collect()]
    assert sorted(got) == list(range(120))


def test_batches_are_bounded(spark, folder):
    src, out = folder("src"), folder("out")
    changes(spark, 0, 80).repartition(4).write.parquet(src)
    with streams.ProgressLog(spark, folder("log")) as log:
        streams.append_to(stream(spark, src, files=1), out, folder("check"), every=None).awaitTermination()
    p = log.rows()
    assert p.filter("input_rows > 0").count() == 4 and p.agg(F.sum("input_rows")).first()[0] == 80


def test_progress_of_more_batches_than_spark_keeps(spark, folder):
    src = folder("src")
    changes(spark, 0, 210).repartition(105, "n").write.parquet(src)
    n = spark.read.parquet(src).select(F.input_file_name()).distinct().count()
    with streams.ProgressLog(spark, folder("log"), every=40) as log:
        q = streams.append_to(stream(spark, src, files=1), folder("out"), folder("check"), every=None)
        q.awaitTermination()
    p = log.rows()
    assert p.agg(F.sum("input_rows")).first()[0] == 210 and p.select("batch_id").distinct().count() >= n
    assert len(q.recentProgress) <= 100


def test_callback_stops_and_the_next_run_goes_on(spark, folder):
    src, check, seen = folder("src"), folder("check"), {}
    changes(spark, 0, 60).repartition(6, "n").write.parquet(src)

    def third(batch, batch_id):
        seen[batch_id] = [r.n for r in batch.collect()]
        return batch_id == 2

    assert streams.run_until(stream(spark, src, files=1), third, check)
    assert max(seen) == 2 and sum(map(len, seen.values())) < 60
    assert not streams.run_until(stream(spark, src, files=1), lambda b, k: bool(seen.update({k: [r.n for r in b.collect()]})), check)
    assert sorted(n for b in seen.values() for n in b) == list(range(60))
    with pytest.raises(Exception, match="own fault"):
        streams.run_until(stream(spark, src), lambda b, k: (_ for _ in ()).throw(ValueError("own fault")), folder("check2"))


def test_late_rows_are_dropped(spark, folder):
    src, out = folder("src"), folder("out")
    check = folder("check")
    on_time = changes(spark, 0, 300)
    on_time.coalesce(1).write.parquet(src)
    run = lambda: streams.append_to(
        streams.counts(stream(spark, src), "at", ["op"], "1 hour", delay="10 minutes"), out, check, every=None
    ).awaitTermination()
    run()
    changes(spark, 0, 30).coalesce(1).write.mode("append").parquet(src)
    run()
    got = spark.read.parquet(out)
    assert got.agg(F.sum("events")).first()[0] == 240  # four closed hours, nothing counted twice
    batch = streams.counts(on_time, "at", ["op"], "1 hour").filter(F.col("window_end") <= F.timestamp_seconds(F.lit(1704067200 + 4 * 3600)))
    assert got.exceptAll(batch).isEmpty() and batch.exceptAll(got).isEmpty()


def test_streaming_dedupe(spark, folder):
    src, out = folder("src"), folder("out")
    d = changes(spark, 0, 100)
    d.unionByName(d).coalesce(1).write.parquet(src)
    streams.append_to(streams.dedupe(stream(spark, src), ["n"], "at", "1 hour"), out, folder("check"), every=None).awaitTermination()
    assert spark.read.parquet(out).count() == 100


def test_fan_out(spark, folder):
    src, out = folder("src"), folder("out")
    changes(spark, 0, 100).coalesce(1).write.parquet(src)
    streams.fan_out(stream(spark, src), "op", ["c", "u"], out, folder("check")).awaitTermination()
    got = {(r.table_name, r.source_table): r["count"] for r in spark.read.parquet(out).groupBy("table_name", "source_table").count().collect()}
    want = {(r.op if r.op in "cu" else "__rest", r.op): r["count"] for r in changes(spark, 0, 100).groupBy("op").count().collect()}
    assert got == want


def test_validation_per_batch(spark, folder):
    src, out = folder("src"), folder("out")
    changes(spark, 0, 90).repartition(3).write.parquet(src)
    checks = lambda b: quality.check_rules(b, [quality.Rule("op_known", "op in ('c', 'u')")])
    streams.validate_to(stream(spark, src), checks, out, folder("check")).awaitTermination()
    r = spark.read.parquet(out).agg(F.sum("checked").alias("n"), F.sum("failures").alias("bad"), F.countDistinct("checked_batch").alias("b")).first()
    assert (r.n, r.b) == (90, 3) and r.bad == changes(spark, 0, 90).filter("op in ('d', 'r')").count()


def test_sessions_stream_closes_what_batch_closes(spark, folder):
    src, out = folder("src"), folder("out")
    d = changes(spark, 0, 300).filter("n % 40 < 20")
    d.coalesce(1).write.parquet(src)
    one = lambda x: x.withColumn("g", F.lit("all"))
    found = streams.sessions(one(stream(spark, src)), "at", ["g"], "5 minutes", "1 minute")
    streams.append_to(found, out, folder("check"), every=None).awaitTermination()
    got, batch = spark.read.parquet(out), streams.sessions(one(d), "at", ["g"], "5 minutes")
    assert batch.count() == 8 and got.exceptAll(batch).isEmpty() and got.count() == 7


def test_handle_and_for_each(spark, folder):
    d = changes(spark, 0, 50)
    got = streams.handle(d, lambda row: row["op"] == "d", ["n"])
    assert got.filter("handled").count() == d.filter("op = 'd'").count() and got.count() == 50
    src, seen = folder("src"), folder("seen")
    d.coalesce(1).write.parquet(src)

    def note(row):
        with open(f"{seen}-{row['n']}", "w") as f:
            f.write(row["op"])

    streams.for_each(stream(spark, src), note, folder("check")).awaitTermination()
    import glob

    assert len(glob.glob(seen + "-*")) == 50


def test_feed_to_overwrites_a_repeated_batch(spark, folder):
    src, out = folder("src"), folder("out")
    changes(spark, 0, 60).coalesce(1).write.parquet(src)
    for n in range(2):
        streams.feed_to(stream(spark, src), out, folder(f"check{n}")).awaitTermination()
    assert spark.read.parquet(out).count() == 60


def test_stream_apply_equals_batch_apply(spark):
    base = feed.current_of_changes(changes(spark, 0, 100), ["id"], ["n"]).select("id", "v")
    step = ap.apply_changes(base, changes(spark, 0, 200).filter("n >= 100"), ["id"], ["n"])
    assert table(step) == table(feed.current_of_changes(changes(spark, 0, 200), ["id"], ["n"]).select("id", "v"))


def test_sessions_of_a_hot_group(spark):
    """A third of the rows are of one group; the split scan gives the sessions of session_window."""
    i = F.col("id")
    d = spark.range(3000).select(
        F.when(i % 3 == 0, 0).otherwise(i % 17).alias("g"),
        F.timestamp_seconds(F.lit(1704067200) + F.pmod(F.xxhash64(i), F.lit(400000))).alias("at"),
    )
    w = F.session_window("at", "20 minutes").alias("w")
    plain = d.groupBy(w, "g").agg(F.count("*").alias("events"))
    plain = plain.select(F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "g", "events")
    whole = streams.sessions(d.drop("g"), "at", [], "20 seconds")
    assert whole.agg(F.sum("events")).first()[0] == 3000
    for unit in ("hour", "day"):
        cut = streams.sessions(d, "at", ["g"], "20 minutes", bucket=F.date_trunc(unit, F.col("at")), hot_rows=200)
        assert cut.exceptAll(plain).isEmpty() and plain.exceptAll(cut).isEmpty()
