"""Structured Streaming jobs over change sources: append, upsert, fan-out, dedupe, windows, checks."""

from __future__ import annotations

import json
import threading
import time
from collections.abc import Callable, Mapping, Sequence

import pandas as pd
from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidemark.functions import lineage, ordered
from tidemark.operators import apply as ap
from tidemark.sinks import writers
from tidemark.sinks.seen_ids import SeenIds

# Default time between micro-batches.
TRIGGER = "10 seconds"


def _trigger(writer, every: str | None):
    """A time between batches, or (None) one run over everything available that then stops."""
    return writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)


def append_to(
    df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", every: str | None = TRIGGER, partition_by: Sequence[str] = (), **options: str
) -> StreamingQuery:
    """Append sink; offsets are committed in the checkpoint only after the batch is written."""
    writer = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return _trigger(writer, every).start(path)


def run_append(
    raw: DataFrame, steps: Sequence[Callable[[DataFrame], DataFrame]], path: str, checkpoint: str, every: str | None = None, **options: str
) -> StreamingQuery:
    """Source -> parse -> filter -> project -> append, as one query."""
    for step in steps:
        raw = raw.transform(step)
    return append_to(raw, path, checkpoint, every=every, **options)


def upsert_to(
    changes: DataFrame,
    root: str,
    checkpoint: str,
    keys: Sequence[str],
    order_by: Sequence[str],
    columns: Sequence[str],
    op: str = "op",
    every: str | None = None,
) -> StreamingQuery:
    """Keep a table under the change stream.

    A micro-batch is collapsed and written as ``delta/batch_id=n``: the work is that of the batch, not
    of the table, and a batch repeated after a failure overwrites its own folder. ``read_upserted``
    merges on read and ``fold`` makes the merged state the new base. With a table format that has
    MERGE, one would merge at this place.
    """
    kept = list(dict.fromkeys([*keys, *columns, *order_by, op]))

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        last = ap.latest_per_key(batch.select(*kept), keys, order_by)
        last.write.mode("overwrite").parquet(f"{root}/delta/batch_id={batch_id}")

    writer = changes.writeStream.foreachBatch(one_batch).option("checkpointLocation", checkpoint)
    return _trigger(writer, every).start()


#: Key buckets of a base: a fold rewrites only those that a batch since the last fold has touched.
BUCKETS = 64
_FOLD, _BUCKET, _LIST = "fold_id", "key_bucket", "key_bucket int, fold_id bigint, buckets int"


def _bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _base_list(spark: SparkSession, root: str, fold: int | None) -> list:
    """Which fold wrote each bucket of the base (-1: the bucket has no rows); one small row per bucket."""
    if fold is None:
        return []
    return spark.read.schema(_LIST).parquet(f"{root}/base/version={fold}").collect()


def _base_rows(spark: SparkSession, root: str, listed: Sequence) -> DataFrame | None:
    paths = [f"{root}/buckets/{_FOLD}={r.fold_id}/{_BUCKET}={r.key_bucket}" for r in listed if r.fold_id >= 0]
    if not paths:
        return None
    return spark.read.option("basePath", f"{root}/buckets").parquet(*paths).drop(_FOLD, _BUCKET)


def _newer(spark: SparkSession, root: str, folded: int | None) -> DataFrame:
    """Collapsed batches that the base doesn't cover."""
    delta = spark.read.parquet(f"{root}/delta")
    return (delta if folded is None else delta.filter(F.col("batch_id") > folded)).drop("batch_id")


def _merged(base: DataFrame | None, newer: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Last change per key over base rows and the batches after them (deletes included)."""
    return ap.latest_per_key(newer, keys, order_by) if base is None else ap.merge_latest(base, newer, keys, order_by)


def _state(spark: SparkSession, root: str, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    folded = writers.latest_version(spark, f"{root}/base")
    base = _base_rows(spark, root, _base_list(spark, root, folded))
    return _merged(base, _newer(spark, root, folded), keys, order_by)


def read_upserted(
    spark: SparkSession, root: str, keys: Sequence[str], order_by: Sequence[str], columns: Sequence[str], op: str = "op"
) -> DataFrame:
    """Current table of ``upsert_to``. Late changes lose against newer ones, whatever their batch."""
    return _state(spark, root, keys, order_by).filter(F.col(op) != "d").select(*columns)


def fold(
    spark: SparkSession, root: str, keys: Sequence[str], order_by: Sequence[str], forget: Column | None = None, op: str = "op",
    buckets: int = BUCKETS, whole: bool = False,
) -> int:
    """Fold all batches so far into the base; returns the last one.

    The base is cut into key buckets (their number is that of the first fold). Only buckets that a new batch has touched, or
    all of them if ``whole``, are written anew, as ``buckets/fold_id=n/key_bucket=b``; a small list of
    which fold wrote each bucket then makes the new base visible, in one step. Untouched buckets keep their files.

    Then what no reader needs is removed: batches that the base before this one covers, lists older than that, and bucket
    files that neither of both lists names. Readers that began with the base before find what they need, and after a failure
    in between the next call does it. Deletes that meet the condition ``forget`` (so old that no late change to their
    key can come) leave the buckets that are written.
    """
    before = writers.latest_version(spark, f"{root}/base")
    last = spark.read.parquet(f"{root}/delta").agg(F.max("batch_id")).first()[0]
    listed = _base_list(spark, root, before)
    if before is None or last > before:
        n = listed[0].buckets if listed else buckets
        newer = _newer(spark, root, before)
        touched = set(range(n)) if whole else {r[0] for r in newer.select(_bucket_of(keys, n)).distinct().collect()}
        state = _merged(_base_rows(spark, root, [r for r in listed if r.key_bucket in touched]), newer, keys, order_by)
        if forget is not None:
            state = state.filter(~((F.col(op) == "d") & F.coalesce(forget, F.lit(False))))
        path = f"{root}/buckets/{_FOLD}={last}"
        writers.overwrite(state.withColumn(_BUCKET, _bucket_of(keys, n)), path, partition_by=[_BUCKET])
        there = {b for b, _ in lineage.numbered_folders(spark, path, _BUCKET)}
        kept = {r.key_bucket: r.fold_id for r in listed}
        rows = [(b, (last if b in there else -1) if b in touched else kept.get(b, -1), n) for b in range(n)]
        writers.write_version(spark.createDataFrame(rows, _LIST).coalesce(1), f"{root}/base", last)
    if before is not None:
        bound = before if last > before else -1
        for name, kind, keep in ((f"{root}/delta", "batch_id", bound + 1), (f"{root}/base", "version", bound)):
            for number, path in lineage.numbered_folders(spark, name, kind):
                if number < keep:
                    lineage.remove(spark, path)
        now = _base_list(spark, root, last)
        named = {(r.fold_id, r.key_bucket) for r in [*listed, *now]}
        for fold_id, folder in lineage.numbered_folders(spark, f"{root}/buckets", _FOLD):
            parts = lineage.numbered_folders(spark, folder, _BUCKET)
            gone = [path for b, path in parts if (fold_id, b) not in named]
            for path in gone if len(gone) < len(parts) or fold_id >= last else [folder]:
                lineage.remove(spark, path)
    return last


def feed_to(
    changes: DataFrame, path: str, checkpoint: str, every: str | None = None, batch_column: str = "batch_id"
) -> StreamingQuery:
    """Write each micro-batch to its own folder ``batch_id=n``; a repeat overwrites its folder."""

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{batch_column}={batch_id}")

    writer = changes.writeStream.foreachBatch(one_batch).option("checkpointLocation", checkpoint)
    return _trigger(writer, every).start()


REST = "__rest"


def fan_out(
    events: DataFrame, table: str | Column, tables: Sequence[str], path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """One stream to many tables in one pass: rows are written partitioned by their table's name. Rows of tables that
    aren't listed, or without a table, go to the table ``__rest``; ``source_table`` says whose they are."""
    name = F.col(table) if isinstance(table, str) else table
    routed = events.withColumn("source_table", name)
    listed = F.coalesce(F.col("source_table").isin(*tables), F.lit(False))
    routed = routed.withColumn("table_name", F.when(listed, F.col("source_table")).otherwise(REST))
    return append_to(routed, path, checkpoint, every=every, partition_by=["table_name"])


def dedupe(events: DataFrame, id_columns: Sequence[str], ts: str, delay: str) -> DataFrame:
    """Drop re-deliveries that come within ``delay``; state older than that is released."""
    return events.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(id_columns))


def counts(
    events: DataFrame, ts: str, by: Sequence[str], window: str, slide: str | None = None, delay: str | None = None
) -> DataFrame:
    """Events per window and group. With a watermark, late rows go and closed windows are final."""
    if delay is not None and events.isStreaming:
        events = events.withWatermark(ts, delay)
    w = F.window(F.col(ts), window, slide) if slide else F.window(F.col(ts), window)
    out = events.groupBy(w.alias("w"), *by).agg(F.count("*").alias("events"))
    return out.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by, "events")


def sessions(
    events: DataFrame, ts: str, by: Sequence[str], gap: str, delay: str | None = None, bucket: Column | None = None,
    hot_rows: int = ordered.HOT_ROWS,
) -> DataFrame:
    """Bursts of activity per group, ended by a pause of ``gap``.

    In a batch, ``bucket`` (a column rising with time; the hour unless given) keeps groups with more
    than ``hot_rows`` rows parallel: the start of each session is carried along in an ordered scan and the
    rows are then counted per start, combined map-side.
    """
    if events.isStreaming:
        if delay is not None:
            events = events.withWatermark(ts, delay)
        out = events.groupBy(F.session_window(F.col(ts), gap).alias("w"), *by).agg(F.count("*").alias("events"))
        return out.select(F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), *by, "events")
    pause = F.expr(f"interval {gap}")
    bucket = F.date_trunc("hour", F.col(ts)) if bucket is None else bucket
    rows = events.select(*by, F.col(ts).alias("__ts"), bucket.alias("__cut"))
    if by:
        whole = rows.withColumnRenamed("__cut", "__bucket")
        rows = ordered.split_hot(whole, by, F.col("__bucket"), "__cut", hot_rows).drop("__bucket")
    with_prev = ordered.scan(rows, by, ["__ts"], {"__prev": ordered.prior(F.col("__ts"))}, "__cut")
    opens = F.col("__prev").isNull() | (F.col("__ts") >= F.col("__prev") + pause)
    start = ordered.known(F.when(opens, F.col("__ts")))
    placed = ordered.scan(with_prev, by, ["__ts"], {"session_start": start}, "__cut")
    out = placed.groupBy(*by, "session_start").agg(F.max("__ts").alias("last"), F.count("*").alias("events"))
    return out.select("session_start", (F.col("last") + pause).alias("session_end"), *by, "events")


def dedupe_for_good(events: DataFrame, store: SeenIds, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Keep the first delivery of every event, however late another one comes: ids are held against ``store`` instead of a
    state that ends at the watermark. Each micro-batch has its own folder, so a repeated one replaces itself."""

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        out = f"{path}/batch_id={batch_id}"
        store.unseen(batch, batch_id).write.mode("overwrite").parquet(out)
        store.add(batch.sparkSession.read.schema(batch.schema).parquet(out), batch_id)

    writer = events.writeStream.foreachBatch(one_batch).option("checkpointLocation", checkpoint)
    return _trigger(writer, every).start()


def validate_to(
    events: DataFrame, checks: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Run the checks on every micro-batch and keep the result rows with the batch they are about."""

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        results = checks(batch).withColumn("checked_batch", F.lit(batch_id).cast("bigint"))
        results.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    writer = events.writeStream.foreachBatch(one_batch).option("checkpointLocation", checkpoint)
    return _trigger(writer, every).start()


def for_each(events: DataFrame, callback: Callable[[Mapping], None], checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Call the user's function for every event, on the executors."""
    writer = events.writeStream.foreach(lambda row: callback(row.asDict(recursive=True)))
    return _trigger(writer.option("checkpointLocation", checkpoint), every).start()


def run_until(events: DataFrame, callback: Callable[[DataFrame, int], bool], checkpoint: str, every: str | None = None) -> bool:
    """Call the user's function with every micro-batch until it returns true or, without ``every``, all that is there has
    been seen. Returns whether the function stopped the run.

    Batches after the one it stopped at are not committed: a later run on the checkpoint begins with them, or with
    that batch itself when the stop came before its commit.
    """
    stop = threading.Event()

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        if stop.is_set():
            raise RuntimeError("stopped by the callback")
        if callback(batch, batch_id):
            stop.set()

    query = _trigger(events.writeStream.foreachBatch(one_batch).option("checkpointLocation", checkpoint), every).start()
    try:
        while not query.awaitTermination(1):
            if stop.is_set():
                query.stop()
    except StreamingQueryException:
        if not stop.is_set():
            raise
    return stop.is_set()


def handle_batches(events: DataFrame, callback: Callable[[pd.DataFrame], pd.Series], keep: Sequence[str]) -> DataFrame:
    """As ``handle``, for a function that takes many events at once, as a pandas frame, and gives a verdict for each."""
    kept = [f for f in events.schema.fields if f.name in keep]
    names = [f.name for f in kept]

    def run(batches):
        for pdf in batches:
            yield pdf[names].assign(handled=callback(pdf).astype(bool).to_numpy())

    return events.mapInPandas(run, T.StructType([*kept, T.StructField("handled", T.BooleanType())]))


def handle(events: DataFrame, callback: Callable[[Mapping], bool], keep: Sequence[str]) -> DataFrame:
    """Call the user's function for every event and keep its verdict in ``handled``.

    Works on batches and streams. Rows go to Python in Arrow batches, in the tasks that hold them; to
    stop early, put a ``limit`` in front.
    """
    kept = [f for f in events.schema.fields if f.name in keep]
    out = T.StructType([*kept, T.StructField("handled", T.BooleanType())])
    names = [f.name for f in kept]

    def run(batches):
        for pdf in batches:
            done = [bool(callback(row)) for row in pdf.to_dict("records")]
            yield pdf[names].assign(handled=done)

    return events.mapInPandas(run, out)


def counted(df: DataFrame, name: str, **conditions: Column) -> DataFrame:
    """The same rows, counted on their way to the sink: all of them (``rows``) and those that meet each condition. No
    second read: the counts come with the progress of each micro-batch (``ProgressLog.counts``)."""
    return df.observe(name, F.count("*").alias("rows"), *[F.count_if(c).alias(k) for k, c in conditions.items()])


PROGRESS = "run_id string, batch_id bigint, timestamp string, input_rows bigint, rows_per_second double, observed string"


class ProgressLog(StreamingQueryListener):
    """Keeps the progress of every micro-batch of the session's queries as rows of a table.

    Rows are appended to ``path`` whenever ``every`` of them have come together or ``seconds`` have gone by, and when a query
    ends, so a run of any length is counted whole; rows wait until a write of them succeeded. ``observed`` has the metrics of
    ``counted`` frames as JSON. ``with ProgressLog(spark, path) as log: ...`` listens inside the block.
    """

    def __init__(self, spark: SparkSession, path: str, every: int = 1000, seconds: float = 60.0):
        self.spark, self.path, self.every, self.seconds = spark, path, every, seconds
        self.waiting: list[tuple] = []
        self.lock, self.writing = threading.Lock(), threading.Lock()
        self.written_at = time.monotonic()

    def __enter__(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        # events still on their way come before the listener goes
        self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        self.spark.streams.removeListener(self)
        self.flush()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        observed = json.dumps({k: v.asDict() for k, v in p.observedMetrics.items()}, default=str)
        with self.lock:
            self.waiting.append((str(p.runId), p.batchId, p.timestamp, p.numInputRows, float(p.processedRowsPerSecond or 0.0), observed))
            full = len(self.waiting) >= self.every or time.monotonic() - self.written_at >= self.seconds
        if full:
            self.flush()

    def onQueryTerminated(self, event) -> None:
        self.flush()

    def flush(self) -> None:
        with self.writing:
            with self.lock:
                rows = list(self.waiting)
            if rows:
                self.spark.createDataFrame(rows, PROGRESS).coalesce(1).write.mode("append").parquet(self.path)
                with self.lock:
                    del self.waiting[: len(rows)]
            self.written_at = time.monotonic()

    def counts(self, name: str, *metrics: str) -> DataFrame:
        """One row: the sums of a ``counted`` frame's metrics over all micro-batches so far."""
        seen = F.from_json(F.get_json_object("observed", f"$.{name}"), "map<string,bigint>")
        return self.rows().agg(*[F.coalesce(F.sum(seen[m]), F.lit(0)).alias(m) for m in metrics])

    def rows(self) -> DataFrame:
        """Progress of all micro-batches so far."""
        self.flush()
        return self.spark.read.schema(PROGRESS).parquet(self.path)
