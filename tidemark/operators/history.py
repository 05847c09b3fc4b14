"""Version and snapshot histories as frames.

Versions: ``version, timestamp, operation, metrics``. Snapshots: ``snapshot_id, parent_snapshot_id,
timestamp, operation, summary``. A history has one row per commit.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import ordered
from tidemark.functions.lineage import cut, scratch
from tidemark.operators import feed as feeds

# Operations that count as writes and as deletes.
WRITE_OPS = ("WRITE", "MERGE")
DELETE_OPS = ("DELETE",)


def from_changes(feed: DataFrame) -> DataFrame:
    """One row per version of a feed; the operation follows from the kinds of change in it."""
    kind = F.col(feeds.CHANGE_TYPE)
    per = feed.groupBy(F.col(feeds.VERSION).alias("version")).agg(
        F.max(feeds.TIMESTAMP).alias("timestamp"),
        F.count_if(kind == feeds.INSERT).alias("i"),
        F.count_if(kind == feeds.POST).alias("u"),
        F.count_if(kind == feeds.DELETE).alias("d"),
    )
    op = F.when((F.col("u") == 0) & (F.col("d") == 0), "WRITE").when((F.col("u") == 0) & (F.col("i") == 0), "DELETE")
    metrics = F.create_map(
        F.lit("inserted"), F.col("i").cast("string"),
        F.lit("updated"), F.col("u").cast("string"),
        F.lit("deleted"), F.col("d").cast("string"),
    )
    return per.select("version", "timestamp", op.otherwise("MERGE").alias("operation"), metrics.alias("metrics"))


def _id(history: DataFrame) -> str:
    return "snapshot_id" if "snapshot_id" in history.columns else "version"


def _like(history: DataFrame, ts: datetime) -> Column:
    return F.lit(ts.isoformat(sep=" ")).cast(history.schema["timestamp"].dataType)


def get(history: DataFrame, entry: int) -> DataFrame:
    return history.filter(F.col(_id(history)) == entry)


def between(history: DataFrame, start: int, end: int | None = None) -> DataFrame:
    out = history.filter(F.col(_id(history)) >= start)
    return out if end is None else out.filter(F.col(_id(history)) <= end)


def since(history: DataFrame, ts: datetime) -> DataFrame:
    return history.filter(F.col("timestamp") >= _like(history, ts))


def latest(history: DataFrame, n: int = 1) -> DataFrame:
    """The ``n`` most recent entries (top-n, no full sort)."""
    return history.orderBy(F.col("timestamp").desc(), F.col(_id(history)).desc()).limit(n)


def range_for_period(history: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """One row with the first and last version of a period, nulls when there is none."""
    inside = history.filter(F.col("timestamp").between(_like(history, start), _like(history, end)))
    return inside.agg(F.min("version").alias("first_version"), F.max("version").alias("last_version"))


def as_of(history: DataFrame, ts: datetime, earliest_if_before: bool = False) -> DataFrame:
    """One row: the entry in force at ``ts``. Before the first entry that is none, or the first one."""
    key, at = F.col(_id(history)), F.col("timestamp")
    order = F.struct(at, key)
    found = F.max_by(key, F.when(at <= _like(history, ts), order))
    if earliest_if_before:
        found = F.coalesce(found, F.min_by(key, order))
    return history.agg(found.alias(_id(history)))


def as_of_many(probes: DataFrame, history: DataFrame, at: str, unit: str = "minute") -> DataFrame:
    """Add the version in force at each probe's time; null before the first version, or without a time.

    The history is cut by ``unit`` of time: a unit that has probes or versions is one row with its own versions and the
    version in force when it begins, carried along over these rows only. Probes find their unit by an equi join, so
    they are neither sorted nor put in one task for a busy unit: a small table of units is broadcast by its
    size, with a large one a hot unit is split at run time. Of versions with the same time the greatest counts.
    """
    name = _id(history)
    ts_type = probes.schema[at].dataType
    cut = lambda c: F.date_trunc(unit, c).cast(ts_type)
    stamp = F.col("timestamp").cast(ts_type)
    versions = history.select(cut(stamp).alias("__unit"), F.struct(stamp.alias("t"), F.col(name).alias("v")).alias("__m"))
    own = versions.groupBy("__unit").agg(F.sort_array(F.collect_list("__m")).alias("__own"))
    asked = probes.select(cut(F.col(at)).alias("__unit")).filter(F.col("__unit").isNotNull()).distinct()
    units = asked.join(own, "__unit", "full_outer").withColumn("__last", F.element_at("__own", -1)["v"])
    units = _kept(units)  # read twice by the scan, and small: a row per unit
    before = ordered.scan(units, [], ["__unit"], {"__start": ordered.known_before(F.col("__last"))}, F.date_trunc("day", F.col("__unit")))
    table = before.select(F.col("__unit").alias("__u"), "__own", "__start")
    inside = F.filter("__own", lambda m: m["t"] <= F.col(at))
    found = F.coalesce(F.try_element_at(inside, F.lit(-1))["v"], F.col("__start"))
    joined = probes.join(table, cut(F.col(at)) == F.col("__u"), "left")
    return joined.select(*probes.columns, found.alias(name))


def _kept(df: DataFrame) -> DataFrame:
    """The frame as a table written once in the shared folder."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def operation_counts(history: DataFrame) -> DataFrame:
    return history.groupBy("operation").agg(F.count("*").alias("versions"))


def operations_summary(history: DataFrame, start: int, end: int) -> DataFrame:
    op = F.col("operation")
    return between(history, start, end).agg(
        F.count("*").alias("versions"),
        F.count_if(op.isin(*WRITE_OPS)).alias("writes"),
        F.count_if(op.isin(*DELETE_OPS)).alias("deletes"),
        F.min("timestamp").alias("first_timestamp"),
        F.max("timestamp").alias("last_timestamp"),
    )


def statistics(history: DataFrame) -> DataFrame:
    """One row: number of entries, first, last, span in seconds, and counts by operation."""
    key = F.col(_id(history))
    order = F.struct("timestamp", key)
    by_op = history.groupBy("operation").agg(
        F.count("*").alias("n"),
        F.min(order).alias("lo"),
        F.max(order).alias("hi"),
    )
    out = by_op.agg(
        F.sum("n").alias("entries"),
        F.min("lo").alias("lo"),
        F.max("hi").alias("hi"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("operation", "n")))).alias("operations"),
    )
    name = _id(history)
    return out.select(
        "entries",
        F.col(f"lo.{name}").alias("first_id"),
        F.col(f"hi.{name}").alias("last_id"),
        F.col("lo.timestamp").alias("first_timestamp"),
        F.col("hi.timestamp").alias("last_timestamp"),
        seconds_between(F.col("lo.timestamp"), F.col("hi.timestamp")).alias("span_seconds"),
        "operations",
    )


def seconds_between(start: Column, end: Column) -> Column:
    """Seconds from start to end with microsecond resolution."""
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(1e6)


def compare(history: DataFrame, first: int, second: int) -> DataFrame:
    """One row: the two entries side by side, the time between them and how many lie between."""
    key = F.col(_id(history))

    def pick(column: str, entry: int) -> Column:
        return F.max(F.when(key == entry, F.col(column)))

    lo, hi = min(first, second), max(first, second)
    return history.agg(
        pick("operation", first).alias("first_operation"),
        pick("operation", second).alias("second_operation"),
        pick("timestamp", first).alias("first_timestamp"),
        pick("timestamp", second).alias("second_timestamp"),
        F.count_if((key > lo) & (key < hi)).alias("versions_between"),
    ).withColumn("seconds_apart", seconds_between(F.col("first_timestamp"), F.col("second_timestamp")))


def ancestors(snapshots: DataFrame, end: int) -> DataFrame:
    """``snapshot_id`` of ``end`` and all its ancestors.

    Pointer doubling: every round squares the jump table, so a chain of n snapshots takes log2(n)
    rounds of equi joins. Each round is checkpointed.
    """
    jump = snapshots.select(F.col("snapshot_id").alias("f"), F.col("parent_snapshot_id").alias("t"))
    jump = jump.filter(F.col("t").isNotNull())
    reached = snapshots.filter(F.col("snapshot_id") == end).select("snapshot_id")
    while True:
        step = reached.join(jump, F.col("snapshot_id") == F.col("f")).select(F.col("t").alias("snapshot_id"))
        reached = cut(reached.unionAll(step).distinct())
        far = jump.select(F.col("f").alias("t"), F.col("t").alias("tt"))
        jump = cut(jump.join(far, "t").select("f", F.col("tt").alias("t")))
        if jump.isEmpty():
            return reached


def chain(snapshots: DataFrame, end: int, start: int | None = None, include_start: bool = True) -> DataFrame:
    """Snapshots on the parent chain from ``start`` to ``end``.

    A ``start`` that is not on the chain leaves it whole, as walking back never meets it.
    """
    line = snapshots.join(ancestors(snapshots, end), "snapshot_id", "left_semi")
    if start is None:
        return line
    mark = F.struct(F.col("timestamp"), F.col("snapshot_id"))
    from_mark = line.filter(F.col("snapshot_id") == start).select(F.max(mark).alias("m")).scalar()
    reached = mark >= from_mark if include_start else mark > from_mark
    return line.filter(F.coalesce(reached, F.lit(True)))


def is_ancestor(snapshots: DataFrame, ancestor: int, descendant: int) -> DataFrame:
    """One row with ``is_ancestor``; a snapshot counts as its own ancestor."""
    hit = ancestors(snapshots, descendant).agg(F.count_if(F.col("snapshot_id") == ancestor).alias("n"))
    return hit.select((F.col("n") > 0).alias("is_ancestor"))


def range_statistics(snapshots: DataFrame, end: int, start: int | None = None) -> DataFrame:
    """One row about the snapshots from ``start`` to ``end``, both included."""
    return chain(snapshots, end, start).agg(
        F.count("*").alias("snapshots"),
        F.min("timestamp").alias("first_timestamp"),
        F.max("timestamp").alias("last_timestamp"),
    ).withColumn("span_seconds", seconds_between(F.col("first_timestamp"), F.col("last_timestamp")))


def pending(history: DataFrame, bookmarks: DataFrame) -> DataFrame:
    """Per reader: bookmark, latest version and how many versions are waiting.

    Versions are numbered without gaps, so what waits is a difference.
    """
    newest = history.select(F.max("version").alias("v")).scalar()
    return bookmarks.select("reader", "last_version", newest.alias("latest_version")).withColumn(
        "pending", F.col("latest_version") - F.col("last_version")
    )


def pending_snapshots(snapshots: DataFrame, end: int, last_read: int) -> DataFrame:
    """One row: snapshots on the chain of ``end`` after ``last_read`` (ids are not in sequence)."""
    return chain(snapshots, end, last_read, include_start=False).agg(F.count("*").alias("pending"))
