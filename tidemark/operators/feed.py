"""Change feeds: base columns plus ``_change_type, _commit_version, _commit_timestamp``.

A feed holds at most one change per key and version; an update is a pre- and a post-image. Feeds on
disk are partitioned by ``_commit_version``, so that version filters prune files.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import ordered
from tidemark.operators.apply import has_op, latest_per_key

CHANGE_TYPE, VERSION, TIMESTAMP = "_change_type", "_commit_version", "_commit_timestamp"
META = (CHANGE_TYPE, VERSION, TIMESTAMP)
# Change types of a feed.
INSERT, PRE, POST, DELETE = "insert", "update_preimage", "update_postimage", "delete"


def base_columns(feed: DataFrame) -> list[str]:
    return [c for c in feed.columns if c not in META]


def schema_of(table: DataFrame) -> T.StructType:
    """Schema of the feed of a table: its fields, nothing nullable added, plus the change columns."""
    fields = [f for f in table.schema.fields if f.name not in META]
    extra = [
        T.StructField(CHANGE_TYPE, T.StringType(), False),
        T.StructField(VERSION, T.LongType(), False),
        T.StructField(TIMESTAMP, T.TimestampType(), False),
    ]
    return T.StructType([*fields, *extra])


def from_changes(
    changes: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    order_by: Sequence[str],
    version: str,
    ts: str,
    op: str = "op",
    bucket: Column | None = None,
    committed: str | None = None,
    hot_rows: int = ordered.HOT_ROWS,
) -> DataFrame:
    """Build the feed from an ordered change log cut into commits by ``version``.

    The log is first collapsed to one change per key and version; only that is put in order per key. ``bucket`` (rising
    with the version) cuts every key; without it keys with more than ``hot_rows`` changes are cut by ranges of versions.
    The commit time is the last event time of the version, joined by version; a log that has its commit
    time in a column (``committed``) needs no join.
    """
    wanted = list(dict.fromkeys([*keys, *columns]))
    needed = list(dict.fromkeys([*wanted, *order_by, version, op, committed or ts]))
    last = latest_per_key(changes.filter(has_op(op)).select(*needed), [*keys, version], order_by)
    row = F.struct(*wanted)
    state = F.struct(F.col(op).alias("o"), row.alias("r"))
    if bucket is None:
        last = ordered.split_hot(last, keys, ordered.range_bucket(version, 10_000), "__cut", hot_rows, counted=changes)
        bucket = "__cut"
    with_prev = ordered.previous(last, keys, [version], state, "__prev", bucket)
    had = F.coalesce(F.col("__prev.o") != "d", F.lit(False))
    gone = F.col(op) == "d"

    def entry(kind: str, image: Column) -> Column:
        return F.struct(F.lit(kind).alias("t"), image.alias("r"))

    old = F.col("__prev.r")
    entries = (
        F.when(~had & ~gone, F.array(entry(INSERT, row)))
        .when(had & ~gone, F.array(entry(PRE, old), entry(POST, row)))
        .when(had & gone, F.array(entry(DELETE, old)))
    )
    at = [F.col(committed).alias(TIMESTAMP)] if committed else []
    out = with_prev.select(F.col(version).cast("bigint").alias(VERSION), *at, F.explode(entries).alias("e"))
    out = out.select("e.r.*", F.col("e.t").alias(CHANGE_TYPE), VERSION, *[TIMESTAMP for _ in at])
    if committed:
        return out.select(*wanted, *META)
    commits = changes.groupBy(F.col(version).cast("bigint").alias(VERSION)).agg(F.max(ts).alias(TIMESTAMP))
    return out.join(commits, VERSION).select(*wanted, *META)


def _after_images(feed: DataFrame) -> DataFrame:
    return feed.filter(F.col(CHANGE_TYPE) != PRE)


def current(feed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Table the feed amounts to."""
    last = latest_per_key(_after_images(feed), keys, [VERSION])
    return last.filter(F.col(CHANGE_TYPE) != DELETE).select(*base_columns(feed))


def current_of_changes(changes: DataFrame, keys: Sequence[str], order_by: Sequence[str], op: str = "op") -> DataFrame:
    """Table a raw change log amounts to."""
    return latest_per_key(changes.filter(has_op(op)), keys, order_by).filter(F.col(op) != "d")


def as_of_version(feed: DataFrame, keys: Sequence[str], version: int) -> DataFrame:
    return current(feed.filter(F.col(VERSION) <= version), keys)


def as_of_timestamp(feed: DataFrame, keys: Sequence[str], ts: datetime) -> DataFrame:
    return current(feed.filter(F.col(TIMESTAMP) <= _like(feed, ts)), keys)


def _like(feed: DataFrame, ts: datetime) -> Column:
    """Literal of the same type as the commit time, so that the filter reaches the scan."""
    return F.lit(ts.isoformat(sep=" ")).cast(feed.schema[TIMESTAMP].dataType)


def between_versions(feed: DataFrame, start: int, end: int | None = None) -> DataFrame:
    """Both ends inclusive; an open end means the latest version."""
    out = feed.filter(F.col(VERSION) >= start)
    return out if end is None else out.filter(F.col(VERSION) <= end)


def between_timestamps(feed: DataFrame, start: datetime, end: datetime | None = None) -> DataFrame:
    """Bounds are cut to whole seconds, both inclusive."""
    out = feed.filter(F.col(TIMESTAMP) >= _like(feed, start.replace(microsecond=0)))
    return out if end is None else out.filter(F.col(TIMESTAMP) <= _like(feed, end.replace(microsecond=0)))


def _latest(feed: DataFrame, back: int = 0) -> Column:
    return feed.select((F.max(VERSION) - F.lit(back)).alias("v")).scalar()


def latest_versions(feed: DataFrame, n: int = 1) -> DataFrame:
    """Changes of the last ``n`` versions."""
    return feed.filter(F.col(VERSION) >= F.greatest(F.lit(0), _latest(feed, n - 1)))


def by_type(feed: DataFrame, *types: str) -> DataFrame:
    return feed.filter(F.col(CHANGE_TYPE).isin(*types))


def inserts(feed: DataFrame) -> DataFrame:
    return by_type(feed, INSERT)


def updates(feed: DataFrame) -> DataFrame:
    return by_type(feed, PRE, POST)


def deletes(feed: DataFrame) -> DataFrame:
    return by_type(feed, DELETE)


def postimages(feed: DataFrame) -> DataFrame:
    """Rows to hand on downstream: inserts and new images, without the change columns."""
    return by_type(feed, INSERT, POST).select(*base_columns(feed))


def net(feed_part: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Net effect of a stretch of a feed: ``keys, b, a, kind`` as in ``diff.paired``.

    Reads only the stretch, not the table: the first image of a key tells its state before, the last
    one its state after. Aggregated map-side, so hot keys cost one row per task.
    """
    columns = base_columns(feed_part)
    image = F.struct(F.col(CHANGE_TYPE).alias("t"), F.struct(*columns).alias("r"))
    kind = F.col(CHANGE_TYPE)
    firsts = F.when(kind.isin(INSERT, PRE, DELETE), F.col(VERSION))
    lasts = F.when(kind.isin(INSERT, POST, DELETE), F.col(VERSION))
    ends = feed_part.groupBy(*keys).agg(F.min_by(image, firsts).alias("f"), F.max_by(image, lasts).alias("l"))
    sides = ends.select(
        *keys,
        F.when(F.col("f.t") != INSERT, F.col("f.r")).alias("b"),
        F.when(F.col("l.t") != DELETE, F.col("l.r")).alias("a"),
    )
    what = (
        F.when(F.col("b").isNull() & F.col("a").isNull(), F.lit(None).cast("string"))
        .when(F.col("b").isNull(), "insert")
        .when(F.col("a").isNull(), "delete")
        .when(~F.col("a").eqNullSafe(F.col("b")), "update")
    )
    return sides.withColumn("kind", what).filter(F.col("kind").isNotNull())


def _where(df: DataFrame, where: str | Column | None) -> DataFrame:
    if where is None:
        return df
    return df.filter(F.expr(where) if isinstance(where, str) else where)


def incremental(
    feed: DataFrame, keys: Sequence[str], start: int, end: int | None = None, where: str | Column | None = None
) -> DataFrame:
    """Rows new or different at ``end`` compared to ``start`` (start exclusive, end inclusive)."""
    part = between_versions(feed, start + 1, end)
    return _where(net(part, keys).filter(F.col("kind") != "delete").select("a.*"), where)


def incremental_by_time(
    feed: DataFrame, keys: Sequence[str], start: datetime, end: datetime | None = None, where: str | Column | None = None
) -> DataFrame:
    """Rows new or different since the last commit at or before ``start``."""
    part = feed.filter(F.col(TIMESTAMP) > _like(feed, start))
    if end is not None:
        part = part.filter(F.col(TIMESTAMP) <= _like(feed, end))
    return _where(net(part, keys).filter(F.col("kind") != "delete").select("a.*"), where)


def latest_snapshots(feed: DataFrame, keys: Sequence[str], n: int = 1) -> DataFrame:
    """Rows new or different through the last ``n`` versions."""
    return net(latest_versions(feed, n), keys).filter(F.col("kind") != "delete").select("a.*")


def batched(df: DataFrame, order_by: Sequence[str], size: int, bucket: Column) -> DataFrame:
    """Add ``batch_id``: consecutive batches of ``size`` rows in a total order.

    The rows are numbered per ``bucket`` (rising with the order) in parallel; only one count per bucket
    is summed up in a single task. Rows whose bucket is null come first, as a bucket of their own.
    """
    numbered = ordered.row_position(df, [], order_by, "__pos", F.struct(bucket.isNotNull().alias("known"), bucket.alias("b")))
    return numbered.withColumn("batch_id", F.floor((F.col("__pos") - 1) / F.lit(size)).cast("bigint")).drop("__pos")


def new_changes(feed: DataFrame, bookmarks: DataFrame, reader: str) -> DataFrame:
    """Changes after the reader's bookmark; everything when it has none."""
    seen = bookmarks.filter(F.col("reader") == reader).select(
        F.coalesce(F.max("last_version"), F.lit(-1).cast("bigint")).alias("v")
    )
    return feed.filter(F.col(VERSION) > seen.scalar())


def advance_bookmark(feed: DataFrame, bookmarks: DataFrame, reader: str) -> DataFrame:
    """Bookmark rows after the reader has taken everything in the feed."""
    mine = feed.agg(F.max(VERSION).alias("last_version")).filter(F.col("last_version").isNotNull())
    moved = bookmarks.unionByName(mine.select(F.lit(reader).alias("reader"), "last_version"))
    return moved.groupBy("reader").agg(F.max("last_version").alias("last_version"))


def process(changes: DataFrame, fn: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Run the caller's function over the changes, as part of the same lazy plan."""
    return changes.transform(fn)


def process_status(changes: DataFrame, fn: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """One row: rows taken and rows produced by ``fn``, and a status."""
    sides = changes.select(F.lit(1).alias("i")).unionAll(process(changes, fn).select(F.lit(0).alias("i")))
    out = sides.agg(F.count_if(F.col("i") == 1).alias("rows_in"), F.count_if(F.col("i") == 0).alias("rows_out"))
    return out.withColumn("status", F.when(F.col("rows_in") > 0, "success").otherwise("no_changes"))


def summary(feed: DataFrame) -> DataFrame:
    return feed.groupBy(CHANGE_TYPE).agg(F.count("*").alias("changes"))


def stats(feed: DataFrame) -> DataFrame:
    """One row: totals by type, updates as pairs, version and time range."""
    kind = F.col(CHANGE_TYPE)
    return feed.agg(
        F.count("*").alias("total_changes"),
        F.count_if(kind == INSERT).alias("inserts"),
        F.count_if(kind == POST).alias("updates"),
        F.count_if(kind == DELETE).alias("deletes"),
        F.min(VERSION).alias("first_version"),
        F.max(VERSION).alias("last_version"),
        F.min(TIMESTAMP).alias("first_timestamp"),
        F.max(TIMESTAMP).alias("last_timestamp"),
    ).withColumn("version_count", F.col("last_version") - F.col("first_version") + 1)


def row_count(df: DataFrame, where: str | Column | None = None) -> DataFrame:
    return _where(df, where).agg(F.count("*").alias("row_count")).withColumn("is_empty", F.col("row_count") == 0)


def row_estimate(table: DataFrame) -> DataFrame:
    """One row: rows of a stored table as its files' footers say, summed in tasks; no column is read. (Of a stored feed,
    and of a planned read of it, ``FeedStore.estimate`` knows more.)"""
    per_file = table.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("n"))
    return per_file.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("estimated_rows")).withColumn("is_empty", F.col("estimated_rows") == 0)


def table_info(feed: DataFrame, keys: Sequence[str], partition_columns: Sequence[str] = (), location: str | None = None) -> DataFrame:
    """One row: whether changes are tracked, versions, changes, live rows, partitioning, location.

    A key's inserts less its deletes is one while it lives, so live rows need no replay.
    """
    kind = F.col(CHANGE_TYPE)
    return feed.agg(
        F.max(VERSION).alias("latest_version"),
        F.min(VERSION).alias("first_version"),
        F.max(TIMESTAMP).alias("last_modified"),
        F.count("*").alias("changes"),
        (F.count_if(kind == INSERT) - F.count_if(kind == DELETE)).alias("live_rows"),
    ).withColumns(
        {
            "change_feed_enabled": F.lit(set(META) <= set(feed.columns)),
            "key_columns": F.lit(",".join(keys)),
            "partition_columns": F.lit(",".join(partition_columns)),
            "location": F.lit(location).cast("string"),
        }
    )


def audit_trail(
    feed: DataFrame, keys: Sequence[str], measure: str, bucket: Column | None = None, hot_rows: int = ordered.HOT_ROWS
) -> DataFrame:
    """Every state a key went through, in order, with the change of ``measure`` since the last one.

    ``bucket`` (rising with the version; ranges of 10,000 versions unless given) keeps keys with more
    than ``hot_rows`` changes parallel.
    """
    bucket = ordered.range_bucket(VERSION, 10_000) if bucket is None else bucket
    rows = _after_images(feed)
    kept = rows.columns
    rows = ordered.split_hot(rows, keys, bucket, "__cut", hot_rows)
    value = F.when(F.col(CHANGE_TYPE) != DELETE, F.col(measure))
    steps = {"step": ordered.position(), "previous_value": ordered.prior(value)}
    out = ordered.scan(rows, keys, [VERSION], steps, "__cut")
    return out.select(*kept, *steps, (value - F.col("previous_value")).alias("delta"))


def expire(feed: DataFrame, keys: Sequence[str], before: datetime) -> DataFrame:
    """Drop the history older than ``before``: it is folded into inserts at its last version, so the
    current table and every later state stay as they are."""
    limit = _like(feed, before)
    old = feed.filter(F.col(TIMESTAMP) < limit)
    kept = feed.filter(F.col(TIMESTAMP) >= limit)
    last = latest_per_key(_after_images(old), keys, [VERSION]).filter(F.col(CHANGE_TYPE) != DELETE)
    top = old.agg(F.max(F.struct(VERSION, TIMESTAMP)).alias("m")).scalar()
    folded = last.select(
        *base_columns(feed),
        F.lit(INSERT).alias(CHANGE_TYPE),
        top[VERSION].alias(VERSION),
        top[TIMESTAMP].alias(TIMESTAMP),
    )
    return folded.unionByName(kept)


def restore_changes(feed: DataFrame, keys: Sequence[str], version: int, at: datetime) -> DataFrame:
    """Feed rows of a new version that bring the table back to its state at ``version``.

    Only what happened after ``version`` is read; its net effect is turned round.
    """
    undone = net(feed.filter(F.col(VERSION) > version), keys)

    def entry(kind: str, image: str) -> Column:
        return F.struct(F.lit(kind).alias("t"), F.col(image).alias("r"))

    entries = (
        F.when(F.col("kind") == "insert", F.array(entry(DELETE, "a")))
        .when(F.col("kind") == "delete", F.array(entry(INSERT, "b")))
        .otherwise(F.array(entry(PRE, "a"), entry(POST, "b")))
    )
    out = undone.select(F.explode(entries).alias("e")).select("e.r.*", F.col("e.t").alias(CHANGE_TYPE))
    return out.select(*base_columns(feed), CHANGE_TYPE, _latest(feed, -1).alias(VERSION), _like(feed, at).alias(TIMESTAMP))
