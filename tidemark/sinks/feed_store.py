"""A stored change feed: stretches of versions, a ledger of commits, and bases.

``changes/<stretch>`` holds the changes of consecutive versions, ordered by version, so files are skipped inside a
stretch, too. ``ledger`` has one small row per version: its time, counts by type, and the stretch that holds it.
``bases/<version>`` is the whole table as it was at a version. What a read opens is looked up in the ledger first:
a time becomes a set of versions, versions become stretches, and a state is the newest base at or before it with the
stretches after that base. Histories and counts read the ledger alone.

A stretch counts once its ledger rows are there, which Spark commits in one file after the changes are
written; so a failed append leaves only a folder that nothing refers to. There is one writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import lineage
from tidemark.operators import feed as feeds
from tidemark.operators.apply import latest_per_key
from tidemark.operators.feed import CHANGE_TYPE, DELETE, INSERT, POST, TIMESTAMP, VERSION

LEDGER = "version bigint, timestamp {}, inserts bigint, updates bigint, deletes bigint, changes bigint, stretch string, first_version bigint, last_version bigint"
BASES = "base_version bigint, folder string, row_count bigint"
HORIZON = "expired_version bigint"


class FeedStore:
    """A stored feed under ``root``, whose rows are identified by ``keys``. The feed's schema is that of the first append."""

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str]):
        self.spark, self.root, self.keys = spark, root.rstrip("/"), list(keys)

    # what the store knows without reading changes

    def _small(self, name: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")
        except AnalysisException:
            return self.spark.createDataFrame([], schema)

    def ledger(self) -> DataFrame:
        """One row per version that is still there."""
        try:
            rows = self.spark.read.parquet(f"{self.root}/ledger")
        except AnalysisException:
            return self.spark.createDataFrame([], LEDGER.format("timestamp"))
        gone = self.horizon()
        return rows if gone is None else rows.filter(F.col("version") > gone)

    def horizon(self) -> int | None:
        """The last version whose changes were given up, or None."""
        return self._small("horizon", HORIZON).agg(F.max("expired_version")).first()[0]

    def bases(self) -> DataFrame:
        return self._small("base_log", BASES)

    def schema(self) -> T.StructType:
        """Schema of the feed, as its first append was."""
        return _schema(self.spark, self.root)

    def latest_version(self) -> int | None:
        last = self.ledger().agg(F.max("version")).first()[0]
        return self.horizon() if last is None else last

    def version_at(self, ts: datetime) -> int | None:
        """The last version that was committed at or before a time; the horizon where that is all that is known."""
        rows = self.ledger()
        found = rows.filter(F.col("timestamp") <= _like(rows, ts)).agg(F.max("version")).first()[0]
        return self.horizon() if found is None else found

    def history(self) -> DataFrame:
        """``version, timestamp, operation, metrics`` of each version, as ``history.from_changes``, from the ledger alone."""
        op = F.when((F.col("updates") == 0) & (F.col("deletes") == 0), "WRITE").when((F.col("updates") == 0) & (F.col("inserts") == 0), "DELETE")
        metrics = F.create_map(
            F.lit("inserted"), F.col("inserts").cast("string"),
            F.lit("updated"), F.col("updates").cast("string"),
            F.lit("deleted"), F.col("deletes").cast("string"),
        )
        return self.ledger().select("version", "timestamp", op.otherwise("MERGE").alias("operation"), metrics.alias("metrics"))

    def change_stats(self) -> DataFrame:
        """As ``feed.stats`` over all changes still there, from the ledger alone."""
        return self.ledger().agg(
            F.coalesce(F.sum("changes"), F.lit(0)).alias("total_changes"),
            F.coalesce(F.sum("inserts"), F.lit(0)).alias("inserts"),
            F.coalesce(F.sum("updates"), F.lit(0)).alias("updates"),
            F.coalesce(F.sum("deletes"), F.lit(0)).alias("deletes"),
            F.min("version").alias("first_version"),
            F.max("version").alias("last_version"),
            F.min("timestamp").alias("first_timestamp"),
            F.max("timestamp").alias("last_timestamp"),
        ).withColumn("version_count", F.col("last_version") - F.col("first_version") + 1)

    def estimate(self, start: int | None = None, end: int | None = None) -> DataFrame:
        """One row about a planned read of versions ``start`` to ``end`` (both included; open ends mean all there is), from
        ledger and base log alone: versions, stretches, changes, and the table's rows at the end."""
        rows = self.ledger()
        upto = rows if end is None else rows.filter(F.col("version") <= end)
        scan = upto if start is None else upto.filter(F.col("version") >= start)
        base = self._base(end)
        after = upto if base is None else upto.filter(F.col("version") > base.base_version)
        live = after.agg((F.coalesce(F.sum(F.col("inserts") - F.col("deletes")), F.lit(0)) + F.lit(0 if base is None else base.row_count)).alias("n"))
        out = scan.agg(
            F.count("*").alias("versions"),
            F.countDistinct("stretch").alias("stretches"),
            F.coalesce(F.sum("changes"), F.lit(0)).alias("planned_changes"),
        )
        return out.withColumn("table_rows", live.select("n").scalar())

    # writing

    def append(self, feed: DataFrame, files: int | None = None) -> int:
        """Add the changes of new versions; the number of versions added. Versions must follow those in the store: an append
        that is repeated after it was done is refused. ``files`` cuts the stretch by version (else by size, at run time)."""
        name = uuid.uuid4().hex
        path = f"{self.root}/changes/{name}"
        ordered = feed.repartitionByRange(files, VERSION, F.xxhash64(*self.keys)) if files else feed.repartitionByRange(VERSION, F.xxhash64(*self.keys))
        ordered.sortWithinPartitions(VERSION).write.parquet(path)
        written = self.spark.read.schema(feed.schema).parquet(path)
        kind = F.col(CHANGE_TYPE)
        rows = written.groupBy(F.col(VERSION).cast("bigint").alias("version")).agg(
            F.max(TIMESTAMP).alias("timestamp"),
            F.count_if(kind == INSERT).alias("inserts"),
            F.count_if(kind == POST).alias("updates"),
            F.count_if(kind == DELETE).alias("deletes"),
            F.count("*").alias("changes"),
        )
        kept = lineage.scratch(self.spark)
        rows.write.parquet(kept)
        rows = self.spark.read.parquet(kept)
        ends = rows.agg(F.min("version").alias("lo"), F.max("version").alias("hi"), F.count("*").alias("n")).first()
        if ends.n:
            newest = self.latest_version()
            if newest is not None and ends.lo <= newest:
                lineage.remove(self.spark, path)
                raise ValueError(f"version {ends.lo} is not after version {newest}, the last one in the store")
            if newest is None:
                _keep_schema(self.spark, self.root, feed.schema)
            of = {"stretch": F.lit(name), "first_version": F.lit(ends.lo), "last_version": F.lit(ends.hi)}
            rows.withColumns(of).coalesce(1).write.mode("append").parquet(f"{self.root}/ledger")
        lineage.remove(self.spark, kept)
        return ends.n

    def add_base(self, version: int | None = None) -> int | None:
        """Keep the whole table as of a version (the latest one unless given), for later reads to begin at."""
        version = self.latest_version() if version is None else version
        if version is None:
            return None
        base = self._base(version)
        if base is not None and base.base_version == version:
            return version
        name = uuid.uuid4().hex
        self.as_of(version).write.parquet(f"{self.root}/bases/{name}")
        rows = self.spark.read.parquet(f"{self.root}/bases/{name}").agg(F.count("*").alias("row_count"))
        rows.select(F.lit(version).cast("bigint").alias("base_version"), F.lit(name).alias("folder"), "row_count").coalesce(1).write.mode("append").parquet(f"{self.root}/base_log")
        return version

    def expire(self, before: datetime) -> int | None:
        """Give up the changes of versions committed before a time; the last version given up. The table as of that
        version is kept as a base first, so it and every later state stay as they are. Then stretches and bases that no read
        can ask for any more are removed; if that fails in between, the next call does it."""
        rows = self.ledger()
        early = rows.filter(F.col("timestamp") < _like(rows, before)).agg(F.max("version")).first()[0]
        late = rows.filter(F.col("timestamp") >= _like(rows, before)).agg(F.min("version")).first()[0]
        last = early if late is None or early is None else min(early, late - 1)
        if last is not None:
            self.add_base(last)
            self.spark.createDataFrame([(last,)], HORIZON).coalesce(1).write.mode("append").parquet(f"{self.root}/horizon")
        gone = self.horizon()
        if gone is not None:
            whole = self.spark.read.parquet(f"{self.root}/ledger").filter(F.col("last_version") <= gone).select(F.col("stretch").alias("f"))
            for row in whole.distinct().toLocalIterator():
                lineage.remove(self.spark, f"{self.root}/changes/{row.f}")
            for row in self.bases().filter(F.col("base_version") < gone).select(F.col("folder").alias("f")).toLocalIterator():
                lineage.remove(self.spark, f"{self.root}/bases/{row.f}")
        return last

    # reading

    def _base(self, version: int | None = None):
        """The newest base at or before a version that is still there."""
        rows, gone = self.bases(), self.horizon()
        rows = rows if version is None else rows.filter(F.col("base_version") <= version)
        rows = rows if gone is None else rows.filter(F.col("base_version") >= gone)
        return rows.orderBy(F.col("base_version").desc()).first()

    def _read(self, picked: DataFrame) -> DataFrame:
        """Changes of picked ledger rows: only their stretches are opened, and between their first and last version."""
        ends = picked.agg(F.min("version").alias("lo"), F.max("version").alias("hi"), F.collect_set("stretch").alias("stretches")).first()
        if not ends.stretches:
            return self.spark.createDataFrame([], _schema(self.spark, self.root))
        paths = [f"{self.root}/changes/{s}" for s in sorted(ends.stretches)]
        rows = self.spark.read.schema(_schema(self.spark, self.root)).parquet(*paths)
        return rows.filter(F.col(VERSION).between(ends.lo, ends.hi))

    def changes(self, start: int | None = None, end: int | None = None) -> DataFrame:
        """Changes of versions ``start`` to ``end``, both included; an open end means all there is."""
        rows = self.ledger()
        rows = rows if start is None else rows.filter(F.col("version") >= start)
        return self._read(rows if end is None else rows.filter(F.col("version") <= end))

    def changes_by_time(self, start: datetime, end: datetime | None = None) -> DataFrame:
        """As ``feed.between_timestamps``: the ledger turns the bounds (whole seconds, both included) into versions."""
        rows = self.ledger()
        rows = rows.filter(F.col("timestamp") >= _like(rows, start.replace(microsecond=0)))
        rows = rows if end is None else rows.filter(F.col("timestamp") <= _like(rows, end.replace(microsecond=0)))
        return feeds.between_timestamps(self._read(rows), start, end)

    def latest_changes(self, n: int = 1) -> DataFrame:
        """Changes of the last ``n`` versions."""
        last = self.latest_version()
        return self.changes(None if last is None else max(0, last - n + 1))

    def as_of(self, version: int | None = None) -> DataFrame:
        """The table at a version: the newest base at or before it, and the changes after that base."""
        gone = self.horizon()
        if gone is not None and version is not None and version < gone:
            raise ValueError(f"the history before version {gone} was given up")
        base = self._base(version)
        part = self.changes(None if base is None else base.base_version + 1, version)
        if base is None:
            return feeds.current(part, self.keys)
        columns = feeds.base_columns(part)
        old = self.spark.read.schema(part.select(*columns).schema).parquet(f"{self.root}/bases/{base.folder}")
        last = latest_per_key(part.filter(F.col(CHANGE_TYPE) != feeds.PRE), self.keys, [VERSION])
        touched = last.select(*[F.col(k).alias(f"__{k}") for k in self.keys])
        same = F.lit(True)
        for k in self.keys:
            same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
        live = last.filter(F.col(CHANGE_TYPE) != DELETE).select(*columns)
        return old.join(touched, same, "left_anti").select(*columns).unionByName(live)

    def as_of_time(self, ts: datetime) -> DataFrame:
        """The table at the last version committed at or before a time; without rows before the first one."""
        version = self.version_at(ts)
        return self.as_of(-1 if version is None else version)

    def incremental(self, start: int, end: int | None = None, where: str | Column | None = None) -> DataFrame:
        """As ``feed.incremental``: rows new or different at ``end`` compared to ``start``; opens the stretches between."""
        return feeds.incremental(self.changes(start + 1, end), self.keys, start, end, where)

    def incremental_by_time(self, start: datetime, end: datetime | None = None, where: str | Column | None = None) -> DataFrame:
        """As ``feed.incremental_by_time``."""
        rows = self.ledger()
        rows = rows.filter(F.col("timestamp") > _like(rows, start))
        rows = rows if end is None else rows.filter(F.col("timestamp") <= _like(rows, end))
        return feeds.incremental_by_time(self._read(rows), self.keys, start, end, where)


def _like(rows: DataFrame, ts: datetime) -> Column:
    """Literal of the type of the ledger's times."""
    return F.lit(ts.isoformat(sep=" ")).cast(rows.schema["timestamp"].dataType)


def _keep_schema(spark: SparkSession, root: str, schema: T.StructType) -> None:
    """The feed's schema, as a table without rows."""
    spark.createDataFrame([], schema).coalesce(1).write.mode("overwrite").parquet(f"{root}/feed_schema")


def _schema(spark: SparkSession, root: str) -> T.StructType:
    return spark.read.parquet(f"{root}/feed_schema").schema
