"""Queries: reading states and feeds, table mutation, differences, feed aggregates, histories."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import functions as F

from tidemark.functions import lineage, ordered
from tidemark.operators import apply, diff, envelope, feed, history, schema, tree
from tidemark.plans import inputs as i
from tidemark.plans.catalog import query
from tidemark.sinks import writers
from tidemark.sources import readers

KEY = ["o_orderkey"]
CURRENT_SQL = """SELECT user_id, event_type, value, props FROM chg
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1 AND op <> 'd'"""


def state_sql(where: str) -> str:
    return f"""SELECT user_id, event_type, value, props FROM (SELECT * FROM feed WHERE _change_type <> 'update_preimage' AND {where}
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY _commit_version DESC) = 1) WHERE _change_type <> 'delete'"""


def net_sql(lo: str, hi: str) -> str:
    """Rows that the state at hi has and the state at lo has not."""
    return f"""SELECT * FROM ({state_sql(hi)}) EXCEPT ALL SELECT * FROM ({state_sql(lo)})"""


def _table_name(part: str) -> str:
    """A catalog name of this run's own."""
    return f"tidemark_{part}_{uuid.uuid4().hex}"


@query("current_state_from_events", CURRENT_SQL, ("chg",))
def current_state_from_events(spark, sf):
    """Raw JSON envelopes -> good events -> last change per key -> live rows."""
    good, _ = envelope.split_invalid(envelope.parse(i.envelopes(spark, sf), i.ROW))
    # a delete without an old image is about a key that has no row
    keyed = good.withColumn("k", envelope.key_of(i.KEYS)).filter(F.col("k.user_id").isNotNull())
    rows = keyed.select("op", "offset", "timestamp", "k.user_id", "after.event_type", "after.value", "after.props")
    live = feed.current_of_changes(rows, i.KEYS, ["timestamp", "offset"])
    return live.select("user_id", "event_type", "value", "props")


@query("s4_current_state", state_sql("true"), ("feed",))
def current_state(spark, sf):
    return feed.current(i.change_feed(spark, sf), i.KEYS)


@query("s5_as_of_version", state_sql("_commit_version <= 14"), ("feed",))
def as_of_version(spark, sf):
    return feed.as_of_version(i.change_feed(spark, sf), i.KEYS, 14)


@query("s6_as_of_timestamp", state_sql("_commit_timestamp <= TIMESTAMP '2024-01-20 12:00:00'"), ("feed",))
def as_of_timestamp(spark, sf):
    return feed.as_of_timestamp(i.change_feed(spark, sf), i.KEYS, datetime(2024, 1, 20, 12))


@query("s7_feed_between_versions", "SELECT * FROM feed WHERE _commit_version BETWEEN 5 AND 9", ("feed",))
def feed_between_versions(spark, sf):
    return feed.between_versions(i.change_feed(spark, sf), 5, 9)


@query(
    "s7_stored_feed_between_versions",
    "SELECT * FROM feed WHERE _commit_version BETWEEN 5 AND 9",
    ("feed",),
)
def stored_feed_between_versions(spark, sf):
    """The same on a stored feed: the ledger says which stretches hold these versions."""
    return i.feed_store(spark, sf).changes(5, 9)


@query("s7_feed_folders_by_version", "SELECT * FROM feed WHERE _commit_version BETWEEN 5 AND 9", ("feed",))
def feed_folders_by_version(spark, sf):
    """The same on a feed with a folder per version, where the bounds prune folders."""
    path = lineage.scratch(spark)
    writers.append_feed(i.change_feed(spark, sf), path)
    return readers.change_feed(spark, path, start=5, end=9)


@query("s4_stored_state", state_sql("true"), ("feed",))
def stored_state(spark, sf):
    return i.feed_store(spark, sf).as_of()


@query("s5_stored_as_of_version", state_sql("_commit_version <= 14"), ("feed",))
def stored_as_of_version(spark, sf):
    """A base and one version after it."""
    return i.feed_store(spark, sf).as_of(14)


@query("s5_stored_before_base", state_sql("_commit_version <= 9"), ("feed",))
def stored_before_base(spark, sf):
    return i.feed_store(spark, sf).as_of(9)


@query("s6_stored_as_of_timestamp", state_sql("_commit_timestamp <= TIMESTAMP '2024-01-20 12:00:00'"), ("feed",))
def stored_as_of_timestamp(spark, sf):
    return i.feed_store(spark, sf).as_of_time(datetime(2024, 1, 20, 12))


@query(
    "s8_stored_between_timestamps",
    """SELECT * FROM feed WHERE _commit_timestamp BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-11 12:30:15'""",
    ("feed",),
)
def stored_between_timestamps(spark, sf):
    return i.feed_store(spark, sf).changes_by_time(datetime(2024, 1, 5, 0, 0, 0, 900), datetime(2024, 1, 11, 12, 30, 15, 999))


@query(
    "s9_stored_latest_versions",
    "SELECT * FROM feed WHERE _commit_version >= (SELECT greatest(0, max(_commit_version) - 2) FROM feed)",
    ("feed",),
)
def stored_latest_versions(spark, sf):
    return i.feed_store(spark, sf).latest_changes(3)


@query(
    "s11_stored_incremental_by_time",
    net_sql("_commit_timestamp <= TIMESTAMP '2024-01-10 06:00:00'", "_commit_timestamp <= TIMESTAMP '2024-01-22 06:00:00'"),
    ("feed",),
)
def stored_incremental_by_time(spark, sf):
    return i.feed_store(spark, sf).incremental_by_time(datetime(2024, 1, 10, 6), datetime(2024, 1, 22, 6))


@query(
    "k16_stored_retention",
    f"""SELECT s.*, (SELECT min(_commit_version) FROM feed WHERE _commit_timestamp >= TIMESTAMP '2024-01-15') AS first_version
    FROM ({state_sql("true")}) s""",
    ("feed",),
)
def stored_retention(spark, sf):
    """The table after the changes of the first two weeks were given up, and the first version that is left."""
    store = i.new_feed_store(spark, sf, lineage.scratch(spark))
    store.expire(datetime(2024, 1, 15))
    first = store.ledger().agg(F.min("version").alias("v")).select("v").scalar()
    return store.as_of().withColumn("first_version", first)


@query(
    "a8_planned_scan",
    f"""SELECT count(DISTINCT _commit_version) AS versions, count(DISTINCT least(_commit_version // 7, 3)) AS stretches, count(*) AS planned_changes,
      (SELECT count(*) FROM ({state_sql("_commit_version <= 18")})) AS table_rows
    FROM feed WHERE _commit_version BETWEEN 5 AND 18""",
    ("feed",),
)
def planned_scan(spark, sf):
    """What a read of versions 5 to 18 would open and give, and the table's rows at its end, without reading changes."""
    return i.feed_store(spark, sf).estimate(5, 18)


@query(
    "s8_feed_between_timestamps",
    """SELECT * FROM feed WHERE _commit_timestamp BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-11 12:30:15'""",
    ("feed",),
)
def feed_between_timestamps(spark, sf):
    return feed.between_timestamps(
        i.change_feed(spark, sf), datetime(2024, 1, 5, 0, 0, 0, 900), datetime(2024, 1, 11, 12, 30, 15, 999)
    )


@query(
    "s9_latest_versions",
    "SELECT * FROM feed WHERE _commit_version >= (SELECT greatest(0, max(_commit_version) - 2) FROM feed)",
    ("feed",),
)
def latest_versions(spark, sf):
    return feed.latest_versions(i.change_feed(spark, sf), 3)


@query(
    "s10_incremental_snapshots",
    """SELECT a.* FROM snap_a a LEFT JOIN snap_b b USING (o_orderkey)
    WHERE b.o_orderkey IS NULL OR a.o_totalprice <> b.o_totalprice""",
    ("snap_b", "snap_a"),
)
def incremental_snapshots(spark, sf):
    return diff.incremental(i.snapshot_before(spark, sf), i.snapshot_after(spark, sf), KEY)


@query("s10_incremental_versions", net_sql("_commit_version <= 8", "_commit_version <= 15"), ("feed",))
def incremental_versions(spark, sf):
    return feed.incremental(i.change_feed(spark, sf), i.KEYS, 8, 15)


@query(
    "s11_incremental_by_time",
    net_sql("_commit_timestamp <= TIMESTAMP '2024-01-10 06:00:00'", "_commit_timestamp <= TIMESTAMP '2024-01-22 06:00:00'"),
    ("feed",),
)
def incremental_by_time(spark, sf):
    f = i.change_feed(spark, sf)
    return feed.incremental_by_time(f, i.KEYS, datetime(2024, 1, 10, 6), datetime(2024, 1, 22, 6))


@query(
    "s12_latest_snapshots",
    net_sql("_commit_version <= (SELECT max(_commit_version) - 4 FROM feed)", "true"),
    ("feed",),
)
def latest_snapshots(spark, sf):
    return feed.latest_snapshots(i.change_feed(spark, sf), i.KEYS, 4)


@query(
    "s13_incremental_with_filter",
    f"SELECT * FROM ({net_sql('_commit_version <= 3', 'true')}) WHERE event_type = 'click' AND value > 20",
    ("feed",),
)
def incremental_with_filter(spark, sf):
    return feed.incremental(i.change_feed(spark, sf), i.KEYS, 3, where="event_type = 'click' AND value > 20")


@query(
    "s15_new_changes",
    "SELECT f.* FROM feed f WHERE _commit_version > (SELECT last_version FROM marks WHERE reader = 'reports')",
    ("feed", "marks"),
)
def new_changes(spark, sf):
    return feed.new_changes(i.change_feed(spark, sf), i.bookmarks(spark, sf), "reports")


@query(
    "s15_advance_bookmark",
    """SELECT reader, CASE WHEN reader = 'reports' THEN (SELECT max(_commit_version) FROM feed) ELSE last_version END AS last_version
    FROM marks""",
    ("feed", "marks"),
)
def advance_bookmark(spark, sf):
    return feed.advance_bookmark(i.change_feed(spark, sf), i.bookmarks(spark, sf), "reports")


@query(
    "s17_poll_by_column",
    "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate > TIMESTAMP '2001-01-15 00:00:00'",
)
def poll_by_column(spark, sf):
    new = readers.poll_by_column(i.read(spark, sf, "orders"), "o_orderdate", datetime(2001, 1, 15))
    return new.select("o_orderkey", "o_orderdate")


@query(
    "s2_bounded_batch",
    "SELECT event_id, user_id, event_type, ts FROM events",
)
def bounded_batch(spark, sf):
    d = readers.change_batch(spark, "parquet", f"{sf}/events.parquet", schema=None)
    return d.select("event_id", "user_id", "event_type", "ts")


@query(
    "s19_feed_schema",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, 'insert' AS _change_type,
      CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS BIGINT) AS _commit_version,
      o_orderdate AS _commit_timestamp FROM orders""",
)
def feed_schema(spark, sf):
    """The whole table as the first load of its feed, in the feed's schema."""
    o = i.read(spark, sf, "orders").select(*i.ORDER_ROW)
    day = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1995-01-01").cast("date"))
    load = o.withColumns(
        {"_commit_timestamp": F.col("o_orderdate"), "_commit_version": day.cast("string"), "_change_type": F.lit(feed.INSERT)}
    )
    d = schema.conform(load, feed.schema_of(o))
    return d.withColumn("_commit_timestamp", i.wall("_commit_timestamp"))


# table mutation


@query(
    "k1_append",
    "SELECT * FROM snap_b UNION ALL SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '2001-06-01'",
    ("snap_b",),
)
def append(spark, sf):
    path = lineage.scratch(spark)
    o = i.read(spark, sf, "orders")
    writers.append(i.snapshot_before(spark, sf), path)
    writers.append(o.filter(F.col("o_orderdate") >= F.expr("timestamp_ntz'2001-06-01'")), path)
    return spark.read.parquet(path)


@query(
    "k2_partitioned_write",
    """SELECT o_orderstatus, count(*) AS orders, count(DISTINCT o_orderkey) AS keys FROM orders GROUP BY 1""",
)
def partitioned_write(spark, sf):
    path = lineage.scratch(spark)
    writers.append(i.read(spark, sf, "orders"), path, partition_by=["o_orderstatus"])
    d = spark.read.parquet(path)
    return d.groupBy("o_orderstatus").agg(F.count("*").alias("orders"), F.countDistinct("o_orderkey").alias("keys"))


@query(
    "k3_time_partitions",
    """SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS o_orderdate_month, count(*) AS orders,
      CAST(min(o_orderdate) AS DATE) AS first_day FROM orders GROUP BY 1""",
)
def time_partitions(spark, sf):
    path = lineage.scratch(spark)
    writers.time_partitioned(
        i.read(spark, sf, "orders").select("o_orderkey", "o_orderdate"), path, "o_orderdate", "month"
    )
    d = spark.read.parquet(path)
    return d.groupBy("o_orderdate_month").agg(
        F.count("*").alias("orders"), F.min("o_orderdate").cast("date").alias("first_day")
    )


@query(
    "k4_sorted_write",
    "SELECT count(*) AS orders, CAST(0 AS BIGINT) AS out_of_order FROM orders",
)
def sorted_write(spark, sf):
    path = lineage.scratch(spark)
    writers.append(i.read(spark, sf, "orders").select("o_orderkey", "o_custkey"), path, sort_by=["o_custkey", "o_orderkey"])
    d = spark.read.parquet(path).select(
        "o_custkey", "o_orderkey", F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("n")
    )
    # neighbours in a file, found by an equi join on file and row number
    nxt = d.select("f", (F.col("n") - 1).alias("n"), F.struct("o_custkey", "o_orderkey").alias("next"))
    pairs = d.join(nxt, ["f", "n"], "left")
    return pairs.agg(
        F.count("*").alias("orders"),
        F.count_if(F.struct("o_custkey", "o_orderkey") > F.col("next")).alias("out_of_order"),
    )


@query("k5_ensure_table", "SELECT o_orderstatus, count(*) AS orders FROM orders GROUP BY 1")
def ensure_table(spark, sf):
    rows = i.read(spark, sf, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("orders"))
    name = _table_name("k5")
    writers.drop_table(spark, name)
    path = lineage.scratch(spark)
    writers.ensure_table(spark, name, rows.schema, path=path)
    writers.ensure_table(spark, name, rows.schema, path=path)
    rows.write.insertInto(name)
    return spark.read.parquet(path)


@query(
    "k8_apply_changes",
    CURRENT_SQL,
    ("chg",),
)
def apply_changes(spark, sf):
    """First half of the log makes the table, the second half is applied to it."""
    c = i.changes(spark, sf)
    later = F.col("ts") >= F.expr("timestamp_ntz'2024-01-16'")
    base = feed.current_of_changes(c.filter(~later), i.KEYS, i.ORDER).select("user_id", *i.FEED_ROW)
    return apply.apply_changes(base, c.filter(later), i.KEYS, i.ORDER)


@query(
    "k8_apply_changes_merge",
    CURRENT_SQL,
    ("chg",),
)
def apply_changes_merge(spark, sf):
    c = i.changes(spark, sf)
    later = F.col("ts") >= F.expr("timestamp_ntz'2024-01-16'")
    base = feed.current_of_changes(c.filter(~later), i.KEYS, i.ORDER).select("user_id", *i.FEED_ROW)
    return apply.apply_changes(base, c.filter(later), i.KEYS, i.ORDER, strategy="merge")


UPSERT_SQL = """SELECT * FROM snap_a UNION ALL
  SELECT b.* FROM snap_b b WHERE b.o_orderkey NOT IN (SELECT o_orderkey FROM snap_a)"""


@query(
    "k8_apply_changes_bucketed",
    """SELECT * FROM snap_a""",
    ("snap_a",),
)
def apply_changes_bucketed(spark, sf):
    """The old state is a table bucketed by its key; only the changes are shuffled to it."""
    b, a = i.snapshot_before(spark, sf), i.snapshot_after(spark, sf)
    name = _table_name("k8")
    writers.drop_table(spark, name)
    writers.save_bucketed(b, name, KEY, 8, path=lineage.scratch(spark))
    d = diff.snapshot_diff(b, a, KEY, images=False)
    ops = d.withColumn("op", F.when(F.col("_change_type") == "delete", "d").otherwise("u")).withColumn("n", F.lit(1))
    return apply.apply_changes(spark.table(name), ops, KEY, ["n"], strategy="merge")


@query("k9_upsert", UPSERT_SQL, ("snap_b", "snap_a"))
def upsert(spark, sf):
    return apply.upsert(i.snapshot_before(spark, sf), i.snapshot_after(spark, sf), KEY)


@query(
    "k10_delete_keys",
    "SELECT b.* FROM snap_b b WHERE b.o_orderkey NOT IN (SELECT o_orderkey FROM snap_a)",
    ("snap_b", "snap_a"),
)
def delete_keys(spark, sf):
    return apply.delete_keys(i.snapshot_before(spark, sf), i.snapshot_after(spark, sf), KEY)


@query(
    "k11_delete_where",
    "SELECT customer_id, email, lifetime_value FROM cust WHERE NOT coalesce(email LIKE '%1@%' AND lifetime_value < 500, false)",
    ("cust",),
)
def delete_where(spark, sf):
    c = i.customers(spark, sf).select("customer_id", "email", "lifetime_value")
    return apply.delete_where(c, "email LIKE '%1@%' AND lifetime_value < 500")


@query("k12_overwrite", "SELECT * FROM snap_a", ("snap_a",))
def overwrite(spark, sf):
    path = lineage.scratch(spark)
    writers.overwrite(i.snapshot_before(spark, sf), path)
    writers.overwrite(i.snapshot_after(spark, sf), path)
    return spark.read.parquet(path)


@query(
    "k13_replace_where",
    """SELECT * FROM snap_b WHERE o_orderstatus <> 'F'
    UNION ALL SELECT * FROM snap_a WHERE o_orderstatus = 'F'""",
    ("snap_b", "snap_a"),
)
def replace_where(spark, sf):
    new = i.snapshot_after(spark, sf).filter("o_orderstatus = 'F'")
    return apply.replace_where(i.snapshot_before(spark, sf), new, "o_orderstatus = 'F'")


@query(
    "k13_replace_partitions",
    """SELECT * FROM snap_b WHERE o_orderstatus <> 'F'
    UNION ALL SELECT * FROM snap_a WHERE o_orderstatus = 'F'""",
    ("snap_b", "snap_a"),
)
def replace_partitions(spark, sf):
    path = lineage.scratch(spark)
    writers.append(i.snapshot_before(spark, sf), path, partition_by=["o_orderstatus"])
    new = i.snapshot_after(spark, sf).filter("o_orderstatus = 'F'")
    writers.replace_partitions(new, path, ["o_orderstatus"])
    return spark.read.parquet(path)


@query(
    "k14_append_evolving",
    """SELECT o_orderkey, o_totalprice, o_orderpriority, CAST(NULL AS VARCHAR) AS channel FROM snap_b
    UNION ALL SELECT o_orderkey, o_totalprice, NULL, 'web' FROM snap_a""",
    ("snap_b", "snap_a"),
)
def append_evolving(spark, sf):
    old = i.snapshot_before(spark, sf).select("o_orderkey", "o_totalprice", "o_orderpriority")
    new = i.snapshot_after(spark, sf).select("o_orderkey", "o_totalprice", F.lit("web").alias("channel"))
    return apply.append_evolving(old, new)


@query("k15_compact", "SELECT * FROM snap_b UNION ALL SELECT * FROM snap_a", ("snap_b", "snap_a"))
def compact(spark, sf):
    many, few = lineage.scratch(spark), lineage.scratch(spark)
    writers.append(i.snapshot_before(spark, sf).repartition(12), many)
    writers.append(i.snapshot_after(spark, sf).repartition(12), many)
    writers.compact(spark.read.parquet(many), few, order_by=["o_custkey"], target_bytes=2**19)
    return spark.read.parquet(few)


@query("k15_clustered", "SELECT * FROM lineitem")
def clustered(spark, sf):
    """Clustered on two columns at once; filters on either skip files."""
    path = lineage.scratch(spark)
    writers.cluster(i.read(spark, sf, "lineitem"), path, ["l_partkey", "l_shipdate"], target_bytes=2**17)
    return spark.read.parquet(path)


@query("k16_expire", state_sql("true"), ("feed",))
def expire(spark, sf):
    """The table is the same after its early history was folded away."""
    return feed.current(feed.expire(i.change_feed(spark, sf), i.KEYS, datetime(2024, 1, 15)), i.KEYS)


@query(
    "k16_expired_history",
    f"""SELECT _commit_version, count(*) AS changes FROM (
      SELECT _commit_version FROM feed WHERE _commit_timestamp >= TIMESTAMP '2024-01-15'
      UNION ALL SELECT (SELECT max(_commit_version) FROM feed WHERE _commit_timestamp < TIMESTAMP '2024-01-15')
        FROM ({state_sql("_commit_timestamp < TIMESTAMP '2024-01-15'")})) GROUP BY 1""",
    ("feed",),
)
def expired_history(spark, sf):
    left = feed.expire(i.change_feed(spark, sf), i.KEYS, datetime(2024, 1, 15))
    return left.groupBy("_commit_version").agg(F.count("*").alias("changes"))


@query("k17_restore", state_sql("_commit_version <= 12"), ("feed",))
def restore(spark, sf):
    """Current table after the changes that take it back to version 12."""
    f = i.change_feed(spark, sf)
    return feed.current(f.unionByName(feed.restore_changes(f, i.KEYS, 12, datetime(2024, 2, 1))), i.KEYS)


@query(
    "k18_table_info",
    f"""SELECT max(_commit_version) AS latest_version, min(_commit_version) AS first_version,
      max(_commit_timestamp) AS last_modified, count(*) AS changes,
      (SELECT count(*) FROM ({state_sql('true')})) AS live_rows, true AS change_feed_enabled, 'user_id' AS key_columns,
      '_commit_version' AS partition_columns, CAST(NULL AS VARCHAR) AS location FROM feed""",
    ("feed",),
)
def table_info(spark, sf):
    return feed.table_info(i.change_feed(spark, sf), i.KEYS, ["_commit_version"])


@query(
    "k20_postimages",
    "SELECT user_id, event_type, value, props FROM feed WHERE _change_type IN ('insert', 'update_postimage')",
    ("feed",),
)
def postimages(spark, sf):
    return feed.postimages(i.change_feed(spark, sf))


SOFT_SQL = """WITH lst AS (SELECT *, ts >= TIMESTAMP '2024-01-16' AS late FROM chg),
  base AS (SELECT * FROM lst WHERE NOT late
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1 AND op <> 'd'),
  new AS (SELECT * FROM lst WHERE late QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
  SELECT user_id, event_type, value, props, false AS is_deleted FROM new WHERE op <> 'd'
  UNION ALL SELECT b.user_id, b.event_type, b.value, b.props, n.user_id IS NOT NULL FROM base b LEFT JOIN new n USING (user_id)
    WHERE n.user_id IS NULL OR n.op = 'd'"""


def _soft(spark, sf, strategy):
    c = i.changes(spark, sf)
    later = F.col("ts") >= F.expr("timestamp_ntz'2024-01-16'")
    base = feed.current_of_changes(c.filter(~later), i.KEYS, i.ORDER).select("user_id", *i.FEED_ROW)
    return apply.apply_changes(base, c.filter(later), i.KEYS, i.ORDER, on_delete="mark", strategy=strategy)


@query("k21_soft_delete", SOFT_SQL, ("chg",))
def soft_delete(spark, sf):
    return _soft(spark, sf, "probe")


@query("k21_soft_delete_merge", SOFT_SQL, ("chg",))
def soft_delete_merge(spark, sf):
    return _soft(spark, sf, "merge")


@query("k22_drop_table", "SELECT count(*) AS orders, false AS table_exists FROM orders")
def drop_table(spark, sf):
    name = _table_name("k22")
    o = i.read(spark, sf, "orders").select("o_orderkey")
    writers.drop_table(spark, name)
    writers.ensure_table(spark, name, o.schema, path=lineage.scratch(spark))
    writers.drop_table(spark, name)
    there = spark.catalog.tableExists(name)
    return o.agg(F.count("*").alias("orders")).withColumn("table_exists", F.lit(there))


# feeds


@query("f5_feed_inserts", "SELECT * FROM feed WHERE _change_type = 'insert'", ("feed",))
def feed_inserts(spark, sf):
    return feed.inserts(i.change_feed(spark, sf))


@query("f5_feed_updates", "SELECT * FROM feed WHERE _change_type IN ('update_preimage', 'update_postimage')", ("feed",))
def feed_updates(spark, sf):
    return feed.updates(i.change_feed(spark, sf))


@query("f5_feed_deletes", "SELECT * FROM feed WHERE _change_type = 'delete'", ("feed",))
def feed_deletes(spark, sf):
    return feed.deletes(i.change_feed(spark, sf))


@query("a1_change_summary", "SELECT _change_type, count(*) AS changes FROM feed GROUP BY 1", ("feed",))
def change_summary(spark, sf):
    return feed.summary(i.change_feed(spark, sf))


A2_SQL = """SELECT count(*) AS total_changes, count(*) FILTER (WHERE _change_type = 'insert') AS inserts,
      count(*) FILTER (WHERE _change_type = 'update_postimage') AS updates,
      count(*) FILTER (WHERE _change_type = 'delete') AS deletes, min(_commit_version) AS first_version,
      max(_commit_version) AS last_version, min(_commit_timestamp) AS first_timestamp,
      max(_commit_timestamp) AS last_timestamp, max(_commit_version) - min(_commit_version) + 1 AS version_count FROM feed"""


@query(
    "a2_change_statistics",
    A2_SQL,
    ("feed",),
)
def change_statistics(spark, sf):
    return i.feed_store(spark, sf).change_stats()


@query("a2_change_statistics_of_rows", A2_SQL, ("feed",))
def change_statistics_of_rows(spark, sf):
    return feed.stats(i.change_feed(spark, sf))


@query(
    "a3_changes_by_version",
    """SELECT _commit_version, count(*) FILTER (WHERE _change_type = 'insert') AS inserts,
      count(*) FILTER (WHERE _change_type LIKE 'update%') // 2 AS updates,
      count(*) FILTER (WHERE _change_type = 'delete') AS deletes FROM feed GROUP BY 1""",
    ("feed",),
)
def changes_by_version(spark, sf):
    kind = F.col(feed.CHANGE_TYPE)
    return i.change_feed(spark, sf).groupBy("_commit_version").agg(
        F.count_if(kind == feed.INSERT).alias("inserts"),
        F.count_if(kind == feed.POST).alias("updates"),
        F.count_if(kind == feed.DELETE).alias("deletes"),
    )


@query("a7_row_estimate", "SELECT count(*) AS estimated_rows, count(*) = 0 AS is_empty FROM orders")
def row_estimate(spark, sf):
    return feed.row_estimate(i.read(spark, sf, "orders"))


@query(
    "a7_row_count",
    "SELECT count(*) AS row_count, count(*) = 0 AS is_empty FROM orders WHERE o_totalprice > 100000",
)
def row_count(spark, sf):
    return feed.row_count(i.read(spark, sf, "orders"), "o_totalprice > 100000")


@query(
    "a9_compare_states",
    """SELECT (SELECT count(*) FROM snap_b) AS rows_before, (SELECT count(*) FROM snap_a) AS rows_after,
      (SELECT count(*) FROM snap_a) - (SELECT count(*) FROM snap_b) AS row_difference, false AS schema_changed""",
    ("snap_b", "snap_a"),
)
def compare_states(spark, sf):
    return diff.compare_states(i.snapshot_before(spark, sf), i.snapshot_after(spark, sf))


SIZE_SQL = """strlen(CAST(o_orderkey AS VARCHAR)) + strlen(CAST(o_custkey AS VARCHAR)) + strlen(o_orderstatus)
  + strlen(o_orderpriority)"""


@query(
    "a9_compare_sizes",
    f"""SELECT count(*) FILTER (WHERE b) AS rows_before, count(*) FILTER (WHERE NOT b) AS rows_after,
      CAST(sum(z) FILTER (WHERE b) AS BIGINT) AS bytes_before, CAST(sum(z) FILTER (WHERE NOT b) AS BIGINT) AS bytes_after,
      count(*) FILTER (WHERE NOT b) - count(*) FILTER (WHERE b) AS row_difference,
      CAST(sum(CASE WHEN b THEN -z ELSE z END) AS BIGINT) AS byte_difference, false AS schema_changed
    FROM (SELECT true AS b, {SIZE_SQL} AS z FROM snap_b UNION ALL SELECT false, {SIZE_SQL} FROM snap_a)""",
    ("snap_b", "snap_a"),
)
def compare_sizes(spark, sf):
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]
    b, a = i.snapshot_before(spark, sf).select(*columns), i.snapshot_after(spark, sf).select(*columns)
    return diff.compare_states(b, a, sizes=True)


AUDIT_SQL = """SELECT user_id, _commit_version, _change_type, value, row_number() OVER w AS step,
      lag(CASE WHEN _change_type <> 'delete' THEN value END) OVER w AS previous_value,
      round(CASE WHEN _change_type <> 'delete' THEN value END - lag(CASE WHEN _change_type <> 'delete' THEN value END) OVER w, 6) AS delta
    FROM feed WHERE _change_type <> 'update_preimage' WINDOW w AS (PARTITION BY user_id ORDER BY _commit_version)"""


@query("w3_audit_trail", AUDIT_SQL, ("feed",))
def audit_trail(spark, sf):
    return _audited(spark, sf, hot_rows=ordered.HOT_ROWS)


@query("w3_audit_trail_cut", AUDIT_SQL, ("feed",))
def audit_trail_cut(spark, sf):
    """Every key's changes are cut by a range of versions, as those of a hot key are."""
    return _audited(spark, sf, hot_rows=0)


def _audited(spark, sf, hot_rows):
    bucket = ordered.range_bucket("_commit_version", 7)
    d = feed.audit_trail(i.change_feed(spark, sf), i.KEYS, "value", bucket, hot_rows)
    return d.select(
        "user_id", "_commit_version", "_change_type", "value", "step", "previous_value", F.round("delta", 6).alias("delta")
    )


@query(
    "t3_limited_query",
    """SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'O' ORDER BY o_totalprice DESC, o_orderkey LIMIT 20""",
)
def limited_query(spark, sf):
    o = i.read(spark, sf, "orders").filter("o_orderstatus = 'O'").select("o_orderkey", "o_totalprice")
    return o.orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(20)


@query(
    "z1_process_changes",
    """SELECT count(*) AS rows_in, count(*) FILTER (WHERE _change_type = 'insert') AS rows_out, 'success' AS status FROM feed""",
    ("feed",),
)
def process_changes(spark, sf):
    return feed.process_status(i.change_feed(spark, sf), feed.inserts)


# differences


@query(
    "j4_snapshot_diff",
    """SELECT o_orderkey, o_totalprice, o_orderstatus, 'insert' AS _change_type FROM snap_a a
      WHERE o_orderkey IN (SELECT o_orderkey FROM diff WHERE kind = 'insert')
    UNION ALL SELECT o_orderkey, o_totalprice, o_orderstatus, 'delete' FROM snap_b
      WHERE o_orderkey IN (SELECT o_orderkey FROM diff WHERE kind = 'delete')
    UNION ALL SELECT o_orderkey, o_totalprice, o_orderstatus, 'update_preimage' FROM snap_b
      WHERE o_orderkey IN (SELECT o_orderkey FROM diff WHERE kind = 'update')
    UNION ALL SELECT o_orderkey, o_totalprice, o_orderstatus, 'update_postimage' FROM snap_a
      WHERE o_orderkey IN (SELECT o_orderkey FROM diff WHERE kind = 'update')""",
    ("diff",),
)
def snapshot_diff(spark, sf):
    d = diff.snapshot_diff(i.snapshot_before(spark, sf), i.snapshot_after(spark, sf), KEY)
    return d.select("o_orderkey", "o_totalprice", "o_orderstatus", "_change_type")


@query(
    "j4_snapshot_diff_by_hash",
    """SELECT kind || CASE WHEN kind = 'update' THEN s ELSE '' END AS change, count(*) AS "rows"
    FROM diff, (VALUES ('_preimage'), ('_postimage')) t(s) WHERE kind = 'update' OR (kind IS NOT NULL AND s = '_preimage')
    GROUP BY 1""",
    ("diff",),
)
def snapshot_diff_by_hash(spark, sf):
    """The same difference, found by hash before any row is joined."""
    d = diff.snapshot_diff(i.snapshot_before(spark, sf), i.snapshot_after(spark, sf), KEY, strategy="hashes")
    return d.groupBy(F.col("_change_type").alias("change")).agg(F.count("*").alias("rows"))


TREE = {"leaf_bits": 5, "levels": 4}
TREE_WIDTH = " UNION ALL ".join(f"SELECT {level} AS level, o_orderkey >> {5 + 6 * level} AS node FROM snap_b" for level in range(4))


@query("x11_checksum_tree", f'SELECT level, node, count(*) AS "rows" FROM ({TREE_WIDTH}) GROUP BY 1, 2', ("snap_b",))
def checksum_tree(spark, sf):
    """The tree of a table, added up from trees of its parts, one of which went again."""
    b = i.snapshot_before(spark, sf)
    late = F.col("o_orderdate") >= F.expr("timestamp_ntz'2000-01-01'")
    parts = [tree.build(part, "o_orderkey", **TREE) for part in (b.filter(~late), b.filter(late), b.filter(late))]
    return tree.combine(*parts, tree.build(b.filter(late), "o_orderkey", **TREE, sign=-1)).select("level", "node", "rows")


@query("j3_tree_diff", "SELECT o_orderkey, kind FROM diff WHERE kind IS NOT NULL", ("diff",))
def tree_diff(spark, sf):
    """Differing keys, found from the top of two trees down; rows are read in differing ranges only."""
    b, a = i.snapshot_before(spark, sf), i.snapshot_after(spark, sf)
    trees = [tree.build(d, "o_orderkey", **TREE) for d in (b, a)]
    return diff.paired(*tree.compare(b, a, *trees, "o_orderkey", **TREE), KEY).select("o_orderkey", "kind")


@query(
    "j1_apply_diff_gives_after",
    "SELECT * FROM snap_a",
    ("snap_a",),
)
def apply_diff(spark, sf):
    """Applying a snapshot difference to the old state gives the new one."""
    b, a = i.snapshot_before(spark, sf), i.snapshot_after(spark, sf)
    d = diff.snapshot_diff(b, a, KEY, images=False)
    ops = d.withColumn("op", F.when(F.col("_change_type") == "delete", "d").otherwise("u")).withColumn("n", F.lit(1))
    return apply.apply_changes(b, ops, KEY, ["n"])


@query("u2_changed_files", "SELECT 'added' AS change, count(*) > 0 AS some FROM orders")
def changed_files(spark, sf):
    path = lineage.scratch(spark)
    writers.append(i.snapshot_before(spark, sf), path)
    old = diff.file_listing(spark.read.parquet(path))
    old_rows = lineage.cut(old)
    writers.append(i.snapshot_after(spark, sf), path)
    changed = diff.files(old_rows, diff.file_listing(spark.read.parquet(path)))
    return changed.groupBy("change").agg((F.count("*") > 0).alias("some"))


# histories


@query("h1_version_history", "SELECT version, ts, inserted, updated, deleted FROM hist", ("hist",))
def version_history(spark, sf):
    return _history_rows(i.feed_store(spark, sf).history())


@query("h1_version_history_of_rows", "SELECT version, ts, inserted, updated, deleted FROM hist", ("hist",))
def version_history_of_rows(spark, sf):
    """The same from the feed's rows."""
    return _history_rows(history.from_changes(i.change_feed(spark, sf)))


def _history_rows(h):
    m = F.col("metrics")
    return h.select(
        "version", F.col("timestamp").alias("ts"), *[m[k].cast("bigint").alias(k) for k in ("inserted", "updated", "deleted")]
    )


@query("h2_version_info", "SELECT version, ts, operation FROM hist WHERE version = 7", ("hist",))
def version_info(spark, sf):
    return history.get(i.versions(spark, sf), 7).select("version", F.col("timestamp").alias("ts"), "operation")


@query("h3_versions_between", "SELECT version, operation FROM hist WHERE version BETWEEN 10 AND 19", ("hist",))
def versions_between(spark, sf):
    return history.between(i.versions(spark, sf), 10, 19).select("version", "operation")


@query("h4_versions_since", "SELECT version, operation FROM hist WHERE ts >= TIMESTAMP '2024-01-21'", ("hist",))
def versions_since(spark, sf):
    return history.since(i.versions(spark, sf), datetime(2024, 1, 21)).select("version", "operation")


@query(
    "h5_range_for_period",
    """SELECT min(version) AS first_version, max(version) AS last_version FROM hist
    WHERE ts BETWEEN TIMESTAMP '2024-01-06' AND TIMESTAMP '2024-01-09 12:00:00'""",
    ("hist",),
)
def range_for_period(spark, sf):
    return history.range_for_period(i.versions(spark, sf), datetime(2024, 1, 6), datetime(2024, 1, 9, 12))


@query("h6_version_at", "SELECT max(version) AS version FROM hist WHERE ts <= TIMESTAMP '2024-01-17 09:00:00'", ("hist",))
def version_at(spark, sf):
    return history.as_of(i.versions(spark, sf), datetime(2024, 1, 17, 9))


@query("h6_version_before_first", "SELECT CAST(NULL AS BIGINT) AS version FROM hist LIMIT 1", ("hist",))
def version_before_first(spark, sf):
    return history.as_of(i.versions(spark, sf), datetime(2023, 12, 1))


@query("h6_snapshot_before_first", "SELECT min(snapshot_id) AS snapshot_id FROM snaps", ("snaps",))
def snapshot_before_first(spark, sf):
    return history.as_of(i.snapshots(spark, sf), datetime(2023, 12, 1), earliest_if_before=True)


@query(
    "j6_version_of_each_event",
    """SELECT e.event_id, (SELECT max(h.version) FROM hist h WHERE h.ts <= e.ts) AS version FROM events e""",
    ("hist",),
)
def version_of_each_event(spark, sf):
    probes = i.read(spark, sf, "events").select("event_id", "ts")
    return history.as_of_many(probes, i.versions(spark, sf), "ts", "minute").select("event_id", "version")


@query("h7_snapshot_info", "SELECT * FROM snaps WHERE snapshot_id = 1140", ("snaps",))
def snapshot_info(spark, sf):
    s = history.get(i.snapshots(spark, sf), 1140)
    return s.select("snapshot_id", "parent_snapshot_id", F.col("timestamp").alias("ts"), "operation")


CHAIN_SQL = """WITH RECURSIVE line AS (SELECT snapshot_id, parent_snapshot_id, ts FROM snaps WHERE snapshot_id = {end}
  UNION ALL SELECT s.snapshot_id, s.parent_snapshot_id, s.ts FROM snaps s JOIN line l ON s.snapshot_id = l.parent_snapshot_id)
"""


@query(
    "h8_snapshot_chain",
    CHAIN_SQL.format(end=1175) + "SELECT snapshot_id FROM line WHERE snapshot_id >= 1035",
    ("snaps",),
)
def snapshot_chain(spark, sf):
    return history.chain(i.snapshots(spark, sf), 1175, 1035).select("snapshot_id")


@query("j8_ancestors", CHAIN_SQL.format(end=1189) + "SELECT snapshot_id FROM line", ("snaps",))
def ancestors(spark, sf):
    return history.ancestors(i.snapshots(spark, sf), 1189)


@query(
    "h9_is_ancestor",
    CHAIN_SQL.format(end=1175) + "SELECT count(*) FILTER (WHERE snapshot_id = 1105) > 0 AS is_ancestor FROM line",
    ("snaps",),
)
def is_ancestor(spark, sf):
    return history.is_ancestor(i.snapshots(spark, sf), 1105, 1175)


@query(
    "t1_latest_versions",
    "SELECT version, operation FROM hist ORDER BY ts DESC, version DESC LIMIT 5",
    ("hist",),
)
def latest_version_rows(spark, sf):
    return history.latest(i.versions(spark, sf), 5).select("version", "operation")


@query(
    "t2_latest_snapshots",
    "SELECT snapshot_id, parent_snapshot_id FROM snaps ORDER BY ts DESC, snapshot_id DESC LIMIT 3",
    ("snaps",),
)
def latest_snapshot_rows(spark, sf):
    return history.latest(i.snapshots(spark, sf), 3).select("snapshot_id", "parent_snapshot_id")


@query("a4_operation_counts", "SELECT operation, count(*) AS versions FROM hist GROUP BY 1", ("hist",))
def operation_counts(spark, sf):
    return history.operation_counts(i.versions(spark, sf))


@query(
    "a5_operations_summary",
    """SELECT count(*) AS versions, count(*) FILTER (WHERE operation IN ('WRITE', 'MERGE')) AS writes,
      count(*) FILTER (WHERE operation = 'DELETE') AS deletes, min(ts) AS first_timestamp, max(ts) AS last_timestamp
    FROM hist WHERE version BETWEEN 4 AND 22""",
    ("hist",),
)
def operations_summary(spark, sf):
    return history.operations_summary(i.versions(spark, sf), 4, 22)


@query(
    "a6_snapshot_statistics",
    """SELECT count(*) AS entries, arg_min(snapshot_id, ts) AS first_id, arg_max(snapshot_id, ts) AS last_id,
      min(ts) AS first_timestamp, max(ts) AS last_timestamp,
      round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6, 3) AS span_seconds,
      count(*) FILTER (WHERE operation = 'MERGE') AS merges FROM snaps""",
    ("snaps",),
)
def snapshot_statistics(spark, sf):
    s = history.statistics(i.snapshots(spark, sf))
    return s.select(
        "entries", "first_id", "last_id", "first_timestamp", "last_timestamp",
        F.round("span_seconds", 3).alias("span_seconds"), F.col("operations")["MERGE"].alias("merges"),
    )


@query(
    "a8_range_statistics",
    CHAIN_SQL.format(end=1175)
    + """SELECT count(*) AS snapshots, min(ts) AS first_timestamp, max(ts) AS last_timestamp,
      round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6, 3) AS span_seconds FROM line WHERE snapshot_id >= 1035""",
    ("snaps",),
)
def range_statistics(spark, sf):
    s = history.range_statistics(i.snapshots(spark, sf), 1175, 1035)
    return s.withColumn("span_seconds", F.round("span_seconds", 3))


@query(
    "a10_compare_versions",
    """SELECT a.operation AS first_operation, b.operation AS second_operation, a.ts AS first_timestamp,
      b.ts AS second_timestamp, (SELECT count(*) FROM hist WHERE version > 3 AND version < 18) AS versions_between,
      round((epoch_us(b.ts) - epoch_us(a.ts)) / 1e6, 3) AS seconds_apart
    FROM hist a, hist b WHERE a.version = 3 AND b.version = 18""",
    ("hist",),
)
def compare_versions(spark, sf):
    c = history.compare(i.versions(spark, sf), 3, 18)
    return c.withColumn("seconds_apart", F.round("seconds_apart", 3))


@query(
    "a14_pending_versions",
    """SELECT reader, last_version, (SELECT max(version) FROM hist) AS latest_version,
      (SELECT max(version) FROM hist) - last_version AS pending FROM marks""",
    ("hist", "marks"),
)
def pending_versions(spark, sf):
    return history.pending(i.versions(spark, sf), i.bookmarks(spark, sf))


@query(
    "a14_pending_snapshots",
    CHAIN_SQL.format(end=1189) + "SELECT count(*) AS pending FROM line WHERE snapshot_id > 1063",
    ("snaps",),
)
def pending_snapshots(spark, sf):
    return history.pending_snapshots(i.snapshots(spark, sf), 1189, 1063)



@query("a20_table_files", 'SELECT count(*) AS "rows", CAST(1 AS BIGINT) AS files FROM orders')
def table_files(spark, sf):
    d = diff.file_listing(i.read(spark, sf, "orders"))
    return d.agg(F.sum("rows").alias("rows"), F.count("*").alias("files"))
