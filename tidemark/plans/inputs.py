"""Inputs of the registered queries, derived by Spark from the given tables, with their SQL twins.

Each input covers the whole table it comes from.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import lineage
from tidemark.operators import envelope, feed, schema
from tidemark.sinks.feed_store import FeedStore

ROW = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
        T.StructField("updated_at", T.LongType()),
    ]
)
KEYS, ORDER = ["user_id"], ["ts", "event_id"]
FEED_ROW = ["event_type", "value", "props"]
ORDER_ROW = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
CONSUMED_UNTIL = datetime(2024, 1, 28)

SQL = {
    "chg": """SELECT event_id, ts, user_id, event_type, value, props,
        CASE event_type WHEN 'signup' THEN 'c' WHEN 'view' THEN 'r' WHEN 'error' THEN 'd' ELSE 'u' END AS op,
        CASE WHEN event_type = 'purchase' THEN 'carts' ELSE 'users' END AS tbl,
        CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS BIGINT) AS ver,
        epoch_us(ts) // 1000 AS ts_ms, CAST(epoch_us(ts) AS BIGINT) AS updated_at
      FROM events""",
    "env": """SELECT *, coalesce(op IN ('u', 'd') AND p_op <> 'd', false) AS has_before FROM (
        SELECT *, lag(op) OVER w AS p_op, lag(event_type) OVER w AS p_event_type, lag(value) OVER w AS p_value,
          lag(props) OVER w AS p_props, lag(updated_at) OVER w AS p_updated_at
        FROM chg WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))""",
    "last_ver": """SELECT * FROM chg QUALIFY row_number() OVER (
        PARTITION BY user_id, ver ORDER BY ts DESC, event_id DESC) = 1""",
    "steps": """SELECT *, lag(op) OVER w AS p_op, lag(event_type) OVER w AS p_event_type,
        lag(value) OVER w AS p_value, lag(props) OVER w AS p_props
      FROM last_ver WINDOW w AS (PARTITION BY user_id ORDER BY ver)""",
    "commits": "SELECT ver, max(ts) AS cts FROM chg GROUP BY ver",
    "feed": """SELECT f.*, c.cts AS _commit_timestamp FROM (
        SELECT user_id, event_type, value, props, 'insert' AS _change_type, ver AS _commit_version
          FROM steps WHERE coalesce(p_op, 'd') = 'd' AND op <> 'd'
        UNION ALL SELECT user_id, p_event_type, p_value, p_props, 'update_preimage', ver
          FROM steps WHERE p_op <> 'd' AND op <> 'd'
        UNION ALL SELECT user_id, event_type, value, props, 'update_postimage', ver
          FROM steps WHERE p_op <> 'd' AND op <> 'd'
        UNION ALL SELECT user_id, p_event_type, p_value, p_props, 'delete', ver
          FROM steps WHERE p_op <> 'd' AND op = 'd') f
      JOIN commits c ON f._commit_version = c.ver""",
    "cust": """SELECT c_custkey AS customer_id,
        CASE WHEN c_nationkey = 3 THEN NULL WHEN c_nationkey = 4 THEN '' ELSE 'Customer' END AS first_name,
        CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE substr(c_name, 10) END AS last_name,
        n_name AS city, CASE WHEN n_regionkey = 2 THEN NULL ELSE 'S' || c_nationkey END AS state, r_name AS country,
        CASE WHEN c_nationkey = 7 THEN NULL ELSE ' User' || c_custkey || '@Example.COM ' END AS email,
        c_mktsegment AS customer_tier, c_acctbal AS lifetime_value,
        TIMESTAMP '1996-01-01 00:00:00' + to_days(CAST(30 * c_nationkey AS INTEGER)) AS registration_date,
        CASE WHEN c_nationkey = 9 THEN NULL ELSE c_acctbal >= 0 END AS is_active,
        CASE WHEN c_mktsegment = 'FURNITURE' THEN 'd' WHEN c_mktsegment = 'BUILDING' THEN NULL
             WHEN c_mktsegment = 'HOUSEHOLD' THEN 'r' ELSE 'u' END AS __op,
        CASE WHEN c_nationkey = 11 THEN 'true' WHEN c_nationkey = 12 THEN NULL ELSE 'false' END AS __deleted,
        CAST(c_custkey * 1000 AS BIGINT) AS __ts_ms, c_custkey AS __lsn
      FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "snap_b": "SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '2001-06-01'",
    "snap_a": """SELECT o_orderkey, o_custkey, o_orderstatus,
        CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 100 ELSE o_totalprice END AS o_totalprice,
        o_orderdate, o_orderpriority
      FROM orders WHERE o_orderdate >= TIMESTAMP '1995-07-01'""",
    "diff": """SELECT coalesce(b.o_orderkey, a.o_orderkey) AS o_orderkey,
        CASE WHEN b.o_orderkey IS NULL THEN 'insert' WHEN a.o_orderkey IS NULL THEN 'delete'
             WHEN a.o_totalprice IS DISTINCT FROM b.o_totalprice THEN 'update' END AS kind
      FROM snap_b b FULL OUTER JOIN snap_a a ON a.o_orderkey = b.o_orderkey""",
    "hist": """SELECT _commit_version AS version, max(_commit_timestamp) AS ts,
        CASE CAST(_commit_version % 3 AS INTEGER) WHEN 0 THEN 'WRITE' WHEN 1 THEN 'MERGE' ELSE 'DELETE' END AS operation,
        count(*) FILTER (WHERE _change_type = 'insert') AS inserted,
        count(*) FILTER (WHERE _change_type = 'update_postimage') AS updated,
        count(*) FILTER (WHERE _change_type = 'delete') AS deleted
      FROM feed GROUP BY _commit_version""",
    "snaps": """SELECT 1000 + version * 7 AS snapshot_id,
        CASE WHEN version = 20 THEN 1070 WHEN version > 0 THEN 1000 + (version - 1) * 7 END AS parent_snapshot_id,
        ts, operation FROM hist""",
    "offs": """SELECT event_type AS topic, CAST(user_id % 4 AS INTEGER) AS part, event_id AS off, ts FROM events""",
    "runs": """SELECT event_type AS source_name, date_trunc('hour', ts) AS run_at, count(*) AS processed,
        count(*) FILTER (WHERE value > 50) AS errors, max(value) AS lag_seconds
      FROM events GROUP BY 1, 2""",
    "drift": """SELECT event_type AS tbl, ver, ts, 'k' AS col, 'BIGINT' AS type FROM chg
      UNION ALL SELECT event_type, ver, ts, 'value', 'DOUBLE' FROM chg WHERE ver < 20
      UNION ALL SELECT event_type, ver, ts, 'amount', 'DOUBLE' FROM chg WHERE ver >= 20
      UNION ALL SELECT event_type, ver, ts, 'extra', CASE WHEN ver < 15 THEN 'BIGINT' ELSE 'DOUBLE' END
        FROM chg WHERE ver >= 10""",
    "schemas": "SELECT DISTINCT tbl, ver, col, type FROM drift",
    "changes": """SELECT coalesce(o.tbl, n.tbl) AS tbl, coalesce(o.nxt, n.ver) AS ver, coalesce(o.col, n.col) AS col,
        o.type AS old_type, n.type AS new_type,
        CASE WHEN o.type IS NULL THEN 'ADD' WHEN n.type IS NULL THEN 'DROP' ELSE 'ALTER' END AS change_type
      FROM (SELECT s.*, v.nxt FROM schemas s JOIN
              (SELECT tbl, ver, lead(ver) OVER (PARTITION BY tbl ORDER BY ver) AS nxt
               FROM (SELECT DISTINCT tbl, ver FROM schemas)) v
            ON s.tbl = v.tbl AND s.ver = v.ver WHERE v.nxt IS NOT NULL) o
      FULL OUTER JOIN (SELECT s.* FROM schemas s
            JOIN (SELECT tbl, min(ver) AS v0 FROM schemas GROUP BY tbl) m ON s.tbl = m.tbl WHERE s.ver > m.v0) n
        ON o.tbl = n.tbl AND o.nxt = n.ver AND o.col = n.col
      WHERE o.type IS DISTINCT FROM n.type""",
    "parents": "SELECT * FROM customer WHERE c_acctbal >= 0",
}
USES = {
    "env": ("chg",), "last_ver": ("chg",), "steps": ("last_ver",), "commits": ("chg",), "feed": ("steps", "commits"),
    "diff": ("snap_b", "snap_a"), "hist": ("feed",), "snaps": ("hist",), "drift": ("chg",), "schemas": ("drift",),
    "changes": ("schemas",),
}


def with_inputs(sql: str, needs: tuple[str, ...]) -> str:
    """SQL with the definitions it needs in front of it."""
    ordered_names: list[str] = []

    def visit(name: str) -> None:
        for dep in USES.get(name, ()):
            visit(dep)
        if name not in ordered_names:
            ordered_names.append(name)

    for n in needs:
        visit(n)
    if not ordered_names:
        return sql
    head = ", ".join(f"{n} AS ({SQL[n]})" for n in ordered_names)
    sql = sql.strip()
    if sql[:4].upper() == "WITH":
        rest = sql[4:].lstrip()
        recursive = rest[:9].upper() == "RECURSIVE"
        rest = rest[9:] if recursive else rest
        return f"WITH {'RECURSIVE ' if recursive else ''}{head}, {rest}"
    return f"WITH {head} {sql}"


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def utc(ts: str | Column) -> Column:
    """Wall time as an instant; the session runs in UTC."""
    return (F.col(ts) if isinstance(ts, str) else ts).cast("timestamp")


def wall(ts: str | Column) -> Column:
    return (F.col(ts) if isinstance(ts, str) else ts).cast("timestamp_ntz")


def changes_of(events: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    op = F.when(kind == "signup", "c").when(kind == "view", "r").when(kind == "error", "d").otherwise("u")
    return events.select(
        "event_id", "ts", "user_id", "event_type", "value", "props",
        op.alias("op"),
        F.when(kind == "purchase", "carts").otherwise("users").alias("tbl"),
        F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date")).cast("bigint").alias("ver"),
        F.unix_millis(utc("ts")).alias("ts_ms"),
        F.unix_micros(utc("ts")).alias("updated_at"),
    )


def changes(spark: SparkSession, sf: str) -> DataFrame:
    """Change log of users: one row per event, key user_id, order (ts, event_id)."""
    return changes_of(read(spark, sf, "events"))


def with_before(spark: SparkSession, sf: str) -> DataFrame:
    return envelope.add_before(
        changes(spark, sf), KEYS, ORDER, ROW.names, bucket=F.date_trunc("hour", F.col("ts"))
    )


def _source() -> Column:
    return F.struct(
        F.lit("1.0").alias("version"),
        F.lit("log").alias("connector"),
        F.lit("shop").alias("db"),
        F.when(F.col("event_type") != "view", "app").alias("schema"),
        F.col("tbl").alias("table"),
        F.col("ts_ms").alias("ts_ms"),
        F.col("event_id").alias("lsn"),
        F.col("ver").alias("txId"),
    )


def _binlog_source() -> Column:
    return F.struct(
        F.lit("shop").alias("db"),
        F.col("tbl").alias("table"),
        F.col("ts_ms").alias("ts_ms"),
        F.concat(F.lit("bin."), F.col("ver")).alias("file"),
        F.col("event_id").alias("pos"),
        F.lit(1).cast("bigint").alias("server_id"),
        F.col("user_id").alias("thread"),
    )


def _message(df: DataFrame) -> DataFrame:
    return df.select(
        F.to_json(F.struct("user_id")).cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.concat(F.lit("shop."), F.col("tbl")).alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        utc("ts").alias("timestamp"),
    )


def envelopes(spark: SparkSession, sf: str, binlog: bool = False) -> DataFrame:
    """Raw messages with full envelopes."""
    rows = with_before(spark, sf)
    return _message(envelope.build(rows, ROW.names, _binlog_source() if binlog else _source()))


def flat_text() -> Column:
    body = F.struct(
        *ROW.names,
        F.col("op").alias("__op"),
        (F.col("op") == "d").cast("string").alias("__deleted"),
        F.lit("shop").alias("__db"),
        F.col("tbl").alias("__table"),
        F.col("ts_ms").alias("__ts_ms"),
        F.col("event_id").alias("__lsn"),
    )
    return F.to_json(body)


def flats(spark: SparkSession, sf: str) -> DataFrame:
    """Raw messages in flat form; small values come as broken text, deletes are followed by a tombstone."""
    c = changes(spark, sf)
    text = flat_text()
    broken = F.col("value") < 1.0
    good = _message(c.withColumn("value", F.when(broken, F.substring(text, 1, 40)).otherwise(text)))
    tombs = _message(c.filter(F.col("op") == "d").withColumn("value", F.lit(None).cast("string")))
    return good.unionByName(tombs)


def change_feed(spark: SparkSession, sf: str) -> DataFrame:
    return feed.from_changes(changes(spark, sf), KEYS, FEED_ROW, ORDER, "ver", "ts")


#: Days that begin a new stretch of the stored feed, and the last day that its base covers.
STRETCHES, BASE_DAY = (0, 7, 14, 21), 13
_stores: dict[tuple[str, str], str] = {}


def new_feed_store(spark: SparkSession, sf: str, root: str) -> FeedStore:
    """The change feed stored by weeks, with a base at the end of the second one."""
    store, whole = FeedStore(spark, root, KEYS), lineage.scratch(spark)
    change_feed(spark, sf).write.parquet(whole)
    rows = spark.read.parquet(whole)
    for lo, hi in zip(STRETCHES, [*STRETCHES[1:], None]):
        store.append(feed.between_versions(rows, lo, None if hi is None else hi - 1))
    store.add_base(BASE_DAY)
    lineage.remove(spark, whole)
    return store


def feed_store(spark: SparkSession, sf: str) -> FeedStore:
    """The stored feed that queries read; it is written once per application and set of tables."""
    of = spark.sparkContext.applicationId, sf
    if of not in _stores:
        _stores[of] = new_feed_store(spark, sf, lineage.scratch(spark)).root
    return FeedStore(spark, _stores[of], KEYS)


def bookmarks(spark: SparkSession, sf: str) -> DataFrame:
    """How far two readers have come: one to the commits before a date, one to a week before that."""
    c = changes(spark, sf)

    def mark(reader: str, day: str) -> DataFrame:
        return c.filter(F.col("ts") < F.lit(day).cast("timestamp_ntz")).agg(F.max("ver").alias("last_version")).select(
            F.lit(reader).alias("reader"), "last_version"
        )

    return mark("reports", "2024-01-28").unionByName(mark("search", "2024-01-21"))


BOOKMARKS_SQL = """SELECT 'reports' AS reader, max(ver) AS last_version FROM chg WHERE ts < TIMESTAMP '2024-01-28'
  UNION ALL SELECT 'search', max(ver) FROM chg WHERE ts < TIMESTAMP '2024-01-21'"""
SQL["marks"] = BOOKMARKS_SQL
USES["marks"] = ("chg",)


def versions(spark: SparkSession, sf: str) -> DataFrame:
    """Version history; the operation is set by the version number."""
    h = feed_store(spark, sf).history()
    third = F.col("version") % 3
    return h.withColumn("operation", F.when(third == 0, "WRITE").when(third == 1, "MERGE").otherwise("DELETE"))


def snapshots(spark: SparkSession, sf: str) -> DataFrame:
    """Snapshot history in which version 20 branches off from version 10."""
    v = F.col("version")
    parent = F.when(v == 20, F.lit(1070)).when(v > 0, 1000 + (v - 1) * 7)
    return versions(spark, sf).select(
        (1000 + v * 7).alias("snapshot_id"), parent.alias("parent_snapshot_id"), "timestamp", "operation",
        F.col("metrics").alias("summary"),
    )


def customers(spark: SparkSession, sf: str) -> DataFrame:
    c, n, r = read(spark, sf, "customer"), read(spark, sf, "nation"), read(spark, sf, "region")
    nation, seg = F.col("c_nationkey"), F.col("c_mktsegment")
    d = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    return d.select(
        F.col("c_custkey").alias("customer_id"),
        F.when(nation == 3, F.lit(None).cast("string")).when(nation == 4, "").otherwise("Customer").alias("first_name"),
        F.when(seg != "MACHINERY", F.expr("substring(c_name, 10)")).alias("last_name"),
        F.col("n_name").alias("city"),
        F.when(F.col("n_regionkey") != 2, F.concat(F.lit("S"), nation)).alias("state"),
        F.col("r_name").alias("country"),
        F.when(nation != 7, F.concat(F.lit(" User"), F.col("c_custkey"), F.lit("@Example.COM "))).alias("email"),
        seg.alias("customer_tier"),
        F.col("c_acctbal").alias("lifetime_value"),
        F.expr("timestamp_ntz'1996-01-01' + make_dt_interval(30 * c_nationkey)").alias("registration_date"),
        F.when(nation != 9, F.col("c_acctbal") >= 0).alias("is_active"),
        F.when(seg == "FURNITURE", "d").when(seg == "BUILDING", F.lit(None).cast("string")).when(seg == "HOUSEHOLD", "r")
        .otherwise("u").alias("__op"),
        F.when(nation == 11, "true").when(nation != 12, "false").alias("__deleted"),
        (F.col("c_custkey") * 1000).alias("__ts_ms"),
        F.col("c_custkey").alias("__lsn"),
    )


def snapshot_before(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as they were before the last months."""
    return read(spark, sf, "orders").select(*ORDER_ROW).filter(F.col("o_orderdate") < F.expr("timestamp_ntz'2001-06-01'"))


def snapshot_after(spark: SparkSession, sf: str) -> DataFrame:
    """Orders later on: the oldest are gone, new ones are there, urgent ones cost 100 more."""
    o = read(spark, sf, "orders").select(*ORDER_ROW)
    price = F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice") + 100).otherwise(F.col("o_totalprice"))
    return o.filter(F.col("o_orderdate") >= F.expr("timestamp_ntz'1995-07-01'")).withColumn("o_totalprice", price)


def positions(spark: SparkSession, sf: str) -> DataFrame:
    """Where the consumer stands per topic and partition."""
    e = messages_by_type(spark, sf).filter(F.col("ts") < F.lit(CONSUMED_UNTIL).cast("timestamp_ntz"))
    return e.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("position"))


def messages_by_type(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "events").select(
        F.col("event_type").alias("topic"), (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"), "ts",
    )


def runs(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly run log per source."""
    e = read(spark, sf, "events")
    return e.groupBy(F.col("event_type").alias("source_name"), F.date_trunc("hour", F.col("ts")).alias("run_at")).agg(
        F.count("*").alias("processed"), F.count_if(F.col("value") > 50).alias("errors"),
        F.max("value").alias("lag_seconds"),
    ).withColumn("run_at", F.col("run_at").cast("timestamp_ntz"))


def drifting(spark: SparkSession, sf: str) -> DataFrame:
    """Events as JSON whose fields change by day: extra comes on day 10 and turns into a fraction on
    day 15, value becomes amount on day 20."""
    c = changes(spark, sf)
    day = F.col("ver")
    body = F.struct(
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        F.when(day < 20, F.col("value")).alias("value"),
        F.when(day >= 20, F.col("value")).alias("amount"),
        F.when(day.between(10, 14), F.col("event_id")).alias("extra_whole"),
        F.when(day >= 15, F.col("event_id") + F.lit(0.5).cast("double")).alias("extra_part"),
    )
    text = F.regexp_replace(F.to_json(body), "extra_whole|extra_part", "extra")
    return c.select("event_type", "ver", "ts", "event_id", text.alias("json"))


def renamed(spark: SparkSession, sf: str) -> DataFrame:
    """Events as JSON with two text fields that get new names on day 20, in crossed name order."""
    c = changes(spark, sf)
    day = F.col("ver")
    user, page = F.concat(F.lit("user "), F.col("user_id")), F.get_json_object("props", "$.k")
    body = F.struct(
        F.when(day < 20, user).alias("actor"), F.when(day < 20, F.concat(F.lit("K-"), page)).alias("code"),
        F.when(day >= 20, F.concat(F.lit("K-"), page)).alias("label"), F.when(day >= 20, user).alias("person"),
    )
    return c.select("event_type", "ver", F.to_json(body).alias("json"))


def schemas(spark: SparkSession, sf: str) -> DataFrame:
    return schema.observed(drifting(spark, sf), "json", "event_type", "ver")


def parents(spark: SparkSession, sf: str) -> DataFrame:
    """Customers in good standing; orders of the others are orphans."""
    return read(spark, sf, "customer").filter(F.col("c_acctbal") >= 0)
