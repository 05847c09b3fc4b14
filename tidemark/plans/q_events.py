"""Queries: event parsing, projection, filters and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import checksum, scalar
from tidemark.operators import apply, diff, envelope, quality, transform
from tidemark.plans import inputs as i
from tidemark.plans.catalog import query


def _parsed(spark, sf, binlog=False):
    raw = i.envelopes(spark, sf, binlog)
    return envelope.parse(raw, i.ROW, "binlog" if binlog else "lsn")


@query(
    "p1_parse_envelope",
    """SELECT event_id AS "offset", op, ts_ms, tbl AS source_table,
      CASE WHEN has_before THEN user_id END AS before_user, CASE WHEN has_before THEN p_value END AS before_value,
      CASE WHEN op <> 'd' THEN user_id END AS after_user, CASE WHEN op <> 'd' THEN value END AS after_value,
      CASE WHEN op <> 'd' THEN props END AS after_props FROM env""",
    ("env",),
)
def parse_envelope(spark, sf):
    return _parsed(spark, sf).select(
        "offset", "op", "ts_ms", F.col("source.table").alias("source_table"),
        F.col("before.user_id").alias("before_user"), F.col("before.value").alias("before_value"),
        F.col("after.user_id").alias("after_user"), F.col("after.value").alias("after_value"),
        F.col("after.props").alias("after_props"),
    )


@query(
    "p2_parse_flat",
    """SELECT event_id AS "offset", user_id, event_type, value, props, op AS __op,
      CASE WHEN op = 'd' THEN 'true' ELSE 'false' END AS __deleted, tbl AS __table, ts_ms AS __ts_ms, event_id AS __lsn
    FROM chg WHERE value >= 1.0""",
    ("chg",),
)
def parse_flat(spark, sf):
    good, _ = envelope.split_invalid(envelope.parse_flat(i.flats(spark, sf), i.ROW))
    return good.select(
        "offset", "user_id", "event_type", "value", "props", "__op", "__deleted", "__table", "__ts_ms", "__lsn"
    )


@query(
    "p3_payload_row",
    """SELECT event_id AS "offset", CASE WHEN op = 'd' THEN (CASE WHEN has_before THEN p_event_type END) ELSE event_type END
      AS event_type, CASE WHEN op = 'd' THEN (CASE WHEN has_before THEN p_value END) ELSE value END AS value FROM env""",
    ("env",),
)
def payload_row(spark, sf):
    raw = i.envelopes(spark, sf)
    # half of the tables send their events wrapped in a payload field
    wrapped = F.concat(F.lit('{"schema":null,"payload":'), F.col("value").cast("string"), F.lit("}")).cast("binary")
    raw = raw.withColumn("value", F.when(F.col("topic") == "shop.carts", wrapped).otherwise(F.col("value")))
    p = envelope.parse(raw, i.ROW).withColumn("row", envelope.payload_row())
    return p.select("offset", "row.event_type", "row.value")


@query(
    "p4_unwrap",
    """SELECT event_id AS "offset", CASE WHEN op <> 'd' THEN user_id WHEN has_before THEN user_id END AS user_id,
      CASE WHEN op <> 'd' THEN value WHEN has_before THEN p_value END AS value, op AS __op,
      CASE WHEN op = 'd' THEN 'true' ELSE 'false' END AS __deleted, 'shop' AS __db, tbl AS __table, ts_ms AS __ts_ms,
      event_id AS __lsn FROM env""",
    ("env",),
)
def unwrap(spark, sf):
    return envelope.unwrap(_parsed(spark, sf)).select(
        "offset", "user_id", "value", "__op", "__deleted", "__db", "__table", "__ts_ms", "__lsn"
    )


@query(
    "p5_op_names",
    """SELECT CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'view' THEN 'SNAPSHOT' WHEN 'error' THEN 'DELETE'
      ELSE 'UPDATE' END AS operation, count(*) AS events FROM events GROUP BY 1""",
)
def op_names(spark, sf):
    named = i.changes(spark, sf).select(scalar.op_name("op", "SNAPSHOT").alias("operation"))
    return named.groupBy("operation").agg(F.count("*").alias("events"))


@query(
    "p6_standardize_lsn",
    """SELECT event_id AS "offset", CASE op WHEN 'c' THEN 'INSERT' WHEN 'u' THEN 'UPDATE' WHEN 'd' THEN 'DELETE' ELSE 'READ' END
      AS operation, tbl AS "table", CASE WHEN event_type = 'view' THEN 'public' ELSE 'app' END AS db_schema,
      'shop' AS database, event_id AS lsn, ver AS tx_id, user_id AS user_key,
      CASE WHEN op = 'd' THEN (CASE WHEN has_before THEN p_value END) ELSE value END AS value,
      make_timestamp(ts_ms * 1000) AS event_time FROM env
    WHERE op <> 'd' OR has_before""",
    ("env",),
)
def standardize_lsn(spark, sf):
    s = envelope.standardize(_parsed(spark, sf), "lsn", i.KEYS)
    return s.filter(F.col("primary_key.user_id").isNotNull()).select(
        "offset", "operation", "table", F.col("metadata.schema").alias("db_schema"), "metadata.database",
        "metadata.lsn", F.col("metadata.txId").alias("tx_id"), F.col("primary_key.user_id").alias("user_key"),
        "data.value", i.wall("event_timestamp").alias("event_time"),
    )


@query(
    "p7_standardize_binlog",
    """SELECT event_id AS "offset", is_flat, CASE op WHEN 'c' THEN 'INSERT' WHEN 'u' THEN 'UPDATE' WHEN 'd' THEN 'DELETE'
      ELSE 'READ' END AS operation, tbl AS "table", CASE WHEN NOT is_flat THEN 'bin.' || ver END AS binlog_file,
      CASE WHEN NOT is_flat THEN event_id END AS binlog_position,
      CASE WHEN is_flat OR op <> 'd' THEN value WHEN has_before THEN p_value END AS value
    FROM (SELECT *, false AS is_flat FROM env
          UNION ALL SELECT *, true FROM env WHERE value >= 1.0)""",
    ("env",),
)
def standardize_binlog(spark, sf):
    raw = i.envelopes(spark, sf, binlog=True).unionByName(i.flats(spark, sf))
    good, _ = envelope.split_invalid(envelope.parse_any(raw, i.ROW, "binlog"))
    s = envelope.standardize(good.drop("timestamp").withColumn("topic", F.col("is_flat").cast("string")), "binlog")
    return s.select(
        "offset", (F.col("topic") == "true").alias("is_flat"), "operation", "table", "metadata.binlog_file",
        "metadata.binlog_position", "data.value",
    )


@query(
    "p8_business_columns",
    """SELECT event_id AS "offset", k AS field, CASE k WHEN 'user_id' THEN CAST(user_id AS VARCHAR)
      WHEN 'event_type' THEN event_type WHEN 'props' THEN props WHEN 'updated_at' THEN CAST(updated_at AS VARCHAR) END AS text
    FROM chg, (VALUES ('user_id'), ('event_type'), ('props'), ('updated_at')) t(k) WHERE value >= 1.0""",
    ("chg",),
)
def business_columns(spark, sf):
    raw = i.flats(spark, sf).filter(F.col("value").isNotNull())
    fields = envelope.business_fields(F.col("value").cast("string"))
    out = raw.select("offset", F.explode(fields).alias("field", "text"))
    # the text of a fraction is engine specific
    return out.filter((F.col("field") != "value"))


@query(
    "p9_split_invalid",
    """SELECT CASE WHEN value < 1.0 THEN 'malformed' ELSE 'good' END AS outcome, count(*) AS events FROM chg GROUP BY 1""",
    ("chg",),
)
def split_invalid(spark, sf):
    good, bad = envelope.split_invalid(envelope.parse_flat(i.flats(spark, sf), i.ROW), i.KEYS)
    both = good.select(F.lit("good").alias("outcome")).unionByName(bad.select(F.col("_error").alias("outcome")))
    return both.groupBy("outcome").agg(F.count("*").alias("events"))


@query(
    "p10_drop_tombstones",
    """SELECT tbl AS __table, count(*) AS messages FROM chg GROUP BY 1""",
    ("chg",),
)
def drop_tombstones(spark, sf):
    d = envelope.parse_flat(i.flats(spark, sf), i.ROW)
    return d.groupBy(F.expr("substring(topic, 6)").alias("__table")).agg(F.count("*").alias("messages"))


@query(
    "p11_primary_key",
    """SELECT event_id AS "offset", CASE WHEN op <> 'd' OR has_before THEN user_id END AS key_user FROM env""",
    ("env",),
)
def primary_key(spark, sf):
    p = _parsed(spark, sf).withColumn("k", envelope.key_of(i.KEYS))
    return p.select("offset", F.col("k.user_id").alias("key_user"))


@query(
    "p12_changed_fields",
    """SELECT event_id AS "offset", concat_ws(',', CASE WHEN event_type IS DISTINCT FROM p_event_type THEN 'event_type' END,
      CASE WHEN value IS DISTINCT FROM p_value THEN 'value' END, CASE WHEN props IS DISTINCT FROM p_props THEN 'props' END)
      AS fields FROM env WHERE op = 'u' AND has_before""",
    ("env",),
)
def changed_fields(spark, sf):
    p = _parsed(spark, sf).filter((F.col("op") == "u") & F.col("before").isNotNull())
    names = diff.changed_fields(["event_type", "value", "props"])
    return p.select("offset", F.array_join(names, ",").alias("fields"))


FULL_NAME_SQL = "coalesce(nullif(concat_ws(' ', nullif(first_name, ''), nullif(last_name, '')), ''), '{}')"
LOCATION_SQL = "coalesce(nullif(concat_ws(', ', nullif(city, ''), nullif(state, ''), nullif(country, '')), ''), '{}')"
LIVE_SQL = "NOT (coalesce(__op = 'd', false) OR coalesce(lower(__deleted) = 'true', false))"
ANALYTICS_SQL = f"""SELECT customer_id, email, {FULL_NAME_SQL.format('Unknown')} AS full_name,
  {LOCATION_SQL.format('Unknown')} AS location, customer_tier, coalesce(lifetime_value, 0.0) AS lifetime_value,
  registration_date, coalesce(is_active, true) AS is_active, 0 AS total_orders, 'postgres_cdc' AS _source_system,
  CASE coalesce(__op, 'c') WHEN 'c' THEN 'INSERT' WHEN 'u' THEN 'UPDATE' WHEN 'r' THEN 'READ' ELSE 'UNKNOWN' END
    AS _cdc_operation, __ts_ms AS _event_timestamp_ms, __lsn AS _source_lsn FROM cust WHERE {LIVE_SQL}"""


@query("p13_customer_analytics", ANALYTICS_SQL, ("cust",))
def customer_analytics(spark, sf):
    return transform.customer_analytics(i.customers(spark, sf))


@query(
    "p15_adaptive_projection",
    f"""SELECT customer_id, email, {FULL_NAME_SQL.format('')} AS full_name, {LOCATION_SQL.format('')} AS location,
      CAST(NULL AS VARCHAR) AS customer_tier, CAST(0.0 AS DOUBLE) AS lifetime_value,
      CAST(NULL AS TIMESTAMP) AS registration_date, true AS is_active, 0 AS total_orders,
      'postgres_cdc' AS _source_system, 'INSERT' AS _cdc_operation, CAST(NULL AS BIGINT) AS _event_timestamp_ms,
      CAST(NULL AS BIGINT) AS _source_lsn FROM cust""",
    ("cust",),
)
def adaptive_projection(spark, sf):
    few = i.customers(spark, sf).select("customer_id", "email", "first_name", "last_name", "city", "state", "country")
    return transform.customer_analytics(few, name_default="", place_default="")


@query(
    "p17_add_metadata",
    """SELECT customer_id, 'customers_to_lake' AS _pipeline_id, '7' AS _batch_id,
      TIMESTAMP '2024-01-31 00:00:00' AS _processed_timestamp FROM cust""",
    ("cust",),
)
def add_metadata(spark, sf):
    at = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    return transform.add_metadata(i.customers(spark, sf).select("customer_id"), "customers_to_lake", 7, at)


@query(
    "p18_flatten",
    """SELECT event_id AS event_id, user_id AS row_user_id, value AS row_value, tbl AS source_table, ts_ms AS source_at_ts_ms
    FROM chg""",
    ("chg",),
)
def flatten(spark, sf):
    nested = i.changes(spark, sf).select(
        "event_id",
        F.struct("user_id", "value").alias("row"),
        F.struct(F.col("tbl").alias("table"), F.struct("ts_ms").alias("at")).alias("source"),
    )
    return transform.flatten(nested)


@query(
    "p19_build_events",
    """SELECT md5(concat_ws('-', 'users', CAST(user_id AS VARCHAR), op, CAST(event_id AS VARCHAR))) AS event_id,
      CASE op WHEN 'c' THEN 'INSERT' WHEN 'u' THEN 'UPDATE' WHEN 'd' THEN 'DELETE' ELSE 'READ' END AS operation,
      'shop' AS source, 'users' AS "table", event_id AS event_time,
      CASE WHEN has_before THEN p_value END AS before_value, CASE WHEN op <> 'd' THEN value END AS after_value FROM env""",
    ("env",),
)
def build_events(spark, sf):
    e = envelope.build_events(i.with_before(spark, sf), i.ROW.names, "users", "shop", "op", "event_id", i.KEYS)
    return e.select(
        "event_id", "operation", "source", "table", "event_time",
        F.col("before.value").alias("before_value"), F.col("after.value").alias("after_value"),
    )


@query(
    "f1_for_table",
    """SELECT event_id AS "offset", op FROM chg WHERE tbl = 'carts'""",
    ("chg",),
)
def for_table(spark, sf):
    return envelope.for_table(_parsed(spark, sf), "carts").select("offset", "op")


@query(
    "f2_for_operations",
    """SELECT op, count(*) AS events, sum(CASE WHEN op <> 'd' THEN 1 ELSE 0 END)::BIGINT AS with_row
    FROM chg WHERE op IN ('c', 'd') GROUP BY op""",
    ("chg",),
)
def for_operations(spark, sf):
    kept = envelope.for_ops(_parsed(spark, sf), ["c", "d"])
    return kept.groupBy("op").agg(F.count("*").alias("events"), F.count("after").alias("with_row"))


@query(
    "f3_drop_deletes",
    f"SELECT customer_id, __op, __deleted FROM cust WHERE {LIVE_SQL}",
    ("cust",),
)
def drop_deletes(spark, sf):
    return transform.drop_deletes(i.customers(spark, sf)).select("customer_id", "__op", "__deleted")


@query(
    "f4_business_rules",
    """SELECT customer_id, concat_ws(',', CASE WHEN email IS NULL THEN 'email_present' END,
      CASE WHEN NOT lifetime_value >= 0 THEN 'lifetime_value_not_negative' END) AS broken FROM cust""",
    ("cust",),
)
def business_rules(spark, sf):
    kept, out = quality.apply_rules(i.customers(spark, sf), quality.BUSINESS_RULES)
    good = kept.select("customer_id", F.lit("").alias("broken"))
    return good.unionByName(out.select("customer_id", F.array_join("broken_rules", ",").alias("broken")))


@query(
    "f6_predicates",
    """SELECT o_orderkey, o_totalprice FROM orders
    WHERE o_orderstatus = 'F' AND o_totalprice >= 250000 AND o_orderpriority <> '5-LOW'""",
)
def predicates(spark, sf):
    where = "o_orderstatus = 'F' AND o_totalprice >= 250000 AND o_orderpriority != '5-LOW'"
    return i.read(spark, sf, "orders").filter(where).select("o_orderkey", "o_totalprice")


RULES_SQL = """SELECT r.rule, count(*) AS checked, count(*) FILTER (WHERE CASE r.rule
    WHEN 'email_format' THEN NOT coalesce(regexp_matches(email, '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\\.[a-zA-Z]{2,}$'), false)
    WHEN 'phone_format' THEN NOT regexp_matches(phone, '^\\+?[1-9]\\d{1,14}$')
    WHEN 'registered_in_the_past' THEN NOT coalesce(registration_date <= now()::TIMESTAMP, false)
    WHEN 'tier_known' THEN coalesce(customer_tier NOT IN ('Bronze', 'Silver', 'Gold', 'Platinum'), true)
    ELSE NOT lifetime_value >= 0 END) AS failures
  FROM (SELECT trim(email) AS email, CAST(customer_id * 7 AS VARCHAR) AS phone, lifetime_value,
          CASE WHEN customer_id % 11 = 0 THEN TIMESTAMP '9999-01-01' WHEN customer_id % 13 <> 0 THEN registration_date END AS registration_date,
          CASE customer_tier WHEN 'MACHINERY' THEN 'Gold' WHEN 'BUILDING' THEN 'Silver' ELSE customer_tier END AS customer_tier
        FROM cust),
    (VALUES ('email_format'), ('phone_format'), ('tier_known'), ('lifetime_value_not_negative'), ('registered_in_the_past')) r(rule) GROUP BY r.rule"""


@query(
    "f7_row_rules",
    f"SELECT *, CASE WHEN failures > 0 THEN 'failed' ELSE 'passed' END AS status FROM ({RULES_SQL})",
    ("cust",),
)
def row_rules(spark, sf):
    tier = F.col("customer_tier")
    c = i.customers(spark, sf).select(
        F.trim("email").alias("email"), (F.col("customer_id") * 7).cast("string").alias("phone"), "lifetime_value",
        F.when(tier == "MACHINERY", "Gold").when(tier == "BUILDING", "Silver").otherwise(tier).alias("customer_tier"),
        F.when(F.col("customer_id") % 11 == 0, F.expr("timestamp_ntz'9999-01-01'"))
        .when(F.col("customer_id") % 13 != 0, F.col("registration_date").cast("timestamp_ntz")).alias("registration_date"),
    )
    return quality.check_rules(c, [*quality.CUSTOMER_RULES, quality.REGISTRATION_RULE])


@query(
    "f7_order_rules",
    """SELECT rule, count(*) AS checked, count(*) FILTER (WHERE NOT ok) AS failures,
      CASE WHEN count(*) FILTER (WHERE NOT ok) > 0 THEN 'failed' ELSE 'passed' END AS status FROM (
      SELECT r.rule, CASE r.rule WHEN 'amount_positive' THEN o_totalprice - 20000 > 0 WHEN 'status_known' THEN o_orderstatus IN ('F', 'P')
        ELSE o_orderdate >= TIMESTAMP '1996-01-01' + to_days(CAST(30 * c_nationkey AS INTEGER)) END AS ok
      FROM orders JOIN customer ON o_custkey = c_custkey, (VALUES ('amount_positive'), ('status_known'), ('ordered_after_registration')) r(rule))
    GROUP BY rule""",
)
def order_rules(spark, sf):
    status = F.col("o_orderstatus")
    o = i.read(spark, sf, "orders").select(
        "o_custkey", (F.col("o_totalprice") - 20000).alias("total_amount"), F.col("o_orderdate").alias("order_date"),
        F.when(status == "F", "delivered").when(status == "P", "pending").otherwise("lost").alias("order_status"),
    )
    days = F.make_dt_interval(30 * F.col("c_nationkey"))
    c = i.read(spark, sf, "customer").select("c_custkey", (F.expr("timestamp_ntz'1996-01-01'") + days).alias("registration_date"))
    both = o.join(c, F.col("o_custkey") == F.col("c_custkey"))
    return quality.check_rules(both, [*quality.ORDER_RULES, quality.ORDER_DATE_RULE])


@query(
    "f7_product_rules",
    """WITH p AS (SELECT p_retailprice - 950 AS price, CAST(p_size * 20 - 40 AS DOUBLE) AS cost, p_size - 3 AS stock, p_name || p_brand AS sku FROM part)
    SELECT *, CASE WHEN failures > 0 THEN 'failed' ELSE 'passed' END AS status FROM (
      SELECT 'price_positive' AS rule, count(*) AS checked, count(*) FILTER (WHERE NOT price > 0) AS failures FROM p
      UNION ALL SELECT 'cost_in_range', count(*), count(*) FILTER (WHERE NOT (cost > 0 AND cost <= price)) FROM p
      UNION ALL SELECT 'stock_not_negative', count(*), count(*) FILTER (WHERE NOT stock >= 0) FROM p
      UNION ALL SELECT 'sku_unique', count(*), count(*) - count(DISTINCT sku) FROM p)""",
)
def product_rules(spark, sf):
    p = i.read(spark, sf, "part").select(
        (F.col("p_retailprice") - 950).alias("price"), (F.col("p_size") * 20 - 40).cast("double").alias("cost"),
        (F.col("p_size") - 3).alias("quantity_in_stock"), F.concat("p_name", "p_brand").alias("sku"),
    )
    return quality.check_unique(p, quality.PRODUCT_RULES, "sku")


@query(
    "f8_event_rules",
    """SELECT rule, (SELECT count(*) FROM env) AS checked, failures, CASE WHEN failures > 0 THEN 'failed' ELSE 'passed' END AS status
    FROM (
      SELECT 'operation_known' AS rule, count(*) FILTER (WHERE op = 'r') AS failures FROM env
      UNION ALL SELECT 'insert_has_no_before', 0
      UNION ALL SELECT 'delete_has_no_after', 0
      UNION ALL SELECT 'update_has_both', count(*) FILTER (WHERE op = 'u' AND NOT has_before) FROM env
      UNION ALL SELECT 'key_unchanged', 0
      UNION ALL SELECT 'times_in_order', count(*) FILTER (WHERE ts_ms > CAST(floor(value) AS BIGINT) * 1000 + ts_ms - 60000) FROM env
      UNION ALL SELECT 'event_id_present', 0
      UNION ALL SELECT 'system_present', 0
      UNION ALL SELECT 'table_present', count(*) FILTER (WHERE event_type = 'view') FROM env
      UNION ALL SELECT 'event_id_unique', count(*) - count(DISTINCT (user_id, op, ver)) FROM env)""",
    ("env",),
)
def event_rules(spark, sf):
    d = i.with_before(spark, sf)
    # ids by key, operation and day repeat; capture time is the value in seconds less a minute after the source
    d = d.withColumn("capture", F.floor("value") * 1000 + F.col("ts_ms") - 60000)
    image = F.struct(*i.ROW.names)
    e = d.select(
        scalar.event_id("user_id", "op", "ver").alias("event_id"),
        scalar.op_name("op").alias("operation"),
        "before",
        F.when(F.col("op") != "d", image).alias("after"),
        F.col("ts_ms").alias("source_ts"), F.col("capture").alias("capture_ts"), F.col("capture").alias("process_ts"),
        F.lit("shop").alias("system"), F.when(F.col("event_type") != "view", F.col("event_type")).alias("table"),
    )
    return quality.check_events(e, ["user_id"], present=["system", "table"])


@query(
    "u4_dedupe_events",
    """SELECT user_id, ver, op, min_by(event_id, (ts, event_id)) AS event_id FROM chg GROUP BY user_id, ver, op""",
    ("chg",),
)
def dedupe_events(spark, sf):
    d = envelope.dedupe(i.changes(spark, sf), ["user_id", "ver", "op"], i.ORDER)
    return d.select("user_id", "ver", "op", "event_id")


@query(
    "w2_before_image",
    """SELECT event_id, op, CASE WHEN has_before THEN p_event_type END AS old_type,
      CASE WHEN has_before THEN p_value END AS old_value FROM env""",
    ("env",),
)
def before_image(spark, sf):
    return _old_values(i.with_before(spark, sf))


@query(
    "w2_before_image_cut",
    """SELECT event_id, op, CASE WHEN has_before THEN p_event_type END AS old_type,
      CASE WHEN has_before THEN p_value END AS old_value FROM env""",
    ("env",),
)
def before_image_cut(spark, sf):
    """Every key's events are cut by the hour, as those of a hot key are."""
    return _old_values(envelope.add_before(i.changes(spark, sf), i.KEYS, i.ORDER, i.FEED_ROW, hot_rows=0))


def _old_values(d):
    return d.select(
        "event_id", "op", F.col("before.event_type").alias("old_type"), F.col("before.value").alias("old_value")
    )


@query(
    "w1_latest_per_key",
    """SELECT user_id, event_id, op, value FROM chg
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    ("chg",),
)
def latest_per_key(spark, sf):
    d = apply.latest_per_key(i.changes(spark, sf), i.KEYS, i.ORDER)
    return d.select("user_id", "event_id", "op", "value")


# scalar functions


@query(
    "x1_full_name",
    f"""SELECT customer_id, {FULL_NAME_SQL.format('Unknown')} AS full_name,
      coalesce(nullif(concat_ws(' ', nullif(first_name, ''), nullif(last_name, '')), ''), '') AS name_or_blank FROM cust""",
    ("cust",),
)
def full_name(spark, sf):
    return i.customers(spark, sf).select(
        "customer_id",
        scalar.full_name("first_name", "last_name").alias("full_name"),
        scalar.full_name("first_name", "last_name", "").alias("name_or_blank"),
    )


@query(
    "x2_location",
    f"SELECT customer_id, {LOCATION_SQL.format('Unknown')} AS location FROM cust",
    ("cust",),
)
def location(spark, sf):
    return i.customers(spark, sf).select("customer_id", scalar.location("city", "state", "country").alias("location"))


@query(
    "x3_op_mapping",
    """SELECT customer_id, CASE __op WHEN 'u' THEN 'UPDATE' WHEN 'd' THEN 'DELETE' WHEN 'r' THEN 'READ' ELSE 'UNKNOWN' END
      AS operation FROM cust""",
    ("cust",),
)
def op_mapping(spark, sf):
    return i.customers(spark, sf).select("customer_id", scalar.op_name("__op").alias("operation"))


@query(
    "x4_timestamps",
    """SELECT event_id, make_timestamp(ts_ms * 1000) AS from_millis, ts AS from_micros,
      CASE WHEN op = 'd' THEN NULL ELSE make_timestamp(ts_ms * 1000) END AS from_text FROM chg""",
    ("chg",),
)
def timestamps(spark, sf):
    d = i.changes(spark, sf)
    iso = F.date_format(F.timestamp_millis("ts_ms"), "yyyy-MM-dd'T'HH:mm:ss.SSS")
    text = F.when(F.col("op") == "d", "not a time").when(F.col("op") == "c", iso).otherwise(F.col("ts_ms").cast("string"))
    return d.select(
        "event_id",
        i.wall(scalar.epoch_millis("ts_ms")).alias("from_millis"),
        i.wall(scalar.epoch_micros("updated_at")).alias("from_micros"),
        i.wall(scalar.any_timestamp(text)).alias("from_text"),
    )


@query(
    "x5_iso_text",
    """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS iso, ts AS back FROM events""",
)
def iso_text(spark, sf):
    d = i.read(spark, sf, "events").withColumn("iso", scalar.iso_text("ts"))
    return d.select("event_id", "iso", i.wall(scalar.iso_timestamp("iso")).alias("back"))


@query(
    "x6_casts",
    """SELECT p_partkey, CAST(p_size AS BIGINT) AS size_int, CAST(p_retailprice AS DOUBLE) AS price,
      TRY_CAST(p_type AS BIGINT) AS type_int, lower(CASE WHEN p_size > 25 THEN 'YES' ELSE p_type END)
        IN ('true', '1', 'yes') AS big FROM part""",
)
def casts(spark, sf):
    d = i.read(spark, sf, "part")
    return d.select(
        "p_partkey",
        scalar.to_int(F.concat(F.lit(" "), F.col("p_size").cast("string"))).alias("size_int"),
        scalar.to_float(F.col("p_retailprice").cast("string")).alias("price"),
        scalar.to_int("p_type").alias("type_int"),
        scalar.to_bool(F.when(F.col("p_size") > 25, "YES").otherwise(F.col("p_type"))).alias("big"),
    )


@query(
    "x7_clean_text",
    """SELECT customer_id, lower(trim(email)) AS email, upper(customer_tier[1]) || lower(customer_tier[2:]) AS tier FROM cust""",
    ("cust",),
)
def clean_text(spark, sf):
    return i.customers(spark, sf).select(
        "customer_id", scalar.clean_email("email").alias("email"), scalar.title_case("customer_tier").alias("tier")
    )


@query(
    "x8_mask",
    """SELECT customer_id, 'user_' || substr(md5(email), 1, 8) || '@masked.com' AS email, sha256(city) AS city,
      CASE WHEN state IS NOT NULL THEN '***' END AS state,
      repeat('*', greatest(length(country) - 2, 0)) || right(country, 2) AS country FROM cust""",
    ("cust",),
)
def mask(spark, sf):
    c = i.customers(spark, sf).select("customer_id", "email", "city", "state", "country")
    out = transform.mask(c, {"email": "email", "city": "hash", "state": "redact"})
    return out.withColumn("country", scalar.mask_partial("country", 2))


CHECKED = ["o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus", "o_totalprice", "o_orderdate"]
ROW_TEXT_SQL = "concat_ws('|', {})".format(
    ", ".join(f"'{c}=' || coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in sorted(CHECKED))
)
ROW_NUMBER_SQL = f"CAST('0x' || substr(md5({ROW_TEXT_SQL}), 1, 15) AS BIGINT)"


@query(
    "x9_row_checksum",
    f"SELECT o_orderkey, md5({ROW_TEXT_SQL}) AS md5, sha256({ROW_TEXT_SQL}) AS sha256 FROM orders",
)
def row_checksum(spark, sf):
    d = i.read(spark, sf, "orders")
    cols = checksum.checksum_columns(d, CHECKED)
    return d.select(
        "o_orderkey", checksum.row_checksum(cols).alias("md5"), checksum.row_checksum(cols, "sha256").alias("sha256")
    )


@query(
    "x10_dataset_checksum",
    f'SELECT count(*) AS "rows", CAST(sum({ROW_NUMBER_SQL}) AS VARCHAR) AS checksum FROM orders',
)
def dataset_checksum(spark, sf):
    return quality.dataset_checksum(i.read(spark, sf, "orders"), CHECKED)


@query(
    "x11_incremental_checksum",
    f'SELECT count(*) AS "rows", CAST(sum({ROW_NUMBER_SQL}) AS VARCHAR) AS checksum FROM orders',
)
def incremental_checksum(spark, sf):
    o = i.read(spark, sf, "orders")
    new = F.col("o_orderdate") >= F.expr("timestamp_ntz'2001-06-01'")
    old_sum = quality.dataset_checksum(o.filter(~new), CHECKED)
    return quality.combine_checksums(old_sum, quality.dataset_checksum(o.filter(new), CHECKED))


@query(
    "x12_event_id",
    """SELECT event_id, md5(concat_ws('-', event_type, CAST(user_id % 4 AS VARCHAR), CAST(event_id AS VARCHAR))) AS id
    FROM events""",
)
def event_id(spark, sf):
    d = i.messages_by_type(spark, sf)
    return d.select(F.col("offset").alias("event_id"), scalar.event_id("topic", "partition", "offset").alias("id"))


@query(
    "x13_defaults",
    """SELECT event_id, coalesce(TRY_CAST(json_extract_string(props, '$.k') AS VARCHAR), 'none') AS k,
      'none' AS other FROM events""",
)
def defaults(spark, sf):
    d = i.read(spark, sf, "events").withColumn("m", F.from_json("props", "map<string,string>"))
    return d.select(
        "event_id", scalar.map_value("m", "k", "none").alias("k"), scalar.map_value("m", "other", "none").alias("other")
    )


@query(
    "x14_iso_dates",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS day FROM orders""",
)
def iso_dates(spark, sf):
    d = i.read(spark, sf, "orders")
    text = F.when(F.col("o_orderstatus") == "P", "31/12/99").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return d.select("o_orderkey", scalar.iso_date(text).alias("day"))


@query(
    "x15_human_bytes",
    """SELECT doc_id, CASE WHEN b < 1024 THEN printf('%.2f B', b) WHEN b < 1048576 THEN printf('%.2f KB', b / 1024.0)
      ELSE printf('%.2f MB', b / 1048576.0) END AS size FROM (SELECT doc_id, CAST(strlen(text) AS DOUBLE) * 64 AS b FROM documents)""",
)
def human_bytes(spark, sf):
    d = i.read(spark, sf, "documents")
    return d.select("doc_id", scalar.human_bytes(F.octet_length("text") * 64).alias("size"))


@query(
    "x16_json_fields",
    """SELECT event_id, json_extract_string(props, '$.k') AS k, CAST(NULL AS VARCHAR) AS city FROM events""",
)
def json_fields(spark, sf):
    d = i.read(spark, sf, "events")
    return transform.json_fields(d, "props", {"k": "$.k", "city": "$.address.city"}).select("event_id", "k", "city")


@query(
    "s14_batches",
    """SELECT batch_id, count(*) AS "rows", min(event_id) AS first_event, max(event_id) AS last_event FROM (
      SELECT event_id, CAST(floor((row_number() OVER (ORDER BY ts, event_id) - 1) / 1000) AS BIGINT) AS batch_id FROM events)
    GROUP BY batch_id""",
)
def batches(spark, sf):
    from tidemark.operators import feed

    d = feed.batched(
        i.read(spark, sf, "events").select("event_id", "ts"), i.ORDER, 1000, F.date_trunc("minute", F.col("ts"))
    )
    return d.groupBy("batch_id").agg(
        F.count("*").alias("rows"), F.min("event_id").alias("first_event"), F.max("event_id").alias("last_event")
    )

