"""Queries: joins for quality, validators, schema comparison, score cards."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import feed, quality, schema, transform
from tidemark.plans import inputs as i
from tidemark.plans.catalog import query
from tidemark.plans.q_events import CHECKED, ROW_NUMBER_SQL
from tidemark.sources import gen

KEY = ["o_orderkey"]


def result_sql(name: str, checked: str, failures: str, failed: str, expected="NULL", actual="NULL", source: str = "") -> str:
    return f"""SELECT '{name}' AS validator, CASE WHEN {failed} THEN 'failed' ELSE 'passed' END AS status,
      CAST({checked} AS BIGINT) AS checked, CAST({failures} AS BIGINT) AS failures,
      CAST({expected} AS BIGINT) AS expected, CAST({actual} AS BIGINT) AS actual {source}"""


B, A = "(SELECT count(*) FROM snap_b)", "(SELECT count(*) FROM snap_a)"
COUNTS = ("snap_b", "snap_a")
SUMS_DIFFER = f"(SELECT sum({ROW_NUMBER_SQL}) FROM snap_b) IS DISTINCT FROM (SELECT sum({ROW_NUMBER_SQL}) FROM snap_a)"


@query("v1_row_count", result_sql("row_count", B, f"abs({B} - {A})", f"abs({B} - {A}) > 10", B, A), COUNTS)
def row_count(spark, sf):
    return quality.row_count(i.snapshot_before(spark, sf), i.snapshot_after(spark, sf), 10)


@query(
    "v2_row_count_fraction",
    result_sql("row_count", B, f"abs({B} - {A})", f"abs({B} - {A}) > 0.2 * {B}", B, A),
    COUNTS,
)
def row_count_fraction(spark, sf):
    return quality.row_count(i.snapshot_before(spark, sf), i.snapshot_after(spark, sf), 0.2, "fraction")


@query(
    "v3_row_checksums",
    result_sql("checksum", B, "(SELECT count(*) FROM diff WHERE kind IS NOT NULL)", "true", B, A),
    ("diff",),
)
def row_checksums(spark, sf):
    return quality.checksum(i.snapshot_before(spark, sf), i.snapshot_after(spark, sf), KEY)


@query(
    "v3_row_checksums_exclude",
    result_sql("checksum", B, "(SELECT count(*) FROM diff WHERE kind IN ('insert', 'delete'))", "true", B, A),
    ("diff",),
)
def row_checksums_exclude(spark, sf):
    return quality.checksum(i.snapshot_before(spark, sf), i.snapshot_after(spark, sf), KEY, ["o_totalprice"])


@query(
    "v3_line_checksums",
    result_sql(
        "checksum", "n", "bad", "bad > 0", "n", "n",
        """FROM (SELECT (SELECT count(*) FROM lineitem) AS n, (SELECT count(*) FROM (
          SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING bool_or(l_returnflag = 'R'))) AS bad)""",
    ),
)
def line_checksums(spark, sf):
    """Keys that occur more than once are compared as bags."""
    keys = ["l_orderkey", "l_linenumber"]
    li = i.read(spark, sf, "lineitem").select(*keys, "l_partkey", "l_returnflag", "l_shipdate")
    flag = F.col("l_returnflag")
    return quality.checksum(li, li.withColumn("l_returnflag", F.when(flag == "R", "X").otherwise(flag)), keys)


@query(
    "v4_dataset_checksum",
    result_sql("dataset_checksum", B, f"CASE WHEN {SUMS_DIFFER} THEN 1 ELSE 0 END", SUMS_DIFFER, B, A),
    COUNTS,
)
def dataset_checksum(spark, sf):
    return quality.dataset_checksum_match(i.snapshot_before(spark, sf), i.snapshot_after(spark, sf), CHECKED)


@query(
    "v4_sampled_checksum",
    result_sql(
        "dataset_checksum", "n", "0", "false", "n", "n",
        """FROM (SELECT count(*) FILTER (WHERE CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 15) AS BIGINT) % 100 < 10)
          AS n FROM orders)""",
    ),
)
def sampled_checksum(spark, sf):
    o = i.read(spark, sf, "orders")
    return quality.dataset_checksum_match(o, o, CHECKED, sample_percent=10, key="o_orderkey")


@query(
    "v5_field_match",
    result_sql(
        "field:o_totalprice", "n", "bad", "bad > 0", "0", "bad",
        """FROM (SELECT count(*) AS n, count(*) FILTER (WHERE a.o_totalprice <> b.o_totalprice) AS bad
          FROM snap_a a JOIN snap_b b USING (o_orderkey))""",
    ),
    COUNTS,
)
def field_match(spark, sf):
    return quality.field_match(i.snapshot_before(spark, sf), i.snapshot_after(spark, sf), KEY, "o_totalprice")


@query(
    "j3_compare_rows",
    """SELECT o_orderkey, CASE kind WHEN 'insert' THEN 'extra' WHEN 'delete' THEN 'missing' ELSE 'different' END AS verdict,
      CASE WHEN kind = 'update' THEN 'o_totalprice' END AS fields FROM diff WHERE kind IS NOT NULL""",
    ("diff",),
)
def compare_rows(spark, sf):
    fields = ["o_totalprice", "o_orderstatus", "o_custkey"]
    return quality.compare(i.snapshot_before(spark, sf), i.snapshot_after(spark, sf), KEY, fields)


@query(
    "t4_first_mismatches",
    """SELECT o_orderkey, CASE kind WHEN 'insert' THEN 'extra' WHEN 'delete' THEN 'missing' ELSE 'different' END AS verdict
    FROM diff WHERE kind IS NOT NULL ORDER BY o_orderkey LIMIT 10""",
    ("diff",),
)
def first_mismatches(spark, sf):
    c = quality.compare(i.snapshot_before(spark, sf), i.snapshot_after(spark, sf), KEY, ["o_totalprice"])
    return quality.sample(c, 10, KEY).select("o_orderkey", "verdict")


@query(
    "v6_completeness",
    """SELECT "column", checked, nulls, CASE WHEN nulls > 0 AND "column" <> 'state' THEN 'failed' ELSE 'passed' END AS status FROM (
      SELECT c AS "column", count(*) AS checked, count(*) FILTER (WHERE CASE c WHEN 'email' THEN email WHEN 'first_name' THEN first_name
        WHEN 'state' THEN state ELSE city END IS NULL) AS nulls
      FROM cust, (VALUES ('email'), ('first_name'), ('state'), ('city')) t(c) GROUP BY c)""",
    ("cust",),
)
def completeness(spark, sf):
    return quality.completeness(
        i.customers(spark, sf), ["email", "first_name", "state", "city"], ["email", "first_name", "city"]
    )


@query(
    "v7_duplicate_keys",
    "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def duplicate_keys(spark, sf):
    return quality.duplicate_keys(i.read(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "v7_unique_key",
    result_sql(
        "unique_key", "n", "bad", "bad > 0", "NULL", "NULL",
        """FROM (SELECT sum(c) AS n, count(*) FILTER (WHERE c > 1) AS bad FROM
          (SELECT count(*) AS c FROM lineitem GROUP BY l_orderkey, l_linenumber))""",
    ),
)
def unique_key(spark, sf):
    return quality.unique_key(i.read(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


CHILD_SQL = "(SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_custkey END AS o_custkey FROM orders)"


def _child(spark, sf):
    o = i.read(spark, sf, "orders")
    return o.select("o_orderkey", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey")).alias("o_custkey"))


@query(
    "j2_orphans",
    f"""SELECT o_orderkey, o_custkey FROM {CHILD_SQL} o
    WHERE o_custkey IS NULL OR NOT EXISTS (SELECT 1 FROM parents p WHERE p.c_custkey = o.o_custkey)""",
    ("parents",),
)
def orphans(spark, sf):
    return quality.orphans(_child(spark, sf), i.parents(spark, sf), "o_custkey", "c_custkey")


@query(
    "j2_orphan_keys",
    f"""SELECT o_custkey, count(*) AS "rows" FROM {CHILD_SQL} o
    WHERE o_custkey IS NULL OR NOT EXISTS (SELECT 1 FROM parents p WHERE p.c_custkey = o.o_custkey) GROUP BY 1""",
    ("parents",),
)
def orphan_keys(spark, sf):
    return quality.orphan_keys(_child(spark, sf), i.parents(spark, sf), "o_custkey", "c_custkey")


@query(
    "v8_referential_integrity",
    result_sql(
        "referential_integrity", "n", "bad", "bad > 0", "NULL", "NULL",
        f"""FROM (SELECT count(*) AS n, count(*) FILTER (WHERE o_custkey IS NULL OR NOT EXISTS
          (SELECT 1 FROM parents p WHERE p.c_custkey = o.o_custkey)) AS bad FROM {CHILD_SQL} o)""",
    ),
    ("parents",),
)
def referential_integrity(spark, sf):
    return quality.referential_integrity(_child(spark, sf), i.parents(spark, sf), "o_custkey", "c_custkey")


@query(
    "j5_enrich_counts",
    """SELECT customer_id, customer_tier, coalesce(n, 0) AS total_orders FROM cust
    LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON o_custkey = customer_id""",
    ("cust",),
)
def enrich_counts(spark, sf):
    c = i.customers(spark, sf).select("customer_id", "customer_tier")
    return transform.enrich_counts(c, i.read(spark, sf, "orders"), "customer_id", "o_custkey")


@query(
    "j7_cross_table_rule",
    result_sql(
        "ordered_after_registration", "n", "bad", "bad > 0", "NULL", "NULL",
        """FROM (SELECT count(*) AS n, count(*) FILTER (WHERE NOT o_orderdate >= registration_date) AS bad
          FROM orders JOIN cust ON o_custkey = customer_id)""",
    ),
    ("cust",),
)
def cross_table_rule(spark, sf):
    o = i.read(spark, sf, "orders").select("o_custkey", "o_orderdate")
    c = i.customers(spark, sf).select("customer_id", "registration_date")
    rule = quality.Rule("ordered_after_registration", "o_orderdate >= registration_date")
    return quality.check_cross_rule(o, c, "o_custkey", "customer_id", rule)


@query(
    "j9_coverage",
    result_sql(
        "coverage", "n", "n - got", "got < n * 0.95", "n", "got",
        """FROM (SELECT count(*) AS n, count(*) FILTER (WHERE o_orderkey IN (SELECT o_orderkey FROM snap_a)) AS got FROM snap_b)""",
    ),
    COUNTS,
)
def coverage(spark, sf):
    return quality.coverage(i.snapshot_before(spark, sf), i.snapshot_after(spark, sf), KEY)


@query(
    "v9_type_errors",
    """SELECT "column", "type", (SELECT count(*) FROM part) AS checked, errors,
      CASE WHEN errors > 0 THEN 'failed' ELSE 'passed' END AS status FROM (
      SELECT 'p_size' AS "column", 'INTEGER' AS "type", CAST(0 AS BIGINT) AS errors
      UNION ALL SELECT 'p_brand', 'BIGINT', count(*) FROM part
      UNION ALL SELECT 'p_retailprice', 'SMALLINT', count(*) FROM part
      UNION ALL SELECT 'p_type', 'VARCHAR(25)', 0)""",
)
def type_errors(spark, sf):
    p = i.read(spark, sf, "part")
    text = p.select(
        F.col("p_size").cast("string"), "p_brand", F.format_string("%.2f", "p_retailprice").alias("p_retailprice"), "p_type"
    )
    kinds = {"p_size": "INTEGER", "p_brand": "BIGINT", "p_retailprice": "SMALLINT", "p_type": "VARCHAR(25)"}
    return quality.type_errors(text, kinds)


@query(
    "v10_schema_presence",
    """SELECT count(*) AS orders, 'o_channel' AS missing, 'o_custkey' AS other_type FROM orders""",
)
def schema_presence(spark, sf):
    o = i.read(spark, sf, "orders")
    want = T.StructType(
        [T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.StringType()), T.StructField("o_channel", T.StringType())]
    )
    missing, other = schema.presence(o, want)
    return o.agg(F.count("*").alias("orders")).select(
        "orders", F.lit(",".join(missing)).alias("missing"), F.lit(",".join(other)).alias("other_type")
    )


def _suite(spark, sf):
    b, a = i.snapshot_before(spark, sf), i.snapshot_after(spark, sf)
    return {
        "row_count": lambda: quality.row_count(b, a, 0.2, "fraction"),
        "checksum": lambda: quality.checksum(b, a, KEY),
        "fields": lambda: quality.fields_match(b, a, KEY, ["o_totalprice", "o_orderstatus"]),
        "order_key": lambda: quality.unique_key(a, KEY),
        "customer": lambda: quality.referential_integrity(a, i.parents(spark, sf), "o_custkey", "c_custkey"),
        "no_such_column": lambda: quality.unique_key(a, ["no_such_column"]),
    }


SUITE_SQL = f"""WITH c AS (SELECT {B} AS b, {A} AS a, (SELECT count(*) FROM diff WHERE kind IS NOT NULL) AS d,
      (SELECT count(*) FROM diff WHERE kind = 'update') AS u,
      (SELECT count(*) FROM snap_b JOIN snap_a USING (o_orderkey)) AS pairs,
      (SELECT count(*) FROM snap_a WHERE o_custkey NOT IN (SELECT c_custkey FROM parents)) AS lost),
    r(validator, failed, checked, failures, expected, actual, error) AS (
      SELECT 'checksum', d > 0, b, d, b, a, NULL FROM c
      UNION ALL SELECT 'unique_key', false, a, 0, NULL, NULL, NULL FROM c
      UNION ALL SELECT 'field:o_orderstatus', false, pairs, 0, 0, 0, NULL FROM c
      UNION ALL SELECT 'field:o_totalprice', u > 0, pairs, u, 0, u, NULL FROM c
      UNION ALL SELECT 'row_count', abs(b - a) > 0.2 * b, b, abs(b - a), b, a, NULL FROM c
      UNION ALL SELECT 'referential_integrity', lost > 0, a, lost, NULL, NULL, NULL FROM c
      UNION ALL SELECT 'no_such_column', true, NULL, NULL, NULL, NULL, 'AnalysisException')
    SELECT validator, CASE WHEN failed THEN 'failed' ELSE 'passed' END AS status, CAST(checked AS BIGINT) AS checked,
      CAST(failures AS BIGINT) AS failures, CAST(expected AS BIGINT) AS expected, CAST(actual AS BIGINT) AS actual,
      error FROM r"""


@query("v11_validation_suite", SUITE_SQL, ("diff", "parents"))
def validation_suite(spark, sf):
    return quality.run(spark, _suite(spark, sf)).drop("message")


@query(
    "v11_reconcile",
    f"""SELECT validator, CASE WHEN failures > 0 THEN 'failed' ELSE 'passed' END AS status, checked, failures, expected, actual FROM (
      SELECT 'row_count' AS validator, b AS checked, abs(b - a) AS failures, b AS expected, a AS actual FROM n
      UNION ALL SELECT 'checksum', b, (SELECT count(*) FROM diff WHERE kind IS NOT NULL), b, a FROM n
      UNION ALL SELECT 'missing_keys', b, (SELECT count(*) FROM diff WHERE kind = 'delete'), NULL, NULL FROM n
      UNION ALL SELECT 'extra_keys', a, (SELECT count(*) FROM diff WHERE kind = 'insert'), NULL, NULL FROM n
      UNION ALL SELECT 'unique_source_key', b, 0, NULL, NULL FROM n
      UNION ALL SELECT 'unique_destination_key', a, 0, NULL, NULL FROM n)""".replace("FROM n", f"FROM (SELECT {B} AS b, {A} AS a)"),
    ("diff",),
)
def reconcile(spark, sf):
    return quality.reconcile(i.snapshot_before(spark, sf), i.snapshot_after(spark, sf), KEY)


@query(
    "v12_fail_fast",
    f"SELECT * FROM ({SUITE_SQL}) WHERE validator IN ('row_count', 'checksum')",
    ("diff", "parents"),
)
def fail_fast(spark, sf):
    return quality.run_now(spark, _suite(spark, sf), fail_fast=True).drop("message")


@query(
    "v14_feed_matches_table",
    result_sql("row_count", "n", "0", "false", "n", "n",
               "FROM (SELECT count(*) AS n FROM diff WHERE kind = 'insert')"),
    ("diff",),
)
def feed_matches_table(spark, sf):
    """Inserts in the feed against the rows that were written."""
    from tidemark.operators import diff

    b, a = i.snapshot_before(spark, sf), i.snapshot_after(spark, sf)
    written = a.filter(F.col("o_orderdate") >= F.expr("timestamp_ntz'2001-06-01'"))
    return quality.row_count(written, feed.inserts(diff.snapshot_diff(b, a, KEY)))


RESULTS_SQL = """SELECT event_type AS source_name, CASE WHEN value > 100 THEN 'failed' WHEN value > 60 THEN 'warning'
  WHEN value < 1 THEN 'skipped' ELSE 'passed' END AS status FROM events"""


def _results(spark, sf):
    v = F.col("value")
    status = F.when(v > 100, "failed").when(v > 60, "warning").when(v < 1, "skipped").otherwise("passed")
    return i.read(spark, sf, "events").select(F.col("event_type").alias("source_name"), status.alias("status"))


@query(
    "a17_scorecard",
    f"""SELECT source_name, count(*) AS checks, count(*) FILTER (WHERE status = 'skipped') AS skipped,
      count(*) FILTER (WHERE status = 'passed') AS passed, count(*) FILTER (WHERE status = 'warning') AS warning,
      count(*) FILTER (WHERE status = 'failed') AS failed,
      round(100.0 * (1 - count(*) FILTER (WHERE status = 'failed') / count(*)), 6) AS score,
      round(count(*) FILTER (WHERE status = 'passed') / count(*), 6) AS pass_rate FROM ({RESULTS_SQL}) GROUP BY 1""",
)
def scorecard(spark, sf):
    return quality.scorecard(_results(spark, sf), ["source_name"])


@query(
    "a18_overall_status",
    f"""SELECT source_name, status AS first_status, CASE WHEN bool_or(status = 'failed') THEN 'failed' WHEN bool_or(status = 'warning')
      THEN 'warning' WHEN bool_and(status = 'skipped') THEN 'skipped' ELSE 'passed' END AS overall_status
    FROM ({RESULTS_SQL}) GROUP BY 1, 2""",
)
def overall_status(spark, sf):
    r = _results(spark, sf).withColumn("first_status", F.col("status"))
    return quality.overall(r, ["source_name", "first_status"])


# schemas


BASE_TYPE = "trim(split_part(upper({}), '(', 1))"
EDGE_SQL = "SELECT tbl, col, type FROM schemas WHERE ver = {}"


def _at(spark, sf, version):
    return i.schemas(spark, sf).filter(F.col("version") == version).drop("version")


@query(
    "e1_schema_compatibility",
    f"""SELECT coalesce(s.tbl, d.tbl) AS "table", coalesce(s.col, d.col) AS "column", s.type AS source_type, d.type AS dest_type,
      CASE WHEN d.type IS NULL THEN 'missing' WHEN s.type IS NULL THEN 'extra' WHEN s.type = d.type THEN 'compatible'
        ELSE 'type_mismatch' END AS verdict,
      d.type IS NOT NULL AND (s.type IS NULL OR s.type = d.type) AS ok
    FROM ({EDGE_SQL.format(12)}) s FULL OUTER JOIN ({EDGE_SQL.format(24)}) d ON s.tbl = d.tbl AND s.col = d.col""",
    ("schemas",),
)
def schema_compatibility(spark, sf):
    return schema.compatibility(_at(spark, sf, 12), _at(spark, sf, 24), ["table"])


@query(
    "e1_compatibility_status",
    f"""SELECT coalesce(s.tbl, d.tbl) AS "table", CASE WHEN bool_and(d.type IS NOT NULL AND (s.type IS NULL OR s.type = d.type))
        THEN 'passed' ELSE 'failed' END AS status,
      count(*) FILTER (WHERE s.type IS NOT NULL AND d.type IS NOT NULL) AS common, count(*) FILTER (WHERE d.type IS NULL) AS missing,
      count(*) FILTER (WHERE s.type IS NULL) AS extra, count(*) FILTER (WHERE s.type <> d.type) AS type_mismatches
    FROM ({EDGE_SQL.format(12)}) s FULL OUTER JOIN ({EDGE_SQL.format(24)}) d ON s.tbl = d.tbl AND s.col = d.col GROUP BY 1""",
    ("schemas",),
)
def compatibility_status(spark, sf):
    return schema.compatibility_status(schema.compatibility(_at(spark, sf, 12), _at(spark, sf, 24), ["table"]), ["table"])


EVOLUTION_SQL = f"""SELECT coalesce(o.tbl, n.tbl) AS "table", coalesce(o.col, n.col) AS "column", o.type AS old_type, n.type AS new_type,
  CASE WHEN o.type IS NULL THEN 'added' WHEN n.type IS NULL THEN 'removed' ELSE 'modified' END AS change, o.type IS NULL AS is_safe
FROM ({EDGE_SQL.format(5)}) o FULL OUTER JOIN ({EDGE_SQL.format(25)}) n ON o.tbl = n.tbl AND o.col = n.col
WHERE o.type IS DISTINCT FROM n.type"""


@query("e2_schema_evolution", EVOLUTION_SQL, ("schemas",))
def schema_evolution(spark, sf):
    return schema.evolution(_at(spark, sf, 5), _at(spark, sf, 25), ["table"])


@query(
    "e7_compatibility_modes",
    f"""SELECT "table", mode, count(*) AS changes, count(*) FILTER (WHERE bad) AS breaking,
      CASE WHEN bool_or(bad) THEN 'failed' ELSE 'warning' END AS status FROM (
      SELECT "table", mode, CASE mode WHEN 'backward' THEN NOT is_safe AND change <> 'added'
        WHEN 'forward' THEN change = 'added' OR (change = 'modified' AND NOT is_safe)
        WHEN 'full' THEN change = 'added' OR NOT is_safe ELSE false END AS bad
      FROM ({EVOLUTION_SQL}), (VALUES ('backward'), ('forward'), ('full'), ('none')) m(mode)) GROUP BY 1, 2""",
    ("schemas",),
)
def compatibility_modes(spark, sf):
    changes = schema.evolution(_at(spark, sf, 5), _at(spark, sf, 25), ["table"])
    out = None
    for mode in ("backward", "forward", "full", "none"):
        one = schema.evolution_status(changes, mode, ["table"]).withColumn("mode", F.lit(mode))
        out = one if out is None else out.unionByName(one)
    return out


CHANGES_SQL = """SELECT tbl AS "table", ver AS version, col AS "column", old_type, new_type, change_type,
  change_type <> 'ADD' AS is_breaking FROM changes"""


@query("e3_detect_changes", CHANGES_SQL, ("changes",))
def detect_changes(spark, sf):
    return schema.detect_changes(i.schemas(spark, sf))


@query(
    "e4_schema_from_events",
    """SELECT tbl AS "table", col AS "column", 'BIGINT' AS "type", count(*) AS events FROM drift WHERE col <> 'k' GROUP BY 1, 2
    UNION ALL SELECT tbl, 'k', 'int64', count(*) FROM drift WHERE col = 'k' GROUP BY 1""".replace(
        "'BIGINT' AS \"type\"", "'double' AS \"type\""
    ),
    ("drift",),
)
def schema_from_events(spark, sf):
    d = i.drifting(spark, sf)
    keys = F.map_keys(F.from_json("json", "map<string,string>"))
    leaves = F.transform(
        keys, lambda k: F.struct(k.alias("field"), F.when(k == "k", "int64").otherwise("double").alias("type"))
    )
    block = F.array(
        F.struct(F.lit("before").alias("field"), leaves.alias("fields")),
        F.struct(F.lit("after").alias("field"), leaves.alias("fields")),
    )
    text = F.to_json(F.struct(F.struct(block.alias("fields")).alias("schema")))
    found = schema.from_event(d.select(F.col("event_type").alias("table"), text.alias("text")), "text", ["table"])
    return found.groupBy("table", "column", "type").agg(F.count("*").alias("events"))


@query(
    "e5_field_drift",
    """SELECT tbl AS "table", col AS "column", min(ts) AS first_seen, max(ts) AS last_seen, count(*) AS events
    FROM drift GROUP BY 1, 2""",
    ("drift",),
)
def field_drift(spark, sf):
    return schema.drift(i.drifting(spark, sf), "json", "event_type", "ts")


@query("e5_observed_schemas", 'SELECT tbl AS "table", ver AS version, col AS "column", type AS "type" FROM schemas', ("schemas",))
def observed_schemas(spark, sf):
    return i.schemas(spark, sf)


@query(
    "e6_rename_candidates",
    """SELECT d.tbl AS "table", d.ver AS version, d.old_type AS "type", d.col AS old_name, a.col AS new_name
    FROM changes d JOIN changes a ON d.tbl = a.tbl AND d.ver = a.ver AND d.old_type = a.new_type
    WHERE d.change_type = 'DROP' AND a.change_type = 'ADD'""",
    ("changes",),
)
def rename_candidates(spark, sf):
    return schema.renames(schema.detect_changes(i.schemas(spark, sf)))


@query(
    "e6_renames_by_content",
    """SELECT event_type AS "table", 20 + min(ver - 20) FILTER (WHERE ver >= 20) AS version, 'VARCHAR' AS "type", old_name, new_name
    FROM chg, (VALUES ('actor', 'person'), ('code', 'label')) t(old_name, new_name)
    GROUP BY event_type, old_name, new_name HAVING min(ver) < 20 AND max(ver) >= 20""",
    ("chg",),
)
def renames_by_content(spark, sf):
    """Two renames in one step, told apart by what the columns hold."""
    d = i.renamed(spark, sf)
    seen = schema.observed(d, "json", "event_type", "ver")
    found = schema.renames_by_content(schema.detect_changes(seen), schema.profiles(d, "json", "event_type", "ver"))
    return found.drop("score")


@query(
    "e8_schema_ledger",
    """SELECT tbl AS table_name, ver AS schema_version, change_type, CASE change_type WHEN 'ADD' THEN 'added ' || col || ' ' || new_type
      WHEN 'DROP' THEN 'dropped ' || col || ' ' || old_type ELSE 'changed ' || col || ' from ' || old_type || ' to ' || new_type END
      AS change_description FROM changes""",
    ("changes",),
)
def schema_ledger(spark, sf):
    return schema.ledger(schema.detect_changes(i.schemas(spark, sf)))


@query(
    "e9_conform",
    """SELECT event_id, round(TRY_CAST(CASE WHEN event_id % 5 = 0 THEN 'n/a' ELSE CAST(CAST(value AS INTEGER) AS VARCHAR) END AS DOUBLE), 3) AS value,
      CAST(user_id AS VARCHAR) AS user_id, CAST(NULL AS BIGINT) AS points, event_type FROM events""",
)
def conform(spark, sf):
    target = T.StructType(
        [
            T.StructField("event_id", T.LongType()),
            T.StructField("value", T.DoubleType()),
            T.StructField("user_id", T.StringType()),
            T.StructField("points", T.LongType()),
        ]
    )
    # one value in five is no number
    text = F.when(F.col("event_id") % 5 == 0, "n/a").otherwise(F.bround("value").cast("int").cast("string"))
    e = i.read(spark, sf, "events").select("event_id", text.alias("value"), "user_id", "event_type")
    d = schema.conform(e, target, extra="keep")
    return d.select("event_id", F.round("value", 3).alias("value"), "user_id", "points", "event_type")


@query(
    "e10_no_loss_in_evolution",
    f"""SELECT count(*) AS "rows", CAST(sum({ROW_NUMBER_SQL}) AS VARCHAR) AS checksum FROM orders""",
)
def no_loss_in_evolution(spark, sf):
    """Old columns have the same checksum after a column was added and one widened."""
    o = i.read(spark, sf, "orders")
    narrow = o.withColumn("o_custkey", F.col("o_custkey").cast("int"))
    target = T.StructType([*o.schema.fields, T.StructField("o_channel", T.StringType())])
    return quality.dataset_checksum(schema.conform(narrow, target), CHECKED)


@query(
    "e11_schema_from_pairs",
    "SELECT event_id AS id, event_type AS kind, CAST(value AS DOUBLE) AS amount, props AS extra FROM events",
)
def schema_from_pairs(spark, sf):
    wanted = schema.from_pairs([("id", "long"), ("kind", "string"), ("amount", "double"), ("extra", "json")])
    e = i.read(spark, sf, "events").select("event_id", "event_type", "value", "props")
    return schema.conform(e.toDF(*wanted.names), wanted)


# generated rows


def _draw(key: str, name: str, n: int) -> str:
    return f"(CAST('0x' || substr(md5(concat_ws('-', '0', '{name}', CAST({key} AS VARCHAR))), 1, 8) AS BIGINT) % {n})"


@query(
    "g1_generated_customers",
    f"""SELECT c_custkey AS customer_id, 'user' || c_custkey || '@example.com' AS email, CASE WHEN {_draw('c_custkey', 'tier', 100)} < 40
      THEN 'Bronze' WHEN {_draw('c_custkey', 'tier', 100)} < 70 THEN 'Silver' WHEN {_draw('c_custkey', 'tier', 100)} < 90 THEN 'Gold'
      ELSE 'Platinum' END AS customer_tier, {_draw('c_custkey', 'active', 100)} < 95 AS is_active,
      {_draw('c_custkey', 'value', 500001)} / 100 AS lifetime_value FROM customer""",
)
def generated_customers(spark, sf):
    c = gen.table("customers", i.read(spark, sf, "customer"), key="c_custkey")
    return c.select("customer_id", "email", "customer_tier", "is_active", "lifetime_value")


@query(
    "g1_generated_orders",
    f"""SELECT o_orderkey AS order_id, o_custkey AS customer_id, ({_draw('o_orderkey', 'total', 199001)} + 1000) / 100 AS total_amount
    FROM orders""",
)
def generated_orders(spark, sf):
    o = gen.table("orders", i.read(spark, sf, "orders"), customer="o_custkey", key="o_orderkey")
    return o.select("order_id", "customer_id", "total_amount")


MOVES_SQL = f"""SELECT event_id, prev, CASE kind WHEN 0 THEN a % 91 + 10 WHEN 1 THEN -(a % least(50, prev) + 1) ELSE a % 41 - 20 END AS m, kind
  FROM (SELECT event_id, {_draw('event_id', 'previous', 451)} + 50 AS prev, {_draw('event_id', 'amount', 1000003)} AS a,
    {_draw('event_id', 'kind', 3)} AS kind FROM events)"""


@query(
    "g1_generated_inventory",
    f"""SELECT event_id AS transaction_id, CASE kind WHEN 0 THEN 'IN' WHEN 1 THEN 'OUT' ELSE 'ADJUSTMENT' END AS transaction_type,
      abs(m) AS quantity, prev AS previous_quantity, greatest(0, prev + m) AS new_quantity FROM ({MOVES_SQL})""",
)
def generated_inventory(spark, sf):
    d = gen.table("inventory", i.read(spark, sf, "events"), product="user_id", key="event_id")
    return d.select("transaction_id", "transaction_type", "quantity", "previous_quantity", "new_quantity")


@query(
    "g1_generated_products",
    f"""SELECT p_partkey AS product_id, ({_draw('p_partkey', 'price', 199001)} + 1000) / 100 AS price,
      {_draw('p_partkey', 'stock', 501)} AS stock_quantity FROM part""",
)
def generated_products(spark, sf):
    p = gen.table("products", i.read(spark, sf, "part"), key="p_partkey")
    return p.select("product_id", "price", "stock_quantity")


@query(
    "g1_generated_order_items",
    f"""SELECT l_orderkey * 10 + l_linenumber AS order_item_id, l_orderkey AS order_id, l_partkey AS product_id,
      {_draw('(l_orderkey * 10 + l_linenumber)', 'quantity', 10)} + 1 AS quantity FROM lineitem""",
)
def generated_order_items(spark, sf):
    li = i.read(spark, sf, "lineitem").withColumn("id", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    d = gen.table("order_items", li, order="l_orderkey", product="l_partkey")
    return d.select("order_item_id", "order_id", "product_id", "quantity")


@query(
    "g1_generated_suppliers",
    f"""SELECT s_suppkey AS supplier_id, 'Supplier ' || s_suppkey AS supplier_name,
      'Contact' || {_draw('s_suppkey', 'contact', 1000)} AS contact_name FROM supplier""",
)
def generated_suppliers(spark, sf):
    s = gen.table("suppliers", i.read(spark, sf, "supplier"), key="s_suppkey")
    return s.select("supplier_id", "supplier_name", "contact_name")


@query(
    "g2_change_events_from_table",
    """SELECT CASE kind WHEN 'insert' THEN 'INSERT' WHEN 'update' THEN 'UPDATE' ELSE 'DELETE' END AS operation,
      count(*) AS events, count(*) FILTER (WHERE kind <> 'insert') AS with_before, count(*) FILTER (WHERE kind <> 'delete') AS with_after
    FROM diff WHERE kind IS NOT NULL GROUP BY 1""",
    ("diff",),
)
def change_events_from_table(spark, sf):
    from tidemark.operators import diff, envelope

    d = diff.paired(i.snapshot_before(spark, sf), i.snapshot_after(spark, sf), KEY)
    op = F.when(F.col("kind") == "insert", "c").when(F.col("kind") == "update", "u").otherwise("d")
    rows = d.select("o_orderkey", F.col("b").alias("before"), op.alias("op"), F.col("a.o_totalprice"), F.lit(0).alias("at"))
    e = envelope.build_events(rows, ["o_orderkey", "o_totalprice"], "orders", "shop", "op", "at", KEY)
    return e.groupBy("operation").agg(
        F.count("*").alias("events"), F.count("before").alias("with_before"), F.count("after").alias("with_after")
    )


@query(
    "g3_inventory_rules",
    """SELECT r AS rule, (SELECT count(*) FROM events) AS checked, CAST(0 AS BIGINT) AS failures, 'passed' AS status
    FROM (VALUES ('quantity_adds_up'), ('quantity_not_negative')) t(r)""",
)
def inventory_rules(spark, sf):
    d = gen.table("inventory", i.read(spark, sf, "events"), product="user_id", key="event_id")
    return quality.check_rules(d, quality.INVENTORY_RULES)
