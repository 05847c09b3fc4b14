"""Validators and schema comparison."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import quality as q
from tidemark.operators import schema


def rows(spark, n, start=0):
    return spark.range(start, start + n).select("id", F.concat(F.lit("v"), "id").alias("v"))


def status(df):
    return df.first().status


def test_row_count(spark):
    assert status(q.row_count(rows(spark, 10), rows(spark, 10))) == "passed"
    assert status(q.row_count(rows(spark, 10), rows(spark, 8), 1)) == "failed"
    assert status(q.row_count(rows(spark, 10000), rows(spark, 9950), 0.01, "fraction")) == "passed"
    assert status(q.row_count(rows(spark, 0), rows(spark, 1), 0.5, "fraction")) == "failed"
    assert status(q.row_count(rows(spark, 0), rows(spark, 0), 0.5, "fraction")) == "passed"
    r = q.row_count(rows(spark, 3), rows(spark, 5)).first()
    assert (r.expected, r.actual, r.failures) == (3, 5, 2)


@pytest.mark.parametrize("algorithm", ["xxhash64", "md5", "sha256"])
def test_checksum_by_key_not_by_position(spark, algorithm):
    a = rows(spark, 50)
    shuffled = a.orderBy(F.col("id").desc())
    assert status(q.checksum(a, shuffled, ["id"], algorithm=algorithm)) == "passed"
    changed = a.withColumn("v", F.when(F.col("id") == 7, "other").otherwise(F.col("v")))
    r = q.checksum(a, changed, ["id"], algorithm=algorithm).first()
    assert (r.status, r.failures) == ("failed", 1)
    assert status(q.checksum(a, changed, ["id"], exclude=["v"], algorithm=algorithm)) == "passed"
    assert status(q.checksum(a, rows(spark, 49), ["id"], algorithm=algorithm)) == "failed"


def test_checksum_of_repeated_and_null_keys(spark):
    a = spark.createDataFrame([(1, "a"), (1, "b"), (None, "x"), (None, "y")], "id long, v string")
    b = spark.createDataFrame([(None, "y"), (1, "b"), (None, "x"), (1, "a")], "id long, v string")
    c = spark.createDataFrame([(None, "y"), (1, "b"), (None, "x"), (1, "b")], "id long, v string")
    assert status(q.checksum(a, b, ["id"])) == "passed"
    r = q.checksum(a, c, ["id"]).first()
    assert (r.status, r.failures) == ("failed", 1)


def test_reconcile(spark):
    a = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (3, "c")], "id long, v string")
    b = spark.createDataFrame([(1, "a"), (2, "x"), (4, "d"), (3, "c"), (3, "c")], "id long, v string")
    got = {r.validator: (r.status, r.failures) for r in q.reconcile(a, b, ["id"], tolerance=1).collect()}
    assert got == {
        "row_count": ("passed", 1), "checksum": ("failed", 2), "missing_keys": ("passed", 0), "extra_keys": ("failed", 1),
        "unique_source_key": ("failed", 1), "unique_destination_key": ("failed", 1),
    }
    same = q.reconcile(a.limit(0), a.limit(0), ["id"]).collect()
    assert {r.status for r in same} == {"passed"} and len(same) == 6


def test_dataset_checksum_is_additive_and_order_free(spark):
    a = rows(spark, 1000)
    whole = q.dataset_checksum(a).first()
    assert whole == q.dataset_checksum(a.repartition(7)).first()
    parts = q.combine_checksums(q.dataset_checksum(a.filter("id < 300")), q.dataset_checksum(a.filter("id >= 300")))
    assert parts.first() == whole
    assert q.dataset_checksum(a.limit(0)).first().checksum == "0"
    assert status(q.dataset_checksum_match(a, a.repartition(3))) == "passed"
    assert status(q.dataset_checksum_match(a, a.withColumn("v", F.lit("x")))) == "failed"


def test_dataset_checksum_by_hand(spark):
    import hashlib

    a = spark.createDataFrame([(1, "a"), (2, None)], "id long, v string")
    want = sum(int(hashlib.md5(t.encode()).hexdigest()[:15], 16) for t in ("id=1:1|v=1:a", "id=1:2|v=-"))
    assert q.dataset_checksum(a).first().checksum == str(want)


def test_fields(spark):
    a = spark.createDataFrame([(1, "a", 1), (2, None, 2), (3, "c", 3)], "id long, v string, w int")
    b = spark.createDataFrame([(3, "c", 9), (2, None, 2), (1, "z", 1)], "id long, v string, w int")
    got = {r.validator: (r.status, r.failures, r.actual) for r in q.fields_match(a, b, ["id"], ["v", "w"], ["w"]).collect()}
    assert got == {"field:v": ("failed", 1, 1), "field:w": ("failed", 1, 1)}
    assert q.field_match(a, a, ["id"], "v").first().failures == 1
    assert status(q.field_match(a, a, ["id"], "v", required=False)) == "passed"


def test_compare(spark):
    a = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id long, v string")
    b = spark.createDataFrame([(2, "x"), (3, "c"), (4, "d")], "id long, v string")
    got = {(r.id, r.verdict, r.fields) for r in q.compare(a, b, ["id"], ["v"]).collect()}
    assert got == {(1, "missing", None), (2, "different", "v"), (4, "extra", None)}


def test_orphans(spark):
    orders = spark.createDataFrame([(1, 1), (2, 999), (3, None)], "order_id long, customer_id long")
    customers = spark.createDataFrame([(1,), (None,)], "id long")
    assert sorted(r.order_id for r in q.orphans(orders, customers, "customer_id", "id").collect()) == [2, 3]
    r = q.referential_integrity(orders, customers, "customer_id", "id").first()
    assert (r.status, r.checked, r.failures) == ("failed", 3, 2)
    assert {r.customer_id: r.rows for r in q.orphan_keys(orders, customers, "customer_id", "id").collect()} == {999: 1, None: 1}


def test_orphans_with_a_hot_key(spark):
    """A third of the child rows hold one lost key, another third no key; no row is lost or doubled."""
    c = spark.range(30000).select(
        "id", F.when(F.col("id") % 3 == 0, 777).when(F.col("id") % 3 == 1, F.col("id") % 50).alias("fk")
    )
    p = spark.range(50).withColumnRenamed("id", "pk").unionAll(spark.range(50))
    got = q.orphans(c, p, "fk", "pk")
    assert got.count() == 20000 and got.filter("fk = 777").count() == 10000
    assert got.select("id").distinct().count() == 20000


def test_rules(spark):
    d = spark.createDataFrame(
        [(1, "a@x.io", "+15551234567", "Gold", 5.0), (2, "bad", None, "Gold", -1.0), (None, None, "x", None, 0.0)],
        "customer_id long, email string, phone string, customer_tier string, lifetime_value double",
    )
    got = {r.rule: r.failures for r in q.check_rules(d, q.CUSTOMER_RULES).collect()}
    assert got == {"email_format": 2, "phone_format": 1, "tier_known": 1, "lifetime_value_not_negative": 1}
    kept, out = q.apply_rules(d, q.BUSINESS_RULES)
    assert [r.customer_id for r in kept.collect()] == [1]
    assert {r.customer_id: r.broken_rules for r in out.collect()} == {
        2: ["lifetime_value_not_negative"], None: ["email_present", "customer_id_present"]}


def test_event_rules(spark):
    s = "struct<id:long>"
    rows_ = [
        ("e1", "INSERT", None, (1,), 1, 2, 3), ("e1", "UPDATE", (1,), (2,), 1, 2, 3), ("e2", "DELETE", (1,), (1,), 5, 2, 3),
        (None, "READ", None, None, 1, 1, 1), ("e3", "INSERT", (1,), (1,), 1, 1, 1), ("e4", "UPDATE", None, (1,), 1, 1, 1),
    ]
    d = spark.createDataFrame(
        rows_, f"event_id string, operation string, before {s}, after {s}, source_ts int, capture_ts int, process_ts int"
    )
    got = {r.rule: r.failures for r in q.check_events(d, ["id"]).collect()}
    assert got == {
        "operation_known": 1, "insert_has_no_before": 1, "delete_has_no_after": 1, "update_has_both": 1,
        "key_unchanged": 1, "times_in_order": 1, "event_id_present": 1, "event_id_unique": 1,
    }


def test_completeness_duplicates_types(spark):
    d = spark.createDataFrame([("1", None), ("x", "b"), ("x", None)], "a string, b string")
    assert {r.column: (r.nulls, r.status) for r in q.completeness(d, ["a", "b"]).collect()} == {
        "a": (0, "passed"), "b": (2, "failed")}
    assert q.duplicate_keys(d, ["a"]).first().copies == 2
    assert status(q.unique_key(d, ["a", "b"])) == "passed"
    got = {r.column: r.errors for r in q.type_errors(d, {"a": "INTEGER", "b": "VARCHAR(10)"}).collect()}
    assert got == {"a": 2, "b": 0}


def test_coverage_and_cross_rule(spark):
    assert status(q.coverage(rows(spark, 100), rows(spark, 95), ["id"])) == "passed"
    assert status(q.coverage(rows(spark, 100), rows(spark, 94), ["id"])) == "failed"
    child = spark.createDataFrame([(1, 5), (1, 1), (2, 9)], "fk long, day int")
    parent = spark.createDataFrame([(1, 3)], "pk long, since int")
    r = q.check_cross_rule(child, parent, "fk", "pk", q.Rule("after", "day >= since")).first()
    assert (r.validator, r.status, r.checked, r.failures) == ("after", "failed", 2, 1)


def test_suite(spark):
    ok = lambda: q.row_count(rows(spark, 1), rows(spark, 1))
    bad = lambda: q.row_count(rows(spark, 1), rows(spark, 2))
    broken = lambda: q.unique_key(rows(spark, 1), ["nope"])
    res = q.run(spark, {"a": ok, "b": bad, "c": broken})
    assert sorted((r.validator, r.status) for r in res.collect()) == [("c", "failed"), ("row_count", "failed"), ("row_count", "passed")]
    assert q.overall(res).first()[0] == "failed"
    assert q.run(spark, {}).first().status == "warning"
    assert q.run(spark, {"a": ok, "b": bad}, only=["a"]).count() == 1
    assert q.run_now(spark, {"b": bad, "a": ok}, fail_fast=True).count() == 1
    assert q.run_now(spark, {"b": bad, "a": ok}).count() == 2
    fails_late = lambda: rows(spark, 1).select(F.lit("late").alias("validator"), F.raise_error(F.lit("x")).alias("status"),
                                               *[F.lit(1).alias(c) for c in q.RESULT_COLUMNS[2:]])
    late = q.run_now(spark, {"late": fails_late}).first()
    assert late.status == "failed" and late.error and late.message
    lost = q.run(spark, {"c": broken}).first()
    assert lost.error == "AnalysisException" and "nope" in lost.message
    with pytest.raises(KeyError):
        q.run(spark, {"own": lambda: {}["mistake"]})


@pytest.mark.parametrize(
    "given,want",
    [(["passed", "failed", "warning"], "failed"), (["passed", "warning"], "warning"), (["skipped", "passed"], "passed"),
     (["skipped"], "skipped"), ([], "skipped")],
)
def test_overall(spark, given, want):
    d = spark.createDataFrame([(s,) for s in given], "status string")
    assert q.overall(d).first()[0] == want


def test_scorecard(spark):
    d = spark.createDataFrame([("a", s) for s in ("passed", "passed", "failed", "skipped")], "p string, status string")
    r = q.scorecard(d, ["p"]).first()
    assert (r.checks, r.failed, r.score, r.pass_rate) == (4, 1, 75.0, 0.5)


# schemas


def frame(spark, pairs, **more):
    d = spark.createDataFrame(list(pairs.items()), "column string, type string")
    return d.withColumns({k: F.lit(v) for k, v in more.items()})


BASE = {"id": "INTEGER", "version": "INTEGER", "name": "VARCHAR(100)", "description": "TEXT"}


def test_compatibility(spark):
    s = frame(spark, {"id": "INTEGER", "name": "VARCHAR(100)", "email": "VARCHAR(255)"})
    d = frame(spark, {"id": "BIGINT", "name": "STRING", "email": "STRING", "created_at": "TIMESTAMP"})
    v = schema.compatibility(s, d)
    assert {r.column: r.verdict for r in v.collect()} == {
        "id": "compatible", "name": "compatible", "email": "compatible", "created_at": "extra"}
    assert schema.compatibility_status(v).first().status == "passed"
    assert schema.compatibility_status(schema.compatibility(s, d, exact=True)).first().status == "failed"
    assert schema.compatibility_status(schema.compatibility(d, s)).first().missing == 1


@pytest.mark.parametrize(
    "a,b,lenient,strict",
    [("INTEGER", "BIGINT", True, True), ("BIGINT", "INTEGER", True, False), ("DECIMAL(10,2)", "NUMERIC(12,2)", True, False),
     ("VARCHAR(50)", "TEXT", True, True), ("DATE", "TIMESTAMP", False, True), ("BOOLEAN", "STRING", False, True),
     ("TEXT", "INTEGER", False, False)],
)
def test_type_pairs(spark, a, b, lenient, strict):
    d = spark.createDataFrame([(a, b)], "a string, b string")
    r = d.select(schema.compatible(F.col("a"), F.col("b")), schema.compatible(F.col("a"), F.col("b"), "strict")).first()
    assert tuple(r) == (lenient, strict)


def test_evolution(spark):
    new = {**BASE, "email": "VARCHAR(255)", "id": "BIGINT"}
    e = schema.evolution(frame(spark, BASE), frame(spark, new))
    assert {(r.column, r.change, r.is_safe) for r in e.collect()} == {("email", "added", True), ("id", "modified", True)}
    assert schema.evolution_status(e).first().status == "warning"
    del new["name"]
    e = schema.evolution(frame(spark, BASE), frame(spark, new))
    assert schema.evolution_status(e).first().status == "failed"
    assert schema.evolution_status(e, "none").first().status == "warning"
    same = schema.evolution(frame(spark, BASE), frame(spark, BASE))
    assert schema.evolution_status(same).first().status == "passed"


def sequence(spark, *versions):
    out = None
    for n, pairs in enumerate(versions, 1):
        d = frame(spark, pairs, table="t", version=n)
        out = d if out is None else out.unionByName(d)
    return out


def test_detect_changes(spark):
    v2 = {**BASE, "email": "VARCHAR(255)"}
    v3 = {k: t for k, t in v2.items() if k != "description"}
    v4 = {**v3, "version": "VARCHAR(50)"}
    c = schema.detect_changes(sequence(spark, BASE, v2, v3, v4))
    got = sorted((r.version, r.change_type, r.column, r.is_breaking) for r in c.collect())
    assert got == [(2, "ADD", "email", False), (3, "DROP", "description", True), (4, "ALTER", "version", True)]
    text = {r.schema_version: r.change_description for r in schema.ledger(c).collect()}
    assert text[4] == "changed version from INTEGER to VARCHAR(50)"


def test_schema_swap_and_rename(spark):
    c = schema.detect_changes(sequence(spark, {"a": "INTEGER", "b": "TEXT"}, {"x": "INTEGER", "y": "DATE"}))
    assert sorted((r.change_type, r.column) for r in c.collect()) == [("ADD", "x"), ("ADD", "y"), ("DROP", "a"), ("DROP", "b")]
    assert [(r.old_name, r.new_name) for r in schema.renames(c).collect()] == [("a", "x")]


def test_observed_types(spark):
    d = spark.createDataFrame([("t", 1, '{"a": 1, "b": true, "c": null}'), ("t", 1, '{"a": 1.5, "d": "x"}'), ("t", 1, "broken")],
                              "t string, v int, j string")
    got = {r.column: r.type for r in schema.observed(d, "j", "t", "v").collect()}
    assert got == {"a": "DOUBLE", "b": "BOOLEAN", "d": "VARCHAR"}


def test_schema_from_event(spark):
    import json

    body = {"schema": {"fields": [
        {"field": "before", "fields": [{"field": "old", "type": "int32"}]},
        {"field": "after", "fields": [{"field": "id", "type": "int32"}, {"field": "name", "type": "string"}]},
        {"field": "op", "type": "string"}]}}
    d = spark.createDataFrame([(json.dumps(body),), ("{}",)], "j string")
    assert {r.column: r.type for r in schema.from_event(d, "j").collect()} == {"id": "int32", "name": "string"}


def test_conform_and_pairs(spark):
    want = schema.from_pairs([("id", "long"), ("n", "int"), ("s", "something"), ("at", "timestamp")])
    assert [f.dataType.simpleString() for f in want.fields] == ["bigint", "int", "string", "timestamp"]
    d = spark.createDataFrame([("5", "x", 1)], "id string, n string, more int")
    r = schema.conform(d, want, extra="keep")
    assert r.columns == ["id", "n", "s", "at", "more"] and tuple(r.first()) == (5, None, None, None, 1)
    missing, other = schema.presence(d, want)
    assert (missing, other) == (["s", "at"], ["id", "n"])
    assert isinstance(schema.of_frame(d, "t").schema["type"].dataType, T.StringType)
