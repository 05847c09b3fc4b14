"""Event parsing, filtering, projection."""

import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import diff, envelope, transform

ROW = T.StructType([T.StructField("customer_id", T.LongType()), T.StructField("email", T.StringType())])
RAW = "key binary, value binary, topic string, partition int, offset long"


def raw(spark, *bodies):
    rows = []
    for n, b in enumerate(bodies):
        text = b if b is None or isinstance(b, str) else json.dumps(b)
        rows.append((None, None if text is None else bytearray(text, "utf8"), "t", 0, n))
    return spark.createDataFrame(rows, RAW)


def event(op, before=None, after=None, table="customers", **more):
    return {"before": before, "after": after, "op": op, "ts_ms": 1700000000000,
            "source": {"table": table, "db": "shop", "ts_ms": 1700000000000, "lsn": 5, **more}}


A, B = {"customer_id": 1, "email": "a@x.io"}, {"customer_id": 1, "email": "b@x.io"}


def test_parse_bare_and_wrapped(spark):
    d = envelope.parse(raw(spark, event("c", None, A), {"schema": {}, "payload": event("u", A, B)}), ROW)
    got = d.orderBy("offset").select("op", "after.email", "source.table").collect()
    assert [tuple(r) for r in got] == [("c", "a@x.io", "customers"), ("u", "b@x.io", "customers")]


def test_tombstones_are_dropped_and_bad_events_kept_apart(spark):
    bodies = [None, "{not json", "", event("c", None, A), {"after": A}, event("x", None, A), {"op": "c", "after": A},
              event("c", None, {"email": "no key"}), event("c", None, {"customer_id": 0, "email": ""})]
    good, bad = envelope.split_invalid(envelope.parse(raw(spark, *bodies), ROW), ["customer_id"])
    assert [r.offset for r in good.orderBy("offset").collect()] == [3, 8]
    errors = {r.offset: r._error for r in bad.collect()}
    assert errors == {1: "malformed", 2: "missing op", 4: "missing op", 5: "unknown op", 6: "missing source", 7: "missing key"}


def test_wrong_type_is_malformed(spark):
    _, bad = envelope.split_invalid(envelope.parse(raw(spark, event("c", None, {"customer_id": "abc"})), ROW))
    assert bad.first()["_error"] == "malformed"


def test_delete_payload_is_the_old_row(spark):
    d = envelope.parse(raw(spark, event("d", A, None), event("u", A, B)), ROW)
    got = d.orderBy("offset").select(envelope.payload_row().alias("r")).collect()
    assert [r.r.email for r in got] == ["a@x.io", "b@x.io"]


def test_standardize_defaults(spark):
    e = event("r", None, A)
    e["source"] = {"db": "shop"}
    s = envelope.standardize(envelope.parse(raw(spark, e), ROW), "lsn", ["customer_id"]).first()
    assert (s.operation, s.table, s.metadata.schema, s.primary_key.customer_id) == ("READ", "unknown", "public", 1)


def test_parse_any_takes_both_forms(spark):
    flat = {**B, "__op": "u", "__table": "customers", "__db": "shop", "__ts_ms": 5, "__deleted": "false"}
    d = envelope.parse_any(raw(spark, event("d", A, None, file="bin.1", pos=7), flat), ROW)
    s = envelope.standardize(d, "binlog").orderBy("offset").collect()
    assert [(r.operation, r.data.email, r.metadata.binlog_position) for r in s] == [
        ("DELETE", "a@x.io", 7),
        ("UPDATE", "b@x.io", None),
    ]


def test_unwrap_keeps_deleted_row(spark):
    r = envelope.unwrap(envelope.parse(raw(spark, event("d", A, None)), ROW)).first()
    assert (r.customer_id, r.email, r.__getitem__("__deleted"), r.__getitem__("__op")) == (1, "a@x.io", "true", "d")


def test_changed_fields(spark):
    d = envelope.parse(raw(spark, event("u", A, B), event("u", A, A), event("c", None, A)), ROW)
    got = d.orderBy("offset").select(diff.changed_fields(["customer_id", "email"]).alias("f")).collect()
    assert [r.f for r in got] == [["email"], [], []]


def test_filters(spark):
    d = envelope.parse(raw(spark, event("c", None, A), event("d", A, None, table="orders")), ROW)
    assert envelope.for_table(d, "orders").count() == 1
    assert envelope.for_ops(d, ["c", "u"]).count() == 1


def test_drop_deletes_is_null_safe(spark):
    rows = [(1, "d", "false"), (2, "u", "true"), (3, None, None), (4, "c", None), (5, None, "false")]
    d = spark.createDataFrame(rows, "id int, __op string, __deleted string")
    assert sorted(r.id for r in transform.drop_deletes(d).collect()) == [3, 4, 5]


def test_projection_defaults(spark):
    d = spark.createDataFrame([(1, "a@x.io", None, None)], "customer_id int, email string, first_name string, city string")
    r = transform.customer_analytics(d).first()
    assert (r.full_name, r.location, r.lifetime_value, r.is_active, r.total_orders) == ("Unknown", "Unknown", 0.0, True, 0)
    assert r["_cdc_operation"] == "INSERT" and r["_source_system"] == "postgres_cdc"


def test_build_and_parse_round_trip(spark):
    rows = spark.createDataFrame([(1, "a@x.io", "c", 5), (2, None, "d", 6)], "customer_id long, email string, op string, ts_ms long")
    src = F.struct(F.lit("customers").alias("table"))
    built = envelope.build(rows, ROW.names, src, before=F.when(F.col("op") == "d", F.struct(*ROW.names)))
    back = envelope.parse(built.select("value", "op").withColumnRenamed("op", "o"), ROW).orderBy("ts_ms").collect()
    assert (back[0].after.customer_id, back[0].before) == (1, None)
    assert (back[1].after, back[1].before.customer_id) == (None, 2)


def test_json_is_parsed_once(spark):
    """Filters on parsed fields stay above the parse."""
    good, _ = envelope.split_invalid(envelope.parse(raw(spark, event("c", None, A)), ROW), ["customer_id"])
    plan = envelope.for_table(good, "customers")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1


def test_business_columns(spark):
    d = spark.createDataFrame([(1, "x", "u")], "id int, name string, __op string")
    assert envelope.business_columns(d).columns == ["id", "name"]


def test_flatten(spark):
    d = spark.createDataFrame([((1, (2, "x")), [3])], "a struct<b:int,c:struct<d:int,e:string>>, f array<int>")
    assert transform.flatten(d).columns == ["a_b", "a_c_d", "a_c_e", "f"]
