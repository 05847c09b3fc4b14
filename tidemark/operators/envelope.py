"""Change events: parse, flatten, standardise, filter and build them.

A *raw* frame has the message columns ``key, value, topic, partition, offset, timestamp``. A *parsed*
frame has ``before, after, source, op, ts_ms`` (full envelope) and keeps the position columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import ordered, scalar

CORRUPT = "_corrupt_record"
POSITION = ("topic", "partition", "offset", "timestamp")

# Field names of the change-event format.
SOURCE_FIELDS = {
    "lsn": [
        ("version", "string"), ("connector", "string"), ("name", "string"), ("ts_ms", "bigint"),
        ("db", "string"), ("schema", "string"), ("table", "string"), ("lsn", "bigint"), ("txId", "bigint"),
    ],
    "binlog": [
        ("version", "string"), ("connector", "string"), ("name", "string"), ("ts_ms", "bigint"),
        ("db", "string"), ("table", "string"), ("file", "string"), ("pos", "bigint"),
        ("server_id", "bigint"), ("gtid", "string"), ("thread", "bigint"),
    ],
}
FLAT_FIELDS = [
    ("__op", "string"), ("__deleted", "string"), ("__db", "string"),
    ("__table", "string"), ("__ts_ms", "bigint"), ("__lsn", "bigint"),
]
DEFAULT_TABLE = "unknown"
DEFAULT_SCHEMA = "public"


def _fields(pairs: Sequence[tuple[str, str]]) -> list[T.StructField]:
    return [T.StructField(n, T._parse_datatype_string(t)) for n, t in pairs]


def envelope_schema(row: T.StructType, kind: str = "lsn") -> T.StructType:
    return T.StructType(
        [
            T.StructField("before", row),
            T.StructField("after", row),
            T.StructField("source", T.StructType(_fields(SOURCE_FIELDS[kind]))),
            T.StructField("op", T.StringType()),
            T.StructField("ts_ms", T.LongType()),
        ]
    )


def flat_schema(row: T.StructType) -> T.StructType:
    return T.StructType([*row.fields, *_fields(FLAT_FIELDS)])


def _decode(raw: DataFrame, body: T.StructType) -> DataFrame:
    """One JSON parse per row; the body may be bare or wrapped in ``payload``. Tombstones go.

    The parsed struct goes through a generator (one row in, one row out): filters on its fields stay
    above it, where pushing them below would repeat the parse for every condition.
    """
    whole = T.StructType([*body.fields, T.StructField("payload", body), T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(F.col("value").cast("string"), whole, {"mode": "PERMISSIVE"})
    kept = [c for c in raw.columns if c not in ("key", "value")]
    messages = raw.filter(F.col("value").isNotNull())
    decoded = messages.select(*kept, F.explode(F.array(parsed)).alias("__j"))
    fields = [F.coalesce(F.col(f"__j.payload.`{n}`"), F.col(f"__j.`{n}`")).alias(n) for n in body.names]
    return decoded.select(*kept, *fields, F.col(f"__j.{CORRUPT}").alias(CORRUPT))


def parse(raw: DataFrame, row: T.StructType, kind: str = "lsn") -> DataFrame:
    """Full-envelope JSON to columns; bad text leaves nulls and fills the corrupt column."""
    return _decode(raw, envelope_schema(row, kind))


def parse_flat(raw: DataFrame, row: T.StructType) -> DataFrame:
    """Unwrapped JSON (business columns beside ``__`` columns) to columns."""
    return _decode(raw, flat_schema(row))


def parse_any(raw: DataFrame, row: T.StructType, kind: str = "binlog") -> DataFrame:
    """Rows may be either form: a message with ``__op`` is unwrapped, anything else an envelope."""
    both = T.StructType([*envelope_schema(row, kind).fields, *flat_schema(row).fields])
    d = _decode(raw, both)
    flat = F.col("__op").isNotNull()
    image = F.struct(*[F.col(n) for n in row.names])
    deleted = F.col("__op") == "d"
    fields = dict(SOURCE_FIELDS[kind])
    known = {"db": F.col("__db"), "table": F.col("__table"), "ts_ms": F.col("__ts_ms"), "lsn": F.col("__lsn")}
    source = F.struct(*[known.get(n, F.lit(None)).cast(t).alias(n) for n, t in fields.items()])
    return d.select(
        *[c for c in d.columns if c in raw.columns and c not in row.names],
        F.when(flat & deleted, image).when(~flat, F.col("before")).alias("before"),
        F.when(flat & ~deleted, image).when(~flat, F.col("after")).alias("after"),
        F.when(flat, source).otherwise(F.col("source")).alias("source"),
        F.coalesce("__op", "op").alias("op"),
        F.coalesce("__ts_ms", "ts_ms").alias("ts_ms"),
        flat.alias("is_flat"),
        CORRUPT,
    )


def payload_row(op: str | Column = "op", before: str = "before", after: str = "after") -> Column:
    """The row an event is about: the old image for deletes, the new one otherwise."""
    return F.when(scalar.col(op) == "d", F.col(before)).otherwise(F.col(after))


def unwrap(parsed: DataFrame) -> DataFrame:
    """Envelope to the flat form; a delete becomes its last row with ``__deleted = 'true'``."""
    row = parsed.schema["after"].dataType.names
    source = set(parsed.schema["source"].dataType.names)
    return parsed.withColumn("__row", payload_row()).select(
        *[c for c in POSITION if c in parsed.columns],
        *[F.col(f"__row.`{n}`").alias(n) for n in row],
        F.col("op").alias("__op"),
        F.when(F.col("op") == "d", "true").otherwise("false").alias("__deleted"),
        F.col("source.db").alias("__db"),
        F.col("source.table").alias("__table"),
        F.coalesce("ts_ms", "source.ts_ms").alias("__ts_ms"),
        (F.col("source.lsn") if "lsn" in source else F.lit(None).cast("bigint")).alias("__lsn"),
    )


def standardize(parsed: DataFrame, kind: str = "lsn", keys: Sequence[str] = ()) -> DataFrame:
    """Parsed events in the common form ``operation, table, data, before, timestamp, metadata``."""
    s = {n: F.col(f"source.{n}") for n in parsed.schema["source"].dataType.names}
    if kind == "lsn":
        metadata = F.struct(
            s["db"].alias("database"),
            F.coalesce(s["schema"], F.lit(DEFAULT_SCHEMA)).alias("schema"),
            s["connector"].alias("connector"),
            s["lsn"].alias("lsn"),
            s["txId"].alias("txId"),
        )
    elif kind == "binlog":
        metadata = F.struct(
            s["db"].alias("database"),
            s["file"].alias("binlog_file"),
            s["pos"].alias("binlog_position"),
            s["server_id"].alias("server_id"),
            s["gtid"].alias("gtid"),
            s["thread"].alias("thread"),
        )
    else:
        raise ValueError(f"unknown source kind {kind!r}; one of {sorted(SOURCE_FIELDS)}")
    out = [
        *[F.col(c) for c in POSITION if c in parsed.columns],
        scalar.op_name("op").alias("operation"),
        F.coalesce(s["table"], F.lit(DEFAULT_TABLE)).alias("table"),
        payload_row().alias("data"),
        F.when(F.col("op").isin("u", "d"), F.col("before")).alias("before"),
        scalar.epoch_millis(s["ts_ms"]).alias("timestamp" if "timestamp" not in parsed.columns else "event_timestamp"),
        metadata.alias("metadata"),
    ]
    if keys:
        out.append(key_of(keys).alias("primary_key"))
    return parsed.select(*out)


def business_columns(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in df.columns if not c.startswith("__")])


def business_fields(json_text: str | Column) -> Column:
    """Business entries of a JSON object as a map of texts, for rows without a fixed schema."""
    entries = F.from_json(scalar.col(json_text), "map<string,string>")
    return F.map_filter(entries, lambda k, _: ~k.startswith("__"))


def key_of(keys: Sequence[str], before: str = "before", after: str = "after") -> Column:
    """Key of an event: from the new image, else from the old one."""
    return F.struct(*[F.coalesce(F.col(f"{after}.`{k}`"), F.col(f"{before}.`{k}`")).alias(k) for k in keys])


def with_errors(parsed: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Add ``_error``: null for good events, else the first thing wrong with the event."""
    flat = "__op" in parsed.columns
    op = F.col("__op") if flat else F.col("op")
    error = F.when(F.col(CORRUPT).isNotNull(), F.lit("malformed")).when(op.isNull(), F.lit("missing op"))
    error = error.when(~op.isin(*scalar.OP_NAMES), F.lit("unknown op"))
    if not flat:
        error = error.when(F.col("source").isNull(), F.lit("missing source"))
    for k in keys:
        key = F.col(f"`{k}`") if flat else F.coalesce(F.col(f"after.`{k}`"), F.col(f"before.`{k}`"))
        error = error.when(key.isNull(), F.lit("missing key"))
    return parsed.withColumn("_error", error)


def split_invalid(parsed: DataFrame, keys: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(good, dead letter). Only a null key counts as missing; 0 and '' are keys."""
    marked = with_errors(parsed, keys)
    good = marked.filter(F.col("_error").isNull()).drop("_error", CORRUPT)
    return good, marked.filter(F.col("_error").isNotNull())


def for_table(df: DataFrame, table: str) -> DataFrame:
    return df.filter(_table(df) == table)


def for_ops(df: DataFrame, ops: Sequence[str]) -> DataFrame:
    return df.filter(F.col("__op" if "__op" in df.columns else "op").isin(*ops))


def _table(df: DataFrame) -> Column:
    for name in ("__table", "table"):
        if name in df.columns:
            return F.col(name)
    return F.col("source.table")


def add_before(
    changes: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    columns: Sequence[str],
    op: str = "op",
    bucket: Column | None = None,
    hot_rows: int = ordered.HOT_ROWS,
) -> DataFrame:
    """Add ``before``: the image the key had ahead of an update or delete, null when it had none.

    ``bucket`` (a column rising with the order, see ``functions.ordered``) keeps keys with more than
    ``hot_rows`` rows parallel; it is the hour unless given, if the order starts with a time.
    """
    kept = changes.columns
    bucket = ordered.default_bucket(changes, order_by) if bucket is None else bucket
    if bucket is not None:
        changes = ordered.split_hot(changes, keys, bucket, "__cut", hot_rows)
    image = F.struct(F.col(op).alias("__op"), *[F.col(c) for c in columns])
    d = ordered.previous(changes, keys, order_by, image, "__prev", None if bucket is None else "__cut")
    had_row = F.col(op).isin("u", "d") & (F.col("__prev.__op") != "d")
    old = F.struct(*[F.col(f"__prev.{c}").alias(c) for c in columns])
    return d.select(*kept, F.when(had_row, old).alias("before"))


def dedupe(events: DataFrame, id_columns: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Keep the first delivery of every event; map-side pruned, so a hot id costs one row per task."""
    from tidemark.operators.apply import first_per_key

    return first_per_key(events, id_columns, order_by)


def build(
    rows: DataFrame,
    columns: Sequence[str],
    source: Column,
    op: str | Column = "op",
    before: str | Column | None = "before",
    ts_ms: str | Column = "ts_ms",
) -> DataFrame:
    """Row changes to full-envelope JSON text in ``value``; the other columns stay."""
    op, image = scalar.col(op), F.struct(*[F.col(c) for c in columns])
    old = scalar.col(before) if before is not None else F.lit(None)
    body = F.struct(
        old.alias("before"),
        F.when(op != "d", image).alias("after"),
        source.alias("source"),
        op.alias("op"),
        scalar.col(ts_ms).alias("ts_ms"),
    )
    return rows.withColumn("value", F.to_json(body))


def build_events(
    rows: DataFrame, columns: Sequence[str], table: str, source: str, op: str | Column, at: str | Column, key: Sequence[str]
) -> DataFrame:
    """Rows to standard events (id, operation, source, table, times, before, after)."""
    op, image = scalar.col(op), F.struct(*[F.col(c) for c in columns])
    old = F.col("before") if "before" in rows.columns else image
    return rows.select(
        scalar.event_id(F.lit(table), *key, op, scalar.col(at)).alias("event_id"),
        scalar.op_name(op).alias("operation"),
        F.lit(source).alias("source"),
        F.lit(table).alias("table"),
        scalar.col(at).alias("event_time"),
        F.when(op.isin("u", "d"), old).alias("before"),
        F.when(op != "d", image).alias("after"),
    )
