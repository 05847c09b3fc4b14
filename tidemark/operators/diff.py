"""Differences between two states of a table, and the change feeds they amount to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import checksum
from tidemark.operators.feed import CHANGE_TYPE


def _others(df: DataFrame, keys: Sequence[str]) -> list[str]:
    return [c for c in df.columns if c not in keys]


def _differs(columns: Sequence[str], left: str, right: str) -> Column:
    out = F.lit(False)
    for c in columns:
        out = out | ~F.col(f"{left}.`{c}`").eqNullSafe(F.col(f"{right}.`{c}`"))
    return out


def paired(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys, b, a, kind`` for every key that differs; kind is insert, update or delete.

    Keys are unique in each state (check with ``quality.duplicate_keys``), so the outer join yields
    one row per key and no task holds more than its share of keys.
    """
    rest = _others(before, keys)
    b = before.select(*keys, F.struct(*before.columns).alias("b"))
    a = after.select(*keys, F.struct(*before.columns).alias("a"))
    kind = (
        F.when(F.col("b").isNull(), "insert")
        .when(F.col("a").isNull(), "delete")
        .when(_differs(rest, "b", "a"), "update")
    )
    return b.join(a, list(keys), "full_outer").withColumn("kind", kind).filter(F.col("kind").isNotNull())


def differing_keys(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys whose row differs, judged by 128 bits of hash of the typed values.

    One aggregation of a key and four longs per key; no row is shuffled.
    """
    columns = before.columns

    def side(df: DataFrame, name: str) -> DataFrame:
        h1, h2 = checksum.row_hash(columns), checksum.row_hash(columns, salt="second")
        return df.select(*keys, h1.alias("h1"), h2.alias("h2"), F.lit(name).alias("side"))

    both = side(before, "b").unionAll(side(after, "a"))
    per = both.groupBy(*keys).agg(
        F.count_if(F.col("side") == "b").alias("nb"), F.count_if(F.col("side") == "a").alias("na"),
        F.min("h1").alias("l1"), F.max("h1").alias("u1"), F.min("h2").alias("l2"), F.max("h2").alias("u2"),
    )
    same = (F.col("nb") == F.col("na")) & (F.col("l1") == F.col("u1")) & (F.col("l2") == F.col("u2"))
    return per.filter(~same).select(*keys)


def snapshot_diff(
    before: DataFrame, after: DataFrame, keys: Sequence[str], images: bool = True, strategy: str = "rows"
) -> DataFrame:
    """Change feed that turns ``before`` into ``after``; updates give a row for each image.

    ``images=False`` leaves the old image of updates out. ``strategy="rows"`` joins whole rows and
    compares every value. ``strategy="hashes"`` is for large tables with few changes: it first finds
    the differing keys by hash (see ``differing_keys``) and then joins only their rows, reading each
    table twice but shuffling no row that stayed the same.
    """
    if strategy == "hashes":
        changed = differing_keys(before, after, keys)
        before, after = (x.join(changed, list(keys), "left_semi").select(*before.columns) for x in (before, after))
    elif strategy != "rows":
        raise ValueError("strategy is 'rows' or 'hashes'")
    d = paired(before, after, keys)

    def entry(kind: str, row: Column) -> Column:
        return F.struct(F.lit(kind).alias("t"), row.alias("r"))

    update = [entry("update_preimage", F.col("b")), entry("update_postimage", F.col("a"))][0 if images else 1 :]
    rows = (
        F.when(F.col("kind") == "insert", F.array(entry("insert", F.col("a"))))
        .when(F.col("kind") == "delete", F.array(entry("delete", F.col("b"))))
        .otherwise(F.array(*update))
    )
    return d.select(F.explode(rows).alias("e")).select("e.r.*", F.col("e.t").alias(CHANGE_TYPE))


def incremental(before: DataFrame, after: DataFrame, keys: Sequence[str], where: str | Column | None = None) -> DataFrame:
    """Rows that ``after`` has and ``before`` has not, or has with other values."""
    d = paired(before, after, keys).filter(F.col("kind") != "delete").select("a.*")
    if where is None:
        return d
    return d.filter(F.expr(where) if isinstance(where, str) else where)


def changed_fields(columns: Sequence[str], before: str = "before", after: str = "after") -> Column:
    """Names of the fields whose value differs, in column order; empty when an image is missing."""
    names = [
        F.when(~F.col(f"{before}.`{c}`").eqNullSafe(F.col(f"{after}.`{c}`")), F.lit(c)) for c in columns
    ]
    both = F.col(before).isNotNull() & F.col(after).isNotNull()
    return F.when(both, F.array_compact(F.array(*names))).otherwise(F.array().cast("array<string>"))


def _text_bytes(df: DataFrame) -> Column:
    size = F.lit(0).cast("bigint")
    for c in df.columns:
        size = size + F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0))
    return size


def compare_states(before: DataFrame, after: DataFrame, sizes: bool = False) -> DataFrame:
    """One row: row counts of two states, their difference, and whether the schemas differ.

    ``sizes`` adds the bytes of the values as text; without it no column is read.
    """

    def side(df: DataFrame, n: int) -> DataFrame:
        return df.select(F.lit(n).alias("b"), (_text_bytes(df) if sizes else F.lit(0).cast("bigint")).alias("z"))

    changed = [(f.name, f.dataType) for f in before.schema] != [(f.name, f.dataType) for f in after.schema]
    old, new = F.col("b") == 1, F.col("b") == 0
    out = side(before, 1).unionAll(side(after, 0)).agg(
        F.count_if(old).alias("rows_before"),
        F.count_if(new).alias("rows_after"),
        F.coalesce(F.sum(F.when(old, F.col("z"))), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum(F.when(new, F.col("z"))), F.lit(0)).alias("bytes_after"),
    )
    out = out.withColumns(
        {
            "row_difference": F.col("rows_after") - F.col("rows_before"),
            "byte_difference": F.col("bytes_after") - F.col("bytes_before"),
            "schema_changed": F.lit(changed),
        }
    )
    return out if sizes else out.drop("bytes_before", "bytes_after", "byte_difference")


def files(before: DataFrame, after: DataFrame, path: str = "file_path") -> DataFrame:
    """Data files added to or deleted from a table between two listings (see ``file_listing``)."""
    listed = before.select(path, F.lit(1).alias("b"), F.lit(0).alias("a")).unionAll(
        after.select(path, F.lit(0).alias("b"), F.lit(1).alias("a"))
    )
    seen = listed.groupBy(path).agg(F.max("b").alias("b"), F.max("a").alias("a")).filter(F.col("a") != F.col("b"))
    return seen.select(path, F.when(F.col("a") == 1, "added").otherwise("deleted").alias("change"))


def file_listing(table: DataFrame) -> DataFrame:
    """Files behind a file-based frame, with their size and row count."""
    meta = table.select(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("file_size")
    )
    return meta.groupBy("file_path", "file_size").agg(F.count("*").alias("rows"))
