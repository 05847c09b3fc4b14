"""Collapse change batches and apply them to tables.

The order columns must be total: two events of one key may never tie. c, r and u set the row, d
removes it, and a d for an unknown key does nothing. An event with any other op, or none, changes nothing
(``split_by_op`` sets such events aside). Keys must not be null.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANK = "__rank"
# Ops that set a row, and the one that removes it.
SETS, REMOVES = ("c", "r", "u"), "d"


def has_op(op: str | Column) -> Column:
    """Whether an event's op says what to do with its row."""
    value = F.col(op) if isinstance(op, str) else op
    return F.coalesce(value.isin(*SETS, REMOVES), F.lit(False))


def split_by_op(changes: DataFrame, op: str = "op") -> tuple[DataFrame, DataFrame]:
    """(events that can be applied, all others: null, truncate or unknown ops)."""
    return changes.filter(has_op(op)), changes.filter(~has_op(op))


def _pick(df: DataFrame, keys: Sequence[str], order: list[Column]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(RANK, F.row_number().over(w)).filter(F.col(RANK) == 1).drop(RANK)


def latest_per_key(changes: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Last change per key. Plans as a group limit ahead of the shuffle: a task sends at most one
    row per key, however many changes a hot key has."""
    if not order_by:
        raise ValueError("latest_per_key needs a total order")
    return _pick(changes, keys, [F.col(c).desc_nulls_last() for c in order_by])


def first_per_key(changes: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    if not order_by:
        raise ValueError("first_per_key needs a total order")
    return _pick(changes, keys, [F.col(c).asc_nulls_last() for c in order_by])


def apply_changes(
    base: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    op: str = "op",
    on_delete: str = "remove",
    strategy: str = "probe",
) -> DataFrame:
    """Table after the change batch; ``base`` has one row per key.

    ``probe`` (small batch on a large table) anti-joins the table with the changed keys, which
    Spark broadcasts when their measured size allows, so the table is then not shuffled; the batch
    is collapsed twice. ``merge`` (batch comparable to the table) collapses once and does one
    full outer join. ``on_delete="mark"`` keeps deleted rows with ``is_deleted = true``.
    """
    if on_delete not in ("remove", "mark"):
        raise ValueError("on_delete is 'remove' or 'mark'")
    columns = [c for c in base.columns if c != "is_deleted"]
    known = changes.filter(has_op(op)).select(*columns, F.col(op).alias("__op"), *_extra(order_by, columns))
    last = latest_per_key(known, keys, order_by)
    if strategy == "merge":
        return _merge(base, last, keys, columns, on_delete)
    if strategy != "probe":
        raise ValueError("strategy is 'probe' or 'merge'")
    deleted = F.col("__op") == "d"
    if on_delete == "remove":
        untouched = base.select(*columns).join(last.select(*keys), list(keys), "left_anti")
        return untouched.unionByName(last.filter(~deleted).select(*columns))
    marked = base.select(*columns, _was_deleted(base))
    live = last.filter(~deleted).select(*columns, F.lit(False).alias("is_deleted"))
    gone = last.select(*keys, "__op")
    kept = marked.join(gone, list(keys), "left").filter(F.col("__op").isNull() | (F.col("__op") == "d"))
    kept = kept.withColumn("is_deleted", F.col("is_deleted") | F.col("__op").isNotNull()).drop("__op")
    return kept.unionByName(live)


def _extra(order_by: Sequence[str], columns: Sequence[str]) -> list[str]:
    return [c for c in order_by if c not in columns]


def _was_deleted(base: DataFrame) -> Column:
    was = F.col("is_deleted") if "is_deleted" in base.columns else F.lit(False)
    return F.coalesce(was, F.lit(False)).alias("is_deleted")


def _merge(base: DataFrame, last: DataFrame, keys: Sequence[str], columns: Sequence[str], on_delete: str) -> DataFrame:
    old = base.select(*keys, F.struct(*columns).alias("__old"), _was_deleted(base))
    new = last.select(*keys, F.struct(*columns).alias("__new"), "__op")
    joined = old.join(new, list(keys), "full_outer")
    sets = F.col("__op").isNotNull() & (F.col("__op") != "d")
    removes = F.coalesce(F.col("__op") == "d", F.lit(False))
    picked = joined.withColumn("__row", F.when(sets, F.col("__new")).otherwise(F.col("__old")))
    out = [F.col(f"__row.`{c}`").alias(c) for c in columns]
    if on_delete == "remove":
        return picked.filter(~removes).select(*out)
    kept = picked.filter(~(removes & F.col("__old").isNull()))
    flag = F.when(sets, False).when(removes, True).otherwise(F.col("is_deleted"))
    return kept.select(*out, flag.alias("is_deleted"))


def merge_latest(base: DataFrame, newer: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Last row per key over a base with one row per key and further changes.

    Base rows without changes pass through: when the changed keys are few enough for Spark to broadcast
    them, the base is not shuffled. Only contested keys are put in order.
    """
    last = latest_per_key(newer, keys, order_by)
    touched = last.select(*keys)
    untouched = base.join(touched, list(keys), "left_anti")
    contested = base.join(touched, list(keys), "left_semi").unionByName(last)
    return untouched.unionByName(latest_per_key(contested, keys, order_by).select(*untouched.columns))


def upsert(base: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with a known key replace it, the others are added; ``rows`` has one row per key."""
    return base.join(rows.select(*keys), list(keys), "left_anti").unionByName(rows.select(*base.columns))


def delete_keys(base: DataFrame, gone: DataFrame, keys: Sequence[str]) -> DataFrame:
    return base.join(gone.select(*keys), list(keys), "left_anti")


def delete_where(base: DataFrame, condition: str | Column) -> DataFrame:
    """Rows for which the condition is false or unknown stay."""
    cond = F.expr(condition) if isinstance(condition, str) else condition
    return base.filter(~F.coalesce(cond, F.lit(False)))


def replace_where(base: DataFrame, rows: DataFrame, condition: str | Column) -> DataFrame:
    """Delete what the condition matches, then append the rows."""
    return delete_where(base, condition).unionByName(rows.select(*base.columns))


def append_evolving(base: DataFrame, rows: DataFrame) -> DataFrame:
    """Append rows that may have new columns; missing values become null."""
    return base.unionByName(rows, allowMissingColumns=True)
