"""Ordered per-key scans that stay parallel inside one hot key.

A plain window puts all rows of a key into one task. Here the rows of a key are also cut by
``bucket``, a column that never decreases along the order (a day, an id range). Each
(key, bucket) is scanned on its own; what a bucket has to know of the earlier ones is computed
on a summary with one row per (key, bucket) and joined back. Without ``bucket`` the plain window
is used, which is right when the rows per key are known to be few.

A null bucket means the key is not cut. ``split_hot`` sets the bucket for hot keys only, so that the
summary is as small as the hot keys' number of buckets and all other keys are scanned as usual.

Keys must not be null: send such rows to the dead-letter side first (``envelope.split_invalid``).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalar import col

_B, _CARRY, _LOCAL, _FIRST = "__bucket", "__carry", "__local", "__first"


def day_bucket(ts: str | Column) -> Column:
    return col(ts).cast("date")


def range_bucket(number: str | Column, width: int) -> Column:
    """Equal ranges of an increasing number, such as a log position or an offset."""
    return F.floor(col(number) / F.lit(width))


# Defaults of ``split_hot``: rows of one key that a single task can still put in order with ease, and the number
# of keys that may be hot. Callers set both.
HOT_ROWS = 1_000_000
MAX_HOT_KEYS = 100_000
# Width of a range of whole numbers.
NUMBERS = 1_000_000


def hot_keys(df: DataFrame, keys: Sequence[str], rows: int = HOT_ROWS, most: int = MAX_HOT_KEYS) -> DataFrame:
    """Keys with more than ``rows`` rows and more than their share of 1 / ``most`` of all rows, so
    there are at most ``most`` of them."""
    share = df.select((F.count("*") / F.lit(most)).alias("s")).scalar()
    per_key = df.groupBy(*keys).agg(F.count("*").alias("__n"))
    return per_key.filter(F.col("__n") > F.greatest(F.lit(float(rows)), share)).select(*keys)


def default_bucket(df: DataFrame, order_by: Sequence[str]) -> Column | None:
    """The hour, when the rows are ordered by a time first; ranges of ``NUMBERS`` when it is a whole number (a log
    position, an offset); None when nothing is known of the order."""
    kind = df.schema[order_by[0]].dataType.typeName()
    if kind in ("timestamp", "timestamp_ntz"):
        return F.date_trunc("hour", F.col(order_by[0]))
    return range_bucket(order_by[0], NUMBERS) if kind in ("long", "integer", "short") else None


def split_hot(
    df: DataFrame, keys: Sequence[str], bucket: Column, name: str, rows: int = HOT_ROWS, most: int = MAX_HOT_KEYS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Add the bucket column ``name``: the bucket for rows of hot keys, null for all others. With ``rows`` 0 every
    key is cut by its bucket.

    Costs a count per key, which reads the key columns only and combines map-side. The hot keys are
    broadcast, so ``df`` is not shuffled for this; ``most`` bounds their number. ``counted`` is a cheaper frame whose
    rows per key are no fewer.
    """
    if rows <= 0:
        return df.withColumn(name, bucket)
    hot = F.broadcast(hot_keys(df if counted is None else counted, keys, rows, most).withColumn("__hot", F.lit(True)))
    return df.join(hot, list(keys), "left").withColumn(name, F.when(F.col("__hot"), bucket)).select(*df.columns, name)


def _window(keys: Sequence[str], order_by: Sequence[str | Column]):
    return Window.partitionBy(*keys).orderBy(*[col(o) for o in order_by])


@dataclass(frozen=True)
class Step:
    """One column of a scan: its value inside a bucket, what a bucket hands on, and both combined."""

    local: Callable
    summary: Callable[[list[str | Column]], Column]
    carry: Callable
    combine: Callable[[Column, Column], Column]


def _before(w):
    return w.rowsBetween(Window.unboundedPreceding, -1)


def _so_far(w):
    return w.rowsBetween(Window.unboundedPreceding, 0)


def _mark(order_by: Sequence[str | Column]) -> Column:
    return F.struct(*[col(o) for o in order_by])


def prior(value: Column) -> Step:
    """``value`` of the preceding row of the key."""
    return Step(
        local=lambda w: F.lag(value).over(w),
        summary=lambda order_by: F.max_by(value, _mark(order_by)),
        carry=lambda edge, w: F.lag(edge).over(w),
        combine=lambda here, before: F.when(F.col(_FIRST), before).otherwise(here),
    )


def total(value: Column) -> Step:
    """Sum of ``value`` up to and including this row."""
    return Step(
        local=lambda w: F.sum(value).over(_so_far(w)),
        summary=lambda order_by: F.sum(value),
        carry=lambda edge, w: F.sum(edge).over(_before(w)),
        combine=lambda here, before: here + F.coalesce(before, F.lit(0)),
    )


def position() -> Step:
    """1-based position of the row in the order of its key."""
    return total(F.lit(1).cast("bigint"))


def known(value: Column) -> Step:
    """Latest non-null ``value`` at or before this row."""
    return Step(
        local=lambda w: F.last(value, ignorenulls=True).over(_so_far(w)),
        summary=lambda order_by: F.max_by(value, F.when(value.isNotNull(), _mark(order_by))),
        carry=lambda edge, w: F.last(edge, ignorenulls=True).over(_before(w)),
        combine=lambda here, before: F.coalesce(here, before),
    )


def known_before(value: Column) -> Step:
    """Latest non-null ``value`` of the rows before this one."""
    return Step(
        local=lambda w: F.last(value, ignorenulls=True).over(_before(w)),
        summary=lambda order_by: F.max_by(value, F.when(value.isNotNull(), _mark(order_by))),
        carry=lambda edge, w: F.last(edge, ignorenulls=True).over(_before(w)),
        combine=lambda here, before: F.coalesce(here, before),
    )


def scan(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str | Column],
    steps: Mapping[str, Step],
    bucket: str | Column | None = None,
) -> DataFrame:
    """Add one column per step, all in the same pass over the ordered rows of each key.

    A bucket named by a column stays in the result, so that a second scan over the same keys and bucket
    finds the rows already in place and does not shuffle again.
    """
    if bucket is None:
        if not keys:
            raise ValueError("one order over all rows needs a bucket")
        w = _window(keys, order_by)
        return df.withColumns({name: s.local(w) for name, s in steps.items()})
    b = bucket if isinstance(bucket, str) else _B
    cut = df if isinstance(bucket, str) else df.withColumn(b, bucket)
    inner = _window([*keys, b], order_by)
    here = {f"{_LOCAL}{n}": s.local(inner) for n, s in enumerate(steps.values())}
    scanned = cut.withColumns({**here, _FIRST: F.row_number().over(inner) == 1})
    edges = cut.filter(F.col(b).isNotNull()).groupBy(*keys, b).agg(*[s.summary(order_by).alias(f"__edge{n}") for n, s in enumerate(steps.values())])
    outer = _window(keys, [b])
    carried = edges.select(
        *keys, b, *[s.carry(F.col(f"__edge{n}"), outer).alias(f"{_CARRY}{n}") for n, s in enumerate(steps.values())]
    )
    joined = scanned.join(carried, [*keys, b], "left")
    added = [
        s.combine(F.col(f"{_LOCAL}{n}"), F.col(f"{_CARRY}{n}")).alias(name)
        for n, (name, s) in enumerate(steps.items())
    ]
    return joined.select(*df.columns, *added)


def previous(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], value: Column, name: str, bucket: str | Column | None = None
) -> DataFrame:
    return scan(df, keys, order_by, {name: prior(value)}, bucket)


def running_sum(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], value: Column, name: str, bucket: str | Column | None = None
) -> DataFrame:
    return scan(df, keys, order_by, {name: total(value)}, bucket)


def row_position(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], name: str, bucket: str | Column | None = None
) -> DataFrame:
    return scan(df, keys, order_by, {name: position()}, bucket)


def last_known(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], value: Column, name: str, bucket: str | Column | None = None
) -> DataFrame:
    return scan(df, keys, order_by, {name: known(value)}, bucket)
