"""Checksum trees over key ranges: two tables are compared from the top down, and rows are read only where ranges differ.

The key is a whole number (or a date or time, read as one). A leaf covers 2^``leaf_bits`` keys, a node of the level above
2^``FAN_BITS`` nodes of the level below. Every node holds the number of its rows and the sums of their 64-bit hashes in
three pieces, so nodes are added and subtracted: rows that come or go change one node per level, and trees of the parts
of a table add up to the tree of the table. The order of rows doesn't matter, repeated rows count as often as they occur.

A tree is a frame ``(level, node, rows, h0, h1, h2)``, small against its table: store it and hand it to ``differing``.
Null keys are one node (null) per level. Two bags of rows with equal sums are taken for equal.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import checksum, lineage

LEAF_BITS, FAN_BITS, LEVELS = 12, 6, 4
SUMS = ["rows", "h0", "h1", "h2"]
#: Most key ranges that are put into the filter of a scan; beyond it they are those of a higher level.
MAX_RANGES = 200


def _place(df: DataFrame, key: str) -> Column:
    kind = df.schema[key].dataType
    if isinstance(kind, T.IntegralType):
        return F.col(key).cast("long")
    if isinstance(kind, T.DateType):
        return F.unix_date(key).cast("long")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_seconds(F.col(key).cast("timestamp"))
    raise TypeError(f"the key {key} is neither a whole number nor a date or time")


def build(df: DataFrame, key: str, columns: Sequence[str] | None = None, leaf_bits: int = LEAF_BITS, levels: int = LEVELS, sign: int = 1) -> DataFrame:
    """The tree of a table in one aggregation; ``sign=-1`` for rows that went. The upper levels are made of the leaves."""
    number = checksum.row_hash(sorted(columns or df.columns))
    leaf = F.shiftright(_place(df, key), leaf_bits)
    rows = df.select(leaf.alias("node"), number.alias("number"), F.lit(sign).cast("long").alias("sign"))
    leaves = rows.groupBy("node").agg(F.sum("sign").alias("rows"), *checksum.hash_sums(F.col("number"), "h", F.col("sign")))
    return _up(leaves, levels)


def _up(leaves: DataFrame, levels: int) -> DataFrame:
    every = leaves.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(levels - 1))))
    node = F.expr(f"shiftright(node, level * {FAN_BITS})")
    return every.select("level", node.alias("node"), *SUMS).groupBy("level", "node").agg(*[F.sum(c).alias(c) for c in SUMS])


def combine(*trees: DataFrame) -> DataFrame:
    """The tree of all rows that the trees stand for. Nodes that come to nothing are left out."""
    total = reduce(DataFrame.unionByName, trees).groupBy("level", "node").agg(*[F.sum(c).alias(c) for c in SUMS])
    return total.filter(reduce(Column.__or__, [F.col(c) != 0 for c in SUMS]))


def differing(a: DataFrame, b: DataFrame, levels: int = LEVELS) -> DataFrame:
    """(node, rows_a, rows_b) of the leaves that differ. A level's nodes are looked at only below nodes that differ."""

    def at(level: int, under: DataFrame | None) -> DataFrame:
        sides = []
        for tree, sign in ((a, 1), (b, -1)):
            nodes = tree.filter(F.col("level") == level)
            if under is not None:
                nodes = nodes.join(under, F.shiftright("node", FAN_BITS).eqNullSafe(F.col("parent")), "left_semi")
            sums = [(F.col(c) * sign).alias(c) for c in SUMS]
            counts = [F.when(F.lit(sign == s), F.col("rows")).otherwise(0).alias(n) for s, n in ((1, "rows_a"), (-1, "rows_b"))]
            sides.append(nodes.select("node", *sums, *counts))
        both = sides[0].unionAll(sides[1]).groupBy("node").agg(*[F.sum(c).alias(c) for c in [*SUMS, "rows_a", "rows_b"]])
        return both.filter(reduce(Column.__or__, [F.col(c) != 0 for c in SUMS]))

    found = at(levels - 1, None)
    for level in reversed(range(levels - 1)):
        found = at(level, found.select(F.col("node").alias("parent")))
    return found.select("node", "rows_a", "rows_b")


def ranges(leaves: DataFrame, leaf_bits: int = LEAF_BITS, levels: int = LEVELS, most: int = MAX_RANGES) -> list[tuple[int, int]]:
    """First and last place of the key ranges that hold the leaves, of the lowest level with at most so many nodes;
    neighbours are joined. At most ``most`` numbers come to the driver."""
    nodes = [F.shiftright("node", FAN_BITS * k) for k in range(levels)]
    sizes = leaves.agg(*[F.count_distinct(n).alias(f"n{k}") for k, n in enumerate(nodes)], F.min("node").alias("lo"), F.max("node").alias("hi")).first()
    if sizes.lo is None:
        return []
    level = next((k for k in range(levels) if sizes[f"n{k}"] <= most), None)
    if level is None:  # still too many: one range around all
        return [(sizes.lo << leaf_bits, ((sizes.hi + 1) << leaf_bits) - 1)]
    bits = leaf_bits + FAN_BITS * level
    out: list[list[int]] = []
    for (n,) in leaves.filter("node is not null").select(nodes[level]).distinct().collect():
        out.append([n << bits, ((n + 1) << bits) - 1])
    joined: list[tuple[int, int]] = []
    for lo, hi in sorted(out):
        if joined and joined[-1][1] + 1 == lo:
            joined[-1] = (joined[-1][0], hi)
        else:
            joined.append((lo, hi))
    return joined


def _bound(df: DataFrame, key: str, place: int) -> Column:
    """A place as a value of the key's own type, so that the filter reaches the scan; numbers stay within the type."""
    kind = df.schema[key].dataType
    if isinstance(kind, T.IntegralType):
        most = 2 ** ({"tinyint": 8, "smallint": 16, "int": 32}.get(kind.simpleString(), 64) - 1)
        return F.lit(max(-most, min(most - 1, place))).cast(kind)
    if isinstance(kind, T.DateType):
        return F.date_from_unix_date(F.lit(place).cast("int"))
    return F.timestamp_seconds(F.lit(place)).cast(kind)


def rows_in(df: DataFrame, key: str, leaves: DataFrame, found: Sequence[tuple[int, int]], leaf_bits: int = LEAF_BITS) -> DataFrame:
    """The rows of a table in the given leaves. Their key ranges (``ranges``) are part of the scan's filter, so on a table
    that is sorted or clustered by its key only their files and row groups are read."""
    k = F.col(key)
    timed = isinstance(df.schema[key].dataType, (T.TimestampType, T.TimestampNTZType))
    # a time's last place is a whole second
    inside = [(k >= _bound(df, key, lo)) & ((k < _bound(df, key, hi + 1)) if timed else (k <= _bound(df, key, hi))) for lo, hi in found]
    kept = df.filter(reduce(Column.__or__, inside, k.isNull()))
    return kept.join(leaves.select("node"), F.shiftright(_place(df, key), leaf_bits).eqNullSafe(F.col("node")), "left_semi")


def compare(
    a: DataFrame, b: DataFrame, tree_a: DataFrame, tree_b: DataFrame, key: str, leaf_bits: int = LEAF_BITS, levels: int = LEVELS
) -> tuple[DataFrame, DataFrame]:
    """The rows of both tables in the leaves that differ: whatever differs between the tables differs between these.
    The leaves are written once, as three steps read them."""
    path = lineage.scratch(a.sparkSession)
    differing(tree_a, tree_b, levels).write.parquet(path)
    leaves = a.sparkSession.read.schema("node long, rows_a long, rows_b long").parquet(path)
    found = ranges(leaves, leaf_bits, levels)
    return rows_in(a, key, leaves, found, leaf_bits), rows_in(b, key, leaves, found, leaf_bits)
