"""Data-quality checks. Every check is one lazy frame; a validator gives one result row

``validator, status, checked, failures, expected, actual`` with status passed, failed, warning or
skipped. Checks over one frame run in one pass.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import checksum as sums

# Statuses from best to worst.
STATUSES = ("skipped", "passed", "warning", "failed")
PASSED, FAILED, WARNING, SKIPPED = "passed", "failed", "warning", "skipped"
RESULT_COLUMNS = ("validator", "status", "checked", "failures", "expected", "actual")
# Columns of a suite's rows: why a validator couldn't run, else null.
SUITE_COLUMNS = (*RESULT_COLUMNS, "error", "message")
SUITE = (
    "validator string, status string, checked bigint, failures bigint, expected bigint, actual bigint, error string, message string"
)
# Text patterns of the customer rules.
EMAIL = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
PHONE = r"^\+?[1-9]\d{1,14}$"
TIERS = ("Bronze", "Silver", "Gold", "Platinum")
ORDER_STATUSES = ("pending", "processing", "shipped", "delivered", "cancelled")
OPERATIONS = ("INSERT", "UPDATE", "DELETE")


@dataclass(frozen=True)
class Rule:
    """A row rule as an SQL condition. A condition that is unknown (null) passes only if optional."""

    name: str
    condition: str
    optional: bool = False

    def broken(self) -> Column:
        return ~F.coalesce(F.expr(self.condition), F.lit(self.optional))


# The rules for customer rows, and those a row must meet to be written on.
CUSTOMER_RULES = (
    Rule("email_format", f"email rlike r'{EMAIL}'"),
    Rule("phone_format", f"phone rlike r'{PHONE}'", optional=True),
    Rule("tier_known", "customer_tier in ('Bronze', 'Silver', 'Gold', 'Platinum')"),
    Rule("lifetime_value_not_negative", "lifetime_value >= 0"),
)
REGISTRATION_RULE = Rule("registered_in_the_past", "registration_date <= current_timestamp()")
# The rules for orders (with ``registration_date`` of the customer joined in) and for products.
ORDER_RULES = (
    Rule("amount_positive", "total_amount > 0"),
    Rule("status_known", "order_status in ({})".format(", ".join(f"'{s}'" for s in ORDER_STATUSES))),
)
ORDER_DATE_RULE = Rule("ordered_after_registration", "order_date >= registration_date")
PRODUCT_RULES = (
    Rule("price_positive", "price > 0"),
    Rule("cost_in_range", "cost > 0 and cost <= price"),
    Rule("stock_not_negative", "quantity_in_stock >= 0"),
)
BUSINESS_RULES = (
    Rule("email_present", "email is not null"),
    Rule("lifetime_value_not_negative", "lifetime_value >= 0"),
    Rule("customer_id_present", "customer_id is not null"),
)
INVENTORY_RULES = (
    Rule(
        "quantity_adds_up",
        "case transaction_type when 'IN' then new_quantity = previous_quantity + quantity"
        " when 'OUT' then new_quantity = previous_quantity - quantity"
        " else new_quantity in (previous_quantity + quantity, greatest(0, previous_quantity - quantity)) end",
    ),
    Rule("quantity_not_negative", "new_quantity >= 0"),
)


def _result(
    df: DataFrame, name: str | Column, failed: Column, checked: Column, failures: Column, expected=None, actual=None,
    empty: str | Column = PASSED,
) -> DataFrame:
    """``empty`` is the status when nothing was there to check."""
    empty = F.lit(empty) if isinstance(empty, str) else empty
    none = F.lit(None).cast("bigint")
    return df.select(
        (F.lit(name) if isinstance(name, str) else name).alias("validator"),
        F.when(failed, FAILED).when(checked == 0, empty).otherwise(PASSED).alias("status"),
        checked.cast("bigint").alias("checked"),
        failures.cast("bigint").alias("failures"),
        (none if expected is None else expected.cast("bigint")).alias("expected"),
        (none if actual is None else actual.cast("bigint")).alias("actual"),
    )


def apply_rules(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """(rows that meet every rule, quarantined rows with the names of the rules they break)."""
    broken = F.array_compact(F.array(*[F.when(r.broken(), F.lit(r.name)) for r in rules]))
    any_broken = F.lit(False)
    for r in rules:
        any_broken = any_broken | r.broken()
    return df.filter(~any_broken), df.filter(any_broken).withColumn("broken_rules", broken)


def check_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows checked and failures per rule, all rules in one pass."""
    total = df.agg(F.count("*").alias("checked"), *[F.count_if(r.broken()).alias(f"f{i}") for i, r in enumerate(rules)])
    entries = [F.struct(F.lit(r.name).alias("rule"), F.col(f"f{i}").alias("failures")) for i, r in enumerate(rules)]
    out = total.select("checked", F.inline(F.array(*entries)))
    return out.select(
        "rule", "checked", "failures",
        F.when(F.col("failures") > 0, FAILED).when(F.col("checked") == 0, SKIPPED).otherwise(PASSED).alias("status"),
    )


def check_unique(df: DataFrame, rules: Sequence[Rule], unique: str) -> DataFrame:
    """``check_rules`` with one rule more, that the column ``unique`` has no value twice: one aggregation by that
    column has both. A value's rows beyond the first fail; nulls are not values."""
    per = df.groupBy(unique).agg(F.count("*").alias("n"), *[F.count_if(r.broken()).alias(f"f{i}") for i, r in enumerate(rules)])
    again = F.when(F.col(unique).isNotNull(), F.col("n") - 1).otherwise(0)
    sums = {**{r.name: F.sum(f"f{i}") for i, r in enumerate(rules)}, f"{unique}_unique": F.sum(again)}
    total = per.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("checked"), *[F.coalesce(s, F.lit(0)).alias(n) for n, s in sums.items()])
    entries = [F.struct(F.lit(n).alias("rule"), F.col(n).alias("failures")) for n in sums]
    out = total.select("checked", F.inline(F.array(*entries)))
    return out.select(
        "rule", "checked", "failures",
        F.when(F.col("failures") > 0, FAILED).when(F.col("checked") == 0, SKIPPED).otherwise(PASSED).alias("status"),
    )


def check_events(
    events: DataFrame,
    keys: Sequence[str],
    operation: str = "operation",
    times: Sequence[str] = ("source_ts", "capture_ts", "process_ts"),
    present: Sequence[str] = (),
) -> DataFrame:
    """Rules for standard events with ``event_id, before, after``: failures per rule.

    Uniqueness and the row rules share one aggregation by event id. A missing time is out of order; the columns
    ``present`` (source system and table) may not be null.
    """
    op, b, a = F.col(operation), F.col("before"), F.col("after")
    moved = F.lit(False)
    for k in keys:
        moved = moved | ~F.col(f"before.`{k}`").eqNullSafe(F.col(f"after.`{k}`"))
    late = F.lit(False)
    for first, second in zip(times, times[1:]):
        late = late | ~F.coalesce(F.col(first) <= F.col(second), F.lit(False))
    bad = {
        "operation_known": ~F.coalesce(op.isin(*OPERATIONS), F.lit(False)),
        "insert_has_no_before": (op == "INSERT") & b.isNotNull(),
        "delete_has_no_after": (op == "DELETE") & a.isNotNull(),
        "update_has_both": (op == "UPDATE") & (b.isNull() | a.isNull()),
        "key_unchanged": (op == "UPDATE") & b.isNotNull() & a.isNotNull() & moved,
        "times_in_order": late,
        "event_id_present": F.col("event_id").isNull(),
        **{f"{c}_present": F.col(c).isNull() for c in present},
    }
    per_id = events.groupBy("event_id").agg(
        F.count("*").alias("n"), *[F.count_if(c).alias(name) for name, c in bad.items()]
    )
    repeated = F.when(F.col("event_id").isNotNull(), F.col("n") - 1).otherwise(0)
    total = per_id.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("checked"),
        F.coalesce(F.sum(repeated), F.lit(0)).alias("event_id_unique"),
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in bad],
    )
    entries = [F.struct(F.lit(n).alias("rule"), F.col(n).alias("failures")) for n in (*bad, "event_id_unique")]
    out = total.select("checked", F.inline(F.array(*entries)))
    return out.select(
        "rule", "checked", "failures",
        F.when(F.col("failures") > 0, FAILED).when(F.col("checked") == 0, SKIPPED).otherwise(PASSED).alias("status"),
    )


def _counts(src: DataFrame, dst: DataFrame) -> DataFrame:
    sides = src.select(F.lit(1).alias("s")).unionAll(dst.select(F.lit(0).alias("s")))
    return sides.agg(F.count_if(F.col("s") == 1).alias("s"), F.count_if(F.col("s") == 0).alias("d"))


def _count_differs(tolerance: float, mode: str) -> Column:
    gap = F.abs(F.col("s") - F.col("d"))
    if mode == "absolute":
        return gap > F.lit(tolerance)
    if mode == "fraction":
        return F.when(F.col("s") == 0, F.col("d") != 0).otherwise(gap > F.lit(tolerance) * F.col("s"))
    raise ValueError("mode is 'absolute' or 'fraction'")


def row_count(src: DataFrame, dst: DataFrame, tolerance: float = 0, mode: str = "absolute") -> DataFrame:
    """Row counts agree within a number of rows, or within a fraction of the source."""
    s, d = F.col("s"), F.col("d")
    return _result(_counts(src, dst), "row_count", _count_differs(tolerance, mode), s, F.abs(s - d), s, d)


def dataset_checksum(df: DataFrame, columns: Sequence[str] | None = None, exclude: Sequence[str] | None = None) -> DataFrame:
    """One row ``rows, checksum``: an exact sum over row checksums, so row order, partitioning and
    retries do not matter and parts can be added up (``combine_checksums``)."""
    named = sums.checksum_columns(df, columns, exclude)
    number = sums.number60(sums.row_checksum(named))
    parts = df.agg(F.count("*").alias("rows"), *sums.piece_sums(number, "p"))
    return parts.select("rows", sums.total_of_pieces("p").cast("string").alias("checksum"))


def combine_checksums(*parts: DataFrame) -> DataFrame:
    """Checksum of a dataset from the checksums of its parts, such as old rows and new ones."""
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    total = F.sum(F.col("checksum").cast(sums.TOTAL_TYPE))
    return every.agg(F.sum("rows").alias("rows"), F.coalesce(total, F.lit(0)).cast("string").alias("checksum"))


def checksum_mismatches(
    src: DataFrame, dst: DataFrame, keys: Sequence[str], exclude: Sequence[str] | None = None, algorithm: str = "xxhash64"
) -> DataFrame:
    """Row counts per key on both sides and whether the rows are the ``same``.

    Both sides go into one aggregation of signed hash sums: no join, one shuffle of a key and a few
    longs, combined map-side, so hot keys and keys that occur more than once (bags of rows) are fine.
    """
    columns = sums.checksum_columns(src, exclude=exclude)
    if algorithm == "xxhash64":
        number = sums.row_hash(columns)
    else:
        number = sums.number60(sums.row_checksum(columns, algorithm))

    def side(df: DataFrame, sign: int) -> DataFrame:
        return df.select(*keys, F.lit(sign).cast("bigint").alias("__sign"), number.alias("__h"))

    both = side(src, 1).unionAll(side(dst, -1))
    per = both.groupBy(*keys).agg(
        F.count_if(F.col("__sign") == 1).alias("sn"),
        F.count_if(F.col("__sign") == -1).alias("dn"),
        *sums.hash_sums(F.col("__h"), "__h", F.col("__sign")),
    )
    same = F.col("sn") == F.col("dn")
    for k in range(3):
        same = same & (F.col(f"__h{k}") == 0)
    return per.select(*keys, "sn", "dn", same.alias("same"))


def checksum(
    src: DataFrame, dst: DataFrame, keys: Sequence[str], exclude: Sequence[str] | None = None, algorithm: str = "xxhash64"
) -> DataFrame:
    """Row checksums agree key by key; different row counts fail too.

    The default hashes typed values to 64 bits; ``md5``, ``sha1`` and ``sha256`` hash the row text.
    """
    per = checksum_mismatches(src, dst, keys, exclude, algorithm)
    t = per.agg(
        F.coalesce(F.sum("sn"), F.lit(0)).alias("s"),
        F.coalesce(F.sum("dn"), F.lit(0)).alias("d"),
        F.count_if(~F.col("same")).alias("bad"),
    )
    failed = (F.col("bad") > 0) | (F.col("s") != F.col("d"))
    return _result(t, "checksum", failed, F.col("s"), F.col("bad"), F.col("s"), F.col("d"))


def reconcile(
    src: DataFrame,
    dst: DataFrame,
    keys: Sequence[str],
    exclude: Sequence[str] | None = None,
    tolerance: float = 0,
    mode: str = "absolute",
    algorithm: str = "xxhash64",
) -> DataFrame:
    """Row counts, checksums, missing and extra keys, and key uniqueness on both sides.

    Six results from one pass over each table and one aggregation (see ``checksum_mismatches``); as
    separate validators they would read the tables again for each.
    """
    here, there = F.col("sn") > 0, F.col("dn") > 0
    t = checksum_mismatches(src, dst, keys, exclude, algorithm).agg(
        F.coalesce(F.sum("sn"), F.lit(0)).alias("s"),
        F.coalesce(F.sum("dn"), F.lit(0)).alias("d"),
        F.count_if(~F.col("same")).alias("unequal"),
        F.count_if(here).alias("source_keys"),
        F.count_if(there).alias("destination_keys"),
        F.count_if(here & ~there).alias("missing"),
        F.count_if(there & ~here).alias("extra"),
        F.count_if(F.col("sn") > 1).alias("source_repeats"),
        F.count_if(F.col("dn") > 1).alias("destination_repeats"),
    )
    none = F.lit(None).cast("bigint")
    s, d = F.col("s"), F.col("d")

    def row(name: str, failed: Column, checked: Column, failures: Column, expected: Column, actual: Column) -> Column:
        status = F.when(failed, FAILED).otherwise(PASSED)
        values = (F.lit(name), status, checked, failures, expected, actual)
        return F.struct(*[v.alias(c) for v, c in zip(values, RESULT_COLUMNS)])

    def none_of(name: str, count: str, checked: str) -> Column:
        return row(name, F.col(count) > 0, F.col(checked), F.col(count), none, none)

    entries = [
        row("row_count", _count_differs(tolerance, mode), s, F.abs(s - d), s, d),
        row("checksum", (F.col("unequal") > 0) | (s != d), s, F.col("unequal"), s, d),
        none_of("missing_keys", "missing", "source_keys"),
        none_of("extra_keys", "extra", "destination_keys"),
        none_of("unique_source_key", "source_repeats", "source_keys"),
        none_of("unique_destination_key", "destination_repeats", "destination_keys"),
    ]
    return t.select(F.inline(F.array(*entries)))


def dataset_checksum_match(
    src: DataFrame, dst: DataFrame, columns: Sequence[str] | None = None, sample_percent: int | None = None, key: str | None = None
) -> DataFrame:
    """Whole-dataset checksums agree. With ``sample_percent`` both sides keep the same keys, chosen by
    the hash of ``key``, for a quick look; the full check is the default."""
    if sample_percent is not None:
        keep = sums.number60(F.md5(F.col(key).cast("string"))) % 100 < sample_percent
        src, dst = src.filter(keep), dst.filter(keep)
    both = dataset_checksum(src, columns).withColumn("side", F.lit("s")).unionByName(
        dataset_checksum(dst, columns).withColumn("side", F.lit("d"))
    )

    def of(side: str, c: str) -> Column:
        return F.max(F.when(F.col("side") == side, F.col(c)))

    t = both.agg(
        of("s", "rows").alias("s"), of("d", "rows").alias("d"),
        of("s", "checksum").alias("sc"), of("d", "checksum").alias("dc"),
    )
    bad = (F.col("sc") != F.col("dc")) | (F.col("s") != F.col("d"))
    return _result(t, "dataset_checksum", bad, F.col("s"), bad.cast("int"), F.col("s"), F.col("d"))


def compare(src: DataFrame, dst: DataFrame, keys: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Keys that are missing, extra or hold different field values, with the names of those fields.

    Keys are unique on both sides (see ``duplicate_keys``).
    """
    s = src.select(*keys, F.struct(*fields).alias("s"))
    d = dst.select(*keys, F.struct(*fields).alias("d"))
    names = [F.when(~F.col(f"s.`{c}`").eqNullSafe(F.col(f"d.`{c}`")), F.lit(c)) for c in fields]
    verdict = (
        F.when(F.col("d").isNull(), "missing")
        .when(F.col("s").isNull(), "extra")
        .when(~F.col("s").eqNullSafe(F.col("d")), "different")
    )
    out = s.join(d, list(keys), "full_outer").withColumn("verdict", verdict).filter(F.col("verdict").isNotNull())
    changed = F.when(F.col("verdict") == "different", F.array_join(F.array_compact(F.array(*names)), ","))
    return out.select(*keys, "verdict", changed.alias("fields"))


def fields_match(
    src: DataFrame, dst: DataFrame, keys: Sequence[str], fields: Sequence[str], required: Sequence[str] | None = None
) -> DataFrame:
    """Fields are present where required, and equal on both sides key by key: one result row per
    field, all from one join. ``actual`` is the number of unequal values. Without a key in common nothing was
    compared: failed if the source has rows, else skipped."""
    must = set(fields if required is None else required)
    s = src.select(*keys, *[F.col(f).alias(f"s{i}") for i, f in enumerate(fields)])
    d = dst.select(*keys, *[F.col(f).alias(f"d{i}") for i, f in enumerate(fields)])
    counts = [F.count("*").alias("n")]
    for i, f in enumerate(fields):
        absent = F.col(f"s{i}").isNull() | F.col(f"d{i}").isNull() if f in must else F.lit(False)
        counts.append(F.count_if(absent).alias(f"absent{i}"))
        counts.append(F.count_if(~absent & ~F.col(f"s{i}").eqNullSafe(F.col(f"d{i}"))).alias(f"diff{i}"))
    n_src = src.agg(F.count("*").alias("n")).scalar()
    t = s.join(d, list(keys), "inner").agg(*counts)
    entries = [
        F.struct(F.lit(f"field:{f}").alias("v"), F.col(f"absent{i}").alias("absent"), F.col(f"diff{i}").alias("diff"))
        for i, f in enumerate(fields)
    ]
    t = t.select("n", F.inline(F.array(*entries)))
    failures = F.col("absent") + F.col("diff")
    nothing = F.when(n_src > 0, FAILED).otherwise(SKIPPED)
    return _result(t, F.col("v"), failures > 0, F.col("n"), failures, F.lit(0), F.col("diff"), nothing)


def field_match(src: DataFrame, dst: DataFrame, keys: Sequence[str], field: str, required: bool = True) -> DataFrame:
    return fields_match(src, dst, keys, [field], [field] if required else [])


def completeness(df: DataFrame, columns: Sequence[str], required: Sequence[str] | None = None) -> DataFrame:
    """Nulls per column in one pass; a null in a required column fails; an empty frame is skipped."""
    must = set(columns if required is None else required)
    t = df.agg(F.count("*").alias("checked"), *[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(columns)])
    entries = [
        F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("nulls"), F.lit(c in must).alias("required"))
        for i, c in enumerate(columns)
    ]
    out = t.select("checked", F.inline(F.array(*entries)))
    bad = F.col("required") & (F.col("nulls") > 0)
    return out.select("column", "checked", "nulls", F.when(bad, FAILED).when(F.col("checked") == 0, SKIPPED).otherwise(PASSED).alias("status"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).filter(F.col("copies") > 1)


def unique_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    t = df.groupBy(*keys).agg(F.count("*").alias("copies")).agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("n"), F.count_if(F.col("copies") > 1).alias("bad")
    )
    return _result(t, "unique_key", F.col("bad") > 0, F.col("n"), F.col("bad"))


def orphan_keys(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Foreign keys without a parent and how many rows hold each (a null key is one of them).

    The child is counted per key ahead of the shuffle, so hot keys do not matter.
    """
    held = child.groupBy(F.col(child_key)).agg(F.count("*").alias("rows"))
    known = parent.select(F.col(parent_key).alias(child_key)).filter(F.col(child_key).isNotNull())
    return held.join(known, child_key, "left_anti")


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows without a parent; a null foreign key is an orphan.

    The lost keys are found on key counts. The child then meets only those, which are few as a rule
    and are broadcast when their measured size allows; rows with a null key never take part in a join.
    """
    lost = orphan_keys(child, parent, child_key, parent_key).filter(F.col(child_key).isNotNull())
    no_key = child.filter(F.col(child_key).isNull())
    return child.join(lost.select(child_key), child_key, "left_semi").select(*child.columns).unionByName(no_key)


def referential_integrity(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    held = child.groupBy(F.col(child_key)).agg(F.count("*").alias("rows"))
    known = parent.select(F.col(parent_key).alias(child_key)).distinct().withColumn("ok", F.lit(True))
    t = held.join(known, child_key, "left").agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("n"),
        F.coalesce(F.sum(F.when(F.col("ok").isNull(), F.col("rows"))), F.lit(0)).alias("bad"),
    )
    return _result(t, "referential_integrity", F.col("bad") > 0, F.col("n"), F.col("bad"))


def check_cross_rule(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str, rule: Rule) -> DataFrame:
    """Rule over a child row and its parent; children without a parent are not counted, and without any
    pair the check is skipped.

    The join is a plain equi join on a unique parent key: small parents are broadcast by size, and
    a hot child key is split at run time (adaptive skew join).
    """
    t = child.join(parent, child[child_key] == parent[parent_key]).agg(
        F.count("*").alias("n"), F.count_if(rule.broken()).alias("bad")
    )
    return _result(t, rule.name, F.col("bad") > 0, F.col("n"), F.col("bad"), empty=SKIPPED)


def coverage(expected: DataFrame, captured: DataFrame, keys: Sequence[str], at_least: float = 0.95) -> DataFrame:
    """Share of expected keys that were captured is high enough."""
    e = expected.select(*keys).distinct()
    c = captured.select(*keys).distinct().withColumn("hit", F.lit(True))
    t = e.join(c, list(keys), "left").agg(F.count("*").alias("n"), F.count_if("hit").alias("got"))
    bad = F.col("got") < F.col("n") * F.lit(at_least)
    return _result(t, "coverage", bad, F.col("n"), F.col("n") - F.col("got"), F.col("n"), F.col("got"))


# Abstract SQL type names and the Spark types a text must convert to.
TYPE_CASTS = {
    "SMALLINT": "smallint", "INTEGER": "int", "INT": "int", "BIGINT": "bigint",
    "DECIMAL": "decimal(38,10)", "NUMERIC": "decimal(38,10)", "FLOAT": "float", "DOUBLE": "double",
    "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz", "DATE": "date",
    "VARCHAR": None, "TEXT": None, "CHAR": None, "STRING": None, "JSON": None,
}


WHOLE = r"^\s*[+-]?\d+\s*$"


def type_errors(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Texts that do not convert to the expected type, per column, in one pass."""
    checks = []
    for c, t in types.items():
        target = TYPE_CASTS.get(t.upper().split("(")[0])
        bad = F.lit(False) if target is None else F.col(c).isNotNull() & F.col(c).try_cast(target).isNull()
        if target in ("smallint", "int", "bigint"):
            # a failed cast is slow, so texts that are no whole numbers do not get that far
            bad = F.when(F.col(c).isNull(), False).when(~F.col(c).rlike(WHOLE), True).otherwise(bad)
        checks.append(F.count_if(bad))
    total = df.agg(F.count("*").alias("checked"), *[x.alias(f"n{i}") for i, x in enumerate(checks)])
    entries = [
        F.struct(F.lit(c).alias("column"), F.lit(t).alias("type"), F.col(f"n{i}").alias("errors"))
        for i, (c, t) in enumerate(types.items())
    ]
    out = total.select("checked", F.inline(F.array(*entries)))
    return out.select(
        "column", "type", "checked", "errors", F.when(F.col("errors") > 0, FAILED).otherwise(PASSED).alias("status")
    )


def sample(df: DataFrame, k: int, order_by: Sequence[str]) -> DataFrame:
    """First ``k`` issues in a fixed order (top-k)."""
    return df.orderBy(*order_by).limit(k)


def _reason(x: Exception) -> tuple[str, str]:
    """(class, first line of the message) of what stopped a validator."""
    return type(x).__name__, (str(x).strip().splitlines() or [""])[0]


def _literal(spark: SparkSession, name: str, status: str, error: str | None = None, message: str | None = None) -> DataFrame:
    return spark.range(1).select(
        F.lit(name).alias("validator"), F.lit(status).alias("status"),
        *[F.lit(None).cast("bigint").alias(c) for c in ("checked", "failures", "expected", "actual")],
        F.lit(error).cast("string").alias("error"), F.lit(message).cast("string").alias("message"),
    )


def run(spark: SparkSession, suite: Mapping[str, Callable[[], DataFrame]], only: Sequence[str] | None = None) -> DataFrame:
    """Result rows of all validators as one lazy frame. A validator that cannot be planned (a missing
    column, say) gives a failed row with the error; an empty suite gives one warning row."""
    frames = []
    for name, build in suite.items():
        if only is not None and name not in only:
            continue
        try:
            none = [F.lit(None).cast("string").alias(c) for c in ("error", "message")]
            frames.append(build().select(*RESULT_COLUMNS, *none))
        except (PySparkException, Py4JJavaError) as x:
            frames.append(_literal(spark, name, FAILED, *_reason(x)))
    if not frames:
        return _literal(spark, "suite", WARNING)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def run_now(
    spark: SparkSession, suite: Mapping[str, Callable[[], DataFrame]], fail_fast: bool = False, only: Sequence[str] | None = None
) -> DataFrame:
    """Run validators one by one; one that raises counts as failed. ``fail_fast`` stops at the first
    failure. Only result rows, a few per validator, come to the driver."""
    rows = []
    for name, build in suite.items():
        if only is not None and name not in only:
            continue
        try:
            found = [(*r, None, None) for r in build().select(*RESULT_COLUMNS).collect()]
        except (PySparkException, Py4JJavaError) as x:
            found = [(name, FAILED, None, None, None, None, *_reason(x))]
        rows += found
        if fail_fast and any(r[1] == FAILED for r in found):
            break
    return spark.createDataFrame(rows or [("suite", WARNING, *[None] * 6)], SUITE)



def _rank(status: str) -> Column:
    return F.array_position(F.array(*[F.lit(s) for s in STATUSES]), F.col(status))


def overall(results: DataFrame, by: Sequence[str] = (), status: str = "status") -> DataFrame:
    """Worst status, per group if asked for; no results means skipped."""
    worst = F.coalesce(F.max(_rank(status)), F.lit(1))
    named = F.element_at(F.array(*[F.lit(s) for s in STATUSES]), F.col("__w").cast("int"))
    return results.groupBy(*by).agg(worst.alias("__w")).select(*by, named.alias("overall_status"))


def scorecard(results: DataFrame, by: Sequence[str], status: str = "status") -> DataFrame:
    """Counts by status, score ``100 * (1 - failures / checks)`` and pass rate per group."""
    s = F.col(status)
    out = results.groupBy(*by).agg(
        F.count("*").alias("checks"), *[F.count_if(s == x).alias(x) for x in STATUSES]
    )
    return out.withColumns(
        {
            "score": F.round(100.0 * (1 - F.col(FAILED) / F.col("checks")), 6),
            "pass_rate": F.round(F.col(PASSED) / F.col("checks"), 6),
        }
    )
