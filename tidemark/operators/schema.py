"""Schemas as frames ``(table, version, column, type)``: compatibility, evolution and drift."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalar import col

# Type pairs a source column may have in the destination.
COMPATIBLE = {
    "INTEGER": ["BIGINT", "INT", "SMALLINT", "NUMBER"],
    "BIGINT": ["INTEGER", "NUMBER"],
    "VARCHAR": ["TEXT", "STRING", "CHAR"],
    "TEXT": ["VARCHAR", "STRING"],
    "DECIMAL": ["NUMERIC", "FLOAT", "DOUBLE", "NUMBER"],
    "TIMESTAMP": ["DATETIME", "DATE"],
}
# The documented, narrower table, where any type may also become STRING.
COMPATIBLE_STRICT = {"INTEGER": ["BIGINT"], "VARCHAR": ["TEXT"], "DATE": ["TIMESTAMP"]}
# Widening type changes that old data survives.
WIDENING = {
    "INTEGER": ["BIGINT"],
    "SMALLINT": ["INTEGER", "BIGINT"],
    "VARCHAR": ["TEXT"],
    "CHAR": ["VARCHAR", "TEXT"],
    "DECIMAL": ["NUMERIC"],
}
# Exact type changes counted as safe by change detection.
SAFE_ALTERS = {"INTEGER": ["BIGINT"], "FLOAT": ["DOUBLE"], "VARCHAR(50)": ["VARCHAR(100)", "TEXT"]}
# Names of simple types and the Spark types they stand for; others are text.
SIMPLE_TYPES = {
    "long": T.LongType(), "int": T.IntegerType(), "string": T.StringType(), "boolean": T.BooleanType(),
    "double": T.DoubleType(), "float": T.FloatType(), "date": T.DateType(), "timestamp": T.TimestampType(),
}
# Observed types of JSON values from narrow to wide.
OBSERVED = ("BOOLEAN", "BIGINT", "DOUBLE", "VARCHAR")


def _base(c: Column) -> Column:
    return F.trim(F.split_part(F.upper(c), F.lit("("), F.lit(1)))


def _exact_pair_in(table: dict[str, list[str]], old: Column, new: Column) -> Column:
    return F.concat(old, F.lit(">"), new).isin(*[f"{a}>{b}" for a, bs in table.items() for b in bs])


def _pair_in(table: dict[str, list[str]], old: Column, new: Column) -> Column:
    return _exact_pair_in(table, _base(old), _base(new))


def compatible(source: Column, dest: Column, mode: str = "lenient") -> Column:
    """Whether a source type fits a destination type."""
    if mode == "lenient":
        return (source == dest) | _pair_in(COMPATIBLE, source, dest)
    if mode == "strict":
        return (source == dest) | _pair_in(COMPATIBLE_STRICT, source, dest) | (_base(dest) == "STRING")
    raise ValueError("mode is 'lenient' or 'strict'")


def compatibility(
    source: DataFrame, dest: DataFrame, by: Sequence[str] = (), mode: str = "lenient", exact: bool = False
) -> DataFrame:
    """Verdict per column: compatible, type_mismatch, missing (in the destination) or extra.

    ``ok`` is false for a missing column and a mismatch, and for an extra one when ``exact``.
    """
    on = [*by, "column"]
    s = source.select(*on, F.col("type").alias("source_type"))
    d = dest.select(*on, F.col("type").alias("dest_type"))
    st, dt = F.col("source_type"), F.col("dest_type")
    verdict = (
        F.when(dt.isNull(), "missing")
        .when(st.isNull(), "extra")
        .when(compatible(st, dt, mode), "compatible")
        .otherwise("type_mismatch")
    )
    out = s.join(d, on, "full_outer").withColumn("verdict", verdict)
    fine = F.col("verdict") == "compatible"
    return out.withColumn("ok", fine if exact else fine | (F.col("verdict") == "extra"))


def compatibility_status(verdicts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    v = F.col("verdict")
    return verdicts.groupBy(*by).agg(
        F.when(F.bool_and("ok"), "passed").otherwise("failed").alias("status"),
        F.count_if(v.isin("compatible", "type_mismatch")).alias("common"),
        F.count_if(v == "missing").alias("missing"),
        F.count_if(v == "extra").alias("extra"),
        F.count_if(v == "type_mismatch").alias("type_mismatches"),
    )


def evolution(old: DataFrame, new: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Changed columns between two schemas and whether old data survives each change."""
    on = [*by, "column"]
    o = old.select(*on, F.col("type").alias("old_type"))
    n = new.select(*on, F.col("type").alias("new_type"))
    ot, nt = F.col("old_type"), F.col("new_type")
    change = F.when(ot.isNull(), "added").when(nt.isNull(), "removed").when(ot != nt, "modified")
    out = o.join(n, on, "full_outer").withColumn("change", change).filter(F.col("change").isNotNull())
    safe = F.when(F.col("change") == "added", True).when(F.col("change") == "removed", False)
    return out.withColumn("is_safe", safe.otherwise(_pair_in(WIDENING, ot, nt)))


# Compatibility modes over the rows of ``evolution``: what a mode does not allow.
def _broken_by(mode: str) -> Column:
    change, safe = F.col("change"), F.col("is_safe")
    backward = ~safe & (change != "added")
    forward = change == "added"
    rules = {
        "backward": backward,
        "forward": forward | ((change == "modified") & ~safe),
        "full": backward | forward,
        "none": F.lit(False),
    }
    if mode not in rules:
        raise ValueError(f"mode is one of {sorted(rules)}")
    return rules[mode]


def evolution_status(changes: DataFrame, mode: str = "backward", by: Sequence[str] = ()) -> DataFrame:
    """passed when nothing changed, warning when all changes are allowed by the mode, else failed.

    ``changes`` holds only changed columns; a group without changes does not appear.
    """
    bad = F.count_if(_broken_by(mode))
    n = F.count("*")
    return changes.groupBy(*by).agg(
        n.alias("changes"),
        bad.alias("breaking"),
        F.when(n == 0, "passed").when(bad > 0, "failed").otherwise("warning").alias("status"),
    )


def detect_changes(schemas: DataFrame) -> DataFrame:
    """ADD, DROP and ALTER between consecutive versions of every table; the first version has none.

    The columns of one version are held together as a map (a schema is narrow), so each version is
    compared with the one before it in one window over the versions of a table.
    """
    entries = F.map_from_entries(F.collect_list(F.struct("column", "type")))
    steps = schemas.groupBy("table", "version").agg(entries.alias("new"))
    w = Window.partitionBy("table").orderBy("version")
    steps = steps.withColumn("old", F.lag("new").over(w)).filter(F.col("old").isNotNull())
    names = F.array_union(F.map_keys("old"), F.map_keys("new"))
    pairs = steps.select("table", "version", "old", "new", F.explode(names).alias("column")).select(
        "table", "version", "column",
        F.try_element_at("old", F.col("column")).alias("old_type"),
        F.try_element_at("new", F.col("column")).alias("new_type"),
    )
    ot, nt = F.col("old_type"), F.col("new_type")
    change = F.when(ot.isNull(), "ADD").when(nt.isNull(), "DROP").when(ot != nt, "ALTER")
    out = pairs.withColumn("change_type", change).filter(F.col("change_type").isNotNull())
    safe = _exact_pair_in(SAFE_ALTERS, ot, nt)
    breaking = F.when(F.col("change_type") == "ADD", False).when(F.col("change_type") == "DROP", True)
    return out.withColumn("is_breaking", breaking.otherwise(~safe))


def renames(changes: DataFrame) -> DataFrame:
    """Candidate renames by schema alone: a DROP and an ADD of one type in the same step, paired in name order. Where there are
    several, ``renames_by_content`` tells which is which."""
    on = ["table", "version", "type"]
    w = Window.partitionBy(*on).orderBy("column")

    def side(kind: str, type_column: str, name: str) -> DataFrame:
        d = changes.filter(F.col("change_type") == kind).select("table", "version", F.col(type_column).alias("type"), "column")
        return d.select(*on, F.row_number().over(w).alias("nth"), F.col("column").alias(name))

    dropped, added = side("DROP", "old_type", "old_name"), side("ADD", "new_type", "new_name")
    return dropped.join(added, [*on, "nth"]).select(*on, "old_name", "new_name")


#: Values of a column are sketched by the least hash in each of so many groups of hashes.
SKETCH = 64
#: Weights of equal values, of equal shapes of values, and of the share of nulls; and the least score of a rename.
RENAME_WEIGHTS, RENAME_SCORE = (0.6, 0.3, 0.1), 0.3


def _sketch(text: Column) -> tuple[Column, Column]:
    """(group, number) of a text's hash."""
    h = F.xxhash64(text)
    return F.pmod(h, F.lit(SKETCH)).cast("int"), F.shiftrightunsigned(h, 6)


def profiles(events: DataFrame, json_text: str, table: str | Column, version: str | Column) -> DataFrame:
    """What the columns of each version hold: ``(table, version, column, rows, known, of, bin, least)``.

    ``of`` is ``value`` or ``shape`` (a text with its digits as 9, capitals as A, other letters as a, runs as one); ``least`` is the least hash
    in a bin. Everything is a count or a minimum, summed up map-side, so profiles of parts can be merged by
    ``merge_profiles`` and a version with any number of rows has at most ``2 * SKETCH`` rows per column. A value that is
    null and a field that isn't there both count as unknown.
    """
    keep = [col(table).alias("table"), col(version).alias("version")]
    f = _fields(events, json_text, keep)
    text = F.col("value").cast("string")
    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace(text, "[0-9]+", "9"), r"\p{Lu}+", "A"), r"\p{Ll}+", "a")
    sketched = [F.struct(F.lit(name).alias("of"), _sketch(c)[0].alias("bin"), _sketch(c)[1].alias("least")) for name, c in (("value", text), ("shape", shape))]
    known = f.filter(text.isNotNull()).select("table", "version", "column", F.inline(F.array(*sketched)))
    least = known.groupBy("table", "version", "column", "of", "bin").agg(F.min("least").alias("least"), F.count("*").alias("known"))
    rows = events.select(*keep).groupBy("table", "version").agg(F.count("*").alias("rows"))
    return least.join(rows, ["table", "version"]).select("table", "version", "column", "rows", "known", "of", "bin", "least")


def merge_profiles(a: DataFrame, b: DataFrame) -> DataFrame:
    """Profiles of two parts of the rows as that of all of them."""
    on = ["table", "version", "column", "of", "bin"]
    both = a.unionByName(b).groupBy(*on).agg(F.min("least").alias("least"), F.sum("known").alias("known"))
    # every row of a part carries that part's count
    rows = a.select("table", "version", "rows").distinct().unionAll(b.select("table", "version", "rows").distinct())
    rows = rows.groupBy("table", "version").agg(F.sum("rows").alias("rows"))
    return both.join(rows, ["table", "version"]).select(*a.columns)


def renames_by_content(changes: DataFrame, profiled: DataFrame, least_score: float = RENAME_SCORE) -> DataFrame:
    """Renames ``(table, version, type, old_name, new_name, score)``: a dropped and an added column of one type whose
    contents are alike, before and after the step.

    The score weighs the share of equal values (minima of hash groups that agree), of equal shapes, and how near the shares
    of nulls are. Within a step the best pair is taken first and its columns are used up, ties go by name, so several renames
    in one step come out one to one. A schema is narrow, so the pairs of one step are few.
    """
    at = ["table", "version"]
    grouped = profiled.groupBy(*at, "column").agg(
        F.map_from_entries(F.collect_list(F.struct(F.struct("of", "bin").alias("k"), F.col("least")))).alias("least"),
        (F.sum(F.when(F.col("of") == "value", F.col("known")).otherwise(0)) / F.max("rows")).alias("share"),
    )
    steps = profiled.select(*at).distinct().withColumn("before", F.lag("version").over(Window.partitionBy("table").orderBy("version")))

    def side(kind: str, type_column: str, name: str) -> DataFrame:
        return changes.filter(F.col("change_type") == kind).select(*at, F.col(type_column).alias("type"), F.col("column").alias(name))

    pairs = side("DROP", "old_type", "old_name").join(side("ADD", "new_type", "new_name"), [*at, "type"]).join(steps, at)
    old = grouped.select("table", F.col("version").alias("before"), F.col("column").alias("old_name"), F.col("least").alias("a"), F.col("share").alias("old_share"))
    new = grouped.select(*at, F.col("column").alias("new_name"), F.col("least").alias("b"), F.col("share").alias("new_share"))
    pairs = pairs.join(old, ["table", "before", "old_name"], "left").join(new, [*at, "new_name"], "left")

    def alike(of: str) -> Column:
        keys = F.filter(F.array_union(F.map_keys("a"), F.map_keys("b")), lambda k: k["of"] == of)
        same = F.filter(keys, lambda k: F.try_element_at("a", k) == F.try_element_at("b", k))
        return F.coalesce(F.when(F.size(keys) > 0, F.size(same) / F.size(keys)), F.lit(0.0))

    shares = F.abs(F.coalesce("old_share", F.lit(0.0)) - F.coalesce("new_share", F.lit(0.0)))
    value, shape, nulls = RENAME_WEIGHTS
    scored = pairs.withColumn("score", value * alike("value") + shape * alike("shape") + nulls * (1 - shares))
    scored = scored.filter(F.col("score") >= least_score)
    entry = F.struct((-F.col("score")).alias("bad"), "old_name", "new_name")
    kind = "array<struct<bad:double,old_name:string,new_name:string>>"

    def take(kept: Column, x: Column) -> Column:
        used = F.exists(kept, lambda k: (k["old_name"] == x["old_name"]) | (k["new_name"] == x["new_name"]))
        return F.when(used, kept).otherwise(F.concat(kept, F.array(x)))

    best = scored.groupBy(*at, "type").agg(F.sort_array(F.collect_list(entry)).alias("pairs"))
    kept = best.select(*at, "type", F.explode(F.aggregate("pairs", F.array().cast(kind), take)).alias("p"))
    return kept.select(*at, "type", "p.old_name", "p.new_name", (-F.col("p.bad")).alias("score"))


def ledger(changes: DataFrame) -> DataFrame:
    """Schema changes as rows of a version ledger."""
    change = F.col("change_type")
    text = (
        F.when(change == "ADD", F.concat(F.lit("added "), F.col("column"), F.lit(" "), F.col("new_type")))
        .when(change == "DROP", F.concat(F.lit("dropped "), F.col("column"), F.lit(" "), F.col("old_type")))
        .otherwise(F.concat_ws(" ", F.lit("changed"), "column", F.lit("from"), "old_type", F.lit("to"), "new_type"))
    )
    return changes.select(
        F.col("table").alias("table_name"),
        F.col("version").alias("schema_version"),
        "change_type",
        text.alias("change_description"),
    )


def _value_type(v: Column) -> Column:
    """Name of a JSON value's type; texts, lists and objects are VARCHAR."""
    kind = F.schema_of_variant(v)
    return (
        F.when(kind == "BOOLEAN", "BOOLEAN")
        .when(kind == "BIGINT", "BIGINT")
        .when((kind == "DOUBLE") | kind.startswith("DECIMAL"), "DOUBLE")
        .when(kind != "VOID", "VARCHAR")
    )


def _fields(events: DataFrame, json_text: str, keep: Sequence[str | Column]) -> DataFrame:
    """One row per field of each JSON object: the kept columns, ``column`` and ``value`` (a variant).

    The values keep their JSON type, so no text is cast to find it. Text that is not JSON has no fields.
    """
    rows = events.select(*keep, F.try_parse_json(F.col(json_text)).alias("__doc"))
    names = ", ".join(f"d.`{c}`" for c in rows.columns if c != "__doc")
    found = events.sparkSession.sql(
        f"SELECT {names}, e.key AS column, e.value FROM {{rows}} AS d, LATERAL variant_explode_outer(d.__doc) AS e",
        rows=rows,
    )
    return found.filter(F.col("column").isNotNull())


def observed(events: DataFrame, json_text: str, table: str | Column, version: str | Column) -> DataFrame:
    """Schema seen in JSON rows per table and version: the widest type of each field's values."""
    keep = [col(table).alias("table"), col(version).alias("version")]
    f = _fields(events, json_text, keep).select("table", "version", "column", _value_type(F.col("value")).alias("type"))
    order = F.array(*[F.lit(t) for t in OBSERVED])
    seen = f.filter(F.col("type").isNotNull())
    rank = F.array_position(order, F.col("type"))
    out = seen.groupBy("table", "version", "column").agg(F.min(rank).alias("least"), F.max(rank).alias("r"))
    # a boolean isn't a narrow number: with any other type it only fits text
    mixed = (F.col("least") == 1) & (F.col("r") > 1)
    widest = F.when(mixed, OBSERVED[-1]).otherwise(F.element_at(order, F.col("r").cast("int")))
    return out.select("table", "version", "column", widest.alias("type"))


def drift(events: DataFrame, json_text: str, table: str | Column, ts: str | Column) -> DataFrame:
    """When each field was first and last seen, and in how many events."""
    f = _fields(events, json_text, [col(table).alias("table"), col(ts).alias("__ts")])
    return f.groupBy("table", "column").agg(
        F.min("__ts").alias("first_seen"), F.max("__ts").alias("last_seen"), F.count("*").alias("events")
    )


# Shape of the schema block in a change event.
_LEAF = "array<struct<field:string,type:string>>"
_BLOCK = f"struct<schema:struct<fields:array<struct<field:string,type:string,fields:{_LEAF}>>>>"


def from_event(events: DataFrame, json_text: str, keep: Sequence[str] = ()) -> DataFrame:
    """Columns and types from the schema block that events carry for their new image."""
    block = F.from_json(F.col(json_text), _BLOCK)
    after = F.filter(block["schema"]["fields"], lambda f: f["field"] == "after")
    leaves = F.flatten(F.transform(after, lambda f: f["fields"]))
    out = events.select(*keep, F.inline_outer(leaves)).withColumnRenamed("field", "column")
    return out.filter(F.col("column").isNotNull() & F.col("type").isNotNull())


def of_frame(df: DataFrame, table: str, version: int = 0) -> DataFrame:
    """Schema of a frame as rows (one per column)."""
    rows = [(table, version, f.name, f.dataType.simpleString().upper()) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "table string, version bigint, column string, type string")


def from_pairs(pairs: Sequence[tuple[str, str]]) -> T.StructType:
    """Spark schema from (name, simple type); an unknown type is text."""
    return T.StructType([T.StructField(n, SIMPLE_TYPES.get(t.lower(), T.StringType())) for n, t in pairs])


def conform(df: DataFrame, target: T.StructType, extra: str = "drop") -> DataFrame:
    """Frame with the target's columns and types: a missing column is a typed null, a value that does
    not convert is null, and other columns are dropped or kept."""
    out = []
    for f in target.fields:
        if f.name in df.columns:
            out.append(F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name))
        else:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
    if extra == "keep":
        out += [F.col(f"`{c}`") for c in df.columns if c not in target.names]
    elif extra != "drop":
        raise ValueError("extra is 'drop' or 'keep'")
    return df.select(*out)


def presence(df: DataFrame, target: T.StructType) -> tuple[list[str], list[str]]:
    """(missing columns, columns of another type): the first fail a batch, the second only warn."""
    have = {f.name: f.dataType for f in df.schema.fields}
    missing = [f.name for f in target.fields if f.name not in have]
    return missing, [f.name for f in target.fields if f.name in have and have[f.name] != f.dataType]
