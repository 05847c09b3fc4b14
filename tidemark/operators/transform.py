"""Reshape rows for analytics: projections, masking, metadata columns, enrichment."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import scalar

# Default source name of the customer projection.
SOURCE_SYSTEM = "postgres_cdc"


def drop_deletes(df: DataFrame) -> DataFrame:
    """A row goes when either its operation or its deleted flag says so; unknown means keep."""
    gone = F.lit(False)
    for name in ("op", "__op"):
        if name in df.columns:
            gone = gone | F.coalesce(F.col(name) == "d", F.lit(False))
    if "__deleted" in df.columns:
        gone = gone | F.coalesce(F.lower(F.col("__deleted")) == "true", F.lit(False))
    return df.filter(~gone)


def _optional(df: DataFrame, name: str, type_name: str, default=None) -> Column:
    """Column if the frame has it, else a typed default, decided when the plan is built."""
    value = F.col(f"`{name}`").cast(type_name) if name in df.columns else F.lit(None).cast(type_name)
    return value if default is None else F.coalesce(value, F.lit(default).cast(type_name))


def customer_analytics(
    flat: DataFrame,
    read_as: str = "READ",
    name_default: str = "Unknown",
    place_default: str = "Unknown",
    source_system: str = SOURCE_SYSTEM,
    ingested_at: Column | None = None,
) -> DataFrame:
    """Customer rows in analytics form, without deletes; works on batches and streams.

    Missing optional columns become typed nulls or defaults; a row without an operation counts as
    an insert.
    """
    live = drop_deletes(flat)
    op = F.col("__op") if "__op" in live.columns else (F.col("op") if "op" in live.columns else F.lit("c"))
    out = [
        F.col("customer_id").cast("bigint").alias("customer_id"),
        _optional(live, "email", "string").alias("email"),
        scalar.full_name(
            _optional(live, "first_name", "string"), _optional(live, "last_name", "string"), name_default
        ).alias("full_name"),
        scalar.location(
            _optional(live, "city", "string"),
            _optional(live, "state", "string"),
            _optional(live, "country", "string"),
            place_default,
        ).alias("location"),
        _optional(live, "customer_tier", "string").alias("customer_tier"),
        _optional(live, "lifetime_value", "double", 0.0).alias("lifetime_value"),
        _optional(live, "registration_date", "timestamp_ntz").alias("registration_date"),
        _optional(live, "is_active", "boolean", True).alias("is_active"),
        F.lit(0).alias("total_orders"),
        F.lit(source_system).alias("_source_system"),
        scalar.op_name(F.coalesce(op, F.lit("c")), read_as).alias("_cdc_operation"),
        _optional(live, "__ts_ms", "bigint").alias("_event_timestamp_ms"),
        _optional(live, "__lsn", "bigint").alias("_source_lsn"),
    ]
    if ingested_at is not None:
        out.append(ingested_at.alias("_ingestion_timestamp"))
    return live.select(*out)


def add_metadata(df: DataFrame, run_id: str, batch_id: int | str, at: Column | None = None) -> DataFrame:
    """Add where and when a row was processed; ``at`` defaults to the query's start time."""
    return df.withColumns(
        {
            "_pipeline_id": F.lit(run_id),
            "_batch_id": F.lit(batch_id).cast("string"),
            "_processed_timestamp": F.current_timestamp() if at is None else at,
        }
    )


MASKS = {
    "email": scalar.mask_email,
    "hash": scalar.mask_hash,
    "redact": scalar.mask_redact,
    "partial": scalar.mask_partial,
}


def mask(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Mask columns, each by one of the strategies email, hash, redact, partial."""
    return df.withColumns({c: MASKS[how](c) for c, how in columns.items()})


def flatten(df: DataFrame, sep: str = "_") -> DataFrame:
    """Nested structs to columns named by their path."""

    def walk(schema: T.StructType, path: tuple[str, ...]):
        for f in schema.fields:
            here = (*path, f.name)
            if isinstance(f.dataType, T.StructType):
                yield from walk(f.dataType, here)
            else:
                yield F.col(".".join(f"`{p}`" for p in here)).alias(sep.join(here))

    return df.select(*walk(df.schema, ()))


def json_fields(df: DataFrame, column: str, paths: Mapping[str, str]) -> DataFrame:
    """Add columns read from a JSON text column; ``paths`` maps name to JSON path."""
    return df.withColumns({name: F.get_json_object(F.col(column), path) for name, path in paths.items()})


def enrich_counts(df: DataFrame, detail: DataFrame, on: str, detail_key: str, name: str = "total_orders") -> DataFrame:
    """Add how many detail rows belong to each row. The detail is counted per key ahead of the
    shuffle, so a key with very many rows costs one row per task."""
    counts = detail.groupBy(F.col(detail_key).alias(on)).agg(F.count("*").alias("__n"))
    base = df.drop(name)
    return base.join(counts, on, "left").withColumn(name, F.coalesce("__n", F.lit(0))).drop("__n")

