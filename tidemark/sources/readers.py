"""Change sources. The format is an argument: files work everywhere, connectors need their jars."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns of a raw message.
MESSAGE = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)
FILE_FORMATS = ("parquet", "json", "orc", "csv", "avro", "text")


def _options(fmt: str, limit: int | None, start: str, options: Mapping[str, str], fail_on_data_loss: bool = True) -> dict[str, str]:
    out: dict[str, str] = {}
    if fmt == "kafka":
        if start not in ("earliest", "latest"):
            raise ValueError("start is 'earliest' or 'latest'")
        out["startingOffsets"] = start
        out["failOnDataLoss"] = str(fail_on_data_loss).lower()
        if limit is not None:
            out["maxOffsetsPerTrigger"] = str(limit)
    elif fmt in FILE_FORMATS:
        if limit is not None:
            out["maxFilesPerTrigger"] = str(limit)
        if start == "latest":
            raise ValueError("a folder is read from its start; use modifiedAfter or poll_by_column")
    elif limit is not None:
        out["maxFilesPerTrigger"] = str(limit)
    return {**out, **options}


def change_stream(
    spark: SparkSession,
    fmt: str,
    path: str | None = None,
    schema: T.StructType = MESSAGE,
    limit: int | None = None,
    start: str = "earliest",
    fail_on_data_loss: bool = True,
    **options: str,
) -> DataFrame:
    """Unbounded source. ``limit`` bounds a trigger, in offsets of a broker or files of a folder; without it a trigger
    takes all there is. Offsets that are gone fail the query unless ``fail_on_data_loss`` is false."""
    reader = spark.readStream.format(fmt).options(**_options(fmt, limit, start, options, fail_on_data_loss))
    if fmt in FILE_FORMATS:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def change_batch(
    spark: SparkSession, fmt: str, path: str | None = None, schema: T.StructType | None = MESSAGE, **options: str
) -> DataFrame:
    """Bounded read of the same source (ending offsets or a time range are connector options)."""
    reader = spark.read.format(fmt).options(**options)
    if schema is not None and fmt in FILE_FORMATS:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def table(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    version: int | None = None,
    timestamp: str | None = None,
    snapshot_id: int | None = None,
    **options: str,
) -> DataFrame:
    """Current table, or an older state where the format supports time travel."""
    extra = dict(options)
    if version is not None:
        extra["versionAsOf"] = str(version)
    if timestamp is not None:
        extra["timestampAsOf"] = timestamp
    if snapshot_id is not None:
        extra["snapshot-id"] = str(snapshot_id)
    return spark.read.format(fmt).options(**extra).load(path)


def change_feed(
    spark: SparkSession, path: str, fmt: str = "parquet", start: int | None = None, end: int | None = None, **options: str
) -> DataFrame:
    """Change feed of a table: by connector options where it keeps one, else a feed stored as files
    and partitioned by version, where the bounds prune folders."""
    if fmt == "delta":
        extra = {"readChangeFeed": "true", "startingVersion": str(start or 0), **options}
        if end is not None:
            extra["endingVersion"] = str(end)
        return spark.read.format(fmt).options(**extra).load(path)
    from tidemark.operators.feed import VERSION, between_versions

    feed = spark.read.format(fmt).options(**options).load(path)
    feed = feed.withColumn(VERSION, F.col(VERSION).cast("bigint"))
    return feed if start is None and end is None else between_versions(feed, start or 0, end)


def jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str | None = None,
    lower: int | str | None = None,
    upper: int | str | None = None,
    partitions: int = 64,
    **options: str,
) -> DataFrame:
    """Relational table, read in parallel ranges of a numeric or time column when one is named."""
    opts = {"url": url, "dbtable": table, **options}
    if partition_column is not None:
        opts |= {
            "partitionColumn": partition_column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return spark.read.format("jdbc").options(**opts).load()


def poll_by_column(table: DataFrame, column: str, after) -> DataFrame:
    """Rows updated after the bookmark. The filter reaches the scan; deletes cannot be seen this way."""
    value = F.lit(after) if isinstance(after, (int, float)) else F.lit(str(after)).cast(table.schema[column].dataType)
    return table.filter(F.col(column) > value)


def next_bookmark(rows: DataFrame, column: str) -> DataFrame:
    return rows.agg(F.max(column).alias("bookmark"))
