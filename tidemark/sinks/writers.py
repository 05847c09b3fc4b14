"""Table writers. Files are written to a new folder or appended; a path being read is never overwritten."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import lineage

# Units a time column can be bucketed by.
TIME_UNITS = ("year", "month", "day", "hour")


def gathered(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Bring the rows of one partition value together, so that a task does not open a file for each
    value. The exchange is sized at run time: small values share a task, a hot value is split."""
    names = ", ".join(f"`{c}`" for c in columns)
    return df.sparkSession.sql(f"SELECT /*+ REBALANCE({names}) */ * FROM {{df}}", df=df)


def _write(df: DataFrame, path: str, mode: str, fmt: str, partition_by: Sequence[str], sort_by: Sequence[str], **options: str):
    if partition_by and not df.isStreaming:
        df = gathered(df, partition_by)
    if sort_by:
        # rows of one partition value stay in order inside each file
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    writer = df.write.format(fmt).mode(mode).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def append(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (), sort_by: Sequence[str] = (), **options: str
) -> None:
    _write(df, path, "append", fmt, partition_by, sort_by, **options)


def overwrite(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (), sort_by: Sequence[str] = (), **options: str
) -> None:
    """Replace the table. For file formats the frame must not read the same path; write the next
    version folder instead (``next_version``)."""
    _write(df, path, "overwrite", fmt, partition_by, sort_by, **options)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str], fmt: str = "parquet") -> None:
    """Overwrite only the partitions that occur in the frame."""
    _write(df, path, "overwrite", fmt, partition_by, (), partitionOverwriteMode="dynamic")


def time_bucket(df: DataFrame, column: str, unit: str, name: str | None = None) -> DataFrame:
    if unit not in TIME_UNITS:
        raise ValueError(f"unit is one of {TIME_UNITS}")
    return df.withColumn(name or f"{column}_{unit}", F.date_trunc(unit, F.col(column)).cast("date"))


def time_partitioned(
    df: DataFrame, path: str, column: str, unit: str, mode: str = "append", sort_by: Sequence[str] = (), fmt: str = "parquet"
) -> None:
    """Write in time partitions."""
    _write(time_bucket(df, column, unit), path, mode, fmt, [f"{column}_{unit}"], sort_by)


def ensure_table(spark: SparkSession, name: str, schema: T.StructType, fmt: str = "parquet", partition_by: Sequence[str] = (), path: str | None = None) -> None:
    """Create the catalog table (and its database) unless it is there."""
    if "." in name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name.split('.')[0]}`")
    if spark.catalog.tableExists(name):
        return
    writer = spark.createDataFrame([], schema).write.format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def save_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int, path: str | None = None, fmt: str = "parquet") -> None:
    """Save a table that is changed again and again, bucketed and sorted by its key: joins and
    aggregations on the key (``apply_changes(strategy="merge")``, differences, checks) then shuffle only
    the other side. Rows are brought to their bucket first, so each bucket is one file."""
    writer = df.repartition(buckets, *keys).write.format(fmt).mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


TARGET_BYTES = 256 * 2**20
#: Smaller files than this are written several to a task, so that tasks and the blocks shuffled to them don't grow with the
#: number of files.
TASK_BYTES = 16 * 2**20


def _shares(df: DataFrame, files: int | None, target_bytes: int) -> tuple[int, int, int]:
    """Files to write, tasks that write them, and rows a file (0: each task writes one file). Rows are counted only where a
    task writes several files."""
    if files is not None:
        return files, files, 0
    files = max(1, -(-lineage.bytes_of(df) // target_bytes))
    tasks = max(-(-files // max(1, TASK_BYTES // target_bytes)), min(files, df.sparkSession.sparkContext.defaultParallelism))
    return files, tasks, -(-df.count() // files) if tasks < files else 0


def compact(
    df: DataFrame, path: str, files: int | None = None, order_by: Sequence[str] = (), fmt: str = "parquet",
    target_bytes: int = TARGET_BYTES,
) -> None:
    """Rewrite a table into files of about ``target_bytes`` (of the present size of the files it is read from; without any,
    ``files`` must be given), or into ``files`` of them, in a
    new folder. With ``order_by`` they are cut by range and
    sorted, so that scans on those columns skip files; rows that tie are cut by their hash, so a hot
    value is spread over files. A task cuts its rows into several files, in their order, where these are small."""
    files, tasks, rows = _shares(df, files, target_bytes)
    if order_by:
        out = df.repartitionByRange(tasks, *order_by, F.xxhash64(*df.columns)).sortWithinPartitions(*order_by)
    else:
        out = df.repartition(tasks)
    out.write.format(fmt).mode("errorifexists").option("maxRecordsPerFile", rows).save(path)


RANK_BITS = 8


def _numbered(df: DataFrame, column: str) -> Column:
    """A number that rises with the column: of a text its first seven bytes; null is below all."""
    kind, c = df.schema[column].dataType, F.col(f"`{column}`")
    if isinstance(kind, T.StringType):
        number = F.conv(F.rpad(F.hex(F.substring(c.cast("binary"), 1, 7)), 14, "0"), 16, 10)
    elif isinstance(kind, T.DateType):
        number = F.unix_date(c)
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        number = F.unix_micros(c.cast("timestamp"))
    else:
        number = c
    return F.coalesce(number.cast("double"), F.lit(float("-inf")))


def interleaved(df: DataFrame, columns: Sequence[str], bits: int = RANK_BITS) -> Column:
    """Interleaved bits of the columns' range ranks (a Z-order curve). Ranks come from quantiles, found in one pass over
    the columns, so skewed columns are cut evenly, too; nulls come first."""
    if not 1 <= len(columns) * bits <= 62 or bits % 2:
        raise ValueError("bits is even, and bits times columns is at most 62")
    n = 2**bits
    at = [k / n for k in range(1, n)]
    names = [f"q{k}" for k in range(len(columns))]
    found = df.agg(*[F.percentile_approx(_numbered(df, c), at, 10 * n).alias(q) for c, q in zip(columns, names)]).first()
    limits = [np.sort(found[q]) for q in names if found[q] is not None]
    if not limits:
        return F.lit(0).cast("long")  # no rows

    def curve(numbers: pd.DataFrame) -> pd.Series:
        out = np.zeros(len(numbers), np.int64)
        for place, at in enumerate(limits):
            rank = np.searchsorted(at, numbers.iloc[:, place].to_numpy(), "right")
            for b in range(bits):
                out |= (rank >> b & 1) << (b * len(limits) + place)
        return pd.Series(out)

    return F.pandas_udf(curve, T.LongType())(F.struct(*[_numbered(df, c).alias(q) for c, q in zip(columns, names)]))


def cluster(
    df: DataFrame, path: str, columns: Sequence[str], files: int | None = None, fmt: str = "parquet", target_bytes: int = TARGET_BYTES,
    bits: int = RANK_BITS,
) -> None:
    """Rewrite a table into a new folder, clustered on several columns at once: filters on any of them skip most files
    by the bounds in their footers. ``files`` as in ``compact``; a hot cell of the curve is spread over files by hash."""
    files, tasks, rows = _shares(df, files, target_bytes)
    curve = "__curve"
    placed = df.withColumn(curve, interleaved(df, columns, bits))
    out = placed.repartitionByRange(tasks, curve, F.xxhash64(*[f"`{c}`" for c in df.columns])).sortWithinPartitions(curve, *[f"`{c}`" for c in columns])
    out.drop(curve).write.format(fmt).mode("errorifexists").option("maxRecordsPerFile", rows).save(path)


def append_feed(feed: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Append feed rows, partitioned by version."""
    from tidemark.operators.feed import VERSION

    _write(feed, path, "append", fmt, [VERSION], ())


def versions(spark: SparkSession, root: str) -> list[int]:
    """Complete versions of a versioned folder table, in order (one small number per version)."""
    try:
        log = spark.read.schema("version long").parquet(f"{root}/log")
    except AnalysisException:
        return []
    return [r.version for r in log.distinct().orderBy("version").collect()]


def latest_version(spark: SparkSession, root: str, upto: int | None = None) -> int | None:
    """Greatest complete version (not above ``upto``), or None: one number comes to the driver."""
    try:
        log = spark.read.schema("version long").parquet(f"{root}/log")
    except AnalysisException:
        return None
    return (log if upto is None else log.filter(F.col("version") <= upto)).agg(F.max("version")).first()[0]


def read_version(spark: SparkSession, root: str, version: int | None = None, fmt: str = "parquet") -> DataFrame:
    v = latest_version(spark, root, version)
    if v is None or version not in (None, v):
        raise FileNotFoundError(f"no complete version {version} under {root}")
    return spark.read.format(fmt).load(f"{root}/version={v}")


def write_version(df: DataFrame, root: str, version: int, fmt: str = "parquet") -> str:
    """Write one version of a folder table and then list it in the log, which makes it visible.
    Repeating this after a failure replaces the half-written version."""
    path = f"{root}/version={version}"
    df.write.format(fmt).mode("overwrite").save(path)
    spark = df.sparkSession
    spark.createDataFrame([(version,)], "version long").coalesce(1).write.mode("append").parquet(f"{root}/log")
    return path
