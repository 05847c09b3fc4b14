"""Lag and freshness: how far processing is behind the source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalar import col
from tidemark.operators.history import seconds_between

# Default limits.
DEFAULT_THRESHOLD_SECONDS = 5.0
DEFAULT_STALE_MINUTES = 5


def of(event_ts: str | Column, processed_ts: str | Column) -> Column:
    """Seconds between event and processing, never negative; null if one of the times is."""
    lag = seconds_between(col(event_ts), col(processed_ts))
    return F.when(lag < 0, 0.0).otherwise(lag)


def check(
    df: DataFrame, lag: str | Column, threshold: float | None = None, warning: float | None = None
) -> DataFrame:
    """Add status (passed, warning, failed; skipped without a lag) and how much of the threshold is used."""
    limit = DEFAULT_THRESHOLD_SECONDS if threshold is None else threshold
    value = col(lag)
    status = F.when(value.isNull(), "skipped").when(value > limit, "failed")
    if warning is not None:
        status = status.when(value > warning, "warning")
    percent = F.when(F.lit(limit) > 0, 100.0 * value / F.lit(limit))
    return df.withColumns({"lag_status": status.otherwise("passed"), "percent_of_threshold": percent})


def batch(df: DataFrame, lag: str | Column, by: Sequence[str] = (), threshold: float | None = None) -> DataFrame:
    """Count, average, least and greatest lag; the greatest decides. No events: skipped."""
    limit = DEFAULT_THRESHOLD_SECONDS if threshold is None else threshold
    value = col(lag)
    out = df.groupBy(*by).agg(
        F.count(value).alias("events"),
        F.avg(value).alias("avg_lag"),
        F.min(value).alias("min_lag"),
        F.max(value).alias("max_lag"),
    )
    status = F.when(F.col("events") == 0, "skipped").when(F.col("max_lag") <= limit, "passed").otherwise("failed")
    return out.withColumn("status", status)


def staleness(
    df: DataFrame, ts: str, now: Column, by: Sequence[str] = (), minutes: float | None = None
) -> DataFrame:
    """Seconds since the last event; more than the limit is a warning."""
    limit = 60 * (DEFAULT_STALE_MINUTES if minutes is None else minutes)
    out = df.groupBy(*by).agg(F.max(ts).alias("last_event"))
    out = out.withColumn("seconds_since", seconds_between(F.col("last_event"), now))
    return out.withColumn("status", F.when(F.col("seconds_since") <= limit, "passed").otherwise("warning"))


def trend(
    df: DataFrame, ts: str, lag: str | Column, window: str = "10 minutes", by: Sequence[str] = (), flat: float = 1e-9
) -> DataFrame:
    """Slope of the lag in seconds per minute, its direction, and average, least and greatest lag."""
    value = col(lag)
    minute = F.timestamp_diff("MICROSECOND", F.date_trunc("day", F.col(ts)), F.col(ts)) / F.lit(6e7)
    out = df.groupBy(*by, F.window(F.col(ts), window).alias("w")).agg(
        F.regr_slope(value, minute).alias("slope_per_minute"),
        F.avg(value).alias("avg_lag"),
        F.min(value).alias("min_lag"),
        F.max(value).alias("max_lag"),
        F.count("*").alias("samples"),
    )
    slope = F.col("slope_per_minute")
    direction = F.when(slope > flat, "increasing").when(slope < -flat, "decreasing").otherwise("stable")
    return out.select(
        *by, F.col("w.start").alias("window_start"), "samples", slope, "avg_lag", "min_lag", "max_lag",
        direction.alias("direction"),
    )


def between_tables(
    source: DataFrame, dest: DataFrame, source_ts: str, dest_ts: str, by: Sequence[str] = (), threshold: float | None = None
) -> DataFrame:
    """Latest source time against latest destination time, per group. A group with nothing in the destination has no
    lag and fails; one without a time in the source is skipped."""
    limit = DEFAULT_THRESHOLD_SECONDS if threshold is None else threshold
    s = source.groupBy(*by).agg(F.max(source_ts).alias("source_latest"))
    d = dest.groupBy(*by).agg(F.max(dest_ts).alias("dest_latest"))
    both = s.join(d, list(by), "left") if by else s.select("*", d.scalar().alias("dest_latest"))
    both = both.withColumn("lag_seconds", of("dest_latest", "source_latest"))
    status = F.when(F.col("source_latest").isNull(), "skipped").when(F.col("lag_seconds") <= limit, "passed").otherwise("failed")
    return both.withColumn("status", status)


def offsets(ends: DataFrame, positions: DataFrame) -> DataFrame:
    """Consumer lag per topic and partition: log end less position (0 when nothing was read yet).

    ``ends`` may be the raw messages; ``offset`` is reduced to its greatest value per partition.
    """
    end = ends.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("end_offset"))
    out = end.join(positions, ["topic", "partition"], "left")
    at = F.coalesce("position", F.lit(0))
    return out.select("topic", "partition", "end_offset", at.alias("position"), (F.col("end_offset") - at).alias("lag"))


def by_count(source: DataFrame, captured: DataFrame, slack: int = 100) -> DataFrame:
    """Source rows against captured events: a warning when more than ``slack`` are not there yet."""
    sides = source.select(F.lit(1).alias("s")).unionAll(captured.select(F.lit(0).alias("s")))
    out = sides.agg(
        F.count_if(F.col("s") == 1).alias("source_rows"), F.count_if(F.col("s") == 0).alias("captured_rows")
    )
    behind = F.col("source_rows") > F.col("captured_rows") + slack
    return out.withColumn("status", F.when(behind, "warning").otherwise("passed"))
