"""Counters, gauges, histograms, rates and alert conditions as aggregations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import ordered
from tidemark.functions.scalar import col
from tidemark.operators.history import seconds_between

# Bucket bounds of the histograms.
DURATION_BUCKETS = (0.001, 0.005, 0.01, 0.05, 0.1, 0.5, 1.0, 5.0, 10.0)
LONG_DURATION_BUCKETS = (0.1, 0.5, 1.0, 5.0, 10.0, 30.0, 60.0, 120.0, 300.0)
# Alert limits (events per second).
LOW_RATE, STALLED_RATE = 10.0, 0.1


def event_counts(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    return df.groupBy(*labels).agg(F.count("*").alias("total"))


def gauges(df: DataFrame, labels: Sequence[str], value: str | Column, order_by: Sequence[str]) -> DataFrame:
    """Last value per label set."""
    order = F.struct(*order_by)
    return df.groupBy(*labels).agg(F.max_by(col(value), order).alias("value"))


def histogram(df: DataFrame, value: str | Column, buckets: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Cumulative counts ``le``, with total count and sum, in one pass (``le`` null is the +Inf bucket)."""
    v = col(value)
    out = df.groupBy(*by).agg(
        F.count(v).alias("total"),
        F.sum(v).alias("value_sum"),
        *[F.count_if(v <= F.lit(b)).alias(f"b{i}") for i, b in enumerate(buckets)],
    )
    entries = [F.struct(F.lit(float(b)).alias("le"), F.col(f"b{i}").alias("count")) for i, b in enumerate(buckets)]
    entries.append(F.struct(F.lit(None).cast("double").alias("le"), F.col("total").alias("count")))
    return out.select(*by, "total", "value_sum", F.inline(F.array(*entries)))


def throughput(runs: DataFrame, by: Sequence[str], processed: str, errors: str, start: str, end: str) -> DataFrame:
    """Rows per second and error rate of each group of runs."""
    out = runs.groupBy(*by).agg(
        F.sum(processed).alias("processed"),
        F.sum(errors).alias("errors"),
        seconds_between(F.min(start), F.max(end)).alias("seconds"),
    )
    return out.withColumns(
        {
            "rows_per_second": F.when(F.col("seconds") > 0, F.col("processed") / F.col("seconds")),
            "error_rate": F.col("errors") / F.greatest(F.col("processed"), F.lit(1)),
        }
    )


def rate(
    df: DataFrame, ts: str, by: Sequence[str] = (), window: str = "5 minutes", seconds: int = 300, slide: str | None = None,
    until: Column | None = None,
) -> DataFrame:
    """Events per second in each window, and whether that is low or stalled.

    Every group has a row for each window from its first event to its last one, or to ``until`` (now, say): a
    source that has stopped shows windows with no events, which are stalled.
    """
    w = F.window(F.col(ts), window, slide) if slide else F.window(F.col(ts), window)
    counted = df.groupBy(*by, w["start"].alias("at")).agg(F.count("*").alias("n"))
    ends = counted.groupBy(*by).agg(F.min("at").alias("first"), F.max("at").alias("last"))
    upto = F.col("last") if until is None else F.greatest(F.col("last"), until.cast(counted.schema["at"].dataType))
    every = ends.select(*by, F.explode(F.sequence("first", upto, F.expr(f"interval {slide or window}"))).alias("at"))
    same = [F.col(f"e.`{c}`").eqNullSafe(F.col(f"c.`{c}`")) for c in by]
    on = F.col("e.at") == F.col("c.at")
    for s in same:
        on = on & s
    out = every.alias("e").join(counted.alias("c"), on, "left").select("e.*", F.coalesce("c.n", F.lit(0)).alias("events"))
    per_second = F.col("events") / F.lit(float(seconds))
    status = F.when(per_second < STALLED_RATE, "stalled").when(per_second < LOW_RATE, "low").otherwise("ok")
    return out.select(
        *by, F.col("at").alias("window_start"), "events",
        per_second.alias("events_per_second"), status.alias("status"),
    )


def sustained(
    samples: DataFrame, by: Sequence[str], ts: str, condition: str | Column, seconds: float, bucket: Column | None = None
) -> DataFrame:
    """Stretches in which the condition held without a break for at least ``seconds``.

    ``samples`` has one row per group and time. Islands are numbered by a running count of the samples
    that break the condition; ``bucket`` (the day unless given) keeps that parallel for a long series.
    """
    bucket = F.date_trunc("day", F.col(ts)) if bucket is None else bucket
    cond = F.expr(condition) if isinstance(condition, str) else condition
    holds = F.coalesce(cond, F.lit(False))
    flagged = samples.select(*by, F.col(ts).alias("__ts"), holds.alias("__on"), bucket.alias("__cut"))
    breaks = F.when(F.col("__on"), 0).otherwise(1).cast("bigint")
    islands = ordered.running_sum(flagged, by, ["__ts"], breaks, "__island", "__cut")
    out = islands.filter("__on").groupBy(*by, "__island").agg(
        F.min("__ts").alias("started"), F.max("__ts").alias("ended"), F.count("*").alias("samples")
    )
    out = out.withColumn("lasted_seconds", seconds_between(F.col("started"), F.col("ended")))
    return out.filter(F.col("lasted_seconds") >= seconds).drop("__island")


def increase(
    samples: DataFrame, by: Sequence[str], ts: str, counter: str, window: str = "15 minutes", bucket: Column | None = None
) -> DataFrame:
    """Growth of a counter per window; a drop in value is a restart from zero.

    ``bucket`` (the day unless given) keeps a long series parallel.
    """
    bucket = F.date_trunc("day", F.col(ts)) if bucket is None else bucket
    last = ordered.previous(samples, by, [ts], F.col(counter), "__prev", bucket)
    grown = (
        F.when(F.col("__prev").isNull(), F.lit(0))
        .when(F.col(counter) >= F.col("__prev"), F.col(counter) - F.col("__prev"))
        .otherwise(F.col(counter))
    )
    out = last.groupBy(*by, F.window(F.col(ts), window).alias("w")).agg(F.sum(grown).alias("increase"))
    return out.select(*by, F.col("w.start").alias("window_start"), "increase")


def health(components: DataFrame, by: Sequence[str], component: str, status: str, order_by: Sequence[str]) -> DataFrame:
    """Overall health from the latest status of every component."""
    now = gauges(components, [*by, component], status, order_by)
    s = F.col("value")
    verdict = (
        F.when(F.bool_and(s == "healthy"), "healthy").when(F.bool_or(s == "unhealthy"), "unhealthy").otherwise("degraded")
    )
    return now.groupBy(*by).agg(verdict.alias("health"), F.count("*").alias("components"))
