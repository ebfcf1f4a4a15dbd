"""Latency samples of the serving pipelines and their statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from orderflow.functions import scalars as X
from orderflow.operators import quantiles as Q
from orderflow.operators.ordered import join_same
from orderflow.schemas import LATENCY_FIELDS

RECENT_MS = 120_000


def snapshot_age_ms(produced_at_ms: Column, as_of_ms: Column) -> Column:
    """Age of a shown snapshot; unknown (null) where there is no produce time."""
    return F.when(produced_at_ms > 0, F.greatest(as_of_ms - produced_at_ms, F.lit(0)))


def latency_samples(shown: DataFrame, recent_ms: int = RECENT_MS) -> DataFrame:
    """One sample per emitted snapshot; emit latencies only where the last event was processed recently."""
    emitted, processed = F.col("emitted_at_ms"), F.col("processed_at_ms")
    recent = emitted - processed <= recent_ms

    def since(start: Column) -> Column:
        return F.when(recent, F.round(F.greatest(emitted - start, F.lit(0)).cast("double"), 2))

    return shown.select(
        (emitted / F.lit(1000.0)).alias("recorded_at"),
        "pipeline",
        F.col("produced_at_ms").alias("last_event_produced_at_ms"),
        processed.alias("last_event_processed_at_ms"),
        F.col("latency_last_ms").alias(LATENCY_FIELDS[0]),
        F.col("latency_avg_1m_ms").alias(LATENCY_FIELDS[1]),
        since(processed).alias(LATENCY_FIELDS[2]),
        since(F.col("produced_at_ms")).alias(LATENCY_FIELDS[3]),
        F.col("events_per_minute").alias("orders_processed_per_minute"),
        F.col("total_orders").alias("total_orders_processed"),
    )


_TIE = ["recorded_at", "last_event_processed_at_ms", "total_orders_processed"]


def _stats(long: DataFrame, groups: list[str]) -> DataFrame:
    latest = F.when(F.col("value").isNotNull(), F.struct(*_TIE))
    base = long.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("samples"),
        F.round(X.exact_avg(F.col("value")), 2).alias("avg"),
        F.round(F.max_by("value", latest), 2).alias("last"),
    )
    ranks = Q.percentiles(
        long, groups, "value", {"p50": F.round(Q.linear("value", 0.5), 2), "p95": F.round(Q.linear("value", 0.95), 2)}
    )
    return join_same(base, ranks, groups, "left")


def window_latency_stats(samples: DataFrame, window_seconds: int = 300) -> DataFrame:
    """Samples, average, p50, p95 and last value per pipeline, field and tumbling window.

    ``samples`` needs ``recorded_at`` (epoch seconds) and, against ties, ``total_orders_processed``.
    """
    window = (F.floor(F.col("recorded_at") / window_seconds) * window_seconds).alias("window_start")
    long = samples.select("pipeline", window, *_TIE, *LATENCY_FIELDS).unpivot(
        ["pipeline", "window_start", *_TIE], LATENCY_FIELDS, "field", "value"
    )
    return _stats(long, ["pipeline", "window_start", "field"])


def pipeline_latency_stats(samples: DataFrame, as_of: Column, window_seconds: int = 300) -> DataFrame:
    """The same per pipeline and field over the samples of the last ``window_seconds`` before ``as_of``, bounds included."""
    kept = samples.where(F.col("recorded_at").between(as_of - window_seconds, as_of))
    long = kept.select("pipeline", *_TIE, *LATENCY_FIELDS).unpivot(["pipeline", *_TIE], LATENCY_FIELDS, "field", "value")
    return _stats(long, ["pipeline", "field"])


def snapshot_ages(samples: DataFrame, as_of_ms: Column) -> DataFrame:
    """Per pipeline: shown snapshots, how many have an age, the newest and the oldest of them at ``as_of_ms``."""
    age = snapshot_age_ms(F.col("last_event_produced_at_ms"), as_of_ms)
    return samples.groupBy("pipeline").agg(
        F.count(F.lit(1)).alias("samples"), F.count(age).alias("aged"), F.min(age).alias("newest_ms"), F.max(age).alias("oldest_ms")
    )


def latency_percentiles(df: DataFrame, group: str, value: str) -> DataFrame:
    """Samples, average, p50, p95 and maximum per group."""
    base = df.groupBy(group).agg(
        F.count(value).alias("samples"),
        F.round(X.exact_avg(F.col(value)), 2).alias("avg"),
        F.coalesce(F.max(value), F.lit(0.0)).alias("max"),
    )
    ranks = Q.percentiles(df, [group], value, {"p50": Q.linear(value, 0.5), "p95": Q.linear(value, 0.95)})
    return join_same(base, ranks, [group], "left")


def recent_samples(samples: DataFrame, limit: int = 200) -> DataFrame:
    """The newest samples over all pipelines."""
    return samples.orderBy(F.desc("recorded_at"), F.desc("last_event_processed_at_ms"), "pipeline").limit(limit)
