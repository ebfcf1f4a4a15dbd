"""Day-by-day history of the event lake.

Every function works on all days of its input at once (one result per UTC day); restrict the input with
``sources.lake.days`` to prune the scan to a date range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from orderflow.functions import scalars as X
from orderflow.schemas import CANCELLED, DELIVERED, UNKNOWN


def event_date() -> Column:
    return F.concat_ws("-", "year", "month", "day").alias("event_date")


def effective_status() -> Column:
    return F.coalesce("event_status", "to_status", "from_status", F.lit(UNKNOWN))


def event_position() -> Column:
    """Event time, then event id; unreadable times sort as 1970 and missing ids as 0."""
    micros = F.coalesce(F.unix_micros(X.iso_timestamp(F.col("created_at"))), F.lit(0))
    return F.struct(micros, F.coalesce(F.col("event_id").try_cast("long"), F.lit(0).cast("long")))


def _per_order(lake: DataFrame, status: Column | None = None) -> DataFrame:
    """Status of the latest event and number of events per (day, order), in one partial aggregation."""
    value = effective_status() if status is None else status
    position = event_position() if status is None else F.when(status.isNotNull(), event_position())
    return lake.groupBy(event_date(), "order_id").agg(
        F.max_by(value, position).alias("status"), F.count(F.lit(1)).alias("events")
    )


def latest_order_status(lake: DataFrame, status: Column | None = None) -> DataFrame:
    """Status of each order's latest event of the day.

    With ``status`` given, rows where it is null are passed over.
    """
    return _per_order(lake.where(F.col("order_id").isNotNull()), status)


def history_kpis(lake: DataFrame) -> DataFrame:
    """Events and orders per day with open, delivered and cancelled counts and their rates, in one scan.

    Events without an order count as events only.
    """
    status, known = F.col("status"), F.col("order_id").isNotNull()
    days = (
        _per_order(lake)
        .groupBy("event_date")
        .agg(
            F.sum("events").alias("total_events"),
            F.count("order_id").alias("total_orders"),
            F.count_if(known & ~status.isin(DELIVERED, CANCELLED)).alias("orders_open"),
            F.count_if(known & (status == DELIVERED)).alias("orders_delivered"),
            F.count_if(known & (status == CANCELLED)).alias("orders_cancelled"),
        )
    )
    return days.select(
        "*",
        X.rate_pct(F.col("orders_delivered"), F.col("total_orders")).alias("delivery_rate_pct"),
        X.rate_pct(F.col("orders_cancelled"), F.col("total_orders")).alias("cancel_rate_pct"),
    )


def status_distribution(lake: DataFrame) -> DataFrame:
    return (
        latest_order_status(lake)
        .groupBy("event_date", "status")
        .agg(F.count(F.lit(1)).alias("total"))
        .orderBy("event_date", F.desc("total"), "status")
    )


def events_by_type(lake: DataFrame) -> DataFrame:
    return (
        lake.groupBy(event_date(), F.coalesce("event_type", F.lit(UNKNOWN)).alias("event_type"))
        .agg(F.count(F.lit(1)).alias("total"))
        .orderBy("event_date", F.desc("total"), "event_type")
    )


def events_by_hour(lake: DataFrame) -> DataFrame:
    """Events and distinct orders per hour; Spark first drops duplicates per (hour, order)."""
    return (
        lake.groupBy(event_date(), "hour")
        .agg(F.count(F.lit(1)).alias("total_events"), F.countDistinct("order_id").alias("total_orders"))
        .orderBy("event_date", "hour")
    )


def peak_hour(lake: DataFrame) -> DataFrame:
    """Busiest hour of each day, the earliest one on ties."""
    hourly = lake.groupBy(event_date(), "hour").agg(F.count(F.lit(1)).alias("total_events"))
    best = F.max_by("hour", F.struct(F.col("total_events"), -F.col("hour").cast("int")))
    return hourly.groupBy("event_date").agg(best.alias("peak_hour"), F.max("total_events").alias("peak_events"))


def shares(counts: DataFrame, keys: list[str], label: str, value: str) -> DataFrame:
    """Share, bar width and running share range of each label; ``counts`` is already aggregated."""
    group = Window.partitionBy(*keys)
    ranked = group.orderBy(F.desc(value), label).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    v, total = F.col(value), F.sum(value).over(group)
    upto = F.sum(value).over(ranked)
    return counts.select(
        *keys,
        label,
        value,
        (v * F.lit(100.0) / total).alias("share_pct"),
        (v * F.lit(100.0) / F.greatest(F.max(value).over(group), F.lit(1))).alias("bar_pct"),
        ((upto - v) * F.lit(100.0) / total).alias("start_pct"),
        (upto * F.lit(100.0) / total).alias("end_pct"),
    )


def status_shares(lake: DataFrame) -> DataFrame:
    counts = latest_order_status(lake).groupBy("event_date", "status").agg(F.count(F.lit(1)).alias("total"))
    return shares(counts, ["event_date"], "status", "total")
