"""Sliding and tumbling rates, and the bucketed time series of the live numbers.

A series is built from changes, not from repeated snapshots: every event adds +1 / -1 to the numbers it
changes, changes are summed per bucket with map-side partials, and only bucket rows are put in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from orderflow.functions import scalars as X
from orderflow.operators import ordered, state

SERIES_BUCKETS = 60
RING_BUCKETS = 300
LEVELS = ["preparing", "waiting_courier", "delivering", "delivered"]


def with_latency(events: DataFrame) -> DataFrame:
    return events.withColumn("latency_ms", X.latency_ms(F.col("event_ts"), F.col("arrival_ts")))


def ticks(ts: Column, window_seconds: int, tick_seconds: int) -> Column:
    """Ends (epoch seconds) of all windows ``[end - window, end]`` that hold the time, one per tick."""
    step, micros = tick_seconds * 1_000_000, F.unix_micros(ts)
    first = F.ceil(micros / F.lit(step))
    last = F.floor((micros + window_seconds * 1_000_000) / F.lit(step))
    return F.transform(F.sequence(first, last), lambda i: i * tick_seconds)


def _windowed(events: DataFrame, window_seconds: int, tick_seconds: int, *cols: str | Column) -> DataFrame:
    end = F.explode(ticks(F.col("arrival_ts"), window_seconds, tick_seconds)).alias("window_end")
    return events.select(end, *cols)


def window_summary(events: DataFrame, window_seconds: int = 60, tick_seconds: int = 60) -> DataFrame:
    """Events, average latency and events per type of every window: one pass, one row per (window, type)."""
    rows = _windowed(with_latency(events), window_seconds, tick_seconds, "event_type", "latency_ms")
    exact = F.col("latency_ms").cast("decimal(18,3)")
    per_type = rows.groupBy("window_end", "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(exact).alias("s"))
    whole = Window.partitionBy("window_end")  # one row per event type
    n, s = F.sum("n").over(whole), F.sum("s").over(whole)
    return per_type.select(
        "window_end", "event_type", F.col("n").alias("type_events"), n.alias("window_events"),
        F.round(s.cast("double") / n, 2).alias("latency_avg_ms"),
    )


def window_by_status(events: DataFrame, window_seconds: int = 60, tick_seconds: int = 60) -> DataFrame:
    rows = _windowed(events.where(F.col("status").isNotNull()), window_seconds, tick_seconds, "status")
    return rows.groupBy("window_end", "status").agg(F.count(F.lit(1)).alias("total"))


def sliding_rate(events: DataFrame, window_seconds: int = 60) -> DataFrame:
    """At every arrival time: events, created orders and mean latency of the trailing window, bounds included.

    Events are first summed per microsecond. A window is the running sums up to its end less those before its start, so
    each time is placed twice, and the sums run in slices of a minute whatever the window's width.
    """
    created = (F.col("event_type") == "ORDER_CREATED") & F.col("order_id").isNotNull()
    at = F.unix_micros("arrival_ts").alias("at_us")
    stamps = (
        with_latency(events)
        .groupBy(at)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(created).alias("c"),
            F.sum(F.col("latency_ms").cast("decimal(18,3)")).alias("s"),
        )
    )
    sums = ("n", "c", "s")
    # at equal places the start comes first: it is before what happens there
    start = F.struct((F.col("at_us") - window_seconds * 1_000_000).alias("place"), F.lit(0).alias("end"), *[(F.col(x) * 0).cast(stamps.schema[x].dataType).alias(x) for x in sums])
    end = F.struct(F.col("at_us").alias("place"), F.lit(1).alias("end"), *sums)
    places = stamps.select("at_us", F.explode(F.array(start, end)).alias("_p")).select("at_us", "_p.*")
    marked = ordered.mark(places, F.floor(F.col("place") / F.lit(60_000_000)))
    running = ordered.carry(marked, [], ["place", "end"], running_sum={f"_{x}": F.col(x) for x in sums})
    n, c, s = (F.sum(F.when(F.col("end") == 1, F.col(f"_{x}")).otherwise(-F.col(f"_{x}"))) for x in sums)
    return running.groupBy("at_us").agg(n.alias("events"), c.alias("created"), (s.cast("double") / n).alias("latency_avg_ms"))


def _bucket(ts: str, seconds: int) -> Column:
    return (F.floor(F.unix_seconds(F.col(ts)) / F.lit(seconds)) * seconds).alias("bucket")


def order_flow(events: DataFrame) -> DataFrame:
    """Per order event: the live-count bucket before and after it, and whether it is the order's first."""
    changes = state.order_changes(events)
    order = ["arrival_ts", "seq"]
    marked = ordered.mark(changes, ordered.time_slice(F.col("arrival_ts")))
    now = ordered.carry(
        marked,
        ["order_id"],
        order,
        last_known={
            "status": F.col("new_status"),
            "has_courier": F.when(F.col("assigned"), F.lit(True)),
        },
    )
    after = state.bucket(F.col("status"), F.coalesce("has_courier", F.lit(False)))
    now = now.withColumn("after", F.coalesce(after, F.lit("none")))
    return ordered.carry(now, ["order_id"], order, previous={"before": F.col("after")})


def courier_flow(events: DataFrame) -> DataFrame:
    signals = state.courier_signals(events)
    marked = ordered.mark(signals, ordered.time_slice(F.col("arrival_ts")))
    return ordered.carry(marked, ["courier_id"], ["arrival_ts", "seq"], previous={"before": F.col("available")})


def bucket_changes(events: DataFrame, bucket_seconds: int = 1) -> DataFrame:
    """Change of every live number per non-empty bucket."""
    flow = order_flow(events)
    level = [
        F.sum((F.col("after") == n).cast("long") - F.coalesce((F.col("before") == n).cast("long"), F.lit(0))).alias(n)
        for n in LEVELS
    ]
    orders = flow.groupBy(_bucket("arrival_ts", bucket_seconds)).agg(
        *level, F.count_if(F.col("before").isNull()).alias("new_orders")
    )
    now, before = F.col("available").cast("long"), F.coalesce(F.col("before").cast("long"), F.lit(0))
    couriers = (
        courier_flow(events)
        .groupBy(_bucket("arrival_ts", bucket_seconds))
        .agg(F.sum(now - before).alias("couriers"))
    )
    created = (F.col("event_type") == "ORDER_CREATED") & F.col("order_id").isNotNull()
    exact = F.col("latency_ms").cast("decimal(18,3)")
    seen = (
        with_latency(events)
        .groupBy(_bucket("arrival_ts", bucket_seconds))
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.count_if(created).alias("created"),
            F.sum(exact).alias("latency_sum"),
            F.max_by("latency_ms", state.position()).alias("latency_last"),
        )
    )
    # three inputs of one row per bucket
    stacked = seen.unionByName(orders, allowMissingColumns=True).unionByName(couriers, allowMissingColumns=True)
    numbers = [*LEVELS, "new_orders", "couriers", "events", "created"]
    return stacked.groupBy("bucket").agg(
        *[F.coalesce(F.sum(n), F.lit(0).cast("long")).alias(n) for n in numbers],
        F.sum("latency_sum").alias("latency_sum"),
        F.max("latency_last").alias("latency_last"),
    )


def rollup_deltas(changes: DataFrame, slice_seconds: int = 86_400) -> DataFrame:
    """Cumulative counters of every bucket and their growth since the bucket before, never below 0."""
    sliced = ordered.mark(changes, F.floor(F.col("bucket") / F.lit(slice_seconds)))
    totals = ordered.carry(
        sliced,
        [],
        ["bucket"],
        running_sum={"total_processed": F.col("new_orders"), "orders_delivered": F.col("delivered")},
    )
    # the step between two buckets of a running total is the change itself
    return totals.select(
        "bucket",
        "total_processed",
        "orders_delivered",
        F.greatest(F.col("new_orders"), F.lit(0)).alias("new_orders"),
        F.greatest(F.col("delivered"), F.lit(0)).alias("new_delivered"),
    )


def newest_bucket(events: DataFrame, bucket_seconds: int = 1) -> DataFrame:
    return events.agg(F.max(_bucket("arrival_ts", bucket_seconds)).alias("newest"))


def ring(changes: DataFrame, newest: DataFrame, bucket_seconds: int = 1, size: int = RING_BUCKETS) -> DataFrame:
    """The last ``size`` buckets up to the newest one, empty ones included, with all live numbers.

    Everything before the ring is summed into one opening row, so the ordered windows see a few hundred rows.
    ``age`` is 0 for the newest bucket.
    """
    reach = (size + SERIES_BUCKETS) * bucket_seconds
    last, step = F.col("newest"), F.lit(bucket_seconds).cast("long")
    spine = newest.select("newest", F.explode(F.sequence(last - reach, last, step)).alias("bucket"))
    numbers = [*LEVELS, "new_orders", "couriers", "events", "created", "latency_sum"]
    inside = changes.groupBy(F.greatest(F.col("bucket"), newest.scalar() - reach).alias("bucket")).agg(
        *[F.sum(n).alias(n) for n in numbers], F.max_by("latency_last", "bucket").alias("latency_last")
    )
    rows = spine.join(inside, "bucket", "left")
    upto = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    trailing = Window.orderBy("bucket").rowsBetween(-(SERIES_BUCKETS - 1), Window.currentRow)
    zero = F.lit(0).cast("long")

    def total(name: str) -> Column:
        return F.coalesce(F.sum(name).over(upto), zero)

    def recent(name: str) -> Column:
        # the opening row holds all older events, so it never counts as recent
        return F.sum(F.when(F.col("bucket") > last - reach, F.col(name))).over(trailing)

    return rows.select(
        "bucket",
        ((last - F.col("bucket")) / bucket_seconds).cast("long").alias("age"),
        F.greatest(F.coalesce("new_orders", zero), zero).alias("new_orders"),
        F.greatest(F.coalesce("delivered", zero), zero).alias("new_delivered"),
        *[total(n).alias(f"orders_{n}") for n in LEVELS],
        total("couriers").alias("couriers_available"),
        total("new_orders").alias("total_processed"),
        F.coalesce(recent("created"), zero).alias("created_per_min"),
        F.when(recent("events") > 0, F.round(recent("latency_sum").cast("double") / recent("events"), 2))
        .otherwise(F.lit(0.0))
        .alias("latency_avg_ms"),
        F.last("latency_last", ignorenulls=True).over(upto).alias("latency_last_ms"),
    ).where(F.col("age") < size)


def rollup_kpis(buckets: DataFrame, bucket_seconds: int = 1) -> DataFrame:
    """New orders and deliveries of the last minute of buckets (bounds included), and the newest levels."""
    recent = F.col("age") <= SERIES_BUCKETS
    levels = [c for c in buckets.columns if c not in ("bucket", "age", "new_orders", "new_delivered")]
    new_orders = F.sum(F.when(recent, F.col("new_orders")))
    return buckets.agg(
        new_orders.alias("new_orders_last_60s"),
        F.sum(F.when(recent, F.col("new_delivered"))).alias("new_delivered_last_60s"),
        F.round(new_orders / F.lit(float(SERIES_BUCKETS * bucket_seconds)), 2).alias("throughput_per_s"),
        *[F.max_by(c, "bucket").alias(c) for c in levels],
    )


def rollup_series(buckets: DataFrame) -> DataFrame:
    """The seven charted series over the newest 60 buckets, as (metric, ts, v)."""
    metrics = {
        "throughput": "new_orders",
        "created": "created_per_min",
        "preparing": "orders_preparing",
        "delivering": "orders_delivering",
        "delivered": "orders_delivered",
        "couriers": "couriers_available",
        "latency": "latency_avg_ms",
    }
    points = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(c).cast("double").alias("v")) for m, c in metrics.items()])
    return (
        buckets.where(F.col("age") < SERIES_BUCKETS)
        .select((F.col("bucket") * 1000).alias("ts"), F.explode(points).alias("_p"))
        .select("_p.metric", "ts", "_p.v")
        .orderBy("metric", "ts")
    )


def delivered_cumulative(buckets: DataFrame) -> DataFrame:
    """Deliveries since the start of the ring; ``buckets`` is a ring and so has a few hundred rows."""
    upto = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return buckets.select((F.col("bucket") * 1000).alias("ts"), F.sum("new_delivered").over(upto).alias("v"))
