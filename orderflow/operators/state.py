"""State of orders and couriers folded from normalised events.

Events need ``event_type, order_id, status, courier_id, courier_available, event_ts, arrival_ts, seq``.
The last arrival wins: rows are ordered by ``(arrival_ts, seq)``; pass another time column as ``time`` to
order by event time instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from orderflow.functions import scalars as X
from orderflow.operators import ordered
from orderflow.schemas import CANCELLED, DELIVERED, DELIVERING_STATUSES, EVENT_FORMATS, NEXT_STATUS, PENDING, PREPARING, READY

STATUS_EVENTS = ["STATUS_CHANGE", "ORDER_EVENT"]
BUCKETS = ["preparing", "waiting_courier", "delivering", "delivered", "cancelled"]


def position(time: str = "arrival_ts") -> Column:
    return F.struct(time, "seq")


def order_changes(events: DataFrame, time: str = "arrival_ts") -> DataFrame:
    """Events that touch an order: a new status, or a courier assignment."""
    kind = F.col("event_type")
    status = F.when(kind == "ORDER_CREATED", F.coalesce("status", F.lit(PENDING))).when(
        kind.isin(STATUS_EVENTS), F.col("status")
    )
    return events.select(
        "order_id",
        F.col(time),
        "seq",
        status.alias("new_status"),
        (kind == "ORDER_CREATED").alias("created"),
        (kind == "COURIER_ASSIGNED").alias("assigned"),
        F.when(kind == "COURIER_ASSIGNED", F.col("courier_id")).alias("courier_id"),
    ).where(F.col("order_id").isNotNull() & (F.col("new_status").isNotNull() | F.col("assigned")))


def latest_orders(events: DataFrame, time: str = "arrival_ts") -> DataFrame:
    """Per order: last status (null if only ever assigned) and whether a courier was assigned.

    One aggregation with map-side partials, so a hot order costs nothing extra.
    """
    changes = order_changes(events, time)
    at = F.when(F.col("new_status").isNotNull(), position(time))
    return changes.groupBy("order_id").agg(
        F.max_by("new_status", at).alias("status"), F.max("assigned").alias("has_courier")
    )


def bucket(status: Column, has_courier: Column) -> Column:
    """The live-count bucket of an order, null where it is in none."""
    return (
        F.when(status == PREPARING, F.lit("preparing"))
        .when((status == READY) & ~has_courier, F.lit("waiting_courier"))
        .when(status.isin(DELIVERING_STATUSES), F.lit("delivering"))
        .when(status == DELIVERED, F.lit("delivered"))
        .when(status == CANCELLED, F.lit("cancelled"))
    )


def orders_waiting_courier(events: DataFrame) -> DataFrame:
    """Orders ready for pickup to which no courier was ever assigned."""
    orders = latest_orders(events)
    return orders.where((F.col("status") == READY) & ~F.col("has_courier")).select("order_id")


def direct_signals(events: DataFrame, time: str = "arrival_ts") -> DataFrame:
    """What events say of a courier themselves: availability, and being busy once seen with an order."""
    kind, courier = F.col("event_type"), F.col("courier_id")
    return events.select(
        courier,
        F.when(kind == "COURIER_AVAILABILITY", F.col("courier_available"))
        .when((kind == "COURIER_LOCATION") & F.col("order_id").isNotNull(), F.lit(False))
        .when((kind == "COURIER_ASSIGNED") & F.col("order_id").isNotNull(), F.lit(False))
        .alias("available"),
        time,
        "seq",
    ).where(courier.isNotNull() & F.col("available").isNotNull())


def courier_signals(events: DataFrame, time: str = "arrival_ts") -> DataFrame:
    """Everything that sets a courier's availability, as (courier_id, available, time, seq).

    A delivery frees the courier last assigned to the order before it; it says nothing while none was.
    """
    delivered = (F.col("new_status") == DELIVERED) & ~F.col("created")
    steps = order_changes(events, time).where(delivered | F.col("courier_id").isNotNull())
    steps = ordered.mark(steps, ordered.time_slice(F.col(time)))
    known = ordered.carry(steps, ["order_id"], [time, "seq"], last_known={"holder": F.col("courier_id")})
    freed = known.where(delivered & F.col("holder").isNotNull()).select(
        F.col("holder").alias("courier_id"), F.lit(True).alias("available"), time, "seq"
    )
    return direct_signals(events, time).unionByName(freed)


def courier_state(events: DataFrame, time: str = "arrival_ts") -> DataFrame:
    return (
        courier_signals(events, time)
        .groupBy("courier_id")
        .agg(F.max_by("available", position(time)).alias("available"))
    )


def courier_counts(events: DataFrame) -> DataFrame:
    free = F.col("available")
    return courier_state(events).agg(
        F.count_if(free).alias("couriers_available"),
        F.count_if(~free).alias("active_couriers"),
        F.count(F.lit(1)).alias("tracked_couriers"),
    )


def realtime_snapshot(events: DataFrame, as_of: Column | None = None, window_seconds: int = 60) -> DataFrame:
    """All live numbers as of the last arrival (or ``as_of``) in one row.

    ``event_formats`` counts the detected formats; names of unknown ones come from the payloads and have no bound, so they are
    one entry here and one row each in ``normalize.format_counts``. Events without a format column give an empty map.
    """
    now = as_of if as_of is not None else events.agg(F.max("arrival_ts").alias("now")).scalar()
    state, status = F.col("bucket"), F.col("status")
    zero = F.lit(0).cast("long")

    orders = latest_orders(events).withColumn("bucket", bucket(status, F.col("has_courier")))
    order_part = orders.agg(
        *[F.count_if(state == name).alias(f"orders_{name}") for name in BUCKETS],
        F.count_if(state.isin("preparing", "waiting_courier", "delivering")).alias("active_orders"),
        F.count(F.lit(1)).alias("total_orders_processed"),
        F.count(status).alias("tracked_orders"),
    )

    late = F.unix_micros(now) - window_seconds * 1_000_000
    recent = F.unix_micros("arrival_ts") >= late
    latency = X.latency_ms(F.col("event_ts"), F.col("arrival_ts"))
    known_ts = F.coalesce("event_ts", "arrival_ts")
    created = (F.col("event_type") == "ORDER_CREATED") & F.col("order_id").isNotNull()
    formats = {f: F.col("format_name") == f for f in EVENT_FORMATS} | {"unknown": F.col("format_name").startswith("unknown")}
    if "format_name" not in events.columns:
        formats = dict.fromkeys(formats, F.lit(False))
    event_part = events.agg(
        *[F.count_if(rows).alias(f"_{f}") for f, rows in formats.items()],
        F.count_if(recent & created).alias("orders_created_per_minute"),
        F.count_if(recent).alias("orders_processed_per_minute"),
        F.round(X.exact_avg(F.when(recent, latency)), 2).alias("latency_avg_1m_ms"),
        F.round(F.max_by(latency, position()), 2).alias("latency_last_ms"),
        F.unix_millis(F.max_by(known_ts, position())).alias("last_event_produced_at_ms"),
        F.unix_millis(F.max("arrival_ts")).alias("last_event_processed_at_ms"),
        F.count_if(F.col("event_type") == "UNKNOWN").alias("unknown_events"),
    )

    parts = order_part.unionByName(event_part, allowMissingColumns=True).unionByName(
        courier_counts(events), allowMissingColumns=True
    )
    counts = [c for c in parts.columns if not c.startswith(("latency", "last_event"))]
    # every part is a single row
    row = parts.agg(
        *[F.coalesce(F.max(c), zero).alias(c) for c in counts],
        *[F.max(c).alias(c) for c in parts.columns if c not in counts],
    )
    # without recent events there is no average to show
    shown = F.when(F.col("orders_processed_per_minute") > 0, F.col("latency_avg_1m_ms"))
    pairs = [x for f in formats for x in (F.lit(f), F.col(f"_{f}"))]
    seen = F.map_filter(F.create_map(*pairs), lambda _, n: n > 0)
    return row.withColumns({"latency_avg_1m_ms": shown, "event_formats": seen}).drop(*[f"_{f}" for f in formats])


def status_funnel(snapshot: DataFrame) -> DataFrame:
    """Stages of the live snapshot with their share of all orders seen."""
    total = F.greatest(F.col("total_orders_processed"), F.lit(1))
    stages = {
        "total": total,
        **{name: F.col(f"orders_{name}") for name in BUCKETS if name != "cancelled"},
    }
    rows = F.array(*[F.struct(F.lit(n).alias("stage"), v.cast("long").alias("orders")) for n, v in stages.items()])
    opened = snapshot.select(total.alias("_total"), F.explode(rows).alias("_s"))
    return opened.select(
        "_s.stage", "_s.orders", F.round(F.col("_s.orders") * F.lit(100.0) / F.col("_total"), 1).alias("pct")
    )


def status_steps(events: DataFrame, time: str = "arrival_ts") -> DataFrame:
    """Status events with the order's status before them."""
    steps = order_changes(events, time).where(F.col("new_status").isNotNull())
    steps = ordered.mark(steps, ordered.time_slice(F.col(time)))
    return ordered.carry(steps, ["order_id"], [time, "seq"], previous={"old_status": F.col("new_status")}).select(
        "order_id", time, "seq", "old_status", "new_status"
    )


def is_allowed(old: Column, new: Column) -> Column:
    """Whether the flow lets an order go from ``old`` to ``new``."""
    return F.coalesce(X.lookup(NEXT_STATUS, X.normalize_status(old)) == X.normalize_status(new), F.lit(False))


def transition_audit(steps: DataFrame) -> DataFrame:
    """How often each status change happened and whether the flow allows it."""
    old, new = F.col("old_status"), F.col("new_status")
    return (
        steps.where(old.isNotNull() & (old != new))
        .groupBy("old_status", "new_status")
        .agg(F.count(F.lit(1)).alias("total"))
        .select("*", is_allowed(old, new).alias("allowed"))
    )


def without_repeats(steps: DataFrame) -> DataFrame:
    """Drop steps that leave the status as it was."""
    return steps.where(~F.col("new_status").eqNullSafe(F.col("old_status")))


def next_status(orders: DataFrame) -> DataFrame:
    return orders.select(
        "order_id", "status", X.lookup(NEXT_STATUS, X.normalize_status(F.col("status"))).alias("next_status")
    )
