"""Declared schemas and the fixed vocabularies of the order domain."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: status vocabulary and transitions ---
PENDING = "PENDING"
PREPARING = "PREPARING"
READY = "READY_FOR_PICKUP"
DELIVERED = "DELIVERED"
CANCELLED = "CANCELLED"
UNKNOWN = "UNKNOWN"
STATUS_FLOW = ["CONFIRMED", "PREPARING", "READY_FOR_PICKUP", "PICKED_UP", "IN_TRANSIT", "DELIVERED"]
DELIVERING_STATUSES = ["PICKED_UP", "IN_TRANSIT", "DELIVERING"]
USER_TYPES = ["client", "courier", "admin"]
# Events of the second publisher and the type each one is normalised to.
V2_TYPES = {
    "ORDER_CREATED": "ORDER_CREATED",
    "ORDER_STATUS_CHANGED": "STATUS_CHANGE",
    "ORDER_COURIER_ASSIGNED": "COURIER_ASSIGNED",
}
TRUE_WORDS = ["true", "1", "yes"]
FALSE_WORDS = ["false", "0", "no"]
GEOFENCE_LIMIT_DEG2 = 0.05
EVENT_FORMATS = [
    "flat_order_event_v2",
    "flat_order_event",
    "status_update",
    "nested_order",
    "courier_availability",
    "courier_location",
]
# --- end of fixed values ---

#: Allowed follow-up of each status: the flow is a chain.
NEXT_STATUS = dict(zip(STATUS_FLOW, STATUS_FLOW[1:]))

_S, _L, _D, _B, _TS = (T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType(), T.TimestampType())


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


EVENT = _struct(
    event_type=_S, order_id=_L, status=_S, courier_id=_L, courier_available=_B, format_name=_S, event_ts=_TS
)
LAKE_COLUMNS = _struct(
    event_id=T.IntegerType(),
    order_id=T.IntegerType(),
    event_type=_S,
    from_status=_S,
    to_status=_S,
    event_status=_S,
    event_message=_S,
    latitude=_D,
    longitude=_D,
    created_at=_S,
)
LAKE_PARTITIONS = _struct(year=_S, month=_S, day=_S, hour=_S)
LAKE = T.StructType(LAKE_COLUMNS.fields + LAKE_PARTITIONS.fields)

USERS = _struct(user_id=_L, user_name=_S, email=_S, phone=_S, latitude=_D, longitude=_D, user_type=_S)
COURIERS = _struct(user_id=_L, vehicle_type=_S, is_available=_B)
RESTAURANTS = _struct(
    restaurant_id=_L,
    restaurant_name=_S,
    cuisine_type=_S,
    restaurant_latitude=_D,
    restaurant_longitude=_D,
    creator_user_id=_L,
)
ORDERS = _struct(order_id=_L, client_id=_L, restaurant_id=_L, courier_id=_L, order_status=_S, created_at=_TS)
ORDER_EVENTS = _struct(
    event_id=_L,
    order_id=_L,
    event_type=_S,
    from_status=_S,
    to_status=_S,
    event_message=_S,
    latitude=_D,
    longitude=_D,
    created_at=_TS,
)
ORDER_ITEMS = _struct(item_id=_L, order_id=_L, item_name=_S, quantity=_L)
TABLES = {
    "users": USERS,
    "couriers": COURIERS,
    "restaurants": RESTAURANTS,
    "orders": ORDERS,
    "order_events": ORDER_EVENTS,
    "order_items": ORDER_ITEMS,
}

LATENCY_FIELDS = [
    "event_to_consumer_latency_ms_last",
    "event_to_consumer_latency_ms_avg_1m",
    "consumer_to_dashboard_emit_latency_ms",
    "event_to_dashboard_emit_latency_ms",
]
LATENCY_SAMPLE = T.StructType(
    [
        T.StructField("recorded_at", _D),
        T.StructField("pipeline", _S),
        T.StructField("last_event_produced_at_ms", _L),
        T.StructField("last_event_processed_at_ms", _L),
        *[T.StructField(name, _D) for name in LATENCY_FIELDS],
        T.StructField("orders_processed_per_minute", _L),
        T.StructField("total_orders_processed", _L),
    ]
)
COURIER_POSITION = T.StructType(
    [
        T.StructField("courier_id", _S),
        T.StructField("timestamp", _S),
        T.StructField("latitude", T.DecimalType(10, 7)),
        T.StructField("longitude", T.DecimalType(10, 7)),
        T.StructField("order_id", _S),
    ]
)
SNAPSHOT_ENVELOPE = _struct(name=_S, source=_S, stored_at=_TS, payload=_S)
