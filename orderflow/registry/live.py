"""Registered queries over order and courier state, windows and rollups; inputs pass through the normaliser."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from orderflow.operators import normalize as N, rollup as R, state as S
from orderflow.registry import views as V
from orderflow.registry.history import normalized
from orderflow.session import materialize

#: The given events are minutes apart, so the rollup uses buckets of an hour in place of a second.
BUCKET = 3600


def stored(spark: SparkSession, folder: str) -> DataFrame:
    """Normalised events parsed once, for queries that read them more than once."""
    return materialize(normalized(spark, folder), "events")


def _ring(spark: SparkSession, folder: str) -> DataFrame:
    events = stored(spark, folder)
    return R.ring(R.bucket_changes(events, BUCKET), R.newest_bucket(events, BUCKET), BUCKET)


def orders_waiting_courier(spark: SparkSession, folder: str) -> DataFrame:
    """An order is what a user did on one day, so that many orders are still waiting."""
    events = normalized(spark, folder)
    return S.orders_waiting_courier(events.withColumn("order_id", F.col("order_id") * 1000 + F.dayofyear("arrival_ts")))


QUERIES = {
    "realtime_snapshot": lambda s, d: S.realtime_snapshot(stored(s, d)).withColumn("event_formats", F.to_json("event_formats")),
    "status_funnel": lambda s, d: S.status_funnel(S.realtime_snapshot(stored(s, d))),
    "courier_state": lambda s, d: S.courier_state(stored(s, d)),
    "courier_availability_counts": lambda s, d: S.courier_counts(stored(s, d)),
    "orders_waiting_courier": orders_waiting_courier,
    "transition_audit": lambda s, d: S.transition_audit(S.status_steps(stored(s, d))),
    "status_validity": lambda s, d: N.status_validity(normalized(s, d)),
    "dedupe_unchanged_status": lambda s, d: S.without_repeats(S.status_steps(stored(s, d))).drop("arrival_ts"),
    "next_status": lambda s, d: S.next_status(S.latest_orders(normalized(s, d))),
    "window_summary_60s": lambda s, d: R.window_summary(normalized(s, d)),
    "window_by_status_60s": lambda s, d: R.window_by_status(normalized(s, d)),
    "sliding_event_rate": lambda s, d: R.sliding_rate(normalized(s, d)),
    "sliding_event_rate_1h": lambda s, d: R.sliding_rate(normalized(s, d), 3600),
    "rollup_deltas": lambda s, d: R.rollup_deltas(R.bucket_changes(stored(s, d), BUCKET)),
    "rollup_kpis": lambda s, d: R.rollup_kpis(_ring(s, d), BUCKET),
    "rollup_series": lambda s, d: R.rollup_series(_ring(s, d)),
    "delivered_cumulative": lambda s, d: R.delivered_cumulative(_ring(s, d)),
}

_CH = """ch AS (SELECT * FROM (
  SELECT order_id, arrival_ts, seq, event_type = 'ORDER_CREATED' AS created, event_type = 'COURIER_ASSIGNED' AS assigned,
    CASE WHEN event_type IN ('ORDER_CREATED', 'STATUS_CHANGE', 'ORDER_EVENT') THEN status END AS new_status,
    CASE WHEN event_type = 'COURIER_ASSIGNED' THEN courier_id END AS holder FROM nm WHERE order_id IS NOT NULL)
  WHERE new_status IS NOT NULL OR assigned)"""
_LO = """lo AS (SELECT o.order_id, s.new_status AS status, has_courier
  FROM (SELECT order_id, bool_or(assigned) AS has_courier FROM ch GROUP BY order_id) o LEFT JOIN (
    SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY arrival_ts DESC, seq DESC) AS rn FROM ch WHERE new_status IS NOT NULL) s
  ON s.order_id = o.order_id AND rn = 1)"""
_SG = """sg AS (
  SELECT courier_id, courier_available AS available, arrival_ts, seq FROM nm
    WHERE event_type = 'COURIER_AVAILABILITY' AND courier_id IS NOT NULL AND courier_available IS NOT NULL
  UNION ALL SELECT courier_id, false, arrival_ts, seq FROM nm
    WHERE event_type IN ('COURIER_LOCATION', 'COURIER_ASSIGNED') AND courier_id IS NOT NULL AND order_id IS NOT NULL
  UNION ALL SELECT h, true, arrival_ts, seq FROM (
    SELECT *, last_value(holder IGNORE NULLS) OVER (PARTITION BY order_id ORDER BY arrival_ts, seq ROWS UNBOUNDED PRECEDING) AS h FROM ch)
    WHERE new_status = 'DELIVERED' AND NOT created AND h IS NOT NULL)"""
_CS = """cs AS (SELECT courier_id, available FROM (
  SELECT *, row_number() OVER (PARTITION BY courier_id ORDER BY arrival_ts DESC, seq DESC) AS rn FROM sg) WHERE rn = 1)"""
_CAT = """CASE WHEN status = 'PREPARING' THEN 'preparing' WHEN status = 'READY_FOR_PICKUP' AND NOT has_courier THEN 'waiting_courier'
  WHEN status IN ('PICKED_UP', 'IN_TRANSIT', 'DELIVERING') THEN 'delivering' WHEN status = 'DELIVERED' THEN 'delivered'
  WHEN status = 'CANCELLED' THEN 'cancelled' END"""
_LAT = """lat AS (SELECT *, greatest(0, (epoch_us(arrival_ts) - epoch_us(coalesce(event_ts, arrival_ts))) / 1000.0::DOUBLE) AS latency_ms FROM nm)"""
_STEPS = """steps AS (SELECT order_id, seq, new_status,
  lag(new_status) OVER (PARTITION BY order_id ORDER BY arrival_ts, seq) AS old_status FROM ch WHERE new_status IS NOT NULL)"""
_FLOW = "CASE {s} WHEN 'CONFIRMED' THEN 'PREPARING' WHEN 'PREPARING' THEN 'READY_FOR_PICKUP' WHEN 'READY_FOR_PICKUP' THEN 'PICKED_UP' WHEN 'PICKED_UP' THEN 'IN_TRANSIT' WHEN 'IN_TRANSIT' THEN 'DELIVERED' END"
_BASE = (V.EV, V.NM)
_STATE = (V.EV, V.NM, _CH, _LO, _SG, _CS, _LAT)

_SNAP = f"""snap AS (SELECT
  (SELECT count(*) FROM lo WHERE {_CAT} = 'preparing') AS orders_preparing,
  (SELECT count(*) FROM lo WHERE {_CAT} = 'waiting_courier') AS orders_waiting_courier,
  (SELECT count(*) FROM lo WHERE {_CAT} = 'delivering') AS orders_delivering,
  (SELECT count(*) FROM lo WHERE {_CAT} = 'delivered') AS orders_delivered,
  (SELECT count(*) FROM lo WHERE {_CAT} = 'cancelled') AS orders_cancelled,
  (SELECT count(*) FROM lo WHERE {_CAT} IN ('preparing', 'waiting_courier', 'delivering')) AS active_orders,
  (SELECT count(*) FROM lo) AS total_orders_processed, (SELECT count(status) FROM lo) AS tracked_orders,
  (SELECT count(*) FROM cs WHERE available) AS couriers_available, (SELECT count(*) FROM cs WHERE NOT available) AS active_couriers,
  (SELECT count(*) FROM cs) AS tracked_couriers,
  (SELECT count(*) FROM nm WHERE event_type = 'UNKNOWN') AS unknown_events,
  (SELECT '{{' || string_agg('"' || f || '":' || n, ',' ORDER BY list_position(['flat_order_event_v2', 'flat_order_event', 'status_update',
       'nested_order', 'courier_availability', 'courier_location', 'unknown'], f)) || '}}'
     FROM (SELECT split_part(format_name, ':', 1) AS f, count(*) AS n FROM nm GROUP BY ALL)) AS event_formats,
  (SELECT count(*) FROM nm WHERE arrival_ts >= (SELECT max(arrival_ts) FROM nm) - INTERVAL 60 SECONDS) AS orders_processed_per_minute,
  (SELECT count(*) FROM nm WHERE event_type = 'ORDER_CREATED' AND order_id IS NOT NULL
     AND arrival_ts >= (SELECT max(arrival_ts) FROM nm) - INTERVAL 60 SECONDS) AS orders_created_per_minute,
  (SELECT {V.rnd(V.avg('latency_ms'), 2)} FROM lat WHERE arrival_ts >= (SELECT max(arrival_ts) FROM nm) - INTERVAL 60 SECONDS) AS latency_avg_1m_ms,
  (SELECT {V.rnd('latency_ms', 2)} FROM lat ORDER BY arrival_ts DESC, seq DESC LIMIT 1) AS latency_last_ms,
  (SELECT epoch_us(coalesce(event_ts, arrival_ts)) // 1000 FROM lat ORDER BY arrival_ts DESC, seq DESC LIMIT 1) AS last_event_produced_at_ms,
  (SELECT epoch_us(max(arrival_ts)) // 1000 FROM nm) AS last_event_processed_at_ms)"""


def _b(t: str) -> str:
    return f"(epoch_us({t}) // {BUCKET * 1_000_000} * {BUCKET})"


# State intervals of orders and couriers; a bucket's level is the number of intervals that cover its end.
_IV = f"""oi AS (SELECT {_CAT} AS cat, b, nb, rn FROM (
    SELECT {_b('arrival_ts')} AS b, lead({_b('arrival_ts')}) OVER o AS nb, row_number() OVER o AS rn,
      last_value(new_status IGNORE NULLS) OVER w AS status, max(CAST(assigned AS INT)) OVER w = 1 AS has_courier FROM ch
    WINDOW o AS (PARTITION BY order_id ORDER BY arrival_ts, seq),
      w AS (PARTITION BY order_id ORDER BY arrival_ts, seq ROWS UNBOUNDED PRECEDING))),
ci AS (SELECT available, {_b('arrival_ts')} AS b, lead({_b('arrival_ts')}) OVER (PARTITION BY courier_id ORDER BY arrival_ts, seq) AS nb FROM sg),
lb AS (SELECT *, {_b('arrival_ts')} AS b FROM lat)"""
_LEVELS = """lv AS (SELECT bucket, count(*) FILTER (cat = 'preparing') AS orders_preparing, count(*) FILTER (cat = 'waiting_courier') AS orders_waiting_courier,
    count(*) FILTER (cat = 'delivering') AS orders_delivering, count(*) FILTER (cat = 'delivered') AS orders_delivered, count(rn) AS total_processed
  FROM spine LEFT JOIN oi ON b <= bucket AND (nb IS NULL OR nb > bucket) GROUP BY bucket)"""
_RING = f"""spine AS (SELECT (SELECT max(b) FROM lb) - i * {BUCKET} AS bucket, i AS age FROM range(301) t(i)),
{_LEVELS},
cl AS (SELECT bucket, count(*) FILTER (available) AS couriers_available FROM spine LEFT JOIN ci ON b <= bucket AND (nb IS NULL OR nb > bucket) GROUP BY bucket),
mv AS (SELECT bucket, count(*) FILTER (event_type = 'ORDER_CREATED' AND order_id IS NOT NULL) AS created_per_min,
    coalesce({V.rnd(V.avg('latency_ms'), 2)}, 0) AS latency_avg_ms
  FROM spine LEFT JOIN lb ON b <= bucket AND b > bucket - {60 * BUCKET} GROUP BY bucket),
la AS (SELECT bucket, latency_ms AS latency_last_ms FROM (
    SELECT bucket, latency_ms, row_number() OVER (PARTITION BY bucket ORDER BY arrival_ts DESC, seq DESC) AS rn
    FROM spine JOIN lb ON b <= bucket) WHERE rn = 1),
ring AS (SELECT * FROM (SELECT *,
    greatest(total_processed - lag(total_processed) OVER (ORDER BY bucket), 0) AS new_orders,
    greatest(orders_delivered - lag(orders_delivered) OVER (ORDER BY bucket), 0) AS new_delivered
  FROM spine JOIN lv USING (bucket) JOIN cl USING (bucket) JOIN mv USING (bucket) LEFT JOIN la USING (bucket)) WHERE age < 300)"""
_RINGED = V.with_(*_STATE, _IV, _RING)

ORACLE = {
    "realtime_snapshot": V.with_(*_STATE, _SNAP) + "SELECT * FROM snap",
    "status_funnel": V.with_(*_STATE, _SNAP)
    + f"""SELECT stage, orders, {V.rnd('orders * 100.0::DOUBLE / (SELECT greatest(total_orders_processed, 1) FROM snap)', 1)} AS pct FROM (
        SELECT 'total' AS stage, greatest(total_orders_processed, 1) AS orders FROM snap
        UNION ALL SELECT 'preparing', orders_preparing FROM snap UNION ALL SELECT 'waiting_courier', orders_waiting_courier FROM snap
        UNION ALL SELECT 'delivering', orders_delivering FROM snap UNION ALL SELECT 'delivered', orders_delivered FROM snap)""",
    "courier_state": V.with_(*_STATE) + "SELECT * FROM cs",
    "courier_availability_counts": V.with_(*_STATE)
    + """SELECT count(*) FILTER (available) AS couriers_available, count(*) FILTER (NOT available) AS active_couriers,
        count(*) AS tracked_couriers FROM cs""",
    "orders_waiting_courier": V.with_(
        *_BASE, "nd AS (SELECT * REPLACE (order_id * 1000 + dayofyear(arrival_ts) AS order_id) FROM nm)", _CH.replace("FROM nm", "FROM nd"), _LO
    )
    + """SELECT order_id FROM lo WHERE status = 'READY_FOR_PICKUP' AND NOT EXISTS (
        SELECT 1 FROM ch WHERE ch.order_id = lo.order_id AND assigned)""",
    "transition_audit": V.with_(*_BASE, _CH, _STEPS)
    + f"""SELECT old_status, new_status, count(*) AS total, coalesce({_FLOW.format(s='old_status')} = new_status, false) AS allowed
        FROM steps WHERE old_status <> new_status GROUP BY ALL""",
    "status_validity": V.with_(*_BASE)
    + """SELECT status, count(*) AS total, status IN ('CONFIRMED', 'PREPARING', 'READY_FOR_PICKUP', 'PICKED_UP', 'IN_TRANSIT', 'DELIVERED') AS valid
        FROM nm WHERE status IS NOT NULL GROUP BY status""",
    "dedupe_unchanged_status": V.with_(*_BASE, _CH, _STEPS)
    + "SELECT order_id, seq, old_status, new_status FROM steps WHERE old_status IS DISTINCT FROM new_status",
    "next_status": V.with_(*_STATE) + f"SELECT order_id, status, {_FLOW.format(s='status')} AS next_status FROM lo",
    "window_summary_60s": V.with_(*_BASE, _LAT)
    + f""", w AS (SELECT *, unnest(range(ceil(epoch_us(arrival_ts) / 60000000.0)::BIGINT,
            epoch_us(arrival_ts) // 60000000 + 2)) * 60 AS window_end FROM lat)
        SELECT window_end, event_type, count(*) AS type_events, CAST(sum(count(*)) OVER (PARTITION BY window_end) AS BIGINT) AS window_events,
          {V.rnd('CAST(sum(sum(CAST(latency_ms AS DECIMAL(18,3)))) OVER (PARTITION BY window_end) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY window_end)', 2)} AS latency_avg_ms
        FROM w GROUP BY window_end, event_type""",
    "window_by_status_60s": V.with_(*_BASE)
    + """, w AS (SELECT *, unnest(range(ceil(epoch_us(arrival_ts) / 60000000.0)::BIGINT,
            epoch_us(arrival_ts) // 60000000 + 2)) * 60 AS window_end FROM nm)
        SELECT window_end, status, count(*) AS total FROM w WHERE status IS NOT NULL GROUP BY ALL""",
    **{
        name: V.with_(*_BASE, _LAT)
        + f"""SELECT DISTINCT epoch_us(arrival_ts) AS at_us, count(*) OVER w AS events,
          count(*) FILTER (event_type = 'ORDER_CREATED' AND order_id IS NOT NULL) OVER w AS created,
          CAST(sum(CAST(latency_ms AS DECIMAL(18,3))) OVER w AS DOUBLE) / count(*) OVER w AS latency_avg_ms
        FROM lat WINDOW w AS (ORDER BY arrival_ts RANGE BETWEEN INTERVAL {seconds} SECONDS PRECEDING AND CURRENT ROW)"""
        for name, seconds in (("sliding_event_rate", 60), ("sliding_event_rate_1h", 3600))
    },
    "rollup_deltas": V.with_(*_STATE, _IV, "spine AS (SELECT DISTINCT b AS bucket FROM lb)", _LEVELS)
    + """SELECT bucket, total_processed, orders_delivered,
          greatest(total_processed - lag(total_processed, 1, 0) OVER o, 0) AS new_orders,
          greatest(orders_delivered - lag(orders_delivered, 1, 0) OVER o, 0) AS new_delivered FROM lv WINDOW o AS (ORDER BY bucket)""",
    "rollup_kpis": _RINGED
    + f"""SELECT CAST(sum(new_orders) FILTER (age <= 60) AS BIGINT) AS new_orders_last_60s,
          CAST(sum(new_delivered) FILTER (age <= 60) AS BIGINT) AS new_delivered_last_60s,
          {V.rnd(f"sum(new_orders) FILTER (age <= 60) / {60.0 * BUCKET}::DOUBLE", 2)} AS throughput_per_s,
          {", ".join(f"max({c}) FILTER (age = 0) AS {c}" for c in ("orders_preparing", "orders_waiting_courier", "orders_delivering",
             "orders_delivered", "couriers_available", "total_processed", "created_per_min", "latency_avg_ms", "latency_last_ms"))} FROM ring""",
    "rollup_series": _RINGED
    + " UNION ALL ".join(
        f"SELECT '{m}' AS metric, bucket * 1000 AS ts, CAST({c} AS DOUBLE) AS v FROM ring WHERE age < 60"
        for m, c in (("throughput", "new_orders"), ("created", "created_per_min"), ("preparing", "orders_preparing"),
            ("delivering", "orders_delivering"), ("delivered", "orders_delivered"), ("couriers", "couriers_available"), ("latency", "latency_avg_ms"))
    ),
    "delivered_cumulative": _RINGED
    + "SELECT bucket * 1000 AS ts, CAST(sum(new_delivered) OVER (ORDER BY bucket) AS BIGINT) AS v FROM ring",
}
