"""Registered queries over the relational read model and the append-only stores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from orderflow import fixtures as X
from orderflow.functions import scalars
from orderflow.operators import relational as R
from orderflow.registry import views as V
from orderflow.session import scratch_path
from orderflow.sources import stores

TTL = 86_400


def lake_rows(spark: SparkSession, folder: str) -> DataFrame:
    return X.order_events(X.events(spark, folder))


def tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {
        "users": X.users(spark, folder),
        "couriers": X.couriers(spark, folder),
        "restaurants": X.restaurants(spark, folder),
        "orders": X.orders(spark, folder),
        "order_events": lake_rows(spark, folder),
        "order_items": X.order_items(spark, folder),
    }


def order_detail(spark: SparkSession, folder: str) -> DataFrame:
    t = tables(spark, folder)
    return R.order_detail(t["orders"], t["order_items"], t["order_events"])


def insert_if_absent(spark: SparkSession, folder: str) -> DataFrame:
    """Every customer seen in an event becomes a courier unless there is one already."""
    seed = X.events(spark, folder).select(
        F.col("order_id").alias("user_id"), F.concat(F.lit("bike "), "k").alias("vehicle_type"), F.lit(True).alias("is_available"), "event_id"
    )
    return R.insert_if_absent(X.couriers(spark, folder), seed, "user_id", "event_id")


def upsert_couriers(spark: SparkSession, folder: str) -> DataFrame:
    changes = X.events(spark, folder).select(
        F.col("order_id").alias("user_id"), F.col("kind").alias("vehicle_type"), (F.col("k") < 50).alias("is_available"), "event_id"
    )
    return R.upsert(X.couriers(spark, folder), changes, "user_id", "event_id")


def assignment_conflicts(spark: SparkSession, folder: str) -> DataFrame:
    requests = X.events(spark, folder).select(
        (F.col("event_id") * 7 % 20_000).alias("order_id"), F.col("order_id").alias("courier_id"), F.col("event_id").alias("seq")
    )
    return R.assignment_conflicts(requests, X.orders(spark, folder), X.couriers(spark, folder))


def _positions(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "positions")
    log = X.events(spark, folder).select(
        F.col("k").alias("courier_id"),
        scalars.iso(F.col("ts")).alias("timestamp"),
        (-23.7 + F.col("k") / 1000).alias("latitude"),
        (-46.8 + F.col("order_id") / 1000).alias("longitude"),
        F.when(F.col("kind") == "purchase", F.col("order_id")).alias("order_id"),
    )
    stores.append_positions(log, path)
    return stores.read_positions(spark, path)


def courier_location_log(spark: SparkSession, folder: str) -> DataFrame:
    log = _positions(spark, folder)
    return log.withColumns({c: F.col(c).cast("double") for c in ("latitude", "longitude")})


def latest_courier_location(spark: SparkSession, folder: str) -> DataFrame:
    newest = R.latest_location(_positions(spark, folder))
    return newest.withColumns({c: F.col(c).cast("double") for c in ("latitude", "longitude")})


def latest_live_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """One named snapshot per order, written on every event."""
    path = scratch_path(spark, "snapshots")
    shown = X.events(spark, folder).select(
        F.concat(F.lit("order-"), "order_id").alias("name"),
        F.col("ts").alias("stored_at"),
        F.to_json(F.struct("status", "k")).alias("payload"),
    )
    stores.write_snapshots(shown, path)
    found = stores.read_snapshots(spark, path, ttl_seconds=TTL)
    return found.select("name", "source", F.unix_micros("stored_at").alias("stored_us"), "payload")



QUERIES = {
    "restaurant_list": lambda s, d: R.restaurant_list(X.restaurants(s, d)),
    "courier_directory": lambda s, d: R.courier_directory(X.couriers(s, d), X.users(s, d)),
    "available_couriers": lambda s, d: R.available_couriers(X.couriers(s, d), X.users(s, d)),
    "dispatch_data": lambda s, d: R.dispatch_data(X.orders(s, d), X.users(s, d), X.restaurants(s, d)),
    "order_detail": order_detail,
    "insert_if_absent": insert_if_absent,
    "upsert_couriers": upsert_couriers,
    "fk_orphans": lambda s, d: R.fk_orphans(tables(s, d)),
    "constraint_report": lambda s, d: R.constraint_report(tables(s, d)),
    "assignment_conflicts": assignment_conflicts,
    "courier_location_log": courier_location_log,
    "latest_courier_location": latest_courier_location,
    "latest_live_snapshot": latest_live_snapshot,
}

_ALL = V.with_(V.EV, V.OE, V.USERS, V.COURIERS, V.RESTAURANTS, V.ORD, V.ITEMS)
_POS = f"""pos AS (SELECT CAST(k AS VARCHAR) AS courier_id, {V.ISO.format(t='ts')} AS timestamp,
    CAST(CAST(-23.7::DOUBLE + k / 1000 AS DECIMAL(10,7)) AS DOUBLE) AS latitude,
    CAST(CAST(-46.8::DOUBLE + order_id / 1000 AS DECIMAL(10,7)) AS DOUBLE) AS longitude,
    CASE WHEN kind = 'purchase' THEN CAST(order_id AS VARCHAR) ELSE 'none' END AS order_id, event_id FROM ev)"""
_FKS = [
    ("couriers", "user_id", "users", "user_id"),
    ("restaurants", "creator_user_id", "users", "user_id"),
    ("ord", "client_id", "users", "user_id"),
    ("ord", "restaurant_id", "restaurants", "restaurant_id"),
    ("ord", "courier_id", "couriers", "user_id"),
    ("oe", "order_id", "ord", "order_id"),
    ("items", "order_id", "ord", "order_id"),
]
_NAME = {"ord": "orders", "oe": "order_events", "items": "order_items"}
_NOT_NULL = {
    "users": ["user_name", "user_type"],
    "restaurants": ["restaurant_name"],
    "ord": ["client_id", "restaurant_id", "order_status"],
    "oe": ["order_id", "event_type"],
    "items": ["order_id", "item_name", "quantity"],
}

ORACLE = {
    "restaurant_list": _ALL + "SELECT * EXCLUDE (creator_user_id) FROM restaurants",
    "courier_directory": _ALL
    + """SELECT user_id AS courier_id, user_name AS name, vehicle_type, is_available, latitude AS lat, longitude AS lon
        FROM couriers JOIN users USING (user_id)""",
    "available_couriers": _ALL
    + """SELECT user_id AS id, user_name AS name, vehicle_type, latitude AS lat, longitude AS lon
        FROM couriers JOIN users USING (user_id) WHERE is_available""",
    "dispatch_data": _ALL
    + """SELECT order_id, client_id, restaurant_id, latitude AS client_latitude, longitude AS client_longitude,
        restaurant_latitude, restaurant_longitude, order_status, courier_id
        FROM ord JOIN users ON user_id = client_id JOIN restaurants USING (restaurant_id)""",
    "order_detail": _ALL
    + f"""SELECT order_id, 0 AS section, {V.ISO.format(t='created_at')} AS created_at, client_id, restaurant_id, courier_id,
          order_status AS label, NULL::BIGINT AS sort_id, NULL::BIGINT AS quantity, NULL AS from_status, NULL AS to_status,
          NULL AS event_status, NULL AS event_message, NULL::DOUBLE AS latitude, NULL::DOUBLE AS longitude FROM ord
        UNION ALL SELECT order_id, 1, NULL, NULL, NULL, NULL, item_name, line, quantity, NULL, NULL, NULL, NULL, NULL, NULL
          FROM items WHERE order_id IN (SELECT order_id FROM ord)
        UNION ALL SELECT order_id, 2, created_at, NULL, NULL, NULL, event_type, event_id, NULL, from_status, to_status, event_status,
          event_message, NULL, NULL FROM oe WHERE order_id IN (SELECT order_id FROM ord)""",
    "insert_if_absent": _ALL
    + """SELECT * FROM couriers UNION ALL SELECT order_id, 'bike ' || k, true FROM (
          SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY event_id) AS rn FROM ev)
        WHERE rn = 1 AND order_id NOT IN (SELECT user_id FROM couriers)""",
    "upsert_couriers": _ALL
    + """, ch AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY event_id DESC) AS rn FROM ev) WHERE rn = 1)
        SELECT * FROM couriers WHERE user_id NOT IN (SELECT order_id FROM ch) UNION ALL SELECT order_id, kind, k < 50 FROM ch""",
    "fk_orphans": _ALL
    + " UNION ALL ".join(
        f"""SELECT '{_NAME.get(c, c)}.{k}' AS reference, count(*) AS orphan_rows, count(DISTINCT c.{k}) AS orphan_keys FROM {c} c
        WHERE c.{k} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {p} p WHERE p.{pk} = c.{k})""" for c, k, p, pk in _FKS),
    "constraint_report": _ALL
    + " UNION ALL ".join(
        f"SELECT '{_NAME.get(t, t)}.{c} not null' AS rule, count(*) FILTER ({c} IS NULL) AS violations FROM {t}"
        for t, cols in _NOT_NULL.items() for c in cols)
    + """ UNION ALL SELECT 'users.user_type known', count(*) FILTER (user_type NOT IN ('client', 'courier', 'admin')) FROM users
        UNION ALL SELECT 'order_items.quantity positive', count(*) FILTER (quantity <= 0) FROM items
        UNION ALL SELECT 'users.email unique', count(*) FROM users WHERE email IN (SELECT email FROM users GROUP BY email HAVING count(*) > 1)""",
    # a replay of one request after another; the lists hold what the requests so far have changed
    "assignment_conflicts": V.with_recursive(
        V.EV, V.USERS, V.COURIERS, V.RESTAURANTS, V.ORD,
        """rq AS MATERIALIZED (
          SELECT row_number() OVER (ORDER BY event_id) AS i, event_id * 7 % 20000 AS order_id, ev.order_id AS courier_id, event_id AS seq,
            o.order_id IS NOT NULL AS known, o.courier_id AS held, coalesce(c.is_available, false) AS free
          FROM ev LEFT JOIN ord o ON o.order_id = event_id * 7 % 20000 LEFT JOIN couriers c ON c.user_id = ev.order_id)""",
        """replay(i, orders_taken, takers, gone, outcome) AS (
          SELECT 0::BIGINT, []::BIGINT[], []::BIGINT[], []::BIGINT[], ''
          UNION ALL
          SELECT i, CASE WHEN outcome = 'assigned' THEN list_append(orders_taken, order_id) ELSE orders_taken END,
            CASE WHEN outcome = 'assigned' THEN list_append(takers, courier_id) ELSE takers END,
            CASE WHEN outcome IN ('assigned', 'already_assigned') AND NOT list_contains(gone, courier_id) THEN list_append(gone, courier_id) ELSE gone END,
            outcome
          FROM (
            SELECT i, orders_taken, takers, gone, order_id, courier_id, CASE WHEN NOT known THEN 'order_not_found'
                WHEN held <> courier_id THEN 'assigned_to_another' WHEN now <> courier_id THEN 'order_taken_earlier'
                WHEN held IS NOT NULL OR now IS NOT NULL THEN 'already_assigned' WHEN NOT free THEN 'courier_unavailable'
                WHEN list_contains(gone, courier_id) THEN 'courier_taken_earlier' ELSE 'assigned' END AS outcome
            FROM (SELECT rq.*, orders_taken, takers, gone, takers[list_position(orders_taken, rq.order_id)] AS now
                  FROM replay JOIN rq ON rq.i = replay.i + 1)))""",
    )
    + "SELECT order_id, courier_id, seq, outcome FROM replay JOIN rq USING (i)",
    "courier_location_log": V.with_(V.EV, _POS) + "SELECT * EXCLUDE (event_id) FROM pos",
    "latest_courier_location": V.with_(V.EV, _POS)
    + """SELECT * EXCLUDE (event_id, rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY courier_id ORDER BY timestamp DESC) AS rn FROM pos) WHERE rn = 1""",
    "latest_live_snapshot": V.with_(V.EV)
    + f"""SELECT 'order-' || order_id AS name, 'store' AS source, epoch_us(ts) AS stored_us, '{{"status":"' || status || '","k":' || k || '}}' AS payload
        FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY ts DESC) AS rn FROM ev
          WHERE ts > (SELECT max(ts) FROM ev) - INTERVAL {TTL} SECONDS) WHERE rn = 1""",
}
