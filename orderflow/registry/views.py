"""SQL twins of ``orderflow.fixtures``, used to check results with another engine."""

from __future__ import annotations

EV = """ev AS (
  SELECT event_id, ts, user_id AS order_id, event_type AS kind, value,
    CAST(json_extract(props, '$.k') AS BIGINT) AS k,
    CASE event_type WHEN 'signup' THEN 'PENDING' WHEN 'view' THEN 'PREPARING' WHEN 'purchase' THEN 'DELIVERED'
      WHEN 'error' THEN 'CANCELLED'
      ELSE CASE WHEN CAST(json_extract(props, '$.k') AS BIGINT) < 50 THEN 'READY_FOR_PICKUP' ELSE 'IN_TRANSIT' END END AS status,
    ts + to_seconds(CAST(json_extract(props, '$.k') AS BIGINT)) AS arrival_ts
  FROM events)"""

PRIOR = """CASE {s} WHEN 'PREPARING' THEN 'CONFIRMED' WHEN 'READY_FOR_PICKUP' THEN 'PREPARING'
  WHEN 'IN_TRANSIT' THEN 'PICKED_UP' WHEN 'DELIVERED' THEN 'IN_TRANSIT' WHEN 'CANCELLED' THEN 'PENDING' END"""

ISO = "strftime({t}, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00'"

OE = f"""oe AS (
  SELECT event_id, order_id, ts, k, arrival_ts,
    CASE WHEN event_id % 7 = 0 THEN 'COURIER_ASSIGNED' ELSE 'STATUS_CHANGE' END AS event_type,
    CASE WHEN event_id % 7 = 0 THEN NULL ELSE {PRIOR.format(s='status')} END AS from_status,
    CASE WHEN event_id % 7 = 0 THEN NULL ELSE status END AS to_status,
    CASE WHEN event_id % 7 = 0 THEN NULL ELSE status END AS event_status,
    CASE WHEN event_id % 7 = 0 THEN 'Courier ' || k || ' assigned'
      ELSE 'Order status changed from ' || coalesce({PRIOR.format(s='status')}, 'None') || ' to ' || status END AS event_message,
    {ISO.format(t='ts')} AS created_at,
    strftime(arrival_ts, '%Y-%m-%d') AS event_date, strftime(arrival_ts, '%H') AS hour
  FROM ev)"""

LATEST = """latest AS (
  SELECT event_date, order_id, coalesce(event_status, to_status, from_status, 'UNKNOWN') AS status, events FROM (
    SELECT *, row_number() OVER (PARTITION BY event_date, order_id ORDER BY ts DESC, event_id DESC) AS rn,
      count(*) OVER (PARTITION BY event_date, order_id) AS events FROM oe) WHERE rn = 1)"""

# Expected normalised events, computed from the event id and never from the JSON text.
NM = f"""nm AS (
  SELECT event_id, arrival_ts, event_id AS seq,
    CASE digit WHEN 0 THEN 'ORDER_CREATED' WHEN 2 THEN 'COURIER_ASSIGNED' WHEN 4 THEN 'COURIER_ASSIGNED'
      WHEN 3 THEN CASE WHEN status = 'PENDING' THEN 'ORDER_CREATED' ELSE 'STATUS_CHANGE' END
      WHEN 6 THEN 'COURIER_AVAILABILITY' WHEN 7 THEN 'COURIER_LOCATION' WHEN 8 THEN 'UNKNOWN' ELSE 'STATUS_CHANGE' END AS event_type,
    CASE WHEN digit IN (6, 8) OR (digit = 7 AND (event_id // 10) % 2 = 1) THEN NULL ELSE order_id END AS order_id,
    CASE WHEN digit = 0 THEN 'PENDING' WHEN digit IN (1, 3, 5, 9) THEN status END AS status,
    CASE WHEN digit IN (2, 4, 5, 6, 7) THEN k END AS courier_id,
    CASE WHEN digit = 6 THEN CASE (event_id // 10) % 5 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN true WHEN 3 THEN false END
      WHEN digit = 7 AND (event_id // 10) % 2 = 0 THEN false END AS courier_available,
    CASE WHEN digit <= 2 THEN 'flat_order_event_v2' WHEN digit <= 4 THEN 'flat_order_event'
      WHEN digit = 5 THEN 'nested_order' WHEN digit = 6 THEN 'courier_availability'
      WHEN digit = 7 THEN 'courier_location' WHEN digit = 9 THEN 'status_update'
      WHEN (event_id // 10) % 2 = 0 THEN 'unknown:raw_text' ELSE 'unknown:aa,timestamp,zz' END AS format_name,
    CASE WHEN digit IN (7, 9) OR (digit = 8 AND (event_id // 10) % 2 = 0) THEN NULL
      WHEN digit = 6 THEN date_trunc('second', ts) ELSE ts END AS event_ts
  FROM (SELECT *, CASE WHEN order_id % 7 = 3 AND event_id % 10 IN (2, 4) THEN 9 ELSE event_id % 10 END AS digit FROM ev))"""


def lat(key: str, step: int) -> str:
    return f"(-23.7 + ({key} * {step} % 250) / 1000)"


def lon(key: str, step: int) -> str:
    return f"(-46.8 + ({key} * {step} % 400) / 1000)"


USERS = f"""users AS (
  SELECT c_custkey AS user_id, c_name AS user_name, 'u' || CAST(floor(c_acctbal) AS BIGINT) || '@example.com' AS email,
    {lat('c_custkey', 37)} AS latitude, {lon('c_custkey', 91)} AS longitude,
    CASE WHEN c_mktsegment = 'MACHINERY' THEN 'machine' WHEN c_acctbal > 0 THEN 'courier' ELSE 'client' END AS user_type
  FROM customer)"""
COURIERS = """couriers AS (
  SELECT c_custkey AS user_id, CASE c_custkey % 3 WHEN 0 THEN 'bike' WHEN 1 THEN 'motorcycle' ELSE 'car' END AS vehicle_type,
    c_acctbal > 0 AS is_available FROM customer WHERE c_mktsegment <> 'MACHINERY')"""
RESTAURANTS = f"""restaurants AS (
  SELECT s_suppkey AS restaurant_id, s_name AS restaurant_name, 'cuisine ' || s_nationkey AS cuisine_type,
    {lat('s_suppkey', 53)} AS restaurant_latitude, {lon('s_suppkey', 29)} AS restaurant_longitude, s_suppkey AS creator_user_id
  FROM supplier)"""
ORD = """ord AS (
  SELECT o_orderkey AS order_id, o_custkey AS client_id, o_orderkey % (SELECT count(*) FROM supplier) AS restaurant_id,
    CASE WHEN o_custkey % 3 <> 0 THEN o_custkey END AS courier_id,
    CASE o_orderstatus WHEN 'F' THEN 'DELIVERED' WHEN 'O' THEN 'PREPARING' ELSE 'READY_FOR_PICKUP' END AS order_status,
    o_orderdate AS created_at FROM orders)"""
ITEMS = """items AS (
  SELECT l_orderkey AS order_id, CAST(l_linenumber AS BIGINT) AS line, p_name AS item_name, CAST(l_quantity AS BIGINT) AS quantity
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""
EDGES = """edges AS (
  SELECT u, v, min(length) AS length FROM (
    SELECT least(l_partkey, l_suppkey + 1000000000) AS u, greatest(l_partkey, l_suppkey + 1000000000) AS v, l_quantity * 100 AS length
    FROM lineitem) GROUP BY ALL)"""
NODES = f"""nodes AS (
  SELECT id, {lon('key', 71)} AS x, {lat('key', 43)} AS y FROM (
    SELECT p_partkey AS key, p_partkey AS id FROM part UNION ALL SELECT s_suppkey, s_suppkey + 1000000000 FROM supplier))"""
REQ = """req AS (
  SELECT order_id || '/' || strftime(ts, '%Y-%m-%d') AS run_id, event_id AS seq, ts AS sent_at, kind AS endpoint, kind = 'signup' AS is_create,
    CASE WHEN k < 2 THEN 404 WHEN kind = 'error' AND k % 5 = 0 THEN 500 ELSE 200 END AS status_code, value + k / 1000000.0::DOUBLE AS latency_ms,
    k % 10 <> 9 AS has_json, CASE WHEN k % 10 <> 8 THEN order_id END AS order_id, status AS order_status
  FROM ev)"""


def avg(value: str) -> str:
    """Average; the sum is of decimals, so that its last digits do not hang on the order of the rows."""
    return f"(CAST(sum(CAST({value} AS DECIMAL(30,12))) AS DOUBLE) / count({value}))"


def rnd(value: str, digits: int) -> str:
    return f"CAST(round(CAST(CAST(CAST({value} AS DOUBLE) AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def with_recursive(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n"
