"""Registered queries over the event lake and the raw payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from orderflow import fixtures
from orderflow.functions import scalars as X
from orderflow.operators import normalize as N
from orderflow.plans import history as H
from orderflow.registry import views as V
from orderflow.session import scratch_path
from orderflow.sources import lake as L

LAKE_DAY = "2024-01-15"
LAKE_RANGE = ("2024-01-27", "2024-02-02")


def lake(spark: SparkSession, folder: str) -> DataFrame:
    return fixtures.order_events(fixtures.events(spark, folder))


def lake_scan_day(spark: SparkSession, folder: str) -> DataFrame:
    """Write the whole event table as an hourly JSON lake, then scan one day's partitions."""
    path = scratch_path(spark, "lake")
    L.write_lake(lake(spark, folder), path)
    return L.read_lake(spark, path).where(L.days(LAKE_DAY)).drop("year", "month", "day", "latitude", "longitude")


def lake_scan_range(spark: SparkSession, folder: str) -> DataFrame:
    """The same lake, a range of days over the end of a month, from the folders of these days."""
    path = scratch_path(spark, "lake")
    L.write_lake(lake(spark, folder), path)
    found = L.read_days(spark, path, *LAKE_RANGE)
    return found.groupBy("year", "month", "day").agg(F.count(F.lit(1)).alias("events"), F.max("event_id").alias("last_id"))


def normalized(spark: SparkSession, folder: str) -> DataFrame:
    raw = fixtures.raw_events(fixtures.spread(fixtures.events(spark, folder)))
    return N.normalize(raw).withColumn("seq", F.col("event_id"))


def normalize_events(spark: SparkSession, folder: str) -> DataFrame:
    return normalized(spark, folder).select(
        "event_id", "event_type", "order_id", "status", "courier_id", "courier_available", "format_name",
        F.unix_micros("event_ts").alias("event_us"),
    )


def unbatch_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """Each payload wrapped as an array, a records object or glued frames, with a scalar mixed in.

    A payload that is no JSON makes its wrapper unreadable as a whole.
    """
    raw = fixtures.raw_events(fixtures.spread(fixtures.events(spark, folder)))
    p, turn = F.col("payload"), F.col("event_id") % 3
    note = F.format_string('{"note":"a}{b","order_id":%d,"status":"x"}', F.col("event_id"))
    batch = (
        F.when(turn == 0, F.concat(F.lit("[5,"), p, F.lit(","), note, F.lit(",null]")))
        .when(turn == 1, F.concat(F.lit('{"records":['), p, F.lit(",7,"), note, F.lit("]}")))
        .otherwise(F.concat(p, note))
    )
    events = N.normalize(raw.withColumn("payload", batch), split_frames=True)
    return events.select("event_id", "event_type", "order_id", "status", "format_name", "parse_error")


def quarantine_bad_records(spark: SparkSession, folder: str) -> DataFrame:
    bad = N.quarantine(normalized(spark, folder))[1]
    return bad.select("event_id", "format_name", "parse_error")


def encode_order_events(spark: SparkSession, folder: str) -> DataFrame:
    base = fixtures.events(spark, folder)
    courier = F.regexp_extract("event_message", r"(\d+)", 1)
    changes = fixtures.order_events(base).select(
        "*",
        F.when(F.col("event_type") == "COURIER_ASSIGNED", courier.cast("long")).alias("courier_id"),
        F.col("order_id").alias("client_id"),
        F.col("order_id").alias("restaurant_id"),
    )
    return N.encode(changes)


QUERIES = {
    "lake_scan_day": lake_scan_day,
    "lake_scan_range": lake_scan_range,
    "latest_order_status": lambda s, d: H.latest_order_status(lake(s, d)),
    "history_kpis": lambda s, d: H.history_kpis(lake(s, d)),
    "status_distribution": lambda s, d: H.status_distribution(lake(s, d)),
    "events_by_type": lambda s, d: H.events_by_type(lake(s, d)),
    "events_by_hour": lambda s, d: H.events_by_hour(lake(s, d)),
    "peak_hour": lambda s, d: H.peak_hour(lake(s, d)),
    "status_shares": lambda s, d: H.status_shares(lake(s, d)),
    "normalize_events": normalize_events,
    "unbatch_payloads": unbatch_payloads,
    "quarantine_bad_records": quarantine_bad_records,
    "format_counts": lambda s, d: N.format_counts(normalized(s, d)),
    "encode_order_events": encode_order_events,
}

_OE = V.with_(V.EV, V.OE)
_LATEST = V.with_(V.EV, V.OE, V.LATEST)
_TOTALS = "t AS (SELECT event_date, status, count(*) AS total FROM latest GROUP BY ALL)"

ORACLE = {
    "lake_scan_day": _OE
    + f"""SELECT CAST(event_id AS INTEGER) AS event_id, CAST(order_id AS INTEGER) AS order_id, event_type, from_status, to_status,
        event_status, event_message, created_at, hour FROM oe WHERE event_date = '{LAKE_DAY}'""",
    "lake_scan_range": _OE
    + f"""SELECT event_date[1:4] AS year, event_date[6:7] AS month, event_date[9:10] AS day, count(*) AS events,
        CAST(max(event_id) AS INTEGER) AS last_id FROM oe WHERE event_date BETWEEN '{LAKE_RANGE[0]}' AND '{LAKE_RANGE[1]}' GROUP BY ALL""",
    "latest_order_status": _LATEST + "SELECT * FROM latest",
    "history_kpis": _LATEST
    + f"""SELECT event_date, CAST(sum(events) AS BIGINT) AS total_events, count(*) AS total_orders,
        count(*) FILTER (status NOT IN ('DELIVERED', 'CANCELLED')) AS orders_open,
        count(*) FILTER (status = 'DELIVERED') AS orders_delivered, count(*) FILTER (status = 'CANCELLED') AS orders_cancelled,
        {V.rnd("count(*) FILTER (status = 'DELIVERED') * 100.0::DOUBLE / count(*)", 1)} AS delivery_rate_pct,
        {V.rnd("count(*) FILTER (status = 'CANCELLED') * 100.0::DOUBLE / count(*)", 1)} AS cancel_rate_pct
        FROM latest GROUP BY event_date""",
    "status_distribution": _LATEST + "SELECT event_date, status, count(*) AS total FROM latest GROUP BY ALL",
    "events_by_type": _OE + "SELECT event_date, event_type, count(*) AS total FROM oe GROUP BY ALL",
    "events_by_hour": _OE
    + "SELECT event_date, hour, count(*) AS total_events, count(DISTINCT order_id) AS total_orders FROM oe GROUP BY ALL",
    "peak_hour": _OE
    + """, h AS (SELECT event_date, hour, count(*) AS n FROM oe GROUP BY ALL)
        SELECT event_date, hour AS peak_hour, n AS peak_events FROM (
          SELECT *, row_number() OVER (PARTITION BY event_date ORDER BY n DESC, hour) AS rn FROM h) WHERE rn = 1""",
    "status_shares": V.with_(V.EV, V.OE, V.LATEST, _TOTALS)
    + """SELECT event_date, status, total, total * 100.0::DOUBLE / sum(total) OVER g AS share_pct,
        total * 100.0::DOUBLE / max(total) OVER g AS bar_pct,
        (sum(total) OVER r - total) * 100.0::DOUBLE / sum(total) OVER g AS start_pct,
        sum(total) OVER r * 100.0::DOUBLE / sum(total) OVER g AS end_pct FROM t
        WINDOW g AS (PARTITION BY event_date), r AS (PARTITION BY event_date ORDER BY total DESC, status)""",
    "normalize_events": V.with_(V.EV, V.NM)
    + """SELECT event_id, event_type, order_id, status, courier_id, courier_available, format_name,
        epoch_us(event_ts) AS event_us FROM nm""",
    "unbatch_payloads": V.with_(V.EV, V.NM)
    + """SELECT event_id, event_type, order_id, status, format_name, false AS parse_error FROM nm WHERE format_name <> 'unknown:raw_text'
        UNION ALL SELECT event_id, 'STATUS_CHANGE', event_id, 'X', 'status_update', false FROM nm WHERE format_name <> 'unknown:raw_text'
        UNION ALL SELECT event_id, 'UNKNOWN', NULL, NULL, 'unknown:raw_text', true FROM nm WHERE format_name = 'unknown:raw_text'""",
    "quarantine_bad_records": V.with_(V.EV, V.NM)
    + "SELECT event_id, format_name, format_name = 'unknown:raw_text' AS parse_error FROM nm WHERE event_type = 'UNKNOWN'",
    "format_counts": V.with_(V.EV, V.NM) + "SELECT format_name, count(*) AS total FROM nm GROUP BY ALL",
    "encode_order_events": _OE
    + """, q AS (SELECT *, CASE WHEN from_status IS NULL THEN 'null' ELSE '"' || from_status || '"' END AS fs,
          CASE WHEN to_status IS NULL THEN 'null' ELSE '"' || to_status || '"' END AS st FROM oe)
        SELECT event_id, CAST(order_id AS VARCHAR) AS partition_key, 'legacy' AS style,
          '{"event_id":' || event_id || ',"order_id":' || order_id || ',"event_type":"' || event_type || '","from_status":' || fs ||
          ',"to_status":' || st || ',"event_status":' || st || ',"event_message":"' || event_message ||
          '","latitude":null,"longitude":null,"created_at":"' || created_at || '"}' || chr(10) AS data FROM q
        UNION ALL
        SELECT event_id, CAST(order_id AS VARCHAR), 'v2',
          CASE WHEN event_type = 'COURIER_ASSIGNED' THEN
            '{"event_type":"ORDER_COURIER_ASSIGNED","order_id":"' || order_id || '","courier_id":' || k || ',"timestamp":"' || created_at || '"}'
          WHEN to_status = 'PENDING' THEN
            '{"event_type":"ORDER_CREATED","order_id":"' || order_id || '","client_id":' || order_id || ',"restaurant_id":' || order_id ||
            ',"status":"PENDING","timestamp":"' || created_at || '"}'
          ELSE '{"event_type":"ORDER_STATUS_CHANGED","order_id":"' || order_id || '","old_status":' || fs || ',"new_status":' || st ||
            ',"timestamp":"' || created_at || '"}' END FROM q""",
}
