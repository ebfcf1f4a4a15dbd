"""Registered queries over latency samples and request logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from orderflow import fixtures
from orderflow.operators import latency as T, loadtest as P
from orderflow.registry import views as V
from orderflow.schemas import LATENCY_FIELDS
from orderflow.session import scratch_path
from orderflow.sources import lake as L

#: The given events are minutes apart, so statistics are per hour in place of five minutes.
WINDOW, DAY = 3600, 86_400
SCENARIO = ("peak", 50, 60)


def samples(spark: SparkSession, folder: str) -> DataFrame:
    return T.latency_samples(fixtures.pipeline_snapshots(fixtures.events(spark, folder)))


def latency_samples(spark: SparkSession, folder: str) -> DataFrame:
    """Through the JSON-lines log and back."""
    path = scratch_path(spark, "latency")
    L.append_latency_samples(samples(spark, folder), path)
    return L.read_latency_samples(spark, path)


def pipeline_latency_stats(spark: SparkSession, folder: str) -> DataFrame:
    """The last day before the newest sample."""
    shown = samples(spark, folder)
    return T.pipeline_latency_stats(shown, shown.agg(F.max("recorded_at")).scalar(), DAY)


def snapshot_ages(spark: SparkSession, folder: str) -> DataFrame:
    """As of a minute before the newest produce time; every thirteenth order's snapshot has lost its produce time."""
    shown, made = samples(spark, folder), "last_event_produced_at_ms"
    as_of = shown.agg(F.max(made)).scalar() - 60_000
    lost = F.when(F.col("total_orders_processed") % 13 == 0, F.lit(0).cast("long"))
    return T.snapshot_ages(shown.withColumn(made, F.coalesce(lost, F.col(made))), as_of)


def log(spark: SparkSession, folder: str) -> DataFrame:
    return fixtures.request_log(fixtures.events(spark, folder))


def load_report_document(spark: SparkSession, folder: str) -> DataFrame:
    """The report written as a JSON document, read back and opened per endpoint."""
    requests, path = log(spark, folder), scratch_path(spark, "report")
    report = P.load_report(P.load_summary(requests, *SCENARIO), P.endpoint_metrics(requests))
    L.write_report(report, path)
    document = spark.read.schema(report.schema).json(path)
    opened = document.select("summary", F.explode("endpoints").alias("endpoint", "stats"))
    return opened.select(
        "summary.scenario", "summary.attempted_orders", "endpoint", "stats.total_requests", "stats.errors", "stats.p95_latency"
    )


QUERIES = {
    "latency_samples": latency_samples,
    "latency_stats": lambda s, d: T.window_latency_stats(samples(s, d), WINDOW),
    "pipeline_latency_stats": pipeline_latency_stats,
    "snapshot_ages": snapshot_ages,
    "latency_percentiles": lambda s, d: T.latency_percentiles(log(s, d), "endpoint", "latency_ms"),
    "recent_samples": lambda s, d: T.recent_samples(samples(s, d)).select("recorded_at", "pipeline", LATENCY_FIELDS[0]),
    "endpoint_metrics": lambda s, d: P.endpoint_metrics(log(s, d)).withColumn("avg_latency", F.round("avg_latency", 6)),
    "endpoint_p95_exclusive": lambda s, d: P.endpoint_p95(log(s, d)),
    "order_outcomes": lambda s, d: P.order_outcomes(log(s, d)),
    "load_summary": lambda s, d: P.load_summary(log(s, d), *SCENARIO),
    "load_report_document": load_report_document,
}

_SAMPLES = f"""raw AS (SELECT event_id AS seq, kind AS pipeline, (epoch_us(ts) // 1000) AS produced, (epoch_us(ts) // 1000) + CAST(trunc(value) AS BIGINT) AS processed,
    (epoch_us(ts) // 1000) + k * 2000 AS emitted, value, k, order_id FROM ev),
samples AS (SELECT emitted / 1000.0::DOUBLE AS recorded_at, pipeline, produced AS last_event_produced_at_ms, processed AS last_event_processed_at_ms,
    value AS {LATENCY_FIELDS[0]}, value / 2 AS {LATENCY_FIELDS[1]},
    CASE WHEN emitted - processed <= 120000 THEN CAST(greatest(emitted - processed, 0) AS DOUBLE) END AS {LATENCY_FIELDS[2]},
    CASE WHEN emitted - processed <= 120000 THEN CAST(greatest(emitted - produced, 0) AS DOUBLE) END AS {LATENCY_FIELDS[3]},
    k AS orders_processed_per_minute, order_id AS total_orders_processed FROM raw)"""
_FIELDS = " UNION ALL ".join(
    f"""SELECT pipeline, CAST(floor(recorded_at / {WINDOW}) AS BIGINT) * {WINDOW} AS window_start, '{f}' AS field, {f} AS value, recorded_at,
    last_event_processed_at_ms AS processed, total_orders_processed AS total FROM samples""" for f in LATENCY_FIELDS
)


def _linear(values: str, groups: str, value: str) -> str:
    """Rank every value, then interpolate on rank (n - 1) * p."""

    def pick(p: float) -> str:
        low = f"max({value}) FILTER (i = floor((n - 1) * {p}::DOUBLE))"
        high = f"max({value}) FILTER (i = least(floor((n - 1) * {p}::DOUBLE) + 1, n - 1))"
        weight = f"max((n - 1) * {p}::DOUBLE - floor((n - 1) * {p}::DOUBLE))"
        return f"{low} * (1 - {weight}) + {high} * {weight}"

    return f"""rk AS (SELECT *, row_number() OVER (PARTITION BY {groups} ORDER BY {value}) - 1 AS i, count(*) OVER (PARTITION BY {groups}) AS n
      FROM {values} WHERE {value} IS NOT NULL),
    pc AS (SELECT {groups}, {pick(0.5)} AS p50, {pick(0.95)} AS p95 FROM rk GROUP BY {groups})"""


_EXCLUSIVE = """rk AS (SELECT endpoint, latency_ms, row_number() OVER (PARTITION BY endpoint ORDER BY latency_ms) AS i,
    count(*) OVER (PARTITION BY endpoint) AS n FROM req),
  jj AS (SELECT *, greatest(least((n + 1) * 95 // 100, n - 1), 1) AS j FROM rk),
  ex AS (SELECT endpoint, CASE WHEN max(n) = 1 THEN max(latency_ms) ELSE (max(latency_ms) FILTER (i = j) * (100 - max((n + 1) * 95 - j * 100))
    + max(latency_ms) FILTER (i = j + 1) * max((n + 1) * 95 - j * 100)) / 100.0::DOUBLE END AS p95_latency FROM jj GROUP BY endpoint)"""
_OUTCOMES = """runs AS (SELECT run_id, coalesce(bool_or(status_code BETWEEN 200 AND 299) FILTER (is_create), false) AS accepted,
    coalesce(bool_or(has_json) FILTER (is_create AND status_code = 200), false) AS has_json,
    max(order_id) FILTER (is_create AND status_code = 200 AND has_json) AS order_id,
    bool_or(NOT is_create AND status_code = 404) AS any_404, bool_or(NOT is_create AND status_code NOT IN (200, 404)) AS any_error,
    arg_max(order_status, seq) FILTER (NOT is_create AND status_code = 200 AND has_json) AS final_status FROM req GROUP BY run_id),
outcomes AS (SELECT *, error IS NULL AS success FROM (SELECT run_id, accepted, order_id, final_status,
    CASE WHEN NOT accepted THEN 'failed_to_create_order' WHEN NOT has_json THEN 'missing_order_response_json'
      WHEN order_id IS NULL THEN 'missing_order_id' WHEN any_404 THEN 'order_not_visible_after_creation' WHEN any_error THEN 'order_query_errors'
      WHEN final_status IS DISTINCT FROM 'DELIVERED' THEN 'order_not_delivered_last_status=' || coalesce(final_status, 'None') END AS error FROM runs))"""
_SUMMARY = """summary AS (SELECT 'peak' AS scenario, 50 AS orders_per_second, 60 AS duration_seconds, 3000 AS expected_orders,
    count(*) AS attempted_orders, count(*) FILTER (accepted) AS accepted_orders, count(*) FILTER (success) AS delivered_orders,
    count(*) FILTER (NOT success) AS failed_orders,
    (SELECT (max(epoch_us(sent_at)) - min(epoch_us(sent_at))) / 1e6::DOUBLE FROM req WHERE is_create) AS emission_elapsed_seconds,
    (SELECT (max(epoch_us(sent_at)) - min(epoch_us(sent_at))) / 1e6::DOUBLE FROM req) AS end_to_end_elapsed_seconds FROM outcomes)"""
_REQ = (V.EV, V.REQ)

ORACLE = {
    "latency_samples": V.with_(V.EV, _SAMPLES) + "SELECT * FROM samples",
    "latency_stats": V.with_(V.EV, _SAMPLES, f"f AS ({_FIELDS})", _linear("f", "pipeline, window_start, field", "value"))
    + f"""SELECT pipeline, window_start, field, samples, avg, last, {V.rnd('p50', 2)} AS p50, {V.rnd('p95', 2)} AS p95 FROM (
        SELECT pipeline, window_start, field, count(*) AS samples, {V.rnd(V.avg('value'), 2)} AS avg,
          {V.rnd('arg_max(value, (recorded_at, processed, total)) FILTER (value IS NOT NULL)', 2)} AS last
        FROM f GROUP BY ALL) LEFT JOIN pc USING (pipeline, window_start, field)""",
    "pipeline_latency_stats": V.with_(
        V.EV, _SAMPLES, f"f AS (SELECT * FROM ({_FIELDS}) WHERE recorded_at >= (SELECT max(recorded_at) FROM samples) - {DAY})",
        _linear("f", "pipeline, field", "value"),
    )
    + f"""SELECT pipeline, field, samples, avg, last, {V.rnd('p50', 2)} AS p50, {V.rnd('p95', 2)} AS p95 FROM (
        SELECT pipeline, field, count(*) AS samples, {V.rnd(V.avg('value'), 2)} AS avg,
          {V.rnd('arg_max(value, (recorded_at, processed, total)) FILTER (value IS NOT NULL)', 2)} AS last
        FROM f GROUP BY ALL) LEFT JOIN pc USING (pipeline, field)""",
    "snapshot_ages": V.with_(V.EV, _SAMPLES)
    + """, ages AS (SELECT pipeline, CASE WHEN total_orders_processed % 13 <> 0 AND last_event_produced_at_ms > 0 THEN
          greatest((SELECT max(last_event_produced_at_ms) FROM samples) - 60000 - last_event_produced_at_ms, 0) END AS age FROM samples)
        SELECT pipeline, count(*) AS samples, count(age) AS aged, min(age) AS newest_ms, max(age) AS oldest_ms FROM ages GROUP BY pipeline""",
    "latency_percentiles": V.with_(*_REQ, _linear("req", "endpoint", "latency_ms"))
    + f"""SELECT endpoint, samples, avg, max, p50, p95 FROM (
        SELECT endpoint, count(*) AS samples, {V.rnd(V.avg('latency_ms'), 2)} AS avg, max(latency_ms) AS max FROM req GROUP BY endpoint)
        JOIN pc USING (endpoint)""",
    "recent_samples": V.with_(V.EV, _SAMPLES)
    + f"""SELECT recorded_at, pipeline, {LATENCY_FIELDS[0]} FROM samples
        ORDER BY recorded_at DESC, last_event_processed_at_ms DESC, pipeline LIMIT 200""",
    "endpoint_metrics": V.with_(*_REQ, _EXCLUSIVE)
    + f"""SELECT * FROM (SELECT endpoint, count(*) AS total_requests, count(*) FILTER (status_code = 200) AS success,
        count(*) FILTER (status_code <> 200) AS errors, round({V.avg('latency_ms')}, 6) AS avg_latency, min(latency_ms) AS min_latency,
        max(latency_ms) AS max_latency FROM req GROUP BY endpoint) JOIN ex USING (endpoint)""",
    "endpoint_p95_exclusive": V.with_(*_REQ, _EXCLUSIVE) + "SELECT * FROM ex",
    "order_outcomes": V.with_(*_REQ, _OUTCOMES) + "SELECT * FROM outcomes",
    "load_summary": V.with_(*_REQ, _OUTCOMES, _SUMMARY)
    + """SELECT *, accepted_orders / emission_elapsed_seconds AS accepted_throughput,
        delivered_orders / end_to_end_elapsed_seconds AS delivered_throughput FROM summary""",
    "load_report_document": V.with_(*_REQ, _OUTCOMES, _EXCLUSIVE)
    + """SELECT 'peak' AS scenario, (SELECT count(*) FROM outcomes) AS attempted_orders, endpoint, count(*) AS total_requests,
        count(*) FILTER (status_code <> 200) AS errors, max(p95_latency) AS p95_latency FROM req JOIN ex USING (endpoint) GROUP BY endpoint""",
}
