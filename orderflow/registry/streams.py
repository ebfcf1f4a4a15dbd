"""Registered queries that run Structured Streaming jobs over the event table until all of it is read."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from orderflow import fixtures as X
from orderflow.operators import latency, normalize as N
from orderflow.registry import live, load, views as V
from orderflow.session import scratch_path
from orderflow.sources.lake import PARTITIONS
from orderflow.streaming import pipelines as P

#: Days of events that arrive together, in one micro-batch; every fortieth event comes with the next ones.
DAYS, LATE, LAST = 5, 40, 6
#: Rows of a file, while a micro-batch has fewer files than FILES or than the cores can use.
FILE_ROWS, FILES = 50_000, 32
WINDOWS_KEPT = 300 * 3600
LIFETIME = 3600 * 48


def source(spark: SparkSession, folder: str) -> DataFrame:
    schema = X.table(spark, folder, "events").schema
    return X.from_events(P.read_stream(spark, folder, schema, pathGlobFilter="events.parquet"))


def arrivals(spark: SparkSession, folder: str, twice: bool = False, late: bool = True, **end) -> DataFrame:
    """The events as a stream of several micro-batches, some of them late, or again in the next one.

    A micro-batch is a fixed number of files, so that its rows are written and read by many tasks; one file where they are few.
    """
    events, path = X.table(spark, folder, "events"), scratch_path(spark, "arrivals")
    group = F.floor((F.dayofmonth("ts") - 1) / DAYS) + F.when(F.lit(late) & (F.col("event_id") % LATE == 7), 1).otherwise(0)
    dealt = events.withColumn("_file", F.least(group, F.lit(LAST)))
    if twice:
        dealt = dealt.unionByName(dealt.where("event_id % 3 = 0").withColumn("_file", F.least(F.col("_file") + 1, F.lit(LAST))))
    most = dealt.groupBy("_file").count().agg(F.max("count")).first()[0] or 1
    files = min(-(-most // FILE_ROWS), max(FILES, 4 * spark.sparkContext.defaultParallelism))
    for n in range(LAST + 1):  # in turn, as the files' times give their order
        rows = dealt.where(F.col("_file") == n).drop("_file")
        (rows.coalesce(1) if files == 1 else rows.repartition(files)).write.mode("append").parquet(path)
        if files > 1:  # tasks without rows write nothing; empty files take their places
            for _ in range((n + 1) * files - len(spark.read.schema(events.schema).parquet(path).inputFiles())):
                spark.createDataFrame([], events.schema).write.mode("append").parquet(path)
    if end:
        P.end_input(spark, path, events.schema, **end)
    return X.from_events(P.read_stream(spark, path, events.schema, maxFilesPerTrigger=str(files)))


def normalized(spark: SparkSession, folder: str) -> DataFrame:
    """Normalised events in several micro-batches."""
    return N.normalize(X.raw_events(arrivals(spark, folder))).withColumn("seq", F.col("event_id"))


def _merged(stream: DataFrame, path: str, add) -> None:
    with P.small_methods(stream.sparkSession):
        query = P.merge_into(stream, f"{path}/checkpoint", add)
    P.run_available(query)


def _statuses(spark: SparkSession, folder: str, lifetime: int | None = None) -> DataFrame:
    path = scratch_path(spark, "status")
    table = P.status_table(spark, f"{path}/table", lifetime)
    _merged(normalized(spark, folder), path, P.add_statuses(table))
    return table.read()


def stream_latest_status(spark: SparkSession, folder: str) -> DataFrame:
    return _statuses(spark, folder).select("order_id", "status")


def stream_living_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with a status in the last two days before the newest one; others have left the table."""
    return _statuses(spark, folder, LIFETIME)


def stream_status_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Counts over the keyed state: the state is stored first, then counted."""
    return stream_latest_status(spark, folder).groupBy("status").agg(F.count(F.lit(1)).alias("total"))


def _windows(spark: SparkSession, folder: str, groups: dict[str, str], width: str, slide: str | None, lifetime: int | None = None) -> DataFrame:
    path = scratch_path(spark, "windows")
    table = P.window_table(spark, f"{path}/table", groups, lifetime)
    _merged(normalized(spark, folder), path, P.add_windows(table, width, slide, 3600))
    return table.read()


def stream_order_lives(spark: SparkSession, folder: str) -> DataFrame:
    """Every life of an order: seen again and again, and then not for six hours."""
    newest = X.events(spark, folder).agg(F.max("arrival_ts")).first()[0]
    after = {"ts": newest + timedelta(days=9), "props": '{"k": 0}', "user_id": -1}
    events = arrivals(spark, folder, **after).withColumn("seq", F.col("event_id"))
    with P.rocksdb_state(spark):
        return P.collected(P.sessions(events, "order_id", "6 hours", "8 days", status=F.col("status")), "lives")


def stream_distinct_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders seen per hour, from sketches that micro-batches add to; whether within 3 % of the exact number."""
    path = scratch_path(spark, "hours")
    table = P.hourly_orders(spark, f"{path}/table")
    _merged(arrivals(spark, folder), path, P.add_orders(table))
    start = F.unix_seconds("arrival_ts") - F.pmod(F.unix_seconds("arrival_ts"), F.lit(3600))
    exact = X.events(spark, folder).groupBy(start.alias("hour")).agg(F.countDistinct("order_id").alias("orders"))
    guess = table.read().select("hour", F.hll_sketch_estimate("orders").alias("_estimate"))
    close = F.abs(F.col("_estimate") - F.col("orders")) <= F.ceil(F.col("orders") * 0.03)
    return exact.join(guess, "hour", "full").select("hour", "orders", close.alias("close"))


def stream_enrich(spark: SparkSession, folder: str) -> DataFrame:
    users = X.users(spark, folder).select(F.col("user_id").alias("order_id"), "user_name", "user_type")
    joined = source(spark, folder).join(users, "order_id")
    return P.collected(joined.select("event_id", "order_id", "status", "user_name", "user_type"), "enriched")


def stream_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """A third of the events delivered twice, in two micro-batches; keys are remembered for as long as copies may come."""
    twice = arrivals(spark, folder, twice=True)
    return P.collected(P.deduplicated(twice, "event_id", "40 days").select("event_id", "order_id", "kind"), "dedup")


def stream_courier_signals(spark: SparkSession, folder: str) -> DataFrame:
    """Courier availability from the signal stream, newest signal per courier."""
    path = scratch_path(spark, "signals")
    holders, signals = P.holder_table(spark, f"{path}/holders"), P.signal_table(spark, f"{path}/signals")
    stream = N.normalize(X.raw_events(arrivals(spark, folder, late=False))).withColumn("seq", F.col("event_id"))
    _merged(stream, path, P.add_signals(holders, signals))
    return signals.read().select("courier_id", "available")


def stream_lake_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path, rows = scratch_path(spark, "stream-lake"), X.order_events(source(spark, folder))
    P.run_available(P.to_lake(rows, f"{path}/data", f"{path}/checkpoint"))
    lake = spark.read.schema(rows.schema).parquet(f"{path}/data")
    return lake.groupBy(*PARTITIONS, "event_type").agg(F.count(F.lit(1)).alias("events"), F.max("event_id").alias("last_id"))


def stream_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """Bad records of the stream, set aside while the good ones are stored."""
    path = scratch_path(spark, "quarantine")
    P.run_available(P.with_quarantine(X.raw_events(source(spark, folder)), f"{path}/data", f"{path}/checkpoint"))
    return P.read_quarantined(spark, f"{path}/data", True).select("event_id", "format_name", "parse_error")


def stream_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """Orders per status after each micro-batch."""
    path = scratch_path(spark, "stream-snapshots")
    table = P.status_table(spark, f"{path}/table")
    add = P.add_statuses(table)

    def snapshot(batch: DataFrame, batch_id: int) -> None:
        add(batch, batch_id)
        shown = table.read().groupBy("status").agg(F.count(F.lit(1)).alias("total"))
        shown.write.mode("overwrite").parquet(f"{path}/data/batch_id={batch_id}")

    _merged(normalized(spark, folder), path, snapshot)
    return spark.read.schema("status string, total long, batch_id long").parquet(f"{path}/data")


def stream_pipeline_latency(spark: SparkSession, folder: str) -> DataFrame:
    """Three pipelines side by side on one source, with the latencies that each has seen.

    The source is a stored stream of normalised events, so that payloads are parsed once and not by every pipeline.
    """
    path, raw = scratch_path(spark, "fan-out"), normalized(spark, folder)
    with P.small_methods(spark):
        stored = P.append_to(raw, f"{path}/events", f"{path}/events-checkpoint")
    P.run_available(stored)
    batch = -(-len(spark.read.schema(raw.schema).parquet(f"{path}/events").inputFiles()) // (LAST + 1))
    events = P.read_stream(spark, f"{path}/events", raw.schema, maxFilesPerTrigger=str(max(1, batch)))
    pipelines = {
        "status": P.add_statuses(P.status_table(spark, f"{path}/status/table")),
        "windows": P.add_windows(P.window_table(spark, f"{path}/windows/table", {}), "1 hour", None, 3600),
        "orders": P.add_orders(P.hourly_orders(spark, f"{path}/orders/table")),
    }
    for query in P.fan_out(events, pipelines, path).values():
        P.run_available(query)
    return latency.latency_percentiles(P.read_samples(spark, path), "pipeline", "latency_ms")


QUERIES = {
    "stream_quarantine": stream_quarantine,
    "stream_snapshots": stream_snapshots,
    "stream_latest_status": stream_latest_status,
    "stream_living_orders": stream_living_orders,
    "stream_order_lives": stream_order_lives,
    "stream_status_counts": stream_status_counts,
    "stream_tumbling_rollup": lambda s, d: _windows(s, d, {"event_type": "string"}, "1 hour", None),
    "stream_recent_buckets": lambda s, d: _windows(s, d, {}, "1 hour", None, WINDOWS_KEPT),
    "stream_sliding_rate": lambda s, d: _windows(s, d, {}, "60 seconds", "10 seconds"),
    "stream_distinct_orders": stream_distinct_orders,
    "stream_pipeline_latency": stream_pipeline_latency,
    "stream_dedup": stream_dedup,
    "stream_enrich": stream_enrich,
    "stream_courier_signals": stream_courier_signals,
    "stream_lake_roundtrip": stream_lake_roundtrip,
}

_STATE = live._STATE
# the micro-batch of every event, and the watermark that the micro-batches before it leave
_ARRIVED = f"""arrived AS (SELECT event_id, arrival_ts, least((day(ts) - 1) // {DAYS} + CASE WHEN event_id % {LATE} = 7 THEN 1 ELSE 0 END, {LAST}) AS file FROM ev)"""
_MARKS = """marks AS (SELECT file, max(max(epoch_us(arrival_ts))) OVER (ORDER BY file ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 3600000000 AS mark
  FROM arrived GROUP BY file)"""
_TIMED = """timed AS (SELECT nm.*, file, coalesce(epoch_us(nm.arrival_ts) < mark, false)::BIGINT AS late
  FROM nm JOIN arrived USING (event_id) JOIN marks USING (file))"""
_TIMES = V.with_(V.EV, V.NM, _ARRIVED, _MARKS, _TIMED)

ORACLE = {
    "stream_quarantine": V.with_(V.EV, V.NM)
    + "SELECT event_id, format_name, format_name = 'unknown:raw_text' AS parse_error FROM nm WHERE event_type = 'UNKNOWN'",
    "stream_snapshots": V.with_(*_STATE, _ARRIVED)
    + """SELECT batch_id, status, count(*) AS total FROM (
        SELECT f.file AS batch_id, order_id, arg_max(new_status, (ch.arrival_ts, seq)) AS status
        FROM ch JOIN arrived a ON a.event_id = seq JOIN (SELECT DISTINCT file FROM arrived) f ON a.file <= f.file
        WHERE new_status IS NOT NULL GROUP BY ALL) GROUP BY ALL""",
    "stream_latest_status": V.with_(*_STATE) + "SELECT order_id, status FROM lo WHERE status IS NOT NULL",
    "stream_status_counts": V.with_(*_STATE) + "SELECT status, count(*) AS total FROM lo WHERE status IS NOT NULL GROUP BY status",
    "stream_living_orders": V.with_(*_STATE)
    + f"""SELECT order_id, new_status AS status, epoch_us(arrival_ts) AS arrival_us, seq FROM (
        SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY arrival_ts DESC, seq DESC) AS rn, max(arrival_ts) OVER () AS newest
        FROM ch WHERE new_status IS NOT NULL) WHERE rn = 1 AND epoch_us(arrival_ts) > epoch_us(newest) - {LIFETIME * 1_000_000}""",
    "stream_order_lives": V.with_(V.EV)
    + """SELECT order_id, min(epoch_us(arrival_ts)) AS first_us, max(epoch_us(arrival_ts)) + 21600000000 AS end_us, count(*) AS events,
          arg_max(status, (arrival_ts, event_id)) AS status
        FROM (SELECT *, sum(fresh) OVER (PARTITION BY order_id ORDER BY arrival_ts, event_id ROWS UNBOUNDED PRECEDING) AS life FROM (
          SELECT *, CASE WHEN epoch_us(arrival_ts) <= epoch_us(lag(arrival_ts) OVER (PARTITION BY order_id ORDER BY arrival_ts, event_id)) + 21600000000
            THEN 0 ELSE 1 END AS fresh FROM ev)) GROUP BY order_id, life""",
    "stream_tumbling_rollup": _TIMES
    + """SELECT epoch_us(arrival_ts) // 3600000000 * 3600 AS window_start, event_type, count(*) AS events, sum(late)::BIGINT AS late_events
        FROM timed GROUP BY ALL""",
    "stream_recent_buckets": _TIMES
    + f"""SELECT * FROM (SELECT epoch_us(arrival_ts) // 3600000000 * 3600 AS window_start, count(*) AS events, sum(late)::BIGINT AS late_events
        FROM timed GROUP BY ALL) WHERE window_start > (SELECT max(epoch_us(arrival_ts)) FROM nm) // 3600000000 * 3600 - {WINDOWS_KEPT}""",
    "stream_sliding_rate": _TIMES
    + """SELECT (epoch_us(arrival_ts) // 10000000 - i) * 10 AS window_start, count(*) AS events, sum(late)::BIGINT AS late_events
        FROM timed, range(6) t(i) GROUP BY ALL""",
    "stream_distinct_orders": V.with_(V.EV)
    + "SELECT epoch_us(arrival_ts) // 3600000000 * 3600 AS hour, count(DISTINCT order_id) AS orders, true AS close FROM ev GROUP BY ALL",
    "stream_pipeline_latency": V.with_(
        V.EV, V.NM, live._LAT, "seen AS (SELECT pipeline, latency_ms FROM lat, (VALUES ('status'), ('windows'), ('orders')) t(pipeline))",
        load._linear("seen", "pipeline", "latency_ms"),
    )
    + f"""SELECT pipeline, samples, avg, max, p50, p95 FROM (
        SELECT pipeline, count(*) AS samples, {V.rnd(V.avg('latency_ms'), 2)} AS avg, max(latency_ms) AS max FROM seen GROUP BY pipeline)
        JOIN pc USING (pipeline)""",
    "stream_dedup": V.with_(V.EV) + "SELECT event_id, order_id, kind FROM ev",
    "stream_enrich": V.with_(V.EV, V.USERS)
    + "SELECT event_id, order_id, status, user_name, user_type FROM ev JOIN users ON user_id = order_id",
    "stream_courier_signals": V.with_(*_STATE) + "SELECT * FROM cs",
    "stream_lake_roundtrip": V.with_(V.EV, V.OE)
    + """SELECT event_date[1:4] AS year, event_date[6:7] AS month, event_date[9:10] AS day, hour, event_type,
        count(*) AS events, max(event_id) AS last_id FROM oe GROUP BY ALL""",
}
