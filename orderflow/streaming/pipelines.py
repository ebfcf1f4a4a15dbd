"""Structured Streaming versions of the live computations.

Normalising and the row-local operators are the batch functions, unchanged. Sources are named by format and
options, so the file source of the tests and a message-stream connector are used the same way.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from orderflow.functions import scalars as X
from orderflow.operators import normalize as N, ordered, state as S
from orderflow.schemas import DELIVERED
from orderflow.session import materialize, scratch_path
from orderflow.sources.lake import PARTITIONS
from orderflow.streaming.store import Table, newest_row, summed

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"


def read_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", **options: str) -> DataFrame:
    """A file stream; ``maxFilesPerTrigger`` or ``maxBytesPerTrigger`` bound each micro-batch."""
    return spark.readStream.schema(schema).options(**options).format(fmt).load(path)


@contextmanager
def _started_with(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting of the queries started inside; they keep it."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before) if before else spark.conf.unset(key)


def rocksdb_state(spark: SparkSession) -> AbstractContextManager[None]:
    """Keep large keyed state off the heap for the queries started inside."""
    return _started_with(spark, _PROVIDER, _ROCKSDB)


def small_methods(spark: SparkSession) -> AbstractContextManager[None]:
    """Generated code, in the queries started inside, in methods that the JVM compiles in any session: it leaves those of
    more than 8000 bytes interpreted, as the event classification makes one."""
    return _started_with(spark, _METHOD_LIMIT, "8000")


def run_available(query: StreamingQuery) -> None:
    """Wait for an ``availableNow`` query and pass its failure on."""
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def append_to(stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", partition_by: list[str] | None = None, **trigger) -> StreamingQuery:
    """Append-mode file sink; the checkpoint makes a restart continue where it stopped."""
    writer = stream.writeStream.outputMode("append").format(fmt).option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.trigger(**(trigger or {"availableNow": True})).start(path)


def to_lake(
    events: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", key: str = "order_id", files_per_hour: int = 4, **trigger
) -> StreamingQuery:
    """Hour-partitioned lake; ``processingTime='60 seconds'`` gives the usual flush interval.

    A live batch is mostly one hour, so an hour's rows go to ``files_per_hour`` tasks, by ``key``.
    """
    spread = F.pmod(F.xxhash64(key), F.lit(files_per_hour))
    return append_to(events.repartition(*PARTITIONS, spread), path, checkpoint, fmt, PARTITIONS, **trigger)


def merge_into(stream: DataFrame, checkpoint: str, add: Callable[[DataFrame, int], None], **trigger) -> StreamingQuery:
    """Hand every micro-batch to ``add(batch, batch_id)``, which merges it into stored tables."""
    writer = stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def with_quarantine(raw: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Normalised events, per micro-batch parsed and written once; ``quarantined`` tells unreadable or unknown payloads."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = N.normalize(batch)
        rows = rows.withColumn("quarantined", F.coalesce(N.is_bad(), F.lit(False)))
        rows.write.mode("overwrite").partitionBy("quarantined").parquet(f"{path}/batch_id={batch_id}")

    writer = raw.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def read_quarantined(spark: SparkSession, path: str, bad: bool) -> DataFrame:
    """The good or the bad rows of ``with_quarantine``; only their folders are read."""
    return spark.read.parquet(path).where(F.col("quarantined").cast("boolean") == bad).drop("quarantined")


def on_snapshot(
    stream: DataFrame, make: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, **trigger
) -> StreamingQuery:
    """Append ``make(batch)`` of every micro-batch, the streaming form of a timed snapshot."""

    def write(batch: DataFrame, batch_id: int) -> None:
        make(batch).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "1 second"})).start()


def fan_out(stream: DataFrame, pipelines: dict[str, Callable[[DataFrame, int], None]], path: str, **trigger) -> dict[str, StreamingQuery]:
    """Several pipelines on one source, each a query with a checkpoint of its own that fails and restarts alone.

    Besides its own work each one logs the event-to-consumer latency of what it has read: one file set per micro-batch, written after the
    work is done, and over again if the micro-batch is replayed.
    """

    def observed(name: str, add: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
        def run(batch: DataFrame, batch_id: int) -> None:
            add(batch, batch_id)
            latency = X.latency_ms(F.col("event_ts"), F.col("arrival_ts"))
            sample = batch.select(F.unix_millis("arrival_ts").alias("processed_at_ms"), latency.alias("latency_ms"))
            sample.write.mode("overwrite").parquet(f"{path}/samples/pipeline={name}/batch_id={batch_id}")

        return run

    return {name: merge_into(stream, f"{path}/{name}/checkpoint", observed(name, add), **trigger) for name, add in pipelines.items()}


def read_samples(spark: SparkSession, path: str) -> DataFrame:
    """The latencies that the pipelines of a ``fan_out`` logged."""
    return spark.read.schema("processed_at_ms long, latency_ms double, pipeline string, batch_id long").parquet(f"{path}/samples")


def status_table(spark: SparkSession, path: str, lifetime_seconds: int | None = None) -> Table:
    """order -> last status, with the time and number of the arrival that set it."""
    schema = T.StructType.fromDDL("order_id long, status string, arrival_us long, seq long")
    lifetime = None if lifetime_seconds is None else lifetime_seconds * 1_000_000
    return Table(spark, path, schema, ["order_id"], newest_row(["order_id"], ["arrival_us", "seq"]), "arrival_us", lifetime)


def add_statuses(table: Table) -> Callable[[DataFrame, int], None]:
    """The last status of every order in a micro-batch, merged into a ``status_table``; no state besides the table."""

    def add(batch: DataFrame, batch_id: int) -> None:
        changes = S.order_changes(batch).where(F.col("new_status").isNotNull())
        rows = changes.select("order_id", F.col("new_status").alias("status"), F.unix_micros("arrival_ts").alias("arrival_us"), "seq")
        table.add(rows, batch_id)

    return add


def window_table(spark: SparkSession, path: str, groups: dict[str, str], lifetime_seconds: int | None = None) -> Table:
    """(window_start in seconds, groups) -> events, and how many of them came behind the watermark."""
    kinds = ", ".join(f"{name} {kind}" for name, kind in groups.items())
    schema = T.StructType.fromDDL(f"window_start long, {kinds + ', ' if kinds else ''}events long, late_events long")
    keys = ["window_start", *groups]
    return Table(spark, path, schema, keys, summed(keys), "window_start", lifetime_seconds)


def add_windows(table: Table, width: str, slide: str | None, delay_seconds: int) -> Callable[[DataFrame, int], None]:
    """Events per window of a micro-batch, added to a ``window_table``.

    A window is right as soon as its rows are in, the last one as well: nothing waits for a watermark. Rows that come more
    than the delay behind the newest arrival of earlier micro-batches correct their stored window and are counted apart, in the
    window and as the fact ``late``.
    """

    def add(batch: DataFrame, batch_id: int) -> None:
        at, newest = F.unix_micros("arrival_ts"), table.manifest()["facts"].get("newest_us")
        late = F.lit(False) if newest is None else at < newest - delay_seconds * 1_000_000
        window = F.window("arrival_ts", width, slide) if slide else F.window("arrival_ts", width)

        def per_window(rows: DataFrame) -> DataFrame:
            one = [F.lit(1).cast("long").alias("events"), F.col("_late").cast("long").alias("late_events")]
            opened = rows.select(window.alias("_w"), *table.keys[1:], *one)
            return opened.select(F.unix_seconds("_w.start").alias("window_start"), *table.keys[1:], "events", "late_events")

        seen = batch.withColumn("_late", F.coalesce(late, F.lit(False)))
        table.add(seen, batch_id, per_window, counts={"late": F.count_if("_late")}, marks={"newest_us": F.max(at)})

    return add


def sessions(events: DataFrame, key: str, lifetime: str, delay: str, **last: Column) -> DataFrame:
    """Keyed state with a lifetime: what is known of a key until it has not been seen for that long, then it leaves the state.

    Each life of a key comes out once, when the watermark has passed its end: when it was first seen, when it ended, events,
    and the ``last`` known values. Null is a key like others.
    """
    life = F.session_window("arrival_ts", lifetime)
    at = F.struct("arrival_ts", "seq")
    values = [F.max_by(c, F.when(c.isNotNull(), at)).alias(n) for n, c in last.items()]
    lives = events.withWatermark("arrival_ts", delay).groupBy(key, life).agg(F.count(F.lit(1)).alias("events"), *values)
    begin, end = (F.unix_micros(f"session_window.{x}") for x in ("start", "end"))
    return lives.select(key, begin.alias("first_us"), end.alias("end_us"), "events", *last)


def end_input(spark: SparkSession, path: str, schema: T.StructType, **values) -> None:
    """A last file with one row far ahead in time: reading it moves the watermark past all rows before and so closes them.

    Its own window or life stays open, so it never comes out.
    """
    row = tuple(values.get(f.name) for f in schema.fields)
    spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(path)


def deduplicated(events: DataFrame, key: str, delay: str) -> DataFrame:
    """At-least-once input to one row per key, remembering keys for ``delay``."""
    return events.withWatermark("arrival_ts", delay).dropDuplicatesWithinWatermark([key])


_HOLDER = "order_id long, courier_id long, arrival_us long, seq long"
_SIGNAL = "courier_id long, available boolean, arrival_us long, seq long"


def holder_table(spark: SparkSession, path: str) -> Table:
    """order -> the courier assigned last."""
    return Table(spark, path, T.StructType.fromDDL(_HOLDER), ["order_id"], newest_row(["order_id"], ["arrival_us", "seq"]), "arrival_us")


def signal_table(spark: SparkSession, path: str) -> Table:
    """courier -> the newest sign of availability."""
    return Table(spark, path, T.StructType.fromDDL(_SIGNAL), ["courier_id"], newest_row(["courier_id"], ["arrival_us", "seq"]), "arrival_us")


def add_signals(holders: Table, signals: Table) -> Callable[[DataFrame, int], None]:
    """Availability of couriers, where a delivery frees the courier that its order was assigned to, in whatever micro-batch.

    Inside the micro-batch the last courier is carried along each order; where there was none before, the stored one counts.
    Micro-batches come in order of arrival.
    """

    def add(batch: DataFrame, batch_id: int) -> None:
        batch = materialize(batch, "signal-batch")
        delivered = (F.col("new_status") == DELIVERED) & ~F.col("created")
        steps = S.order_changes(batch).where(delivered | F.col("courier_id").isNotNull())
        steps = ordered.mark(steps, ordered.time_slice(F.col("arrival_ts")))
        inside = ordered.carry(steps, ["order_id"], ["arrival_ts", "seq"], last_known={"_inside": F.col("courier_id")})
        stored = holders.read().select("order_id", F.col("courier_id").alias("_stored"))
        holder = F.coalesce("_inside", "_stored")
        freed = inside.where(delivered).join(stored, "order_id", "left").where(holder.isNotNull())
        freed = freed.select(holder.alias("courier_id"), F.lit(True).alias("available"), F.unix_micros("arrival_ts").alias("arrival_us"), "seq")
        direct = S.direct_signals(batch).select("courier_id", "available", F.unix_micros("arrival_ts").alias("arrival_us"), "seq")
        signals.add(direct.unionByName(freed), batch_id)
        # last, since the stored holders are those before this micro-batch, also when it is replayed
        assigned = steps.where(F.col("courier_id").isNotNull())
        holders.add(assigned.select("order_id", "courier_id", F.unix_micros("arrival_ts").alias("arrival_us"), "seq"), batch_id)

    return add


def hourly_orders(spark: SparkSession, path: str) -> Table:
    """hour -> a sketch of the orders seen in it; sketches of hours, days or tables merge."""
    schema = T.StructType.fromDDL("hour long, orders binary")
    return Table(spark, path, schema, ["hour"], summed(["hour"], orders=lambda c: F.hll_union_agg(c)), "hour")


def add_orders(table: Table) -> Callable[[DataFrame, int], None]:
    def add(batch: DataFrame, batch_id: int) -> None:
        hour = (F.unix_seconds("arrival_ts") - F.pmod(F.unix_seconds("arrival_ts"), F.lit(3600))).alias("hour")
        rows = batch.where(F.col("order_id").isNotNull()).groupBy(hour).agg(F.hll_sketch_agg("order_id").alias("orders"))
        table.add(rows, batch_id)

    return add


def collected(stream: DataFrame, name: str, **kwargs) -> DataFrame:
    """Run an append-mode stream over all available input into a table and read it."""
    spark = stream.sparkSession
    path = scratch_path(spark, name)
    run_available(append_to(stream, f"{path}/data", f"{path}/checkpoint", **kwargs))
    return spark.read.schema(stream.schema).parquet(f"{path}/data")
