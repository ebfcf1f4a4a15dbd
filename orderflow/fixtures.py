"""The given tables recast as the inputs of this package (see FIXTURES.md). Every rule is row-local."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from orderflow.functions import scalars as X

# --- fixed values: how an event kind of the given tables reads as an order status ---
PRIOR_STATUS = {
    "PREPARING": "CONFIRMED",
    "READY_FOR_PICKUP": "PREPARING",
    "IN_TRANSIT": "PICKED_UP",
    "DELIVERED": "IN_TRANSIT",
    "CANCELLED": "PENDING",
}
STATUS_OF_KIND = {"signup": "PENDING", "view": "PREPARING", "purchase": "DELIVERED", "error": "CANCELLED"}
# --- end of fixed values ---


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Use all cores for per-row work when the input is one small file; large inputs have splits enough."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def from_events(raw: DataFrame) -> DataFrame:
    """Shared reading of the ``events`` table; works on batch and streaming frames alike."""
    k = F.get_json_object("props", "$.k").cast("long")
    ts = F.col("ts").cast("timestamp")
    click = F.when(k < 50, F.lit("READY_FOR_PICKUP")).otherwise(F.lit("IN_TRANSIT"))
    return raw.select(
        "event_id",
        ts.alias("ts"),
        F.col("user_id").alias("order_id"),
        F.col("event_type").alias("kind"),
        "value",
        k.alias("k"),
        F.when(F.col("event_type") == "click", click)
        .otherwise(X.lookup(STATUS_OF_KIND, F.col("event_type")))
        .alias("status"),
        F.timestamp_micros(F.unix_micros(ts) + k * 1_000_000).alias("arrival_ts"),
    )


def events(spark: SparkSession, folder: str) -> DataFrame:
    return from_events(table(spark, folder, "events"))


def order_events(base: DataFrame) -> DataFrame:
    """Rows of the event lake: every seventh row is a courier assignment without any status."""
    assigned = F.col("event_id") % 7 == 0
    status = F.when(~assigned, F.col("status"))
    prior = X.lookup(PRIOR_STATUS, status)
    return base.select(
        "event_id",
        "order_id",
        F.when(assigned, F.lit("COURIER_ASSIGNED")).otherwise(F.lit("STATUS_CHANGE")).alias("event_type"),
        prior.alias("from_status"),
        status.alias("to_status"),
        F.coalesce(status, prior).alias("event_status"),
        F.when(assigned, F.format_string("Courier %d assigned", F.col("k")))
        .otherwise(F.format_string("Order status changed from %s to %s", F.coalesce(prior, F.lit("None")), status))
        .alias("event_message"),
        F.lit(None).cast("double").alias("latitude"),
        F.lit(None).cast("double").alias("longitude"),
        X.iso(F.col("ts")).alias("created_at"),
        *[c.alias(n) for n, c in X.date_parts(F.col("arrival_ts")).items()],
    )


def raw_events(base: DataFrame) -> DataFrame:
    """JSON payload text in every known shape, chosen by the last digit of the event id."""

    def doc(**fields: str) -> str:
        pairs = ", ".join(f"'{name}', {value}" for name, value in fields.items())
        return f"to_json(named_struct({pairs}), map('ignoreNullFields', 'false'))"

    prior = " ".join(f"WHEN '{s}' THEN '{p}'" for s, p in PRIOR_STATUS.items())
    seconds = "unix_seconds(ts)"
    signals = [
        doc(courier_id="k", is_available="'yes'", timestamp=seconds),
        doc(courier_id="k", available="' No '", timestamp=seconds),
        doc(courier_id="k", is_available="true", timestamp=seconds),
        doc(courier_id="k", is_available="'0'", timestamp=seconds),
        doc(courier_id="k", is_available="1", timestamp=seconds),
    ]
    lat, lon = "-23.7D + k / 1000", "-46.8D + k / 500"
    shapes = [
        doc(event_type="'ORDER_CREATED'", order_id="o", client_id="order_id", restaurant_id="k", status="'PENDING'", timestamp="stamp"),
        doc(event_type="'ORDER_STATUS_CHANGED'", order_id="o", old_status="'PENDING'", new_status="status", timestamp="stamp"),
        doc(event_type="'ORDER_COURIER_ASSIGNED'", order_id="o", courier_id="k", timestamp="stamp"),
        doc(
            event_id="event_id", order_id="order_id", event_type="'STATUS_CHANGE'", from_status=f"CASE status {prior} END",
            to_status="status", event_status="status", event_message="'changed'", latitude="CAST(NULL AS DOUBLE)", created_at="stamp",
        ),
        doc(
            event_id="event_id", order_id="order_id", event_type="'courier_assigned'", from_status="CAST(NULL AS STRING)",
            to_status="CAST(NULL AS STRING)", event_message="concat('Courier ', k, ' assigned')", created_at="stamp",
        ),
        doc(
            order="named_struct('order_id', order_id, 'order_status', lower(status), 'courier_id', k, 'created_at', stamp)",
            timestamp="'not a time'",
        ),
        "CASE turn % 5 " + " ".join(f"WHEN {i} THEN {signal}" for i, signal in enumerate(signals)) + " END",
        f"CASE WHEN turn % 2 = 0 THEN {doc(courier_id='k', lat=lat, lon=lon, order_id='order_id')} "
        f"ELSE {doc(courier_id='k', latitude=lat, longitude=lon)} END",
        f"CASE WHEN turn % 2 = 0 THEN concat('garbage ', event_id) ELSE {doc(zz='1', aa='k', timestamp='stamp')} END",
        doc(order_id="order_id", status="lower(status)"),
    ]
    cases = " ".join(f"WHEN {digit} THEN {shape}" for digit, shape in enumerate(shapes))
    # some orders never get a courier
    digit = "CASE WHEN order_id % 7 = 3 AND event_id % 10 IN (2, 4) THEN 9 ELSE event_id % 10 END"
    return base.select(
        "*",
        X.iso(F.col("ts")).alias("stamp"),
        F.col("order_id").cast("string").alias("o"),
        F.expr("event_id div 10").alias("turn"),
    ).selectExpr("event_id", "arrival_ts", f"CASE {digit} {cases} END AS payload")


def _lat(key: Column, step: int) -> Column:
    return -23.7 + (key * step % 250) / 1000


def _lon(key: Column, step: int) -> Column:
    return -46.8 + (key * step % 400) / 1000


def users(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, folder, "customer").select(
        key.alias("user_id"),
        F.col("c_name").alias("user_name"),
        F.concat(F.lit("u"), F.floor("c_acctbal").cast("string"), F.lit("@example.com")).alias("email"),
        F.lit(None).cast("string").alias("phone"),
        _lat(key, 37).alias("latitude"),
        _lon(key, 91).alias("longitude"),
        F.when(F.col("c_mktsegment") == "MACHINERY", F.lit("machine"))
        .when(F.col("c_acctbal") > 0, F.lit("courier"))
        .otherwise(F.lit("client"))
        .alias("user_type"),
    )


def couriers(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "customer")
        .where(F.col("c_mktsegment") != "MACHINERY")
        .select(
            F.col("c_custkey").alias("user_id"),
            F.element_at(
                F.array(F.lit("bike"), F.lit("motorcycle"), F.lit("car")), (F.col("c_custkey") % 3 + 1).cast("int")
            ).alias("vehicle_type"),
            (F.col("c_acctbal") > 0).alias("is_available"),
        )
    )


def restaurants(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("s_suppkey")
    return table(spark, folder, "supplier").select(
        key.alias("restaurant_id"),
        F.col("s_name").alias("restaurant_name"),
        F.concat(F.lit("cuisine "), F.col("s_nationkey").cast("string")).alias("cuisine_type"),
        _lat(key, 53).alias("restaurant_latitude"),
        _lon(key, 29).alias("restaurant_longitude"),
        key.alias("creator_user_id"),
    )


def orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders of the read model; the restaurant is the order key folded onto the supplier keys."""
    suppliers = table(spark, folder, "supplier").agg(F.count(F.lit(1)).alias("n")).scalar()
    status = {"F": "DELIVERED", "O": "PREPARING", "P": "READY_FOR_PICKUP"}
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("client_id"),
        (F.col("o_orderkey") % suppliers).alias("restaurant_id"),
        F.when(F.col("o_custkey") % 3 != 0, F.col("o_custkey")).alias("courier_id"),
        X.lookup(status, F.col("o_orderstatus")).alias("order_status"),
        F.col("o_orderdate").cast("timestamp").alias("created_at"),
    )


def order_items(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part").select("p_partkey", "p_name")
    return (
        table(spark, folder, "lineitem")
        .select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").cast("long").alias("line"),
            F.col("p_name").alias("item_name"),
            F.col("l_quantity").cast("long").alias("quantity"),
        )
    )


def road_edges(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        F.col("l_partkey").alias("u"), (F.col("l_suppkey") + 1_000_000_000).alias("v"), (F.col("l_quantity") * 100).alias("length")
    )


def road_nodes(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part").select(F.col("p_partkey").alias("key"), F.col("p_partkey").alias("id"))
    suppliers = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("key"), (F.col("s_suppkey") + 1_000_000_000).alias("id")
    )
    return parts.unionByName(suppliers).select(
        "id", _lon(F.col("key"), 71).alias("x"), _lat(F.col("key"), 43).alias("y")
    )


def request_log(base: DataFrame) -> DataFrame:
    """Requests of a load run: a run is one order on one day, signups create, the others poll."""
    k = F.col("k")
    code = F.when(k < 2, 404).when((F.col("kind") == "error") & (k % 5 == 0), 500).otherwise(200)
    create = F.col("kind") == "signup"
    return base.select(
        F.concat_ws("/", F.col("order_id").cast("string"), F.date_format("ts", "yyyy-MM-dd")).alias("run_id"),
        F.col("event_id").alias("seq"),
        F.col("ts").alias("sent_at"),
        F.col("kind").alias("endpoint"),
        create.alias("is_create"),
        code.alias("status_code"),
        (F.col("value") + k / F.lit(1_000_000.0)).alias("latency_ms"),
        (k % 10 != 9).alias("has_json"),
        F.when(k % 10 != 8, F.col("order_id")).alias("order_id"),
        F.col("status").alias("order_status"),
    )


def pipeline_snapshots(base: DataFrame) -> DataFrame:
    """What each pipeline shows when it emits: produced, processed and emit times of its last event."""
    return base.select(
        F.col("event_id").alias("seq"),
        F.col("kind").alias("pipeline"),
        F.unix_millis("ts").alias("produced_at_ms"),
        (F.unix_millis("ts") + F.col("value").cast("long")).alias("processed_at_ms"),
        (F.unix_millis("ts") + F.col("k") * 2000).alias("emitted_at_ms"),
        F.col("value").alias("latency_last_ms"),
        (F.col("value") / 2).alias("latency_avg_1m_ms"),
        F.col("k").alias("events_per_minute"),
        F.col("order_id").alias("total_orders"),
    )
