"""Read model of orders, users, couriers and restaurants: joins, upserts and data-quality checks.

Joins carry no broadcast hints: the small sides are broadcast by Spark when their measured size allows it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from orderflow.functions import scalars as X
from orderflow.session import materialize
from orderflow.schemas import USER_TYPES

#: Requests that one task judges one after another, three numbers each.
REPLAYED = 1_000_000


def courier_directory(couriers: DataFrame, users: DataFrame) -> DataFrame:
    """Couriers with their user's name and place, by id; couriers without a user vanish."""
    return (
        couriers.join(users.select("user_id", "user_name", "latitude", "longitude"), "user_id")
        .select(
            F.col("user_id").alias("courier_id"),
            F.col("user_name").alias("name"),
            "vehicle_type",
            "is_available",
            F.col("latitude").alias("lat"),
            F.col("longitude").alias("lon"),
        )
        .orderBy("courier_id")
    )


def available_couriers(couriers: DataFrame, users: DataFrame) -> DataFrame:
    return (
        courier_directory(couriers.where("is_available"), users)
        .select(F.col("courier_id").alias("id"), "name", "vehicle_type", "lat", "lon")
        .orderBy("id")
    )


def with_coordinates(couriers: DataFrame) -> DataFrame:
    return couriers.where(F.col("lat").isNotNull() & F.col("lon").isNotNull())


def restaurant_list(restaurants: DataFrame) -> DataFrame:
    return restaurants.select(
        "restaurant_id", "restaurant_name", "cuisine_type", "restaurant_latitude", "restaurant_longitude"
    ).orderBy("restaurant_id")


def dispatch_data(orders: DataFrame, users: DataFrame, restaurants: DataFrame) -> DataFrame:
    """What a dispatcher needs per order; orders without a known client or restaurant vanish."""
    clients = users.select(
        F.col("user_id").alias("client_id"),
        F.col("latitude").alias("client_latitude"),
        F.col("longitude").alias("client_longitude"),
    )
    places = restaurants.select("restaurant_id", "restaurant_latitude", "restaurant_longitude")
    return (
        orders.join(clients, "client_id")
        .join(places, "restaurant_id")
        .select(
            "order_id",
            "client_id",
            "restaurant_id",
            "client_latitude",
            "client_longitude",
            "restaurant_latitude",
            "restaurant_longitude",
            "order_status",
            "courier_id",
        )
    )


def order_detail(orders: DataFrame, items: DataFrame, events: DataFrame, order_id: int | None = None) -> DataFrame:
    """Order documents as sorted lines: the order, its items by name, its events by time.

    Lines instead of nested lists keep any order's size unbounded. The lines of an order stand together and in
    document order; orders stand in no order. With ``order_id`` the filter reaches all three scans.
    """
    if order_id is not None:
        orders, items, events = (df.where(F.col("order_id") == order_id) for df in (orders, items, events))
    known = orders.select("order_id")
    header = orders.select(
        "order_id", F.lit(0).alias("section"), X.iso(F.col("created_at")).alias("created_at"),
        "client_id", "restaurant_id", "courier_id", F.col("order_status").alias("label"),
    )
    lines = items.join(known, "order_id", "left_semi").select(
        "order_id", F.lit(1).alias("section"), F.col("line").alias("sort_id"), F.col("item_name").alias("label"), "quantity"
    )
    steps = events.join(known, "order_id", "left_semi").select(
        "order_id", F.lit(2).alias("section"), "created_at", F.col("event_id").alias("sort_id"), F.col("event_type").alias("label"),
        "from_status", "to_status", "event_status", "event_message", "latitude", "longitude",
    )
    rows = header.unionByName(lines, allowMissingColumns=True).unionByName(steps, allowMissingColumns=True)
    text = F.when(F.col("section") == 1, F.col("label")).otherwise(F.col("created_at"))
    return rows.repartition("order_id").sortWithinPartitions("order_id", "section", text, "sort_id")


def insert_if_absent(existing: DataFrame, rows: DataFrame, key: str, order: str) -> DataFrame:
    """Add rows whose key is not there yet; of several new rows with one key the first by ``order`` wins."""
    cols = existing.columns
    first = rows.groupBy(key).agg(F.min_by(F.struct(*cols), order).alias("_r")).select("_r.*")
    return existing.unionByName(first.join(existing.select(key), key, "left_anti").select(*cols))


def upsert(existing: DataFrame, changes: DataFrame, key: str, order: str) -> DataFrame:
    """Replace or add whole rows; of several changes to one key the last by ``order`` wins."""
    others = [c for c in existing.columns if c != key]
    last = changes.groupBy(key).agg(F.max_by(F.struct(*others), order).alias("_new"))
    merged = existing.select(key, F.struct(*others).alias("_old")).join(last, key, "full_outer")
    return merged.select(key, F.coalesce("_new", "_old").alias("_row")).select(key, "_row.*")


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_key: str, name: str) -> DataFrame:
    """Rows of ``child`` whose reference is missing in ``parent``; references are counted per value first."""
    refs = child.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("_ref")).agg(F.count(F.lit(1)).alias("_n"))
    missing = refs.join(parent.select(F.col(parent_key).alias("_ref")), "_ref", "left_anti")
    return missing.agg(
        F.lit(name).alias("reference"),
        F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("orphan_rows"),
        F.count(F.lit(1)).alias("orphan_keys"),
    )


def fk_orphans(tables: dict[str, DataFrame]) -> DataFrame:
    """Orphan counts of the seven references between the tables."""
    t = tables
    checks = [
        orphans(t["couriers"], "user_id", t["users"], "user_id", "couriers.user_id"),
        orphans(t["restaurants"], "creator_user_id", t["users"], "user_id", "restaurants.creator_user_id"),
        orphans(t["orders"], "client_id", t["users"], "user_id", "orders.client_id"),
        orphans(t["orders"], "restaurant_id", t["restaurants"], "restaurant_id", "orders.restaurant_id"),
        orphans(t["orders"], "courier_id", t["couriers"], "user_id", "orders.courier_id"),
        orphans(t["order_events"], "order_id", t["orders"], "order_id", "order_events.order_id"),
        orphans(t["order_items"], "order_id", t["orders"], "order_id", "order_items.order_id"),
    ]
    return reduce(DataFrame.unionByName, checks)


def _violations(df: DataFrame, table: str, rules: dict[str, Column]) -> DataFrame:
    """One scan per table: rows that break each rule."""
    counted = df.agg(*[F.count_if(broken).alias(rule) for rule, broken in rules.items()])
    return counted.unpivot([], list(rules), "rule", "violations").select(
        F.concat(F.lit(f"{table}."), "rule").alias("rule"), "violations"
    )


def constraint_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows breaking each column constraint, and rows sharing an e-mail with another."""

    def missing(*cols: str) -> dict[str, Column]:
        return {f"{c} not null": F.col(c).isNull() for c in cols}

    t = tables
    parts = [
        _violations(
            t["users"],
            "users",
            {**missing("user_name", "user_type"), "user_type known": ~F.col("user_type").isin(USER_TYPES)},
        ),
        _violations(t["restaurants"], "restaurants", missing("restaurant_name")),
        _violations(t["orders"], "orders", missing("client_id", "restaurant_id", "order_status")),
        _violations(t["order_events"], "order_events", missing("order_id", "event_type")),
        _violations(
            t["order_items"],
            "order_items",
            {**missing("order_id", "item_name", "quantity"), "quantity positive": F.col("quantity") <= 0},
        ),
    ]
    shared = t["users"].where(F.col("email").isNotNull()).groupBy("email").agg(F.count(F.lit(1)).alias("n"))
    parts.append(
        shared.agg(
            F.lit("users.email unique").alias("rule"),
            F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).cast("long").alias("violations"),
        )
    )
    return reduce(DataFrame.unionByName, parts)


def _replay(requests: DataFrame) -> DataFrame:
    """A bounded number of requests, judged one after another in one task, with ``taken``."""

    def replay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orders, couriers = set(), set()
        for batch in batches:
            keep = []
            for order, courier in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                keep.append(order not in orders and courier not in couriers)
                if keep[-1]:
                    orders.add(order)
                    couriers.add(courier)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keep, pa.bool_())], [*batch.schema.names, "taken"])

    judged = T.StructType([*requests.schema.fields, T.StructField("taken", T.BooleanType())])
    return requests.coalesce(1).sortWithinPartitions("seq").mapInArrow(replay, judged)


def _greedy(edges: DataFrame, prefix: int = REPLAYED) -> DataFrame:
    """Of (order_id, courier_id, seq), those accepted one after another by seq while order and courier are both free.

    A request that is the earliest left for its order and for its courier is accepted whatever the others do, so each
    round accepts all of these and drops the requests that share an order or a courier with one. Nothing before the first
    ``prefix`` requests that are left can decide on them, so the round then replays these in one task: long chains
    of decisions end in as many rounds as they have prefixes.
    """

    def without(left: DataFrame, taken: DataFrame) -> DataFrame:
        return left.join(taken.select("order_id"), "order_id", "left_anti").join(taken.select("courier_id"), "courier_id", "left_anti")

    columns = ["order_id", "courier_id", "seq"]
    left = materialize(edges.select(*columns), "requests-open")
    accepted = left.limit(0)
    while not left.isEmpty():
        by_order = left.groupBy("order_id").agg(F.min("seq").alias("_o"))
        by_courier = left.groupBy("courier_id").agg(F.min("seq").alias("_c"))
        first = left.join(by_order, "order_id").join(by_courier, "courier_id").where("seq = _o and seq = _c")
        taken = materialize(first.select(*columns), "requests-taken")
        left = materialize(without(left, taken).select(*columns), "requests-open")
        replayed = materialize(_replay(left.orderBy("seq").limit(prefix)), "requests-replayed")
        judged, last = replayed.agg(F.count(F.lit(1)), F.max("seq")).first()
        replayed = replayed.where("taken").drop("taken")
        accepted = accepted.unionByName(taken).unionByName(replayed)
        if judged < prefix:
            return accepted
        left = materialize(without(left.where(F.col("seq") > F.lit(last)), replayed).select(*columns), "requests-open")
    return accepted


def assignment_conflicts(requests: DataFrame, orders: DataFrame, couriers: DataFrame) -> DataFrame:
    """Outcome of each assignment request, judged one after another by ``seq`` on what those before it left.

    ``requests``: order_id, courier_id, seq (unique). A request for an order of another courier is refused; otherwise
    its courier becomes unavailable, and it is refused if that changed nothing and the order has no courier yet.
    """
    current = orders.select("order_id", F.col("courier_id").alias("held_by"), F.lit(True).alias("order_known"))
    free = couriers.select(F.col("user_id").alias("courier_id"), F.col("is_available").alias("free"))
    checked = requests.join(current, "order_id", "left").join(free, "courier_id", "left")
    checked = checked.withColumn("free", F.coalesce("free", F.lit(False)))
    same = F.col("held_by").eqNullSafe(F.col("courier_id")) & F.col("held_by").isNotNull()
    # a repeated assignment of a stored pair makes the courier unavailable as well
    gone = checked.where(same).groupBy("courier_id").agg(F.min("seq").alias("gone_from"))
    checked = materialize(checked.join(gone, "courier_id", "left"), "requests")
    may_take = F.col("order_known") & F.col("held_by").isNull() & F.col("free")
    may_take = may_take & (F.col("gone_from").isNull() | (F.col("seq") < F.col("gone_from")))
    accepted = _greedy(checked.where(may_take).select("order_id", "courier_id", "seq"))
    taken = accepted.select("order_id", F.col("courier_id").alias("taken_by"), F.col("seq").alias("taken_at"))
    seq, later = F.col("seq"), F.col("taken_at").isNotNull() & (F.col("taken_at") < F.col("seq"))
    outcome = (
        F.when(F.col("order_known").isNull(), F.lit("order_not_found"))
        .when(F.col("held_by").isNotNull() & (F.col("held_by") != F.col("courier_id")), F.lit("assigned_to_another"))
        .when(F.col("held_by").isNotNull() | later & (F.col("taken_by") == F.col("courier_id")), F.lit("already_assigned"))
        .when(later, F.lit("order_taken_earlier"))
        .when((F.col("taken_at") == seq) & (F.col("taken_by") == F.col("courier_id")), F.lit("assigned"))
        .when(~F.col("free"), F.lit("courier_unavailable"))
        .otherwise(F.lit("courier_taken_earlier"))
    )
    return checked.join(taken, "order_id", "left").select("order_id", "courier_id", "seq", outcome.alias("outcome"))


def latest_location(positions: DataFrame) -> DataFrame:
    """Newest logged position per courier."""
    rest = [c for c in positions.columns if c != "courier_id"]
    return positions.groupBy("courier_id").agg(F.max_by(F.struct(*rest), "timestamp").alias("_p")).select("courier_id", "_p.*")
