"""Raw JSON payloads to one event record: decode, unbatch, classify by shape, and the reverse encoding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from orderflow.functions import scalars as X
from orderflow.schemas import NEXT_STATUS, PENDING, UNKNOWN, V2_TYPES

_COURIER_IN_TEXT = r"(?i)courier\s+(\d+)"
_ITEM = "map<string,variant>"


def decode(data: Column) -> Column:
    """Bytes to stripped text; broken UTF-8 becomes the replacement character."""
    return X.strip(F.make_valid_utf8(data.cast("string")))


def _raw_text(text: Column) -> Column:
    return F.try_parse_json(F.to_json(F.struct(text.alias("raw_text"))))


def _fold_frames(parts: Column) -> Column:
    """Join the parts of a line of glued documents (``{..}{..}``) until they parse, so that braces inside
    strings do not cut a document. ``open`` is what is left over at the end."""
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open"))

    def step(state: Column, part: Column) -> Column:
        # a one-element array carries the grown text and whether it is whole into the choice below
        grown = F.transform(F.array(F.concat(state["open"], part)), lambda t: F.struct(t.alias("t"), X.strict_json(t).isNotNull().alias("ok")))
        return F.get(
            F.transform(
                grown,
                lambda g: F.struct(
                    F.when(g["ok"], F.array_append(state["done"], g["t"])).otherwise(state["done"]).alias("done"),
                    F.when(g["ok"], F.lit("")).otherwise(g["t"]).alias("open"),
                ),
            ),
            0,
        )

    return F.aggregate(parts, start, step)


def unbatch(df: DataFrame, payload: str = "payload", split_frames: bool = False) -> DataFrame:
    """One row per JSON object: arrays and ``records`` lists are opened, scalars and empty text dropped.

    Adds ``pos`` (place in the payload), ``item`` (the object as a map) and ``parse_error``. Text that is
    no JSON stays as an object with the single key ``raw_text``.
    """
    others = [c for c in df.columns if c != payload]
    text = decode(F.col(payload))
    parsed = df.select(*others, text.alias("_text"))
    parsed = parsed.select("*", X.strict_json(F.col("_text")).alias("_json"))
    if split_frames:
        cut = F.when(F.col("_json").isNull(), F.split("_text", r"(?<=\})(?=\s*\{)"))
        parsed = parsed.select("*", cut.alias("_parts"))
        parsed = parsed.select("*", F.when(F.size("_parts") > 1, _fold_frames(F.col("_parts"))).alias("_folded"))
        documents = F.when(F.col("_folded.open") == "", F.transform("_folded.done", lambda t: F.try_parse_json(t)))
        parsed = parsed.select("*", documents.alias("_glued"))
    else:
        parsed = parsed.withColumn("_glued", F.lit(None).cast("array<variant>"))
    body = F.col("_json")
    # empty text gives no document here; a filter above would be pushed down and read the payload twice
    documents = (
        F.when(F.col("_text") == "", F.array().cast("array<variant>"))
        .when(F.col("_glued").isNotNull(), F.col("_glued"))
        .when(body.isNull(), F.array(_raw_text(F.col("_text"))))
        .otherwise(
            F.coalesce(
                F.try_variant_get(body, "$", "array<variant>"),
                F.try_variant_get(body, "$.records", "array<variant>"),
                F.array(body),
            )
        )
    )
    return (
        parsed.select(
            *others,
            (body.isNull() & F.col("_glued").isNull()).alias("parse_error"),
            F.posexplode(F.transform(documents, lambda d: F.try_variant_get(d, "$", _ITEM))).alias("pos", "item"),
        )
        .where(F.col("item").isNotNull())
    )


_TEXTS = [
    "event_type", "event_message", "from_status", "to_status", "new_status", "status", "order_status",
    "created_at", "timestamp", "is_available", "available",
]
_NESTED_TEXTS = ["order_status", "status", "created_at"]


def _record(rule: str, kind: str, form: str, time: str, order="NULL", status="NULL", courier="NULL", available="NULL"):
    """One branch of the rule chain: ``rule`` is its condition, the rest are SQL expressions of the fields."""
    return f"""WHEN {rule} THEN named_struct('event_type', {kind}, 'order_id', CAST({order} AS BIGINT),
        'status', CAST({status} AS STRING), 'courier_id', CAST({courier} AS BIGINT),
        'courier_available', CAST({available} AS BOOLEAN), 'format_name', {form}, 'event_ts', {time})"""


def classify(items: DataFrame, item: str = "item") -> DataFrame:
    """Replace the column ``item`` by the event record: the first rule whose keys are present decides.

    The steps are separate projections so that every JSON value is opened once per row.
    """
    kept = [c for c in items.columns if c != item]
    opened = items.selectExpr(
        *kept,
        f"map_keys({item}) AS keys",
        f"try_variant_get({item}['order'], '$', '{_ITEM}') AS nested",
        *[f"{item}['{n}'] AS v_{n}" for n in [*_TEXTS, "order_id", "courier_id"]],
    ).selectExpr("*", *[f"nested['{n}'] AS n_{n}" for n in [*_NESTED_TEXTS, "order_id", "courier_id"]])

    values = [f"v_{n}" for n in _TEXTS] + [f"n_{n}" for n in _NESTED_TEXTS]
    described = opened.selectExpr(
        *kept,
        "keys",
        "array_contains(map_keys(nested), 'order_id') AS has_nested",
        *[f"schema_of_variant({v}) AS k{v}" for v in values],
        *[f"try_variant_get({v}, '$', 'string') AS {v}" for v in values],
        *[f"try_variant_get({v}, '$', 'bigint') AS {v}" for v in ("v_order_id", "v_courier_id", "n_order_id", "n_courier_id")],
    ).selectExpr(
        *kept,
        "keys",
        "has_nested",
        # a key that holds JSON null reads as the word NONE
        "CASE WHEN array_contains(keys, 'event_type') THEN coalesce(upper(v_event_type), 'NONE') END AS type_word",
        *[f"{X.truthy_sql(v, 'k' + v)} AS {v}" for v in values if "available" not in v and "event_" not in v],
        *[c for n in ("v_created_at", "v_timestamp", "n_created_at") for c in (f"k{n}",)],
        "v_event_message",
        "v_from_status IS NULL AS no_origin",
        f"coalesce({X.bool_sql('v_is_available', 'kv_is_available')}, {X.bool_sql('v_available', 'kv_available')}) AS available",
        "v_order_id", "v_courier_id", "n_order_id", "n_courier_id",
    )
    v2_map = ", ".join(f"'{k}', '{v}'" for k, v in V2_TYPES.items())
    timed = described.selectExpr(
        "*",
        f"{X.timestamp_sql('v_created_at', 'kv_created_at')} AS created_time",
        f"{X.timestamp_sql('v_timestamp', 'kv_timestamp')} AS stamp_time",
        f"{X.timestamp_sql('n_created_at', 'kn_created_at')} AS nested_time",
        f"map({v2_map})[btrim(type_word, ' \\t\\r\\n')] AS v2_type",
        "coalesce(type_word, 'ORDER_EVENT') AS flat_type",
        "upper(coalesce(v_to_status, v_status, v_order_status)) AS flat_status",
        "array_contains(keys, 'order_id') AS has_order",
        "array_contains(keys, 'courier_id') AS has_courier",
    )

    def any_key(*names: str) -> str:
        return "arrays_overlap(keys, array(" + ", ".join(f"'{n}'" for n in names) + "))"

    # the first value that is there decides, even when it is no readable time
    created_first = "CASE WHEN v_created_at IS NOT NULL THEN created_time ELSE stamp_time END"
    stamp_first = "CASE WHEN v_timestamp IS NOT NULL THEN stamp_time ELSE created_time END"
    order_first = "CASE WHEN n_created_at IS NOT NULL THEN nested_time ELSE stamp_time END"
    in_text = f"try_cast(nullif(regexp_extract(coalesce(v_event_message, ''), r'{_COURIER_IN_TEXT}', 1), '') AS BIGINT)"
    rules = [
        _record(
            "has_order AND v2_type IS NOT NULL", "v2_type", "'flat_order_event_v2'", stamp_first, "v_order_id",
            "upper(coalesce(v_new_status, v_status, v_order_status))", "v_courier_id",
        ),
        _record(
            f"has_order AND {any_key('event_type', 'from_status', 'to_status')}",
            f"CASE WHEN flat_type = 'STATUS_CHANGE' AND no_origin AND flat_status = '{PENDING}' THEN 'ORDER_CREATED' ELSE flat_type END",
            "'flat_order_event'", created_first, "v_order_id", "flat_status", f"coalesce(v_courier_id, {in_text})",
        ),
        _record(
            f"has_order AND {any_key('status', 'order_status')}", "'STATUS_CHANGE'", "'status_update'", created_first,
            "v_order_id", "upper(coalesce(v_status, v_order_status))", "v_courier_id",
        ),
        _record(
            "has_nested", "'STATUS_CHANGE'", "'nested_order'", order_first, "n_order_id",
            "upper(coalesce(n_order_status, n_status))", "n_courier_id",
        ),
        _record(
            f"has_courier AND {any_key('is_available', 'available')}", "'COURIER_AVAILABILITY'", "'courier_availability'",
            created_first, courier="v_courier_id", available="available",
        ),
        _record(
            f"has_courier AND {any_key('latitude', 'lat')} AND {any_key('longitude', 'lon')}", "'COURIER_LOCATION'",
            "'courier_location'", created_first, "v_order_id", courier="v_courier_id",
            available="CASE WHEN v_order_id IS NOT NULL THEN false END",
        ),
        _record("true", f"'{UNKNOWN}'", "concat('unknown:', array_join(array_sort(keys), ','))", stamp_first),
    ]
    event = "CASE " + "\n".join(rules) + " END"
    # inline() keeps later filters on the record from copying the whole rule chain into every condition
    return timed.selectExpr(*kept, f"inline(array({event}))")


def normalize(df: DataFrame, payload: str = "payload", split_frames: bool = False) -> DataFrame:
    """Payload rows to event rows; all other columns are kept. Row-local, so it runs on streams as is."""
    return classify(unbatch(df, payload, split_frames))


def is_bad() -> Column:
    """Text that is no JSON, and objects of no known shape."""
    return F.col("parse_error") | F.col("event_type").eqNullSafe(UNKNOWN)


def quarantine(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, bad) rows."""
    return events.where(~is_bad()), events.where(is_bad())


def format_counts(events: DataFrame) -> DataFrame:
    return events.groupBy("format_name").agg(F.count(F.lit(1)).alias("total"))


def _document(**fields: Column) -> Column:
    return F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]), {"ignoreNullFields": "false"})


def encode(changes: DataFrame) -> DataFrame:
    """Order changes to the two published payload styles, with the stream's partition key.

    Input: event_id, order_id, event_type, from_status, to_status, event_message, latitude, longitude,
    created_at (ISO text), courier_id, client_id, restaurant_id.
    """
    c = F.col
    legacy = _document(
        event_id=c("event_id"), order_id=c("order_id"), event_type=c("event_type"), from_status=c("from_status"),
        to_status=c("to_status"), event_status=F.coalesce(X.non_empty(c("to_status")), c("from_status")),
        event_message=c("event_message"), latitude=c("latitude"), longitude=c("longitude"), created_at=c("created_at"),
    )
    key = c("order_id").cast("string")
    created = _document(
        event_type=F.lit("ORDER_CREATED"), order_id=key, client_id=c("client_id"), restaurant_id=c("restaurant_id"),
        status=c("to_status"), timestamp=c("created_at"),
    )
    changed = _document(
        event_type=F.lit("ORDER_STATUS_CHANGED"), order_id=key, old_status=c("from_status"), new_status=c("to_status"),
        timestamp=c("created_at"),
    )
    assigned = _document(
        event_type=F.lit("ORDER_COURIER_ASSIGNED"), order_id=key, courier_id=c("courier_id"), timestamp=c("created_at")
    )
    v2 = (
        F.when(c("event_type") == "COURIER_ASSIGNED", assigned)
        .when(c("from_status").isNull() & (c("to_status") == PENDING), created)
        .otherwise(changed)
    )
    both = F.array(
        F.struct(F.lit("legacy").alias("style"), F.concat(legacy, F.lit("\n")).alias("data")),
        F.struct(F.lit("v2").alias("style"), v2.alias("data")),
    )
    return changes.select("event_id", key.alias("partition_key"), F.explode(both).alias("_p")).select(
        "event_id", "partition_key", "_p.style", "_p.data"
    )


def is_valid_status(status: Column) -> Column:
    """Statuses of the delivery flow; PENDING, REJECTED and CANCELLED are outside it."""
    return X.normalize_status(status).isin(*NEXT_STATUS, *NEXT_STATUS.values())


def status_validity(events: DataFrame) -> DataFrame:
    """How often each status occurs, and whether it is one of the delivery flow."""
    counted = events.where(F.col("status").isNotNull()).groupBy("status").agg(F.count(F.lit(1)).alias("total"))
    return counted.select("status", "total", is_valid_status(F.col("status")).alias("valid"))
