"""Column helpers: lenient casts, first-truthy, time and rounding rules. All run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from orderflow.schemas import FALSE_WORDS, TRUE_WORDS

ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"
_BLANK = " \t\r\n\f\u000b"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(_BLANK))


def strict_json(text: Column) -> Column:
    """The JSON value of a text that is one JSON document and nothing else, otherwise null.

    The parser itself stops after the first value; inside brackets, anything left over is an error. A bracket
    in the text could close them early, so such a text must also parse inside braces.
    """
    inside = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))), "$", "array<variant>")
    closed = ~F.contains(text, F.lit("]")) | F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}"))).isNotNull()
    return F.when((F.size(inside) == 1) & closed, F.get(inside, 0))


def truthy_sql(text: str, kind: str) -> str:
    """The text of a JSON value, or null where the value is null, empty, zero or false."""
    return f"""CASE WHEN {text} = '' OR ({kind} <> 'STRING' AND ({text} IN ('[]', '{{}}', 'false')
        OR coalesce(try_cast({text} AS DOUBLE) = 0, false))) THEN NULL ELSE {text} END"""


def bool_sql(text: str, kind: str) -> str:
    """JSON booleans and the usual words; numbers are not booleans."""
    words = {True: TRUE_WORDS, False: FALSE_WORDS}
    cases = " ".join(
        f"WHEN lower(btrim({text}, ' \\t\\r\\n')) IN ({', '.join(map(repr, w))}) THEN {str(v).lower()}" for v, w in words.items()
    )
    return f"CASE WHEN {kind} IN ('BOOLEAN', 'STRING') THEN CASE {cases} END END"


def timestamp_sql(text: str, kind: str) -> str:
    """JSON text as ISO-8601 (a full date at least), JSON number as epoch seconds."""
    clean = f"btrim({text}, ' \\t\\r\\n')"
    return rf"""CASE WHEN {kind} = 'STRING' THEN CASE WHEN {clean} RLIKE r'^\d{{4}}-\d{{2}}-\d{{2}}' THEN try_cast({clean} AS TIMESTAMP) END
        ELSE try_cast(try_cast({text} AS DOUBLE) AS TIMESTAMP) END"""


def iso_timestamp(text: Column) -> Column:
    """ISO-8601 text to a timestamp; text that does not start with a full date is rejected."""
    clean = strip(text)
    return F.when(clean.rlike(r"^\d{4}-\d{2}-\d{2}"), clean.try_cast("timestamp"))


def normalize_status(text: Column) -> Column:
    return F.upper(F.trim(text))


def non_empty(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def iso(ts: Column) -> Column:
    return F.date_format(ts, ISO_FORMAT)


def latency_ms(event_ts: Column, arrival_ts: Column) -> Column:
    """Event-to-consumer latency; a missing or zero event time counts as arrival time, never below 0."""
    known = F.coalesce(F.when(F.unix_micros(event_ts) != 0, event_ts), arrival_ts)
    return F.greatest(F.lit(0.0), (F.unix_micros(arrival_ts) - F.unix_micros(known)) / F.lit(1000.0))


def exact_avg(value: Column) -> Column:
    """Average from an exact decimal sum, so it does not depend on task order; plain where a value is too large for it."""
    exact = value.try_cast("decimal(38,12)")
    total = F.when(F.count(exact) == F.count(value), F.try_sum(exact).cast("double") / F.count(value))
    return F.coalesce(total, F.avg(value))


def rate_pct(part: Column, total: Column, digits: int = 1) -> Column:
    return F.when(total > 0, F.round(part * F.lit(100.0) / total, digits)).otherwise(F.lit(0.0))


def date_parts(ts: Column) -> dict[str, Column]:
    """Zero-padded UTC partition values."""
    return {
        "year": F.date_format(ts, "yyyy"),
        "month": F.date_format(ts, "MM"),
        "day": F.date_format(ts, "dd"),
        "hour": F.date_format(ts, "HH"),
    }


def lookup(mapping: dict[str, str], key: Column) -> Column:
    """Value of a small fixed mapping, null where the key is not in it."""
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.create_map(*pairs)[key]
