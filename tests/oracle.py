"""Compare a registered query with its SQL twin run by DuckDB on the same files."""

from __future__ import annotations

import datetime
import decimal
import math
from collections import Counter

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    if isinstance(value, (bool, int, str, type(None))):
        return value
    if isinstance(value, (decimal.Decimal, datetime.datetime)):
        return str(value)
    raise TypeError(f"unexpected value {value!r}")


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def difference(con, frame, sql: str) -> str | None:
    """None when rows are equal as multisets, else a short description."""
    expected = con.execute(sql)
    names = [d[0] for d in expected.description]
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    want = _bag(names, expected.fetchall())
    got = _bag(frame.columns, [tuple(r) for r in frame.collect()])
    if want == got:
        return None
    missing, extra = want - got, got - want
    return (
        f"{sorted(names)}: rows {sum(got.values())} vs {sum(want.values())}; "
        f"missing {list(missing)[:3]} ({sum(missing.values())}); extra {list(extra)[:3]} ({sum(extra.values())})"
    )
