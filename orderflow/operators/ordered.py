"""Order-dependent values per key (previous, last known, running sum) that stay parallel on hot keys.

A plain window puts all rows of a key into one task. Every key is therefore cut into slices along its order, by one
rule for all keys: the window runs inside a slice and the state at the end of each slice is carried to the next one
through a table with one row per slice. The result is the plain window's result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

SLICE = "_slice"


def join_same(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on equal keys where null equals null, keeping the key columns once, as grouping treats them."""
    renamed = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(renamed, same, how).drop(*[f"_r_{k}" for k in keys])


def time_slice(ts: Column, seconds: int = 60) -> Column:
    return F.floor(F.unix_seconds(ts) / F.lit(seconds))


def value_slice(value: Column) -> Column:
    """Slice number that grows with the value: decimal exponent and three leading digits."""
    size = F.abs(value.cast("double"))
    exponent = F.floor(F.log10(size))
    lead = F.floor(size / F.pow(F.lit(10.0), exponent - 2))
    number = F.when(size < 1e-9, F.lit(0)).otherwise((exponent + 10) * 1000 + lead)
    return (F.signum(value.cast("double")) * number).cast("long")


def mark(df: DataFrame, slice_by: Column) -> DataFrame:
    """Add the slice column."""
    return df.withColumn(SLICE, slice_by.cast("long"))


def carry(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    previous: dict[str, Column] | None = None,
    last_known: dict[str, Column] | None = None,
    running_sum: dict[str, Column] | None = None,
) -> DataFrame:
    """Add per-key values along ``order`` (which must be unique within a key).

    ``previous``: value of the row before; ``last_known``: last non-null value up to this row;
    ``running_sum``: sum up to this row.
    """
    previous, last_known, running_sum = previous or {}, last_known or {}, running_sum or {}
    split = SLICE in df.columns
    part = keys + [SLICE] if split else keys
    by_order = Window.partitionBy(*part).orderBy(*order)
    so_far = by_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    local = df.select(
        "*",
        *[F.lag(F.struct(v.alias("v"))).over(by_order).alias(n) for n, v in previous.items()],
        *[F.last(v, ignorenulls=True).over(so_far).alias(n) for n, v in last_known.items()],
        *[F.sum(v).over(so_far).alias(n) for n, v in running_sum.items()],
    )
    if not split:
        return local.select(
            *df.columns,
            *[F.col(n)["v"].alias(n) for n in previous],
            *last_known,
            *running_sum,
        )

    position = F.struct(*order)
    ends = df.groupBy(*part).agg(
        *[F.max_by(F.struct(v.alias("v")), position).alias(f"_end_{n}") for n, v in previous.items()],
        *[F.max_by(v, F.when(v.isNotNull(), position)).alias(f"_end_{n}") for n, v in last_known.items()],
        *[F.sum(v).alias(f"_end_{n}") for n, v in running_sum.items()],
    )
    # one row per slice and key
    by_slice = Window.partitionBy(*keys).orderBy(SLICE)
    before = by_slice.rowsBetween(Window.unboundedPreceding, -1)
    starts = ends.select(
        *part,
        *[F.lag(f"_end_{n}").over(by_slice).alias(f"_start_{n}") for n in previous],
        *[F.last(f"_end_{n}", ignorenulls=True).over(before).alias(f"_start_{n}") for n in last_known],
        *[F.sum(f"_end_{n}").over(before).alias(f"_start_{n}") for n in running_sum],
    )
    joined = join_same(local, starts, part)
    return joined.select(
        *df.columns,
        *[F.coalesce(F.col(n), F.col(f"_start_{n}"))["v"].alias(n) for n in previous],
        *[F.coalesce(F.col(n), F.col(f"_start_{n}")).alias(n) for n in last_known],
        # a sum over no earlier slice, or over nulls only, adds nothing
        *[
            F.when(F.col(n).isNull(), F.col(f"_start_{n}"))
            .otherwise(F.col(n) + F.coalesce(F.col(f"_start_{n}"), F.lit(0)))
            .alias(n)
            for n in running_sum
        ],
    )
