"""Exact percentiles per group without holding a group's values in one task.

Values are first counted per (group, value); the running count along the value gives every value its rank
range, and a percentile is then a conditional maximum. Groups are cut along the value (see ``ordered``): by its leading
digits, and a cut with many values further, between its least and its largest one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from orderflow.operators import ordered


#: Distinct values from which on values with the same leading digits are cut further.
SLICE_VALUES = 65_536


def sliced(counts: DataFrame, groups: list[str], value: str) -> DataFrame:
    """Distinct values marked with slices that grow with the value; counts and bounds are exact, so a retry cuts alike."""
    rough = counts.withColumn("_rough", ordered.value_slice(F.col(value)))
    size = F.col(value).cast("double")
    crowded = rough.groupBy(*groups, "_rough").agg(
        F.count(F.lit(1)).alias("_many"), F.min(size).alias("_low"), F.max(size).alias("_high")
    )
    crowded = crowded.where(F.col("_many") > SLICE_VALUES)
    joined = ordered.join_same(rough, crowded, [*groups, "_rough"], "left")
    parts = F.ceil(F.col("_many") / SLICE_VALUES)
    part = F.least(F.floor(F.try_divide(size - F.col("_low"), F.col("_high") - F.col("_low")) * parts), parts - 1)
    marked = ordered.mark(joined, F.shiftleft(F.col("_rough"), 31) + F.coalesce(part, F.lit(0)))
    return marked.select(*counts.columns, ordered.SLICE)


def ranked_values(df: DataFrame, groups: list[str], value: str) -> DataFrame:
    """Distinct values per group with their 0-based rank range ``[lo, hi)`` and the group's size ``n``."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*groups, value).agg(F.count(F.lit(1)).alias("_c"))
    ranks = ordered.carry(sliced(counts, groups, value), groups, [value], running_sum={"hi": F.col("_c")})
    totals = counts.groupBy(*groups).agg(F.sum("_c").alias("n"))
    return ordered.join_same(ranks, totals, groups).select(*groups, value, (F.col("hi") - F.col("_c")).alias("lo"), "hi", "n")


def _at(value: str, rank: Column) -> Column:
    """The value whose rank range holds ``rank``."""
    return F.max(F.when((F.col("lo") <= rank) & (rank < F.col("hi")), F.col(value)))


def linear(value: str, p: float) -> Column:
    """Linear interpolation on rank ``(n - 1) * p``; an aggregate over ranked values."""
    rank = (F.col("n") - 1) * F.lit(p)
    lower = F.floor(rank)
    weight = F.max(rank - lower)
    low, high = _at(value, lower), _at(value, F.least(lower + 1, F.col("n") - 1))
    return low * (F.lit(1.0) - weight) + high * weight


def exclusive(value: str, percent: int) -> Column:
    """Interpolation on rank ``(n + 1) * percent / 100``, kept inside the data; one value is itself."""
    product, n = (F.col("n") + 1) * percent, F.col("n")
    j = F.greatest(F.least(F.floor(product / 100), n - 1), F.lit(1))
    delta = F.max(product - j * 100)
    between = (_at(value, j - 1) * (100 - delta) + _at(value, j) * delta) / F.lit(100.0)
    return F.when(F.max(n) == 1, F.max(value)).otherwise(between)


def percentiles(df: DataFrame, groups: list[str], value: str, wanted: dict[str, Column]) -> DataFrame:
    """``wanted`` maps output names to ``linear`` / ``exclusive`` expressions on ``value``."""
    ranked = ranked_values(df, groups, value)
    return ranked.groupBy(*groups).agg(*[c.alias(name) for name, c in wanted.items()])
