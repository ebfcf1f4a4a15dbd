"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from orderflow.session import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(column: Column) -> Column:
    """Lower-case A-Z only; other letters stay."""
    return F.translate(column, UPPER, LOWER)


def hashable(df: DataFrame) -> list[Column]:
    """The columns a row hash can take in (maps have no order, so Spark hashes none)."""
    return [df[f"`{name}`"] for name, kind in df.dtypes if "map<" not in kind and kind != "variant"]


def null_last_key(column: Column) -> Column:
    """A non-null string that sorts like the column in code-point order, null last."""
    return F.when(column.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), column))


def in_slices(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Rows dealt once into ranges of ``order``, the range in ``_slice``; stored, so that all readers see one dealing."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialize(df.repartitionByRange(parts, *order).withColumn("_slice", F.spark_partition_id()), name)


def running_totals(sliced: DataFrame, order: list[Column], values: dict[str, Column]) -> DataFrame:
    """For every row the sums of ``values`` over all rows before it; one window per slice, one row per slice carried on."""
    slices = sliced.groupBy("_slice").agg(*(F.sum(v).alias(f"_all_{k}") for k, v in values.items()))
    before = W.orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)  # one row per slice
    base = slices.select("_slice", *(F.coalesce(F.sum(f"_all_{k}").over(before), F.lit(0)).alias(f"_base_{k}") for k in values))
    inside = W.partitionBy("_slice").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    rows = sliced.join(base, "_slice")
    for k, v in values.items():
        rows = rows.withColumn(k, F.col(f"_base_{k}") + F.coalesce(F.sum(v).over(inside), F.lit(0)))
    return rows.drop(*(f"_base_{k}" for k in values))
