"""Append-only stores: the courier position log and named snapshots with a lifetime."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from orderflow.schemas import COURIER_POSITION, SNAPSHOT_ENVELOPE

SNAPSHOT_TTL_SECONDS = 120
NO_ORDER = "none"


def append_positions(positions: DataFrame, path: str) -> None:
    """``positions``: courier_id, timestamp (ISO text), latitude, longitude, order_id or null."""
    positions.select(
        F.col("courier_id").cast("string").alias("courier_id"),
        "timestamp",
        F.col("latitude").cast("decimal(10,7)").alias("latitude"),
        F.col("longitude").cast("decimal(10,7)").alias("longitude"),
        F.coalesce(F.col("order_id").cast("string"), F.lit(NO_ORDER)).alias("order_id"),
    ).write.mode("append").parquet(path)


def read_positions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(COURIER_POSITION).parquet(path)


def write_snapshots(snapshots: DataFrame, path: str, source: str = "store") -> None:
    """``snapshots``: name, stored_at, payload (JSON text). Every write is kept; readers take the newest."""
    snapshots.select("name", F.lit(source).alias("source"), "stored_at", "payload").write.mode("append").parquet(path)


def read_snapshots(
    spark: SparkSession, path: str, as_of: Column | None = None, ttl_seconds: int = SNAPSHOT_TTL_SECONDS
) -> DataFrame:
    """Newest living snapshot per name as of ``as_of`` (default: the newest write)."""
    stored = spark.read.schema(SNAPSHOT_ENVELOPE).parquet(path)
    now = as_of if as_of is not None else stored.agg(F.max("stored_at").alias("t")).scalar()
    alive = stored.where(F.unix_micros("stored_at") > F.unix_micros(now) - ttl_seconds * 1_000_000)
    newest = alive.groupBy("name").agg(F.max_by(F.struct("source", "stored_at", "payload"), "stored_at").alias("_s"))
    return newest.select("name", "_s.*")
