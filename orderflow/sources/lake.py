"""The event lake and other file sources and sinks."""

from __future__ import annotations

import operator
from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from orderflow.schemas import LAKE, LATENCY_SAMPLE, TABLES

PARTITIONS = ["year", "month", "day", "hour"]


def write_lake(events: DataFrame, path: str, fmt: str = "json", mode: str = "append") -> None:
    """Hour-partitioned lake. The rebalance hint groups rows per hour and splits hours that are too large."""
    events.hint("rebalance", *PARTITIONS).write.mode(mode).format(fmt).partitionBy(*PARTITIONS).save(path)


def read_lake(spark: SparkSession, path: str) -> DataFrame:
    """Lake scan with the declared schema; unreadable lines are dropped, partition values stay text."""
    return spark.read.schema(LAKE).option("mode", "DROPMALFORMED").json(path)


def days(first: str, last: str | None = None) -> Column:
    """Partition predicate for one UTC day or an inclusive range of days (``YYYY-MM-DD``): whole years, months, days.

    It compares the partition columns themselves, so that a catalog can prune by it too.
    """
    last = last or first
    parts = ("year", "month", "day")
    low, high = first.split("-"), last.split("-")
    same = next((i for i in range(3) if low[i] != high[i]), 3)  # leading parts that both ends share
    wanted = F.lit(True)
    for i in range(same):
        wanted = wanted & (F.col(parts[i]) == low[i])
    if same == 3:
        return wanted

    def inside(ends: list[str], strictly, or_at) -> Column:
        """On the inner side of an end: strictly in a leading part, or equal there and so in the rest."""
        inner = or_at(F.col("day"), ends[2])
        for i in range(1, same - 1, -1):
            inner = strictly(F.col(parts[i]), ends[i]) | ((F.col(parts[i]) == ends[i]) & inner)
        return inner

    return wanted & inside(low, operator.gt, operator.ge) & inside(high, operator.lt, operator.le)


def read_days(spark: SparkSession, path: str, first: str, last: str | None = None) -> DataFrame:
    """The days of a range, read from their folders alone: no other day is listed. Days without a folder have no rows."""
    at, end, months = date.fromisoformat(first), date.fromisoformat(last or first), {}
    while at <= end:
        months.setdefault(f"year={at:%Y}/month={at:%m}", []).append(f"{at:%d}")
        at += timedelta(days=1)
    glob = ",".join(f"{month}/day={{{','.join(inside)}}}" for month, inside in months.items())
    try:
        return spark.read.schema(LAKE).option("mode", "DROPMALFORMED").option("basePath", path).json(f"{path}/{{{glob}}}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LAKE)


def read_tables(spark: SparkSession, folder: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    """The six relational tables with their declared schemas, one subfolder each."""
    return {name: spark.read.schema(schema).format(fmt).load(f"{folder}/{name}") for name, schema in TABLES.items()}


def append_latency_samples(samples: DataFrame, path: str) -> None:
    samples.write.mode("append").json(path)


def read_latency_samples(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LATENCY_SAMPLE).json(path)


def write_report(report: DataFrame, path: str) -> None:
    """A report is one row whose columns become one JSON document."""
    report.write.mode("overwrite").json(path)
