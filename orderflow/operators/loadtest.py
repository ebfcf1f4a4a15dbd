"""Statistics of a load run from its request log.

The log has one row per request: ``run_id, seq, sent_at, endpoint, is_create, status_code, latency_ms, has_json,
order_id, order_status``. A transport error has status code 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from orderflow.functions import scalars as X
from orderflow.operators import quantiles as Q
from orderflow.operators.ordered import join_same
from orderflow.schemas import DELIVERED


def succeeded() -> Column:
    return F.col("status_code").between(200, 299)


def endpoint_p95(log: DataFrame) -> DataFrame:
    return Q.percentiles(log, ["endpoint"], "latency_ms", {"p95_latency": Q.exclusive("latency_ms", 95)})


def endpoint_metrics(log: DataFrame) -> DataFrame:
    base = log.groupBy("endpoint").agg(
        F.count(F.lit(1)).alias("total_requests"),
        F.count_if(succeeded()).alias("success"),
        F.count_if(~succeeded()).alias("errors"),
        X.exact_avg(F.col("latency_ms")).alias("avg_latency"),
        F.min("latency_ms").alias("min_latency"),
        F.max("latency_ms").alias("max_latency"),
    )
    return join_same(base, endpoint_p95(log), ["endpoint"], "left")


def order_outcomes(log: DataFrame) -> DataFrame:
    """One row per run: whether the order was accepted and delivered, or the first reason it was not."""
    ok, create = succeeded(), F.col("is_create")
    poll = ~create
    runs = log.groupBy("run_id").agg(
        F.coalesce(F.max(F.when(create, ok)), F.lit(False)).alias("accepted"),
        F.coalesce(F.max(F.when(create & ok, F.col("has_json"))), F.lit(False)).alias("has_json"),
        F.max(F.when(create & ok & F.col("has_json"), F.col("order_id"))).alias("order_id"),
        F.max(poll & (F.col("status_code") == 404)).alias("any_404"),
        F.max(poll & ~ok & (F.col("status_code") != 404)).alias("any_error"),
        F.max_by("order_status", F.when(poll & ok & F.col("has_json"), F.col("seq"))).alias("final_status"),
    )
    delivered = F.coalesce(F.col("final_status") == DELIVERED, F.lit(False))
    created = F.col("order_id").isNotNull()
    error = (
        F.when(~F.col("accepted"), F.lit("failed_to_create_order"))
        .when(~F.col("has_json"), F.lit("missing_order_response_json"))
        .when(~created, F.lit("missing_order_id"))
        .when(F.col("any_404"), F.lit("order_not_visible_after_creation"))
        .when(F.col("any_error"), F.lit("order_query_errors"))
        .when(
            ~delivered, F.concat(F.lit("order_not_delivered_last_status="), F.coalesce("final_status", F.lit("None")))
        )
    )
    return runs.select("run_id", "accepted", "order_id", "final_status", error.alias("error")).withColumn(
        "success", F.col("error").isNull()
    )


def load_summary(log: DataFrame, scenario: str, orders_per_second: int, duration_seconds: int) -> DataFrame:
    """Attempted, accepted, delivered and failed orders with their throughput, in one row."""
    outcomes = order_outcomes(log).agg(
        F.count(F.lit(1)).alias("attempted_orders"),
        F.count_if("accepted").alias("accepted_orders"),
        F.count_if("success").alias("delivered_orders"),
        F.count_if(~F.col("success")).alias("failed_orders"),
    )

    def seconds(at: Column) -> Column:
        return (F.max(F.unix_micros(at)) - F.min(F.unix_micros(at))) / F.lit(1e6)

    at = F.col("sent_at")
    elapsed = log.agg(
        seconds(F.when(F.col("is_create"), at)).alias("emission_elapsed_seconds"),
        seconds(at).alias("end_to_end_elapsed_seconds"),
    )
    # both sides are a single row
    row = outcomes.unionByName(elapsed, allowMissingColumns=True)
    row = row.agg(*[F.max(c).alias(c) for c in row.columns])

    def per_second(count: str, time: str) -> Column:
        return F.when(F.col(time) > 0, F.col(count) / F.col(time)).otherwise(F.lit(0.0))

    return row.select(
        F.lit(scenario).alias("scenario"),
        F.lit(orders_per_second).alias("orders_per_second"),
        F.lit(duration_seconds).alias("duration_seconds"),
        F.lit(orders_per_second * duration_seconds).alias("expected_orders"),
        *row.columns,
        per_second("accepted_orders", "emission_elapsed_seconds").alias("accepted_throughput"),
        per_second("delivered_orders", "end_to_end_elapsed_seconds").alias("delivered_throughput"),
    )


def load_report(summary: DataFrame, endpoints: DataFrame) -> DataFrame:
    """One row with the summary and a map of endpoint statistics; a service has a handful of endpoints."""
    stats = [c for c in endpoints.columns if c != "endpoint"]
    entry = F.struct("endpoint", F.struct(*stats).alias("stats"))
    listed = endpoints.agg(F.map_from_entries(F.collect_list(entry)).alias("endpoints"))
    row = summary.select(F.struct(*summary.columns).alias("summary")).unionByName(listed, allowMissingColumns=True)
    return row.agg(F.any_value("summary", True).alias("summary"), F.any_value("endpoints", True).alias("endpoints"))
