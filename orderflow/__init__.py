"""Delivery-order event analytics written as Spark DataFrame, SQL and streaming jobs."""
