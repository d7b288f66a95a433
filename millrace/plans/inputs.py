"""The operators' inputs, derived from the given tables.

Coordinates come from whole-number arithmetic on ids, so any SQL engine derives the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.codec import PRE_PROCESSING, PROCESSING_DONE
from millrace.functions.geo import GridSpec
from millrace.functions.times import epoch_ms, plus_us

GRID = GridSpec(west=-74.05, east=-73.75, south=40.55, north=40.85, dlon=0.1, dlat=0.1)
START_TYPES = ("click", "view")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Windows and epoch values of zone-less times must not depend on where the driver runs.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cents() -> Column:
    return F.round(F.col("value") * 100).cast("bigint")


def _coordinate(origin: float, by_event: int, by_user: int) -> Column:
    step = (F.col("event_id") * by_event + F.col("user_id") * by_user) % 320
    return F.lit(origin) + step / F.lit(1000.0)


def rides_of(events: DataFrame) -> DataFrame:
    """One ride record per event; value is the travel time in minutes. Some lie outside the area."""
    return events.select(
        F.col("event_id").alias("ride_id"),
        "ts",
        F.col("event_type").isin(*START_TYPES).alias("is_start"),
        plus_us(F.col("ts"), cents() * -600_000).alias("start_time"),
        F.col("ts").alias("end_time"),
        _coordinate(-74.06, 7919, 104729).alias("start_lon"),
        _coordinate(40.54, 6101, 31).alias("start_lat"),
        _coordinate(-74.06, 4513, 613).alias("end_lon"),
        _coordinate(40.54, 3571, 1009).alias("end_lat"),
    )


def rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rides_of(table(spark, sf_dir, "events"))


def arrivals_of(events: DataFrame) -> DataFrame:
    """Events with an arrival order that differs from their event-time order."""
    delay_us = (F.col("event_id") * 7919 % 7200) * 1_000_000
    return events.select("event_id", "user_id", "ts", plus_us(F.col("ts"), delay_us).alias("arrival_ts"))


def clicks_of(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("user_id").cast("string").alias("customer"),
        F.col("event_type").alias("clicked_item"),
        epoch_ms(F.col("ts")).alias("event_time"),
        F.lit(PRE_PROCESSING).alias("status"),
        F.col("event_id").cast("string").alias("id"),
    )


def requests_of(orders: DataFrame) -> DataFrame:
    return orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("ts"))


def shipments_of(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(F.col("l_orderkey").alias("id"), F.col("l_shipdate").alias("shipped"))


def first_shipments(requests: DataFrame, shipments: DataFrame) -> DataFrame:
    """Per request the first shipment on or after its date."""
    matched = shipments.join(requests, "id").where(F.col("shipped") >= F.col("ts"))
    first = matched.groupBy("id").agg(F.min("shipped").alias("ts"))
    return first.withColumn("status", F.lit(PROCESSING_DONE))


def of_type(events: DataFrame, kind: str, **columns: str | Column) -> DataFrame:
    picked = [c.alias(n) if isinstance(c, Column) else F.col(c).alias(n) for n, c in columns.items()]
    return events.where(F.col("event_type") == kind).select(*picked)


def metric_samples(events: DataFrame) -> DataFrame:
    from millrace.operators.metrics import metric_name

    return events.select("ts", metric_name("event_type").alias("metric"), cents().alias("value"))
