"""Explicit schemas; nothing in this library infers one."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


LINES = _struct(text=T.StringType())

RIDE = _struct(
    ride_id=T.LongType(),
    is_start=T.BooleanType(),
    start_time=T.TimestampType(),
    end_time=T.TimestampType(),
    start_lon=T.DoubleType(),
    start_lat=T.DoubleType(),
    end_lon=T.DoubleType(),
    end_lat=T.DoubleType(),
)

CAR_EVENT = _struct(car_id=T.StringType(), timestamp=T.LongType(), speed=T.DoubleType())

CARD_HOLDER = _struct(id=T.StringType(), card_id=T.IntegerType())

CLICK = _struct(
    customer=T.StringType(),
    clicked_item=T.StringType(),
    event_time=T.LongType(),
    status=T.StringType(),
    id=T.StringType(),
)

TOPIC_ROW = _struct(
    key=T.BinaryType(),
    value=T.BinaryType(),
    topic=T.StringType(),
    partition=T.IntegerType(),
    offset=T.LongType(),
    timestamp=T.TimestampType(),
)

EVENT = _struct(
    event_id=T.LongType(),
    ts=T.TimestampNTZType(),
    user_id=T.LongType(),
    event_type=T.StringType(),
    value=T.DoubleType(),
    props=T.StringType(),
)

METRIC_SAMPLE = _struct(metric=T.StringType(), ts=T.TimestampType(), value=T.LongType())

LOOKUP = _struct(key=T.StringType(), result=T.StringType())
