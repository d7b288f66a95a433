"""Rides as delimited topic rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.codec import CHARSET
from millrace.functions.times import epoch_ms, from_epoch_ms

# The topic between cleansing and counting. Times travel as epoch milliseconds.
RIDE_TOPIC = "test"
WIRE = (
    "ride_id bigint, is_start boolean, start_ms bigint, end_ms bigint,"
    " start_lon double, start_lat double, end_lon double, end_lat double"
)


def encode_rides(rides: DataFrame, topic: str = RIDE_TOPIC) -> DataFrame:
    line = F.concat_ws(
        ",",
        *[F.col(c).cast("string") for c in ("ride_id", "is_start")],
        *[epoch_ms(F.col(c)).cast("string") for c in ("start_time", "end_time")],
        *[F.col(c).cast("string") for c in ("start_lon", "start_lat", "end_lon", "end_lat")],
    )
    return rides.select(
        F.encode(F.col("ride_id").cast("string"), CHARSET).alias("key"),
        F.encode(line, CHARSET).alias("value"),
        F.lit(topic).alias("topic"),
    )


def decode_rides(rows: DataFrame, topic: str = RIDE_TOPIC) -> DataFrame:
    """Typed rides of one topic, with ``ts`` the time of the record; lines that do not parse are left out."""
    parsed = F.from_csv(F.decode("value", CHARSET), WIRE, {"mode": "PERMISSIVE"})
    # The one-element generator keeps predicates on the fields from repeating the parse.
    fields = rows.where(F.col("topic") == topic).select(F.inline(F.array(parsed)))
    start, end = from_epoch_ms(F.col("start_ms")), from_epoch_ms(F.col("end_ms"))
    whole = F.col("ride_id").isNotNull() & F.col("is_start").isNotNull() & start.isNotNull() & end.isNotNull()
    return fields.where(whole).select(
        "ride_id", F.when(F.col("is_start"), start).otherwise(end).alias("ts"), "is_start",
        start.alias("start_time"), end.alias("end_time"), "start_lon", "start_lat", "end_lon", "end_lat",
    )
