"""Travel-time model trained on ride ends and queried by ride starts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.geo import GridSpec, direction_deg, distance_km
from millrace.functions.times import epoch_ms
from millrace.operators.rows import destination_cell, rides_inside
from millrace.operators.running import ROWS_PER_BLOCK, running, running_count, running_sum

DIRECTION_BUCKETS = 8
METRES_PER_STEP = 10.0
SUMS = ("n", "sx", "sy", "sxx", "sxy")


def ride_features(rides: DataFrame, grid: GridSpec, ts: str = "ts") -> DataFrame:
    """Per ride inside the area: destination cell, direction bucket, distance, duration.

    Distance is in steps of ten metres and duration in milliseconds, both whole numbers.
    """
    ref_lat = (grid.south + grid.north) / 2
    ends = [F.col(c) for c in ("start_lon", "start_lat", "end_lon", "end_lat")]
    km = distance_km(*ends, ref_lat)
    # The angle points from the destination back to the start.
    angle = direction_deg(ends[2], ends[3], ends[0], ends[1], ref_lat)
    width = 360.0 / DIRECTION_BUCKETS
    return rides_inside(rides, grid).select(
        "ride_id",
        ts,
        "is_start",
        destination_cell(grid).alias("cell"),
        (F.floor(angle / width) % DIRECTION_BUCKETS).cast("int").alias("bucket"),
        F.round(km * (1000.0 / METRES_PER_STEP)).alias("distance"),
        (epoch_ms(F.col("end_time")) - epoch_ms(F.col("start_time"))).cast("double").alias("duration"),
    )


def exact(value: Column) -> Column:
    """A whole number whose sums are exact at any size, and so the same for any cut points."""
    return value.cast("decimal(28,0)")


def least_squares_minutes(distance: Column, n: Column, sx: Column, sy: Column, sxx: Column, sxy: Column) -> Column:
    """Whole minutes on the fitted line; the mean while no line is determined, NULL before any row."""
    spread = n * sxx - sx * sx
    slope = F.when(spread != 0, (n * sxy - sx * sy) / spread).otherwise(0.0)
    return F.when(n > 0, (((sy - slope * sx) / n) + slope * distance) / 60000.0).cast("int")


def travel_time_predictions(
    rides: DataFrame,
    grid: GridSpec,
    ts: str = "ts",
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """A prediction for each ride start, from the ride ends before it in event time.

    One model per (destination cell, direction bucket). A model is five running sums, so
    training is a running aggregate and a popular destination can be cut into blocks. A ride
    end without a distance or a duration trains nothing.
    """
    features = ride_features(rides, grid, ts)
    x, y = F.col("distance"), F.col("duration")
    trains = ~F.col("is_start") & x.isNotNull() & y.isNotNull()
    whole_x, whole_y = x.cast("bigint"), y.cast("bigint")
    fitted = running(
        features,
        ["cell", "bucket"],
        [ts, "ride_id"],
        {
            "n": running_count(F.when(trains, 1)),
            "sx": running_sum(F.when(trains, exact(x))),
            "sy": running_sum(F.when(trains, exact(y))),
            "sxx": running_sum(F.when(trains, exact(whole_x * whole_x))),
            "sxy": running_sum(F.when(trains, exact(whole_x * whole_y))),
        },
        rows_per_block=rows_per_block,
    )
    minutes = least_squares_minutes(x, *[F.col(c).cast("double") for c in SUMS])
    return fitted.where("is_start").select("ride_id", "cell", "bucket", minutes.alias("minutes"))
