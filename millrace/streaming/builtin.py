"""Streams that need no state function: windows, sessions, counts and joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.geo import GridSpec
from millrace.functions.times import epoch_us
from millrace.operators.histograms import BITS, value_histogram
from millrace.operators.joins import JOIN_WINDOW
from millrace.operators.lateness import CAR_DELAY_SECONDS
from millrace.operators.metrics import metric_counts
from millrace.operators.places import EVERY_MINUTE, THRESHOLD, WindowSize, popular_places
from millrace.operators.sessions import CAR_GAP_SECONDS, sessions


def watermarked(stream: DataFrame, ts: str, delay: str) -> DataFrame:
    """Event time for a stream. Time columns without a zone are read as UTC wall clock."""
    return stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def popular_places_stream(
    rides: DataFrame,
    grid: GridSpec,
    window: WindowSize = EVERY_MINUTE,
    threshold: int = THRESHOLD,
    delay: str = "60 seconds",
    ts: str = "ts",
) -> DataFrame:
    return popular_places(watermarked(rides, ts, delay), grid, window, threshold, ts)


def sessions_stream(
    events: DataFrame, key: str, ts: str, measure: str,
    gap_seconds: int = CAR_GAP_SECONDS, delay: str = f"{CAR_DELAY_SECONDS} seconds",
) -> DataFrame:
    return sessions(watermarked(events, ts, delay), key, ts, measure, gap_seconds)


def metric_counts_stream(samples: DataFrame, ts: str, period: str, delay: str) -> DataFrame:
    return metric_counts(watermarked(samples, ts, delay), ts, period)


def value_histogram_stream(samples: DataFrame, ts: str, value: str, period: str, delay: str, bits: int = BITS) -> DataFrame:
    """Histograms of finished periods; those of several streams can be added up."""
    return value_histogram(watermarked(samples, ts, delay), ts, value, period, bits)


def window_join_stream(
    left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str,
    window: str = JOIN_WINDOW, delay: str = "10 seconds",
) -> DataFrame:
    """Pairs with equal keys in the same window; state is dropped once the window is over.

    Each side keeps a single event-time column, the window. The times themselves travel
    as microseconds under their old names.
    """

    def side(df: DataFrame, ts: str) -> DataFrame:
        timed = watermarked(df, ts, delay).withColumn("window", F.window(ts, window))
        return timed.select(
            key, "window", epoch_us(F.col(ts)).alias(ts),
            *[c for c in df.columns if c not in (key, ts)],
        )

    joined = side(left, left_ts).join(side(right, right_ts), [key, "window"])
    return joined.withColumn("window_start", F.col("window.start")).drop("window")
