"""Popular places: counts per grid cell and window."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.geo import GridSpec
from millrace.functions.times import epoch_ms
from millrace.operators.rows import at_least, ride_cell, rides_inside


@dataclass(frozen=True)
class WindowSize:
    size_seconds: int
    slide_seconds: int

    @property
    def tumbling(self) -> bool:
        return self.size_seconds == self.slide_seconds


# One-minute tumbling windows as run, fifteen by five minutes as described.
EVERY_MINUTE = WindowSize(60, 60)
FIFTEEN_BY_FIVE = WindowSize(15 * 60, 5 * 60)
THRESHOLD = 20


def ride_hits(rides: DataFrame, grid: GridSpec, ts: str = "ts") -> DataFrame:
    """(ts, cell, is_start) of the rides inside the area."""
    return rides_inside(rides, grid).select(ts, ride_cell(grid).alias("cell"), "is_start")


def cell_counts(hits: DataFrame, window: WindowSize, ts: str = "ts") -> DataFrame:
    """Hits per cell, direction and window, on a batch or a watermarked stream."""
    bounds = F.window(ts, f"{window.size_seconds} seconds", f"{window.slide_seconds} seconds")
    counted = hits.groupBy(bounds.alias("w"), "cell", "is_start").agg(F.count(F.lit(1)).alias("n"))
    return counted.select("cell", epoch_ms(F.col("w.end")).alias("window_end_ms"), "is_start", "n")


def cell_counts_by_pane(hits: DataFrame, window: WindowSize, ts: str = "ts") -> DataFrame:
    """The same counts for batch data, without copying each row into every window it is in.

    Rows are counted once per pane (one slide long); only the pane counts are copied.
    """
    if window.tumbling or window.size_seconds % window.slide_seconds:
        return cell_counts(hits, window, ts)
    pane = WindowSize(window.slide_seconds, window.slide_seconds)
    slide_ms = window.slide_seconds * 1000
    copies = window.size_seconds // window.slide_seconds
    ends = F.sequence(
        F.col("window_end_ms"),
        F.col("window_end_ms") + (copies - 1) * slide_ms,
        F.lit(slide_ms).cast("bigint"),
    )
    spread = cell_counts(hits, pane, ts).select("cell", "is_start", "n", F.explode(ends).alias("window_end_ms"))
    summed = spread.groupBy("cell", "window_end_ms", "is_start").agg(F.sum("n").alias("n"))
    return summed.select("cell", "window_end_ms", "is_start", "n")


def to_coordinates(counts: DataFrame, grid: GridSpec) -> DataFrame:
    """Replace the cell by the coordinates of its centre."""
    return counts.select(
        grid.center_lon(F.col("cell")).alias("lon"),
        grid.center_lat(F.col("cell")).alias("lat"),
        "window_end_ms",
        "is_start",
        F.col("n").cast("int").alias("n"),
    )


def popular_places(
    rides: DataFrame,
    grid: GridSpec,
    window: WindowSize = EVERY_MINUTE,
    threshold: int = THRESHOLD,
    ts: str = "ts",
) -> DataFrame:
    """Cells with at least ``threshold`` departures or arrivals in a window."""
    count = cell_counts if rides.isStreaming else cell_counts_by_pane
    counts = count(ride_hits(rides, grid, ts), window, ts)
    return to_coordinates(at_least(counts, "n", threshold), grid)
