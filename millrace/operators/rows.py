"""Row-wise operators: filters, projections and reshaping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.geo import GridSpec


def rides_inside(rides: DataFrame, grid: GridSpec) -> DataFrame:
    """Rides that both start and end inside the area."""
    return rides.where(
        grid.contains(F.col("start_lon"), F.col("start_lat"))
        & grid.contains(F.col("end_lon"), F.col("end_lat"))
    )


def with_status(df: DataFrame, status: str) -> DataFrame:
    return df.where(F.col("status") == status)


def nonempty(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.length(column) > 0)


def at_least(df: DataFrame, column: str, threshold: int) -> DataFrame:
    """Keep aggregated rows that reach a threshold."""
    return df.where(F.col(column) >= threshold)


def ride_cell(grid: GridSpec) -> Column:
    """Departure cell of a start record, arrival cell of an end record."""
    return F.when(F.col("is_start"), grid.cell(F.col("start_lon"), F.col("start_lat"))).otherwise(
        grid.cell(F.col("end_lon"), F.col("end_lat"))
    )


def destination_cell(grid: GridSpec) -> Column:
    return grid.cell(F.col("end_lon"), F.col("end_lat"))


def split_by(df: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame]:
    """The rows that meet a condition and all the others; an unknown counts as not met."""
    met = F.coalesce(condition, F.lit(False))
    return df.where(met), df.where(~met)


def rebalance(df: DataFrame, partitions: int) -> DataFrame:
    """Spread rows evenly, whatever their keys."""
    return df.repartition(partitions)
