"""Areas, grid cells, distances and directions as column arithmetic."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM_PER_DEGREE = 111.32


@dataclass(frozen=True)
class GridSpec:
    """A rectangular area cut into cells, numbered row by row from its north-west corner."""

    west: float
    east: float
    south: float
    north: float
    dlon: float
    dlat: float

    @property
    def columns(self) -> int:
        return math.ceil(round((self.east - self.west) / self.dlon, 9))

    @property
    def rows(self) -> int:
        return math.ceil(round((self.north - self.south) / self.dlat, 9))

    def contains(self, lon: Column, lat: Column) -> Column:
        """Point in area, edges included."""
        return lon.between(self.west, self.east) & lat.between(self.south, self.north)

    def cell(self, lon: Column, lat: Column) -> Column:
        """Cell of a point; a point on the far edge belongs to the last column or row."""
        column = F.least(F.floor((lon - self.west) / self.dlon), F.lit(self.columns - 1))
        row = F.least(F.floor((self.north - lat) / self.dlat), F.lit(self.rows - 1))
        return (column + row * self.columns).cast("int")

    def center_lon(self, cell: Column) -> Column:
        return (self.west + (cell % self.columns + 0.5) * self.dlon).cast("float")

    def center_lat(self, cell: Column) -> Column:
        row = F.floor(cell / F.lit(self.columns))
        return (self.north - (row + 0.5) * self.dlat).cast("float")


def _east_km(from_lon: Column, to_lon: Column, ref_lat: float) -> Column:
    return (to_lon - from_lon) * (EARTH_KM_PER_DEGREE * math.cos(math.radians(ref_lat)))


def _north_km(from_lat: Column, to_lat: Column) -> Column:
    return (to_lat - from_lat) * EARTH_KM_PER_DEGREE


def distance_km(lon1: Column, lat1: Column, lon2: Column, lat2: Column, ref_lat: float) -> Column:
    """Euclidean distance on a plane tangent at ``ref_lat``."""
    return F.hypot(_east_km(lon1, lon2, ref_lat), _north_km(lat1, lat2))


def direction_deg(lon1: Column, lat1: Column, lon2: Column, lat2: Column, ref_lat: float) -> Column:
    """Angle from the first point to the second, counter-clockwise from east, in [0, 360)."""
    degrees = F.degrees(F.atan2(_north_km(lat1, lat2), _east_km(lon1, lon2, ref_lat)))
    return F.when(degrees < 0, degrees + 360.0).otherwise(degrees)
