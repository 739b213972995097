"""Distances on the sphere and the grid that keeps distance joins local."""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean radius of the earth in kilometres.
EARTH_RADIUS_KM = 6371.0

# Head room, in degrees, for rounding at the edge of a grid cell.
_SLACK = 1e-9


def geo_distance_km(
    lat_a: Column, lon_a: Column, lat_b: Column, lon_b: Column, method: str = "haversine"
) -> Column:
    """Great-circle distance in kilometres between two points in degrees.

    ``haversine`` is exact for points close together. ``cosines`` is the law of
    cosines with its argument clamped, so that equal points give 0, not NaN.
    """
    phi_a, phi_b = F.radians(lat_a), F.radians(lat_b)
    if method == "haversine":
        half_lat = F.sin((phi_b - phi_a) / 2)
        half_lon = F.sin(F.radians(lon_b - lon_a) / 2)
        chord = half_lat * half_lat + F.cos(phi_a) * F.cos(phi_b) * half_lon * half_lon
        return F.asin(F.sqrt(F.least(F.lit(1.0), chord))) * F.lit(2 * EARTH_RADIUS_KM)
    if method == "cosines":
        cosine = F.sin(phi_a) * F.sin(phi_b) + F.cos(phi_a) * F.cos(phi_b) * F.cos(
            F.radians(lon_b - lon_a)
        )
        clamped = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine))
        return F.acos(clamped) * F.lit(EARTH_RADIUS_KM)
    raise ValueError(f"unknown distance method: {method!r}")


class Grid(NamedTuple):
    """A latitude/longitude grid for pairs of points at most ``reach_km`` apart.

    Join ``covering`` (every cell the reach of a point touches) with ``home``
    (the one cell of the other point): each pair within reach meets in exactly
    one cell, anywhere on the globe, so no pair is lost and none doubled.
    """

    reach: float
    height: float
    columns: int

    @classmethod
    def within(cls, reach_km: float) -> "Grid":
        if reach_km < 0:
            raise ValueError("reach_km must not be negative")
        reach = min(math.degrees(reach_km / EARTH_RADIUS_KM), 180.0) + _SLACK
        return cls(reach, 2 * reach, max(1, int(360 // (2 * reach))))

    @property
    def width(self) -> float:
        return 360.0 / self.columns

    def _row(self, lat: Column) -> Column:
        return F.floor(lat / F.lit(self.height))

    def _column(self, lon: Column) -> Column:
        return F.floor(lon / F.lit(self.width))

    def _wrap(self, column: Column) -> Column:
        return F.pmod(column, F.lit(self.columns).cast("bigint"))

    def home(self, lat: Column, lon: Column) -> tuple[Column, Column]:
        return self._row(lat), self._wrap(self._column(lon))

    def covering(self, lat: Column, lon: Column) -> tuple[Column, Column]:
        """Arrays of the rows and of the columns within reach of a point."""
        rows = F.sequence(self._row(lat - self.reach), self._row(lat + self.reach))
        if self.reach >= 90:
            around_pole = F.lit(True)
        else:
            around_pole = F.cos(F.radians(lat)) <= math.sin(math.radians(self.reach))
        # Widest longitude difference on a circle of this radius around the point.
        spread = F.degrees(
            F.asin(F.lit(math.sin(math.radians(min(self.reach, 90)))) / F.cos(F.radians(lat)))
        ) + F.lit(_SLACK)
        columns = F.when(
            around_pole, F.sequence(F.lit(0).cast("bigint"), F.lit(self.columns - 1).cast("bigint"))
        ).otherwise(F.sequence(self._column(lon - spread), self._column(lon + spread)))
        return rows, F.array_distinct(F.transform(columns, self._wrap))
