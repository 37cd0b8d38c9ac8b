"""Geodesy on Columns: distances, sign positions, cells and boxes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: metres of one degree of latitude.
METRES_PER_DEGREE = 111320.0


def distance_m(lon0: Column, lat0: Column, lon1: Column, lat1: Column) -> Column:
    """Equirectangular distance in metres; no wrap at the antimeridian; null if any input is."""
    dx = (lon1 - lon0) * F.lit(METRES_PER_DEGREE) * F.cos(F.radians((lat0 + lat1) / 2))
    dy = (lat1 - lat0) * F.lit(METRES_PER_DEGREE)
    return F.sqrt(dx * dx + dy * dy)


def sign_lat(lat: Column, bearing: Column, metres: float) -> Column:
    """Latitude `metres` away from the camera along the bearing; the camera's own if it is null."""
    return F.when(bearing.isNull(), lat).otherwise(lat + F.cos(F.radians(bearing)) * metres / METRES_PER_DEGREE)


def sign_lon(lon: Column, lat: Column, bearing: Column, metres: float) -> Column:
    shrink = F.greatest(F.lit(0.1), F.cos(F.radians(lat)))
    return F.when(bearing.isNull(), lon).otherwise(lon + F.sin(F.radians(bearing)) * metres / (METRES_PER_DEGREE * shrink))


def azimuth(fx: Column, origin: Column) -> Column:
    """Compass azimuth of a horizontal panorama fraction, in [0, 360)."""
    return F.pmod(origin + fx * 360.0, F.lit(360.0))


def fraction_of_azimuth(az: Column, origin: Column) -> Column:
    return F.pmod(az - origin, F.lit(360.0)) / 360.0


def cell_row(lat: Column, metres: float) -> Column:
    """Half-even rounded row of the spacing grid."""
    return F.bround(lat / (metres / METRES_PER_DEGREE)).cast("long")


def cell_col(lon: Column, lat: Column, metres: float) -> Column:
    """Column of the spacing grid; its width follows the point's own latitude."""
    step = F.lit(metres) / (F.lit(METRES_PER_DEGREE) * F.greatest(F.lit(0.1), F.cos(F.radians(lat))))
    return F.bround(lon / step).cast("long")


def neighbour_keys(row: Column, col: Column) -> Column:
    """Nine `"i:j"` keys around a cell, row by row."""
    offsets = F.sequence(F.lit(-1), F.lit(1))
    return F.flatten(
        F.transform(offsets, lambda i: F.transform(offsets, lambda j: F.concat_ws(":", (row + i).cast("string"), (col + j).cast("string"))))
    )


def in_bbox(lon: Column, lat: Column, bbox: tuple[float, float, float, float] | None) -> Column:
    """Inclusive containment; no box contains everything."""
    if bbox is None:
        return F.lit(True)
    west, south, east, north = bbox
    return lon.between(west, east) & lat.between(south, north)


def valid_position(lon: Column, lat: Column) -> Column:
    """Neither null, nor NaN, nor the (0, 0) placeholder, nor off the globe."""
    return F.coalesce(lon.between(-180.0, 180.0) & lat.between(-90.0, 90.0) & ~((lon == 0) & (lat == 0)), F.lit(False))


def polyline_metres(points: Column) -> Column:
    """Length of an array<struct<lon,lat>>; 0 for fewer than two points."""
    legs = F.zip_with(
        F.slice(points, 1, F.greatest(F.size(points) - 1, F.lit(0))),
        F.slice(points, 2, F.greatest(F.size(points) - 1, F.lit(0))),
        lambda a, b: distance_m(a["lon"], a["lat"], b["lon"], b["lat"]),
    )
    return F.aggregate(legs, F.lit(0.0), lambda s, x: s + x)
