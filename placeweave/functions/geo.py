"""Coordinates: the British grid and WGS84, distances, cells and Morton codes.

Geometry is plain: a point is two columns x and y, a line ``array<struct<x,y>>``, and a polygon the
array of its rings' edges ``array<struct<x1,y1,x2,y2>>``; metres on the British grid (EPSG:27700).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType, StructField, StructType

#: Ellipsoids (semi-axes), the grid's projection, and the seven-parameter shift WGS84 -> OSGB36.
AIRY, WGS84 = (6377563.396, 6356256.909), (6378137.0, 6356752.314245)
SCALE, LAT0, LON0, E0, N0 = 0.9996012717, math.radians(49), math.radians(-2), 400000.0, -100000.0
SHIFT, TURN, STRETCH = (-446.448, 125.157, -542.060), (-0.1502, -0.2470, -0.8421), 20.4894e-6


def _arc(lat, a: float, b: float):
    n = (a - b) / (a + b)
    d, s = lat - LAT0, lat + LAT0
    return b * SCALE * (
        (1 + n + 1.25 * n**2 + 1.25 * n**3) * d
        - (3 * n + 3 * n**2 + 2.625 * n**3) * np.sin(d) * np.cos(s)
        + (1.875 * n**2 + 1.875 * n**3) * np.sin(2 * d) * np.cos(2 * s)
        - 35 / 24 * n**3 * np.sin(3 * d) * np.cos(3 * s)
    )


def project(lat, lon):
    """Airy latitude and longitude (radians) to easting and northing."""
    a, b = AIRY
    e2 = 1 - (b / a) ** 2
    s, c, t = np.sin(lat), np.cos(lat), np.tan(lat)
    nu = a * SCALE / np.sqrt(1 - e2 * s**2)
    rho = a * SCALE * (1 - e2) / (1 - e2 * s**2) ** 1.5
    eta = nu / rho - 1
    d = lon - LON0
    north = _arc(lat, a, b) + N0 + nu / 2 * s * c * d**2 + nu / 24 * s * c**3 * (5 - t**2 + 9 * eta) * d**4 \
        + nu / 720 * s * c**5 * (61 - 58 * t**2 + t**4) * d**6
    east = E0 + nu * c * d + nu / 6 * c**3 * (nu / rho - t**2) * d**3 \
        + nu / 120 * c**5 * (5 - 18 * t**2 + t**4 + 14 * eta - 58 * t**2 * eta) * d**5
    return east, north


def unproject(east, north):
    """Easting and northing to Airy latitude and longitude (radians)."""
    a, b = AIRY
    e2 = 1 - (b / a) ** 2
    lat = (north - N0) / (a * SCALE) + LAT0
    for _ in range(6):
        lat = lat + (north - N0 - _arc(lat, a, b)) / (a * SCALE)
    s, c, t = np.sin(lat), np.cos(lat), np.tan(lat)
    nu = a * SCALE / np.sqrt(1 - e2 * s**2)
    rho = a * SCALE * (1 - e2) / (1 - e2 * s**2) ** 1.5
    eta, d = nu / rho - 1, east - E0
    out = lat - t / (2 * rho * nu) * d**2 + t / (24 * rho * nu**3) * (5 + 3 * t**2 + eta - 9 * t**2 * eta) * d**4 \
        - t / (720 * rho * nu**5) * (61 + 90 * t**2 + 45 * t**4) * d**6
    lon = LON0 + d / (c * nu) - (nu / rho + 2 * t**2) * d**3 / (6 * c * nu**3) \
        + (5 + 28 * t**2 + 24 * t**4) * d**5 / (120 * c * nu**5) - (61 + 662 * t**2 + 1320 * t**4 + 720 * t**6) * d**7 / (5040 * c * nu**7)
    return out, lon


def _cartesian(lat, lon, axes):
    a, b = axes
    e2 = 1 - (b / a) ** 2
    nu = a / np.sqrt(1 - e2 * np.sin(lat) ** 2)
    return nu * np.cos(lat) * np.cos(lon), nu * np.cos(lat) * np.sin(lon), (1 - e2) * nu * np.sin(lat)


def _geodetic(x, y, z, axes):
    a, b = axes
    e2 = 1 - (b / a) ** 2
    p = np.hypot(x, y)
    lat = np.arctan2(z, p * (1 - e2))
    for _ in range(6):
        nu = a / np.sqrt(1 - e2 * np.sin(lat) ** 2)
        lat = np.arctan2(z + e2 * nu * np.sin(lat), p)
    return lat, np.arctan2(y, x)


def _shifted(x, y, z, sign: int):
    tx, ty, tz = (sign * v for v in SHIFT)
    rx, ry, rz = (sign * math.radians(v / 3600) for v in TURN)
    s = sign * STRETCH
    return tx + (1 + s) * x - rz * y + ry * z, ty + rz * x + (1 + s) * y - rx * z, tz - ry * x + rx * y + (1 + s) * z


def to_grid(lat, lon):
    """WGS84 degrees to grid metres; the shift is good to some metres."""
    x, y, z = _shifted(*_cartesian(np.radians(lat), np.radians(lon), WGS84), 1)
    return project(*_geodetic(x, y, z, AIRY))


def to_degrees(east, north):
    """Grid metres to WGS84 degrees."""
    lat, lon = unproject(east, north)
    out = _geodetic(*_shifted(*_cartesian(lat, lon, AIRY), -1), WGS84)
    return np.degrees(out[0]), np.degrees(out[1])


@pandas_udf(StructType([StructField("x", DoubleType()), StructField("y", DoubleType())]))
def grid_point(lat: pd.Series, lon: pd.Series) -> pd.DataFrame:
    x, y = to_grid(lat.to_numpy("float64"), lon.to_numpy("float64"))
    return pd.DataFrame({"x": x, "y": y})


@pandas_udf(StructType([StructField("lat", DoubleType()), StructField("lon", DoubleType())]))
def degrees_point(x: pd.Series, y: pd.Series) -> pd.DataFrame:
    lat, lon = to_degrees(x.to_numpy("float64"), y.to_numpy("float64"))
    return pd.DataFrame({"lat": lat, "lon": lon})


def distance(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.sqrt((x1 - x2) * (x1 - x2) + (y1 - y2) * (y1 - y2))


def segment_distance(x: Column, y: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """From a point to the nearest point of a segment."""
    dx, dy = x2 - x1, y2 - y1
    length = dx * dx + dy * dy
    t = F.when(length > 0, ((x - x1) * dx + (y - y1) * dy) / length).otherwise(F.lit(0.0))
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), t))
    return distance(x, y, x1 + t * dx, y1 + t * dy)


def cell(v: Column, size: float) -> Column:
    return F.floor(v / F.lit(float(size))).cast("long")


def morton(x: Column, y: Column, size: float = 1000.0, bits: int = 16) -> Column:
    """The bits of a cell's two numbers, taken in turn: near cells have near codes."""
    cx, cy = cell(x, size), cell(y, size)
    parts = [
        F.shiftleft(F.shiftright(c, i).bitwiseAND(F.lit(1).cast("long")), 2 * i + k)
        for i in range(bits) for k, c in ((0, cx), (1, cy))
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.bitwiseOR(p)
    return out


def edges(line: Column) -> Column:
    """The segments of a line of points."""
    return F.transform(F.slice(line, F.lit(2), F.greatest(F.size(line) - 1, F.lit(0))), lambda p, i: F.struct(
        F.get(line, i)["x"].alias("x1"), F.get(line, i)["y"].alias("y1"), p["x"].alias("x2"), p["y"].alias("y2")))


def area(polygon: Column) -> Column:
    """By the shoelace rule, of one ring's edges."""
    return F.abs(F.aggregate(polygon, F.lit(0.0), lambda a, e: a + (e["x1"] * e["y2"] - e["x2"] * e["y1"]))) / 2


def length(segments: Column) -> Column:
    return F.aggregate(segments, F.lit(0.0), lambda a, e: a + distance(e["x1"], e["y1"], e["x2"], e["y2"]))


def inside(x: Column, y: Column, polygon: Column) -> Column:
    """Whether a ray from the point crosses an odd number of edges."""
    hits = F.filter(polygon, lambda e: ((e["y1"] > y) != (e["y2"] > y)) & (
        x < (e["x2"] - e["x1"]) * (y - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"]))
    return F.size(hits) % 2 == 1


def snap_down(v: Column, step: float = 500.0) -> Column:
    return F.floor(v / step) * step


def snap_up(v: Column, step: float = 500.0) -> Column:
    return F.ceil(v / step) * step
