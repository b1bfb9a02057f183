"""Places on grids and in map space."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def pixel_to_map(px: Column, py: Column, g: list[Column]) -> tuple[Column, Column]:
    """Map coordinates of a pixel by the six numbers of an affine geotransform."""
    return g[0] + px * g[1] + py * g[2], g[3] + px * g[4] + py * g[5]


def map_to_pixel(x: Column, y: Column, west: Column, north: Column, dx: Column, dy: Column) -> tuple[Column, Column]:
    """Column and row, cut towards zero; dy is negative for grids that run south."""
    return ((x - west) / dx).cast("int"), ((y - north) / dy).cast("int")


def tile(side: int = 256) -> list[Column]:
    """Numbers of the square tile of a pixel."""
    return [F.floor(F.col("y") / side).cast("int").alias("tile_y"), F.floor(F.col("x") / side).cast("int").alias("tile_x")]


def utm_to_degrees(east: Column, north: Column, zone: Column, south: bool = False) -> tuple[Column, Column]:
    """Latitude and longitude on WGS 84 of UTM coordinates, by the usual series for the inverse transverse Mercator projection."""
    a, f, k0 = 6378137.0, 1 / 298.257223563, 0.9996
    n = f / (2 - f)
    radius = a / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    beta = (n / 2 - 2 / 3 * n**2 + 37 / 96 * n**3, n**2 / 48 + n**3 / 15, 17 / 480 * n**3)
    delta = (2 * n - 2 / 3 * n**2 - 2 * n**3, 7 / 3 * n**2 - 8 / 5 * n**3, 56 / 15 * n**3)
    xi = (north - (10_000_000.0 if south else 0.0)) / (k0 * radius)
    eta = (east - 500_000.0) / (k0 * radius)
    x, e = xi, eta
    for j, b in enumerate(beta, 1):
        x = x - b * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        e = e - b * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    chi = F.asin(F.sin(x) / F.cosh(e))
    lat = chi
    for j, d in enumerate(delta, 1):
        lat = lat + d * F.sin(2 * j * chi)
    lon = zone * 6 - 183 + F.atan2(F.sinh(e), F.cos(x)) * (180 / math.pi)
    return lat * (180 / math.pi), lon
