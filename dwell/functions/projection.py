"""Longitude and latitude to plane coordinates.

Web Mercator and the transverse Mercator family (UTM and Gauss-Krueger zones on WGS 84 and CGCS2000) are column
arithmetic: Krueger's series to the sixth order of the third flattening, better than a micrometre within a zone. Any
other system needs the library pyproj, which then runs in an Arrow UDF; without it the system is an error.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

GEOGRAPHIC = {"EPSG:4326", "EPSG:4490", "OGC:CRS84"}
#: Semi-axis and flattening of WGS 84 and CGCS2000.
WGS84, CGCS2000 = (6378137.0, 1 / 298.257223563), (6378137.0, 1 / 298.257222101)


def transverse_mercator(lon: Column, lat: Column, ellipsoid: tuple[float, float], meridian: float, scale: float, false_x: float, false_y: float) -> tuple[Column, Column]:
    a, f = ellipsoid
    n = f / (2 - f)
    e = math.sqrt(f * (2 - f))
    radius = a / (1 + n) * (1 + n**2 / 4 + n**4 / 64 + n**6 / 256)
    #: Krueger's coefficients.
    alpha = (
        n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180 - 127 * n**5 / 288 + 7891 * n**6 / 37800,
        13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440 + 281 * n**5 / 630 - 1983433 * n**6 / 1935360,
        61 * n**3 / 240 - 103 * n**4 / 140 + 15061 * n**5 / 26880 + 167603 * n**6 / 181440,
        49561 * n**4 / 161280 - 179 * n**5 / 168 + 6601661 * n**6 / 7257600,
        34729 * n**5 / 80640 - 3418889 * n**6 / 1995840,
        212378941 * n**6 / 319334400,
    )
    phi, lam = F.radians(lat), F.radians(lon - meridian)
    t = F.sinh(F.atanh(F.sin(phi)) - e * F.atanh(e * F.sin(phi)))
    xi = F.atan2(t, F.cos(lam))
    eta = F.asinh(F.sin(lam) / F.sqrt(t * t + F.cos(lam) * F.cos(lam)))
    east, north = eta, xi
    for j, c in enumerate(alpha, 1):
        east = east + c * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        north = north + c * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return false_x + scale * radius * east, false_y + scale * radius * north


def web_mercator(lon: Column, lat: Column) -> tuple[Column, Column]:
    r = WGS84[0]
    return F.radians(lon) * r, F.log(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2)) * r


def _with_pyproj(lon: Column, lat: Column, source: str, target: str) -> tuple[Column, Column]:
    try:
        import pyproj  # noqa: F401
    except ImportError:
        raise ValueError(f"no formula for {source} to {target}, and pyproj is not installed") from None

    @F.arrow_udf("struct<x:double,y:double>")
    def moved(a: pa.Array, b: pa.Array) -> pa.Array:
        import numpy as np
        import pyproj

        x, y = pyproj.Transformer.from_crs(source, target, always_xy=True).transform(a.to_numpy(zero_copy_only=False), b.to_numpy(zero_copy_only=False))
        return pa.StructArray.from_arrays([pa.array(np.asarray(x, float)), pa.array(np.asarray(y, float))], names=["x", "y"])

    out = moved(lon, lat)
    return out["x"], out["y"]


def project(lon: Column, lat: Column, source: str, target: str) -> tuple[Column, Column]:
    """Coordinates in the order x, y, whatever the systems' own axis order. Values outside the globe give null."""
    source, target = source.strip().upper(), target.strip().upper()
    if source == target:
        return lon, lat
    code = int(target.rpartition(":")[2]) if target.startswith("EPSG:") and target[5:].isdigit() else 0
    fine = F.abs(lat) <= 90
    lon, lat = F.when(fine, lon), F.when(fine, lat)
    if source in GEOGRAPHIC:
        if code == 3857:
            return web_mercator(lon, lat)
        if 32601 <= code <= 32660 or 32701 <= code <= 32760:
            return transverse_mercator(lon, lat, WGS84, (code % 100) * 6 - 183, 0.9996, 500_000.0, 0.0 if code < 32700 else 10_000_000.0)
        if 4502 <= code <= 4512:  # six-degree zones without zone prefix, 75 to 135 degrees
            return transverse_mercator(lon, lat, CGCS2000, 75 + (code - 4502) * 6, 1.0, 500_000.0, 0.0)
        if 4491 <= code <= 4501:  # the same with zones 13 to 23 before the easting
            return transverse_mercator(lon, lat, CGCS2000, 75 + (code - 4491) * 6, 1.0, 500_000.0 + (13 + code - 4491) * 1e6, 0.0)
        if 4534 <= code <= 4554:  # three-degree zones without prefix, 75 to 135 degrees
            return transverse_mercator(lon, lat, CGCS2000, 75 + (code - 4534) * 3, 1.0, 500_000.0, 0.0)
        if 4513 <= code <= 4533:  # the same with zones 25 to 45 before the easting
            return transverse_mercator(lon, lat, CGCS2000, 75 + (code - 4513) * 3, 1.0, 500_000.0 + (25 + code - 4513) * 1e6, 0.0)
    return _with_pyproj(lon, lat, source, target)
