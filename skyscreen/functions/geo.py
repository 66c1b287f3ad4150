"""Projection, tiling and quadkey expressions, all of them native columns."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

_A, _FLAT, _K0, _E0 = 6378137.0, 1 / 298.257223563, 0.9996, 500000.0
_N = _FLAT / (2 - _FLAT)
#: Systems in degrees; their datums differ by less than two metres.
DEGREES = (4326, 4269)
_ECC = math.sqrt(_FLAT * (2 - _FLAT))
_RECT = _A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64 + _N**6 / 256)


def _poly(*terms: tuple[int, int, int]) -> float:
    """Sum of p / q * n**k over (p, q, k)."""
    return sum(p / q * _N**k for p, q, k in terms)


#: The public Krüger series in n to the sixth order, forward and inverse.
_ALPHA = (
    _poly((1, 2, 1), (-2, 3, 2), (5, 16, 3), (41, 180, 4), (-127, 288, 5), (7891, 37800, 6)),
    _poly((13, 48, 2), (-3, 5, 3), (557, 1440, 4), (281, 630, 5), (-1983433, 1935360, 6)),
    _poly((61, 240, 3), (-103, 140, 4), (15061, 26880, 5), (167603, 181440, 6)),
    _poly((49561, 161280, 4), (-179, 168, 5), (6601661, 7257600, 6)),
    _poly((34729, 80640, 5), (-3418889, 1995840, 6)),
    _poly((212378941, 319334400, 6)),
)
_BETA = (
    _poly((1, 2, 1), (-2, 3, 2), (37, 96, 3), (-1, 360, 4), (-81, 512, 5), (96199, 604800, 6)),
    _poly((1, 48, 2), (1, 15, 3), (-437, 1440, 4), (46, 105, 5), (-1118711, 3870720, 6)),
    _poly((17, 480, 3), (-37, 840, 4), (-209, 4480, 5), (5569, 90720, 6)),
    _poly((4397, 161280, 4), (-11, 504, 5), (-830251, 7257600, 6)),
    _poly((4583, 161280, 5), (-108847, 3991680, 6)),
    _poly((20648693, 638668800, 6)),
)
_DELTA = (  # geodetic from conformal latitude
    _poly((2, 1, 1), (-2, 3, 2), (-2, 1, 3), (116, 45, 4), (26, 45, 5), (-2854, 675, 6)),
    _poly((7, 3, 2), (-8, 5, 3), (-227, 45, 4), (2704, 315, 5), (2323, 945, 6)),
    _poly((56, 15, 3), (-136, 35, 4), (-1262, 105, 5), (73814, 2835, 6)),
    _poly((4279, 630, 4), (-332, 35, 5), (-399572, 14175, 6)),
    _poly((4174, 315, 5), (-144838, 6237, 6)),
    _poly((601676, 22275, 6)),
)


def usable(lat: Column, lon: Column) -> Column:
    """Both present and within the ranges of degrees."""
    return lat.isNotNull() & lon.isNotNull() & lat.between(-90, 90) & lon.between(-180, 180)


def micro_key(degrees: Column, precision: int = 6) -> Column:
    """The coordinate as an exact integer key."""
    return F.round(degrees * F.lit(10.0**precision)).cast("long")


def in_box(lat: Column, lon: Column, box) -> Column:
    return lat.between(box[1], box[3]) & lon.between(box[0], box[2])


def boxes_overlap(xmin, ymin, xmax, ymax, box) -> Column:
    return (xmin <= F.lit(box[2])) & (xmax >= F.lit(box[0])) & (ymin <= F.lit(box[3])) & (ymax >= F.lit(box[1]))


def utm_epsg(lon: Column, lat: Column) -> Column:
    zone = F.pmod(F.floor((lon + 180.0) / 6.0), F.lit(60)) + 1
    return (zone + F.when(lat >= 0, 32600).otherwise(32700)).cast("int")


def target_crs(wanted: str | int | None, box) -> str:
    """The system to work in: what is asked for, a bare number as an EPSG code, and the zone of the box's middle for ``auto``."""
    text = str(wanted or "auto").strip()
    if text.lower() in ("auto", "auto-utm"):
        lon, lat = (box[0] + box[2]) / 2, (box[1] + box[3]) / 2
        text = str(math.floor((lon + 180.0) / 6.0) % 60 + 1 + (32600 if lat >= 0 else 32700))
    return f"EPSG:{int(text)}" if text.isdigit() else text


def _zone_of(epsg: Column) -> tuple[Column, Column]:
    """(central meridian in degrees, false northing)."""
    south = epsg >= 32700
    zone = epsg - F.when(south, 32700).otherwise(32600)
    return (zone * 6 - 183).cast("double"), F.when(south, 1e7).otherwise(0.0)


def utm_forward(lon: Column, lat: Column, epsg: Column) -> tuple[Column, Column]:
    """(easting, northing) in metres."""
    lon0, north0 = _zone_of(epsg)
    phi, lam = F.radians(lat), F.radians(lon - lon0)
    s = F.sin(phi)
    t = F.sinh(F.atanh(s) - F.lit(_ECC) * F.atanh(F.lit(_ECC) * s))
    xi, eta = F.atan2(t, F.cos(lam)), F.asinh(F.sin(lam) / F.sqrt(t * t + F.cos(lam) * F.cos(lam)))
    east, north = eta, xi
    for j, a in enumerate(_ALPHA, 1):
        east = east + F.lit(a) * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        north = north + F.lit(a) * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return F.lit(_E0) + F.lit(_K0 * _RECT) * east, north0 + F.lit(_K0 * _RECT) * north


def utm_inverse(east: Column, north: Column, epsg: Column) -> tuple[Column, Column]:
    """(longitude, latitude) in degrees; the series hold within some degrees of the zone."""
    lon0, north0 = _zone_of(epsg)
    xi, eta = (north - north0) / F.lit(_K0 * _RECT), (east - F.lit(_E0)) / F.lit(_K0 * _RECT)
    x, e = xi, eta
    for j, b in enumerate(_BETA, 1):
        x = x - F.lit(b) * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        e = e - F.lit(b) * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    conformal = F.asin(F.sin(x) / F.cosh(e))
    latitude = conformal
    for j, d in enumerate(_DELTA, 1):
        latitude = latitude + F.lit(d) * F.sin(2 * j * conformal)
    return lon0 + F.degrees(F.atan2(F.sinh(e), F.cos(x))), F.degrees(latitude)


def project(lon: np.ndarray, lat: np.ndarray, epsg: int) -> tuple[np.ndarray, np.ndarray]:
    """:func:`utm_forward` on arrays, for kernels that run on the executors."""
    zone, north0 = (epsg - 32700, 1e7) if epsg >= 32700 else (epsg - 32600, 0.0)
    phi, lam = np.radians(lat), np.radians(lon - (zone * 6 - 183))
    s = np.sin(phi)
    t = np.sinh(np.arctanh(s) - _ECC * np.arctanh(_ECC * s))
    z = np.arctan2(t, np.cos(lam)) + 1j * np.arcsinh(np.sin(lam) / np.hypot(t, np.cos(lam)))
    z = z + sum(a * np.sin(2 * j * z) for j, a in enumerate(_ALPHA, 1))
    return _E0 + _K0 * _RECT * z.imag, north0 + _K0 * _RECT * z.real


def unproject(east: np.ndarray, north: np.ndarray, epsg: int) -> tuple[np.ndarray, np.ndarray]:
    """:func:`utm_inverse` on arrays."""
    zone, north0 = (epsg - 32700, 1e7) if epsg >= 32700 else (epsg - 32600, 0.0)
    z = (np.asarray(north) - north0 + 1j * (np.asarray(east) - _E0)) / (_K0 * _RECT)
    z = z - sum(b * np.sin(2 * j * z) for j, b in enumerate(_BETA, 1))
    chi = np.arcsin(np.sin(z.real) / np.cosh(z.imag))
    lat = chi + sum(d * np.sin(2 * j * chi) for j, d in enumerate(_DELTA, 1))
    return zone * 6 - 183 + np.degrees(np.arctan2(np.sinh(z.imag), np.cos(z.real))), np.degrees(lat)


def reproject(x: np.ndarray, y: np.ndarray, source: int, target: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of one system in another: UTM zones, or degrees (4326, 4269)."""
    if source == target:
        return x, y
    for code in (source, target):
        if code not in DEGREES and not (32601 <= code <= 32660 or 32701 <= code <= 32760):
            raise ValueError(f"EPSG:{code} is neither a UTM zone nor degrees")
    lon, lat = (x, y) if source in DEGREES else unproject(x, y, source)
    return (lon, lat) if target in DEGREES else project(lon, lat, target)


def tile_id(epsg: Column, east: Column, north: Column, size_m: float) -> Column:
    cell = lambda v: F.floor(v / F.lit(float(size_m))).cast("long").cast("string")
    return F.concat_ws("_", epsg.cast("string"), cell(east), cell(north))


def slippy_tile(lon: Column, lat: Column, zoom: int) -> tuple[Column, Column]:
    n = float(1 << zoom)
    clamp = lambda v: F.greatest(F.lit(0), F.least(F.lit((1 << zoom) - 1), v.cast("long")))
    return clamp((lon + 180.0) / 360.0 * n), clamp((1.0 - F.asinh(F.tan(F.radians(lat))) / math.pi) / 2.0 * n)


def quadkey(x: Column, y: Column, zoom: int) -> Column:
    """One digit a level, the coarsest first: the bit of x plus twice that of y."""
    digits = [(F.shiftright(x, b).bitwiseAND(F.lit(1)) + 2 * F.shiftright(y, b).bitwiseAND(F.lit(1))).cast("string") for b in range(zoom - 1, -1, -1)]
    return F.concat(*digits)


def box_quadkeys(xmin: Column, ymin: Column, xmax: Column, ymax: Column, zoom: int) -> Column:
    """Quadkeys of all tiles that a box touches, by column, then row."""
    x0, y1 = slippy_tile(xmin, ymin, zoom)
    x1, y0 = slippy_tile(xmax, ymax, zoom)
    across = F.sequence(F.least(x0, x1), F.greatest(x0, x1))
    down = F.sequence(F.least(y0, y1), F.greatest(y0, y1))
    return F.array_distinct(F.flatten(F.transform(across, lambda x: F.transform(down, lambda y: quadkey(x, y, zoom)))))


def grid_cells(extent: Column, gsd: float) -> Column:
    """Pixels along an extent: at least one, the last one may reach over."""
    return F.greatest(F.lit(1), F.ceil(extent / F.lit(float(gsd)))).cast("int")


def overlap_pct(box, xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    """Share of ``box`` that an extent covers, in percent of planar degrees, two decimals."""
    wide = F.greatest(F.lit(0.0), F.least(xmax, F.lit(box[2])) - F.greatest(xmin, F.lit(box[0])))
    high = F.greatest(F.lit(0.0), F.least(ymax, F.lit(box[3])) - F.greatest(ymin, F.lit(box[1])))
    return F.round(F.lit(100.0) * wide * high / F.lit((box[2] - box[0]) * (box[3] - box[1])), 2)
