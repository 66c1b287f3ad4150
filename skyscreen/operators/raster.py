"""Map algebra over pixels: one row is (tile_id, row_idx, col_idx) with a column for each layer, null where there is no data."""

from __future__ import annotations

import hashlib
import json
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import sky
from ..functions.text import strip_query
from ..specs import NODATA, PROVENANCE

PIXEL = ["tile_id", "row_idx", "col_idx"]


def valid(value: Column, nodata: float = NODATA) -> Column:
    """The value, or null where it is the sentinel or no finite number."""
    return F.when(F.isnan(value) | (F.abs(value) == float("inf")) | (value == nodata), None).otherwise(value)


def mosaic(granules: DataFrame) -> DataFrame:
    """One value a pixel from (pixel, rank, value): the first valid one by rank."""
    return granules.where(valid(F.col("value")).isNotNull()).groupBy(*PIXEL).agg(F.min_by("value", "rank").alias("value"))


def pseudo_dsm(dem: Column, canopy: Column) -> Column:
    return dem + F.greatest(F.coalesce(canopy, F.lit(0.0)), F.lit(0.0))


def composite(dem: Column, lidar: Column, canopy: Column, building: Column) -> tuple[Column, Column]:
    """(elevation, provenance code): lidar where there is any, else terrain with what stands on it."""
    height = lambda h: F.greatest(F.coalesce(h, F.lit(0.0)), F.lit(0.0))
    stands = canopy.isNotNull() | building.isNotNull()
    elevation = F.coalesce(lidar, F.when(stands, dem + F.greatest(height(canopy), height(building))).otherwise(dem))
    modelled = F.when(building.isNotNull() & (height(building) >= height(canopy)), 4).otherwise(2)
    return elevation, F.when(lidar.isNotNull(), 3).when(dem.isNull(), 0).when(stands, modelled).otherwise(1)


def align(layers: dict[str, DataFrame]) -> DataFrame:
    """Layers (pixel, value) side by side: a full join on the pixel, one column a layer."""
    out = None
    for name, d in layers.items():
        d = d.select(*PIXEL, F.col("value").alias(name))
        out = d if out is None else out.join(d, PIXEL, "full")
    return out


def surface_pixels(layers: DataFrame) -> DataFrame:
    """Layers dem, lidar, canopy, building to ``elevation, provenance``."""
    named = {n: valid(F.col(n)) if n in layers.columns else F.lit(None).cast("double") for n in ("dem", "lidar", "canopy", "building")}
    elevation, code = composite(named["dem"], named["lidar"], named["canopy"], named["building"])
    return layers.select(*PIXEL, elevation.alias("elevation"), code.cast("long").alias("provenance"))


def tile_fractions(surface: DataFrame) -> DataFrame:
    """Per tile: share of pixels with an elevation, and the share of each provenance among those; four decimals."""
    n, known = F.count("*"), F.count_if(F.col("provenance") > 0)
    share = lambda code: F.when(known > 0, F.round(F.count_if(F.col("provenance") == code) / F.when(known > 0, known), 4)).otherwise(0.0)
    names = (("dem_fill", 1), ("pseudo", 2), ("lidar", 3), ("building", 4))
    return surface.groupBy("tile_id").agg(n.alias("n_pixels"), F.round(F.count_if(F.col("elevation").isNotNull()) / n, 4).alias("valid_fraction"), *(share(c).alias(name) for name, c in names))


def tile_summary(surface: DataFrame, modes: DataFrame) -> DataFrame:
    """Fractions with the coverage flag and confidence of each tile's mode."""
    d = tile_fractions(surface).join(modes, "tile_id")
    return d.withColumn("coverage_flag", sky.coverage_flag(F.col("mode"), F.col("valid_fraction"))).withColumn("confidence", sky.surface_confidence(F.col("mode"), F.col("valid_fraction")))


def packed(surface: DataFrame, grids: DataFrame) -> DataFrame:
    """One row a tile: ``elevation`` and ``provenance`` as packed arrays under the grid (height, width, x0, y0, gsd_m, epsg).

    A tile's pixels are one group; the grid bounds it (595 by 595 at the defaults).
    """

    def pack(group: pa.Table) -> pa.Table:
        head = group.slice(0, 1).to_pylist()[0]
        shape = head["height"], head["width"]
        elevation, code = np.full(shape, np.nan, np.float32), np.zeros(shape, np.int8)
        at = group.column("row_idx").to_numpy(), group.column("col_idx").to_numpy()
        inside = (at[0] >= 0) & (at[0] < shape[0]) & (at[1] >= 0) & (at[1] < shape[1])
        at = at[0][inside], at[1][inside]
        elevation[at] = np.array([np.nan if v is None else v for v in group.column("elevation").to_pylist()], np.float32)[inside]
        code[at] = group.column("provenance").to_numpy()[inside]
        names = ("tile_id", "height", "width", "x0", "y0", "gsd_m", "epsg")
        return pa.table({**{n: group.column(n).slice(0, 1) for n in names}, "elevation": pa.array([elevation.tobytes()], pa.binary()), "provenance": pa.array([code.tobytes()], pa.binary())})

    d = surface.join(grids, "tile_id").select("tile_id", "height", "width", "x0", "y0", "gsd_m", "epsg", "row_idx", "col_idx", "elevation", "provenance")
    return d.groupBy("tile_id").applyInArrow(pack, f"tile_id {dict(surface.dtypes)['tile_id']}, height int, width int, x0 double, y0 double, gsd_m double, epsg int, elevation binary, provenance binary")


def warp_bilinear(source: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Values at fractional pixel positions from the four neighbours that have data, weighted; NaN where none has."""
    r0, c0 = np.floor(rows).astype(np.int64), np.floor(cols).astype(np.int64)
    fr, fc = rows - r0, cols - c0
    total, weight = np.zeros(rows.shape), np.zeros(rows.shape)
    for dr, wr in ((0, 1 - fr), (1, fr)):
        for dc, wc in ((0, 1 - fc), (1, fc)):
            r, c = r0 + dr, c0 + dc
            inside = (r >= 0) & (r < source.shape[0]) & (c >= 0) & (c < source.shape[1])
            value = np.where(inside, source[np.clip(r, 0, source.shape[0] - 1), np.clip(c, 0, source.shape[1] - 1)], np.nan)
            w = np.where(np.isfinite(value), wr * wc, 0.0)
            total += np.where(w > 0, value, 0.0) * w
            weight += w
    return np.where(weight > 0, total / np.where(weight > 0, weight, 1.0), np.nan)


def rings(wkb: bytes) -> list[np.ndarray]:
    """All rings of a (multi)polygon in well-known binary, with or without a third dimension."""
    out: list[np.ndarray] = []

    def read(at: int) -> int:
        order = "<" if wkb[at] == 1 else ">"
        kind = struct.unpack_from(order + "I", wkb, at + 1)[0]
        at += 5 + (4 if kind & 0x20000000 else 0)
        dims = 3 if kind & 0x80000000 or (kind & 0xFFFF) // 1000 in (1, 2) else 2
        flat = (kind & 0xFFFF) % 1000
        n = struct.unpack_from(order + "I", wkb, at)[0]
        at += 4
        if flat == 3:
            for _ in range(n):
                points = struct.unpack_from(order + "I", wkb, at)[0]
                out.append(np.frombuffer(wkb, order + "f8", points * dims, at + 4).reshape(points, dims)[:, :2].astype(float))
                at += 4 + points * dims * 8
        elif flat in (6, 7):
            for _ in range(n):
                at = read(at)
        else:
            raise ValueError(f"geometry kind {kind}")
        return at

    read(0)
    return out


def burn(polygon: list[np.ndarray], x0: float, y0: float, gsd: float, height: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the pixels whose centre lies inside, by the even-odd rule."""
    points = np.concatenate(polygon)
    c_lo, c_hi = (int(np.floor((v - x0) / gsd)) for v in (points[:, 0].min(), points[:, 0].max()))
    r_lo, r_hi = (int(np.floor((y0 - v) / gsd)) for v in (points[:, 1].max(), points[:, 1].min()))
    cols, rows = np.arange(max(0, c_lo), min(width - 1, c_hi) + 1), np.arange(max(0, r_lo), min(height - 1, r_hi) + 1)
    if not len(cols) or not len(rows):
        return np.zeros(0, int), np.zeros(0, int)
    x, y = np.meshgrid(x0 + (cols + 0.5) * gsd, y0 - (rows + 0.5) * gsd)
    inside = np.zeros(x.shape, bool)
    for ring in polygon:
        ax, ay = ring[:, 0], ring[:, 1]
        for k in range(len(ring)):
            bx, by = ax[k - 1], ay[k - 1]
            crosses = (ay[k] > y) != (by > y)
            if crosses.any():
                inside ^= crosses & (x < (bx - ax[k]) * (y - ay[k]) / ((by - ay[k]) or 1e-300) + ax[k])
    r, c = np.nonzero(inside)
    return rows[r], cols[c]


def rasterize(buildings: DataFrame, grids: DataFrame) -> DataFrame:
    """``building`` height of every pixel: of the footprints (tile_id, geometry in the grid's metres, height_m) that cover its
    centre, the tallest. Heights of zero or less, null and broken geometries are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for r in b.to_pylist():
                try:
                    rows, cols = burn(rings(bytes(r["geometry"])), r["x0"], r["y0"], r["gsd_m"], r["height"], r["width"])
                except (ValueError, struct.error, IndexError):
                    continue
                out += zip([r["tile_id"]] * len(rows), rows.tolist(), cols.tolist(), [r["height_m"]] * len(rows), strict=True)
            if out:
                a, c, d, e = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, b.schema.field("tile_id").type), pa.array(c, pa.int64()), pa.array(d, pa.int64()), pa.array(e, pa.float64())], names=[*PIXEL, "building"])

    tall = buildings.where("height_m > 0 and geometry is not null").join(grids, "tile_id").select("tile_id", "geometry", "height_m", "x0", "y0", "gsd_m", "height", "width")
    kind = dict(tall.dtypes)["tile_id"]
    return tall.mapInArrow(run, f"tile_id {kind}, row_idx long, col_idx long, building double").groupBy(*PIXEL).agg(F.max("building").alias("building"))


def cache_key(tile: str, box, hrefs: dict[str, list[str]], crs: str, gsd_m: float, mode: str) -> str:
    """A name for a surface that depends on what it is built from; query strings of addresses don't count."""
    plain = {k: [h.split("?", 1)[0] for h in v] for k, v in hrefs.items()}
    what = {"bbox": [round(float(v), 6) for v in box], "hrefs": plain, "crs": crs, "gsd": float(gsd_m), "mode": mode}
    return f"{tile}__{hashlib.sha1(json.dumps(what, sort_keys=True).encode()).hexdigest()[:16]}"


def adhoc_tile(box) -> str:
    return "adhoc_" + hashlib.sha1(json.dumps([round(float(v), 6) for v in box]).encode()).hexdigest()[:8]


def provenance_name(code: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, PROVENANCE)), (code + 1).cast("int"))


def plain_hrefs(items: DataFrame) -> DataFrame:
    return items.withColumn("href", strip_query(F.col("href")))
