"""Surfaces of whole tiles from raster granules and footprints, all on one grid a tile.

Granules are warped one by one; a tile's layers, each a packed array, meet once, where the composite is made. The largest
thing that a task holds is the granules of one tile on its grid.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo, sky
from ..sources.geotiff import read_geotiff
from ..specs import NODATA, SURFACE_MODES, TileSpec
from .raster import rasterize, warp_bilinear

_GRID = "height int, width int, x0 double, y0 double, gsd_m double, epsg int"
GRID = ("height", "width", "x0", "y0", "gsd_m", "epsg")
#: Layers that a mode can't do without, and those that it takes if they are there.
_NEEDS = {"mosaic": ("lidar", "dem"), "true_dsm": ("lidar",), "pseudo_dsm": ("dem",), "cover_proxy": ("dem",)}
_TAKES = {"mosaic": ("canopy", "building"), "pseudo_dsm": ("canopy", "building")}


def grid_of(box, epsg: int, gsd_m: float) -> dict:
    """The grid that covers a box of degrees: its edges are followed in 21 steps, as straight lines bend on the way."""
    t = np.linspace(0, 1, 22)
    low, high = np.full(22, 0.0), np.full(22, 1.0)
    u, v = np.concatenate([t, t, low, high]), np.concatenate([low, high, t, t])
    x, y = geo.reproject(box[0] + u * (box[2] - box[0]), box[1] + v * (box[3] - box[1]), 4326, epsg)
    size = lambda d: max(1, math.ceil(d / gsd_m))
    return {"height": size(y.max() - y.min()), "width": size(x.max() - x.min()), "x0": float(x.min()), "y0": float(y.max()), "gsd_m": gsd_m, "epsg": epsg}


def grids(tiles: DataFrame, spec: TileSpec = TileSpec()) -> DataFrame:
    """``tile_id`` and the grid of every tile (tile_id, utm_epsg, min_lon, min_lat, max_lon, max_lat)."""
    kind = dict(tiles.dtypes)["tile_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [grid_of((r["min_lon"], r["min_lat"], r["max_lon"], r["max_lat"]), r["utm_epsg"], spec.target_gsd_m) for r in b.to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array([r[n] for r in rows], t) for n, t in zip(GRID, (pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.float64(), pa.int32()), strict=True))], names=["tile_id", *GRID])

    return tiles.select("tile_id", "utm_epsg", "min_lon", "min_lat", "max_lon", "max_lat").mapInArrow(run, f"tile_id {kind}, {_GRID}")


def granules_of(spark: SparkSession, tiles: DataFrame, catalogue: DataFrame, path: str) -> DataFrame:
    """``tile_id, layer, rank, content``: files under ``path`` for every tile whose box the catalogue's (layer, rank, name, box) overlaps.

    Only files that a tile needs are read. Boxes meet by quadkey, so no pair of far boxes is compared.
    """
    keys = lambda d, *box: d.withColumn("_q", F.explode(geo.box_quadkeys(*(F.col(c) for c in box), 8)))
    t = keys(tiles.select("tile_id", "min_lon", "min_lat", "max_lon", "max_lat"), "min_lon", "min_lat", "max_lon", "max_lat")
    c = keys(catalogue.select("layer", "rank", "name", "xmin", "ymin", "xmax", "ymax"), "xmin", "ymin", "xmax", "ymax")
    touch = (F.col("xmin") <= F.col("max_lon")) & (F.col("xmax") >= F.col("min_lon")) & (F.col("ymin") <= F.col("max_lat")) & (F.col("ymax") >= F.col("min_lat"))
    wanted = t.join(c, "_q").where(touch).select("tile_id", "layer", "rank", "name").distinct()
    files = spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")
    return wanted.join(files, "name").select("tile_id", "layer", "rank", "content")


def warp_to(source: dict, grid: dict, band: int = 0) -> np.ndarray:
    """A raster that was read, on another grid; bilinear, NaN where it has no data."""
    values = source["bands"][band].astype(np.float64)
    values[~np.isfinite(values) | (values == (NODATA if source["nodata"] is None else source["nodata"]))] = np.nan
    x, y = np.meshgrid(grid["x0"] + (np.arange(grid["width"]) + 0.5) * grid["gsd_m"], grid["y0"] - (np.arange(grid["height"]) + 0.5) * grid["gsd_m"])
    x, y = geo.reproject(x, y, grid["epsg"], source["epsg"] or grid["epsg"])
    return warp_bilinear(values, (source["y0"] - y) / source["gsd_m"] - 0.5, (x - source["x0"]) / source["gsd_x"] - 0.5).astype(np.float32)


def window_for(grid: dict):
    """The part of a raster that a grid needs: its edges in the raster's system, with two pixels to spare on each side."""

    def window(head: dict) -> tuple[int, int, int, int]:
        t = np.linspace(0, 1, 22)
        u, v = np.concatenate([t, t, np.zeros(22), np.ones(22)]), np.concatenate([np.zeros(22), np.ones(22), t, t])
        x, y = geo.reproject(grid["x0"] + u * grid["width"] * grid["gsd_m"], grid["y0"] - v * grid["height"] * grid["gsd_m"], grid["epsg"], head["epsg"] or grid["epsg"])
        rows, cols = (head["y0"] - y) / head["gsd_m"], (x - head["x0"]) / head["gsd_x"]
        return math.floor(rows.min()) - 2, math.floor(cols.min()) - 2, math.ceil(rows.max()) + 2, math.ceil(cols.max()) + 2

    return window


def layers(granules: DataFrame, grids: DataFrame) -> DataFrame:
    """``tile_id, layer, rank, values, error``: each granule on its tile's grid, packed; what can't be read has an error."""
    kind = dict(granules.dtypes)["tile_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                r = b.slice(k, 1).to_pylist()[0]
                values = error = None
                try:
                    values = warp_to(read_geotiff(r["content"], window_for(r)), r).tobytes()
                except Exception as e:  # noqa: BLE001 - any broken file is that tile's error
                    error = f"{r['layer']}: {type(e).__name__}: {e}"[:200]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(k, 1), pa.array([r["layer"]]), pa.array([r["rank"]], pa.int32()), pa.array([values], pa.binary()), pa.array([error], pa.string())], names=["tile_id", "layer", "rank", "values", "error"])

    d = granules.join(grids, "tile_id").select("tile_id", "layer", F.col("rank").cast("int").alias("rank"), "content", *GRID)
    return d.mapInArrow(run, f"tile_id {kind}, layer string, rank int, values binary, error string")


def building_layers(buildings: DataFrame, grids: DataFrame) -> DataFrame:
    """Footprints (tile_id, geometry in the grid's metres, height_m) as one packed layer a tile."""
    kind = dict(buildings.dtypes)["tile_id"]

    def pack(group: pa.Table) -> pa.Table:
        head = group.slice(0, 1).to_pylist()[0]
        values = np.full((head["height"], head["width"]), np.nan, np.float32)
        values[group.column("row_idx").to_numpy(), group.column("col_idx").to_numpy()] = group.column("building").to_numpy()
        return pa.table({"tile_id": group.column("tile_id").slice(0, 1), "layer": ["building"], "rank": pa.array([0], pa.int32()), "values": pa.array([values.tobytes()], pa.binary()), "error": pa.array([None], pa.string())})

    d = rasterize(buildings, grids).join(grids.select("tile_id", "height", "width"), "tile_id")
    return d.groupBy("tile_id").applyInArrow(pack, f"tile_id {kind}, layer string, rank int, values binary, error string")


def mode_of(there: set[str], wanted: str | None = None) -> str:
    """The mode asked for, if the layers allow it, else the best that they do."""
    dsm, dem, standing = "lidar" in there, "dem" in there, bool(there & {"canopy", "building"})
    if wanted is None:
        if not dsm and not dem:
            raise ValueError("neither a surface nor terrain to build from")
        return ("mosaic" if dem else "true_dsm") if dsm else "pseudo_dsm" if standing else "cover_proxy"
    lacks = [n for n in _NEEDS[wanted] if n not in there]
    if wanted == "pseudo_dsm" and not standing:
        lacks.append("canopy or building")
    if lacks:
        after = SURFACE_MODES[SURFACE_MODES.index(wanted) + 1 :]
        raise ValueError(f"{wanted} lacks {', '.join(lacks)}" + (f"; next is {after[0]}" if after else ""))
    return wanted


def fuse(found: dict[str, np.ndarray], shape: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """(elevation, provenance code) of packed layers: lidar where there is any, else terrain with what stands on it."""
    none = np.full(shape, np.nan, np.float32)
    dem, lidar, canopy, building = (found.get(n, none) for n in ("dem", "lidar", "canopy", "building"))
    tree, roof = (np.maximum(np.nan_to_num(v, nan=0.0), 0) for v in (canopy, building))
    stands = np.isfinite(canopy) | np.isfinite(building)
    elevation = np.where(np.isfinite(lidar), lidar, np.where(stands, dem + np.maximum(tree, roof), dem)).astype(np.float32)
    modelled = np.where(np.isfinite(building) & (roof >= tree), 4, 2)
    code = np.select([np.isfinite(lidar), ~np.isfinite(dem), stands], [3, 0, modelled], 1)
    return elevation, code.astype(np.int8)


def build(granules: DataFrame, grids: DataFrame, buildings: DataFrame | None = None, mode: str | None = None) -> DataFrame:
    """A packed surface for every tile that has layers, as :func:`..horizon.score` takes it.

    ``granules``: tile_id, layer (dem, lidar, canopy), rank, content. Of a layer's granules the first valid value by rank
    counts. ``mode`` holds for all tiles; without it each takes the best that its layers allow. Tiles that lack a layer or
    have a broken granule get a row with ``error`` and no arrays; the others go on. Footprints count where the mode models
    what stands.
    """
    if mode is not None and mode not in SURFACE_MODES:
        raise ValueError(f"mode must be one of {SURFACE_MODES}")
    kind = dict(granules.dtypes)["tile_id"]
    parts = layers(granules, grids)
    if buildings is not None:
        parts = parts.unionByName(building_layers(buildings, grids))

    def combine(group: pa.Table) -> pa.Table:
        rows = sorted(group.select(["layer", "rank", "values", "error"]).to_pylist(), key=lambda r: (r["layer"], r["rank"]))
        head = group.select(list(GRID)).slice(0, 1).to_pylist()[0]
        shape, got, chosen, error, known = (head["height"], head["width"]), None, None, None, 0.0
        try:
            chosen = mode_of({r["layer"] for r in rows}, mode)
            uses = _NEEDS[chosen] + _TAKES.get(chosen, ())
            found: dict[str, np.ndarray] = {}
            for r in rows:
                if r["layer"] not in uses:
                    continue
                if r["error"]:
                    raise ValueError(r["error"])
                values = np.frombuffer(r["values"], np.float32).reshape(shape)
                before = found.get(r["layer"])
                found[r["layer"]] = values if before is None else np.where(np.isfinite(before), before, values)
            got = fuse(found, shape)
            known = float(np.isfinite(got[0]).mean())
        except ValueError as e:
            error = str(e)[:200]
        return pa.table({"tile_id": group.column("tile_id").slice(0, 1), **{n: group.column(n).slice(0, 1) for n in GRID}, "elevation": pa.array([got and got[0].tobytes()], pa.binary()), "provenance": pa.array([got and got[1].tobytes()], pa.binary()), "mode": pa.array([chosen], pa.string()), "valid_fraction": [round(known, 4)], "error": pa.array([error], pa.string())})

    d = parts.join(grids, "tile_id").groupBy("tile_id").applyInArrow(combine, f"tile_id {kind}, {_GRID}, elevation binary, provenance binary, mode string, valid_fraction double, error string")
    built = F.col("error").isNull()
    flag, level = sky.coverage_flag(F.col("mode"), F.col("valid_fraction")), sky.surface_confidence(F.col("mode"), F.col("valid_fraction"))
    return d.withColumn("coverage_flag", F.when(built, flag)).withColumn("confidence", F.when(built, level))
