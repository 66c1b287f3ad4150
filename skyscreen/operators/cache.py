"""The cache of built surfaces: a table by key, in which a key names all that a surface is built from."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..specs import TileSpec
from . import surfaces
from .raster import cache_key

_NOTES = ("tile_id", "cache_key", "epsg", "gsd_m", "height", "width", "mode", "coverage_flag", "confidence", "valid_fraction")


def keyed(tiles: DataFrame, hrefs: dict[str, list[str]], crs: str, gsd_m: float, mode: str) -> DataFrame:
    """Tiles (tile_id, min_lon, min_lat, max_lon, max_lat, ...) with the ``cache_key`` of the surface that they would get."""
    box = ["min_lon", "min_lat", "max_lon", "max_lat"]

    @F.arrow_udf("string")
    def key(tile: pa.Array, *corners: pa.Array) -> pa.Array:
        rows = zip(tile.to_pylist(), *(c.to_pylist() for c in corners), strict=True)
        return pa.array([cache_key(str(t), b, hrefs, crs, gsd_m, mode) for t, *b in rows], pa.string())

    return tiles.withColumn("cache_key", key("tile_id", *box))


def read(spark: SparkSession, path: str) -> DataFrame | None:
    """The cache's table, or None while nothing is in it."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def listing(cached: DataFrame, tile: str | None = None) -> DataFrame:
    """What the cache holds, of one tile or of all: notes only, the arrays are not read."""
    d = cached.where(F.col("tile_id").cast("string") == tile) if tile else cached
    return d.select(*[c for c in _NOTES if c in cached.columns]).orderBy("tile_id", "cache_key")


def missing(wanted: DataFrame, cached: DataFrame | None) -> DataFrame:
    """Rows of ``wanted`` whose key the cache lacks."""
    return wanted if cached is None else wanted.join(cached.select("cache_key"), "cache_key", "left_anti")


def fetch(spark: SparkSession, tiles: DataFrame, catalogue: DataFrame, granules: str, path: str, crs: str, mode: str | None = None, spec: TileSpec = TileSpec(), buildings: DataFrame | None = None) -> DataFrame:
    """The surfaces of ``tiles``: those that the cache has are taken from it, the others are built and added.

    Tiles that can't be built are not added, and so are tried again by the next run; their errors are in ``errors`` beside
    the cache. A file's address counts without its query string. An interrupted run adds nothing, as a batch is written whole.
    """
    files = catalogue.select("layer", "rank", "name").distinct().groupBy("layer").agg(F.sum(F.xxhash64("rank", "name").cast("decimal(38,0)")).alias("files"))
    layers = {r["layer"]: [str(r["files"])] for r in files.collect()}  # a number a layer, however many files it has
    wanted = keyed(tiles, layers, crs, spec.target_gsd_m, mode or "auto")
    todo = missing(wanted, read(spark, path))
    built = surfaces.build(surfaces.granules_of(spark, todo, catalogue, granules), surfaces.grids(todo, spec), buildings, mode)
    built = built.join(todo.select("tile_id", "cache_key"), "tile_id")
    built.write.mode("overwrite").parquet(f"{path}.building")
    fresh = spark.read.parquet(f"{path}.building")
    fresh.where("error is null").write.mode("append").parquet(path)
    fresh.where("error is not null").select("tile_id", "error").write.mode("overwrite").json(f"{path}.errors")
    return spark.read.parquet(path).join(wanted.select("cache_key"), "cache_key", "left_semi")
