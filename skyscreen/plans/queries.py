"""Every operator as a query over the star schema's tables, with the same in SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import geo, sky, text
from ..operators import cache, catalog, horizon, locations, quality, raster, rollup, work
from ..specs import AOI, CONUS, SkySpec, TileSpec
from .fixtures import Fixtures, ctes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
_BOX = (-80.0, 35.0, -78.5, 35.1)
_RAYS = SkySpec(azimuth_step_deg=30.0, max_radius_m=30.0)
_GRID = TileSpec(tile_size_m=5000.0)


def query(sql: str | None = None, *views: str):
    def add(f: Callable[[Fixtures], DataFrame]):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Fixtures(spark, sf_dir))
        if sql:
            ORACLE[f.__name__] = f"{ctes(*views)} {sql}" if views else sql
        return f

    return add


_USABLE = "latitude IS NOT NULL AND longitude IS NOT NULL AND latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180"


# --- locations


@query("""SELECT count(*) AS total_rows, count(*) FILTER (WHERE latitude IS NULL OR longitude IS NULL) AS null_coords,
 count(*) FILTER (WHERE latitude NOT BETWEEN -90 AND 90 OR longitude NOT BETWEEN -180 AND 180) AS out_of_range,
 count(DISTINCT (latitude, longitude)) AS distinct_coords, count(*) - count(DISTINCT location_id) AS duplicate_ids FROM locations""", "locations")
def profile_locations(x: Fixtures) -> DataFrame:
    return locations.profile(x.locations)


@query(f"SELECT min(longitude) AS min_lon, min(latitude) AS min_lat, max(longitude) AS max_lon, max(latitude) AS max_lat, count(*) AS n_points, count(DISTINCT (latitude, longitude)) AS n_distinct FROM locations WHERE {_USABLE}", "locations")
def aoi_bbox(x: Fixtures) -> DataFrame:
    return locations.aoi_box(x.locations)


@query(f"SELECT count(*) AS n_points, count(DISTINCT (latitude, longitude)) AS n_distinct FROM locations WHERE {_USABLE} AND latitude BETWEEN 35.0 AND 35.1 AND longitude BETWEEN -80.0 AND -78.5", "locations")
def count_in_bbox(x: Fixtures) -> DataFrame:
    return locations.count_in_box(x.locations, _BOX)


_IN = "latitude BETWEEN 33.84 AND 36.59 AND longitude BETWEEN -84.32 AND -75.46"


@query(f"""SELECT count(*) AS total, count(*) FILTER (WHERE latitude IS NULL OR longitude IS NULL) AS null_coords,
 count(*) FILTER (WHERE latitude NOT BETWEEN -90 AND 90 OR longitude NOT BETWEEN -180 AND 180) AS out_of_range,
 count(*) FILTER (WHERE latitude = 0 AND longitude = 0) AS null_island,
 count(*) FILTER (WHERE {_USABLE} AND NOT (latitude = 0 AND longitude = 0) AND NOT ({_IN})) AS off_aoi,
 count(*) FILTER (WHERE NOT ({_IN}) AND longitude BETWEEN 33.84 AND 36.59 AND latitude BETWEEN -84.32 AND -75.46) AS swapped_suspect,
 count(DISTINCT (latitude, longitude)) AS distinct_coords FROM locations""", "locations")
def input_audit(x: Fixtures) -> DataFrame:
    return locations.audit_counts(x.locations, AOI)


@query("SELECT coord_id, latitude, longitude, n_locations FROM unique_coords", "unique_coords")
def dedup_unique_coords(x: Fixtures) -> DataFrame:
    return locations.unique_coords(x.locations)


@query("SELECT location_id, coord_id FROM keyed k JOIN unique_coords u ON k.lat_key = CAST(round(u.latitude * 1000000) AS BIGINT) AND k.lon_key = CAST(round(u.longitude * 1000000) AS BIGINT)", "unique_coords")
def dedup_location_map(x: Fixtures) -> DataFrame:
    return locations.location_map(x.locations, x.coords)


@query(f"""SELECT CAST(row_number() OVER (ORDER BY a, b) - 1 AS BIGINT) AS coord_id, CAST(a AS DOUBLE) / CAST(100 AS DOUBLE) AS latitude, CAST(b AS DOUBLE) / CAST(100 AS DOUBLE) AS longitude, n_locations
FROM (SELECT CAST(round(latitude * 100) AS BIGINT) AS a, CAST(round(longitude * 100) AS BIGINT) AS b, count(*) AS n_locations FROM locations WHERE {_USABLE} GROUP BY 1, 2) g""", "locations")
def dedup_low_precision(x: Fixtures) -> DataFrame:
    return locations.unique_coords(x.locations, precision=2)


@query("SELECT CAST(sum(n_locations) AS BIGINT) AS usable, count(*) AS unique_coords, max(n_locations) AS most_on_one, CAST(sum(n_locations) - count(*) AS BIGINT) AS duplicates FROM unique_coords", "unique_coords")
def dedup_reduction(x: Fixtures) -> DataFrame:
    n = F.col("n_locations")
    return x.coords.agg(F.sum(n).alias("usable"), F.count("*").alias("unique_coords"), F.max(n).alias("most_on_one"), (F.sum(n) - F.count("*")).alias("duplicates"))


@query("SELECT count(*) AS groups, CAST(coalesce(sum(n), 0) AS BIGINT) AS rows_in_groups, coalesce(max(n), 0) AS largest FROM (SELECT count(*) AS n FROM locations WHERE latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY latitude, longitude HAVING count(*) > 1) g", "locations")
def duplicate_coord_groups(x: Fixtures) -> DataFrame:
    return locations.duplicate_groups(x.locations)


@query("SELECT count(*) - count(DISTINCT location_id) AS surplus, count(*) AS n FROM locations", "locations")
def duplicate_location_ids(x: Fixtures) -> DataFrame:
    return x.locations.agg((F.count("*") - F.count_distinct("location_id")).alias("surplus"), F.count("*").alias("n"))


@query("SELECT county, count(*) AS n_coords, CAST(sum(n_locations) AS BIGINT) AS households FROM unique_coords GROUP BY county", "unique_coords")
def county_weights(x: Fixtures) -> DataFrame:
    coords = locations.unique_coords(x.locations)
    d = locations.coord_counties(x.locations, coords, locations.location_map(x.locations, coords))
    return d.groupBy("county").agg(F.count("*").alias("n_coords"), F.sum("n_locations").alias("households"))


@query(f"SELECT 'fallback' AS source, {CONUS[0]}::DOUBLE AS min_lon, {CONUS[1]}::DOUBLE AS min_lat, {CONUS[2]}::DOUBLE AS max_lon, {CONUS[3]}::DOUBLE AS max_lat")
def aoi_fallback(x: Fixtures) -> DataFrame:
    """Where the box comes from if no row has a usable coordinate."""
    box, where = locations.resolve_aoi(x.locations.where("latitude > 90"))
    return x.spark.createDataFrame([(where, *box)], "source string, min_lon double, min_lat double, max_lon double, max_lat double")


# --- geography

_ZONE = "((CAST(floor((longitude + 180.0) / 6.0) AS BIGINT) % 60 + 60) % 60 + 1 + CASE WHEN latitude >= 0 THEN 32600 ELSE 32700 END)"


@query(f"SELECT coord_id, CAST({_ZONE} AS INTEGER) AS epsg FROM unique_coords", "unique_coords")
def utm_epsg(x: Fixtures) -> DataFrame:
    return x.coords.select("coord_id", geo.utm_epsg(F.col("longitude"), F.col("latitude")).alias("epsg"))


def _series(coefficients, a: str, f: str, g: str) -> str:
    return " + ".join(f"{c!r}::DOUBLE * {f}({2 * j} * {a}) * {g}({2 * j} * eta)" for j, c in enumerate(coefficients, 1))


_UTM = f"""p AS (SELECT *, radians(latitude) AS phi, radians(longitude - (-81.0::DOUBLE)) AS lam FROM unique_coords),
t AS (SELECT *, sinh(atanh(sin(phi)) - {geo._ECC!r}::DOUBLE * atanh({geo._ECC!r}::DOUBLE * sin(phi))) AS t FROM p),
x AS (SELECT *, atan2(t, cos(lam)) AS xi, asinh(sin(lam) / sqrt(t * t + cos(lam) * cos(lam))) AS eta FROM t),
m AS (SELECT *, 500000.0::DOUBLE + {geo._K0 * geo._RECT!r}::DOUBLE * (eta + {_series(geo._ALPHA, 'xi', 'cos', 'sinh')}) AS easting, {geo._K0 * geo._RECT!r}::DOUBLE * (xi + {_series(geo._ALPHA, 'xi', 'sin', 'cosh')}) AS northing FROM x)"""


@query(f", {_UTM} SELECT coord_id, round(easting, 3) AS easting, round(northing, 3) AS northing FROM m", "unique_coords")
def utm_forward(x: Fixtures) -> DataFrame:
    east, north = geo.utm_forward(F.col("longitude"), F.col("latitude"), F.lit(32617))
    return x.coords.select("coord_id", F.round(east, 3).alias("easting"), F.round(north, 3).alias("northing"))


@query("SELECT coord_id, round(longitude, 8) AS lon, round(latitude, 8) AS lat FROM unique_coords", "unique_coords")
def utm_round_trip(x: Fixtures) -> DataFrame:
    """Every coordinate to its own zone and back."""
    zone = geo.utm_epsg(F.col("longitude"), F.col("latitude"))
    east, north = geo.utm_forward(F.col("longitude"), F.col("latitude"), F.col("zone"))
    lon, lat = geo.utm_inverse(F.col("e"), F.col("n"), F.col("zone"))
    d = x.coords.withColumn("zone", zone).select("coord_id", "zone", east.alias("e"), north.alias("n"))
    return d.select("coord_id", F.round(lon, 8).alias("lon"), F.round(lat, 8).alias("lat"))


_TILE = "concat('32617_', CAST(CAST(floor(easting / 5000.0) AS BIGINT) AS VARCHAR), '_', CAST(CAST(floor(northing / 5000.0) AS BIGINT) AS VARCHAR))"


@query(f", {_UTM} SELECT coord_id, {_TILE} AS tile_id FROM m", "unique_coords")
def tile_assign(x: Fixtures) -> DataFrame:
    return locations.assign_tiles(x.coords, 32617, _GRID).select("coord_id", "tile_id")


@query(f", {_UTM} SELECT {_TILE} AS tile_id, count(*) AS n_coords FROM m GROUP BY 1", "unique_coords")
def tile_counts(x: Fixtures) -> DataFrame:
    return locations.tiles(locations.assign_tiles(x.coords, 32617, _GRID), 32617, _GRID).select("tile_id", "n_coords")


_SCALE = f"{geo._K0 * geo._RECT!r}::DOUBLE"
_BACK = " + ".join(f"{c!r}::DOUBLE * sin({2 * j} * chi)" for j, c in enumerate(geo._DELTA, 1))
_BOXES = f"""{_UTM}, t0 AS (SELECT CAST(floor(easting / 5000.0) AS BIGINT) AS ix, CAST(floor(northing / 5000.0) AS BIGINT) AS iy, count(*) AS n_coords FROM m GROUP BY 1, 2),
c0 AS (SELECT ix, iy, n_coords, (iy * 5000 + dy)::DOUBLE / {_SCALE} AS xi, (ix * 5000 + dx - 500000)::DOUBLE / {_SCALE} AS eta FROM t0, (VALUES (-300, -300), (-300, 5300), (5300, -300), (5300, 5300)) v(dx, dy)),
c1 AS (SELECT *, xi - ({_series(geo._BETA, 'xi', 'sin', 'cosh')}) AS a, eta - ({_series(geo._BETA, 'xi', 'cos', 'sinh')}) AS b FROM c0),
c2 AS (SELECT *, asin(sin(a) / cosh(b)) AS chi, -81.0::DOUBLE + degrees(atan2(sinh(b), cos(a))) AS lon FROM c1),
c3 AS (SELECT *, degrees(chi + {_BACK}) AS lat FROM c2)"""


@query(f", {_BOXES} SELECT concat('32617_', CAST(ix AS VARCHAR), '_', CAST(iy AS VARCHAR)) AS tile_id, 32617 AS utm_epsg, round(min(lon), 8) AS min_lon, round(min(lat), 8) AS min_lat, round(max(lon), 8) AS max_lon, round(max(lat), 8) AS max_lat, any_value(n_coords) AS n_coords FROM c3 GROUP BY ix, iy", "unique_coords")
def tile_boxes(x: Fixtures) -> DataFrame:
    d = locations.tiles(locations.assign_tiles(x.coords, locations.grid_epsg(x.coords), _GRID), 32617, _GRID)
    return d.select("tile_id", "utm_epsg", *(F.round(c, 8).alias(c) for c in ("min_lon", "min_lat", "max_lon", "max_lat")), "n_coords")


_SLIPPY = "least(greatest(CAST(trunc((longitude + 180.0) / 360.0 * 64) AS BIGINT), 0), 63) AS x, least(greatest(CAST(trunc((1.0 - asinh(tan(radians(latitude))) / pi()) / 2.0 * 64) AS BIGINT), 0), 63) AS y"
_QK = "concat(" + ", ".join(f"CAST(((x >> {b}) & 1) + 2 * ((y >> {b}) & 1) AS VARCHAR)" for b in range(5, -1, -1)) + ")"


@query(f", s AS (SELECT coord_id, {_SLIPPY} FROM unique_coords) SELECT coord_id, x, y, {_QK} AS quadkey FROM s", "unique_coords")
def slippy_quadkey(x: Fixtures) -> DataFrame:
    a, b = geo.slippy_tile(F.col("longitude"), F.col("latitude"), 6)
    return x.coords.select("coord_id", a.alias("x"), b.alias("y")).withColumn("quadkey", geo.quadkey(F.col("x"), F.col("y"), 6))


@query("""SELECT a.id AS id_a, b.id AS id_b FROM items a JOIN items b ON a.collection = 'c0' AND b.collection = 'c1' AND a.xmin <= b.xmax AND a.xmax >= b.xmin AND a.ymin <= b.ymax AND a.ymax >= b.ymin""", "items")
def bbox_overlap_join(x: Fixtures) -> DataFrame:
    return catalog.overlap_join(x.items.where("collection = 'c0'"), x.items.where("collection = 'c1'"), 6)


@query("SELECT id, greatest(1, CAST(ceil((xmax - xmin) * 1000 / 30.0) AS INTEGER)) AS width, greatest(1, CAST(ceil((ymax - ymin) * 1000 / 30.0) AS INTEGER)) AS height FROM items", "items")
def grid_shape(x: Fixtures) -> DataFrame:
    return x.items.select("id", geo.grid_cells((F.col("xmax") - F.col("xmin")) * 1000, 30.0).alias("width"), geo.grid_cells((F.col("ymax") - F.col("ymin")) * 1000, 30.0).alias("height"))


# --- heights, layers, surfaces


@query("""SELECT p_partkey, CAST(CASE gem WHEN 'HHT:15.00' THEN 15 WHEN 'H:2' THEN 6 WHEN 'HAPP:3' THEN 9 WHEN 'HBET:1-5' THEN 9 WHEN 'H:1+HHT:3.50' THEN 3.5 END AS DOUBLE) AS height_m FROM layers""", "layers")
def gem_height_parse(x: Fixtures) -> DataFrame:
    return x.layers.select("p_partkey", sky.gem_height(F.col("gem")).alias("height_m"))


@query("SELECT tile_id, row_idx, col_idx, coalesce(lidar, building, dem) AS value FROM layers WHERE coalesce(lidar, building, dem) IS NOT NULL", "layers")
def mosaic_coalesce(x: Fixtures) -> DataFrame:
    parts = [x.layers.select(*raster.PIXEL, F.lit(i).alias("rank"), F.col(c).alias("value")) for i, c in enumerate(("lidar", "building", "dem"))]
    return raster.mosaic(parts[0].unionByName(parts[1]).unionByName(parts[2]))


@query("SELECT tile_id, row_idx, col_idx, dem + greatest(coalesce(canopy, 0), 0) AS elevation FROM layers", "layers")
def pseudo_dsm(x: Fixtures) -> DataFrame:
    return x.layers.select(*raster.PIXEL, raster.pseudo_dsm(F.col("dem"), F.col("canopy")).alias("elevation"))


_COMPOSITE = """s AS (SELECT tile_id, row_idx, col_idx, CASE WHEN lidar IS NOT NULL THEN lidar WHEN canopy IS NULL AND building IS NULL THEN dem ELSE dem + greatest(coalesce(canopy, 0), coalesce(building, 0), 0) END AS elevation,
 CAST(CASE WHEN lidar IS NOT NULL THEN 3 WHEN dem IS NULL THEN 0 WHEN canopy IS NULL AND building IS NULL THEN 1 WHEN building IS NOT NULL AND greatest(building, 0) >= greatest(coalesce(canopy, 0), 0) THEN 4 ELSE 2 END AS BIGINT) AS provenance FROM layers)"""


@query(f", {_COMPOSITE} SELECT * FROM s", "layers")
def composite_surface(x: Fixtures) -> DataFrame:
    return raster.surface_pixels(x.layers)


@query(f", {_COMPOSITE} SELECT tile_id, row_idx, col_idx, elevation, provenance FROM s", "layers")
def composite_from_aligned_layers(x: Fixtures) -> DataFrame:
    one = lambda c: x.layers.where(F.col(c).isNotNull()).select(*raster.PIXEL, F.col(c).alias("value"))
    whole = x.layers.select(*raster.PIXEL)
    return whole.join(raster.surface_pixels(raster.align({c: one(c) for c in ("dem", "lidar", "canopy", "building")})), raster.PIXEL, "left").withColumn("provenance", F.coalesce("provenance", F.lit(0)).cast("long"))


_FRACTIONS = """f AS (SELECT tile_id, count(*) AS n_pixels, round(count(elevation)::DOUBLE / count(*), 4) AS valid_fraction, """ + ", ".join(f"CASE WHEN count(*) FILTER (WHERE provenance > 0) > 0 THEN round((count(*) FILTER (WHERE provenance = {c}))::DOUBLE / count(*) FILTER (WHERE provenance > 0), 4) ELSE 0.0::DOUBLE END AS {n}" for n, c in (("dem_fill", 1), ("pseudo", 2), ("lidar", 3), ("building", 4))) + " FROM s GROUP BY tile_id)"


@query(f", {_COMPOSITE}, {_FRACTIONS} SELECT * FROM f", "layers")
def provenance_fractions(x: Fixtures) -> DataFrame:
    return raster.tile_fractions(raster.surface_pixels(x.layers))


@query(f""", {_COMPOSITE}, {_FRACTIONS}, m AS (SELECT f.tile_id, valid_fraction, CASE f.tile_id % 4 WHEN 0 THEN 'mosaic' WHEN 1 THEN 'true_dsm' WHEN 2 THEN 'pseudo_dsm' ELSE 'cover_proxy' END AS mode FROM f)
SELECT tile_id, mode, CASE WHEN mode = 'cover_proxy' THEN mode WHEN valid_fraction >= 0.99 THEN 'ok' WHEN valid_fraction > 0 THEN 'partial' ELSE 'empty' END AS coverage_flag,
CASE WHEN mode = 'cover_proxy' THEN 'low' WHEN mode = 'pseudo_dsm' THEN CASE WHEN valid_fraction >= 0.99 THEN 'medium' ELSE 'low' END WHEN valid_fraction >= 0.99 THEN 'high' ELSE 'medium' END AS confidence FROM m""", "layers")
def coverage_confidence(x: Fixtures) -> DataFrame:
    modes = x.layers.select("tile_id").distinct().withColumn("mode", F.element_at(F.array(*map(F.lit, ("mosaic", "true_dsm", "pseudo_dsm", "cover_proxy"))), (F.col("tile_id") % 4 + 1).cast("int")))
    return raster.tile_summary(raster.surface_pixels(x.layers), modes).select("tile_id", "mode", "coverage_flag", "confidence")


@query("""SELECT id, CASE WHEN id % 2 = 0 AND id % 3 = 0 THEN 'mosaic' WHEN id % 2 = 0 THEN 'true_dsm' WHEN id % 3 = 0 AND (id % 5 = 0 OR id % 7 = 0) THEN 'pseudo_dsm' WHEN id % 3 = 0 THEN 'cover_proxy' END AS mode,
CASE WHEN id % 2 = 0 AND id % 3 = 0 THEN 'true_dsm' WHEN id % 2 = 0 THEN 'pseudo_dsm' WHEN id % 3 = 0 AND (id % 5 = 0 OR id % 7 = 0) THEN 'cover_proxy' END AS fallback FROM signals""", "signals")
def surface_mode_pick(x: Fixtures) -> DataFrame:
    has = lambda k: F.col("id") % k == 0
    d = x.signals.select("id", sky.pick_mode(has(2), has(3), has(5), has(7)).alias("mode"))
    return d.withColumn("fallback", sky.next_mode(F.col("mode")))


def _ring_wkb(rings: pa.Array) -> pa.Array:
    """Polygons of five points, as well-known binary, for a whole batch of flat rings."""
    raw, head = rings.flatten().to_numpy().astype("<f8").tobytes(), b"\x01\x03\x00\x00\x00\x01\x00\x00\x00\x05\x00\x00\x00"
    return pa.array([head + raw[at : at + 80] for at in range(0, len(raw), 80)], pa.binary())


@query("""SELECT l.tile_id, p.r AS row_idx, p.c AS col_idx, max(l.building) AS building FROM layers l, (SELECT a.range AS r, b.range AS c FROM range(0, 10) a, range(0, 10) b) p
WHERE l.building > 0 AND p.r BETWEEN l.row_idx AND l.row_idx + 2 AND p.c BETWEEN l.col_idx AND l.col_idx + 1 GROUP BY 1, 2, 3""", "layers")
def rasterize_max(x: Fixtures) -> DataFrame:
    west, north, east, south = F.col("col_idx") * 10.0, -F.col("row_idx") * 10.0, F.col("col_idx") * 10.0 + 20.0, -F.col("row_idx") * 10.0 - 30.0
    ring = [(west, north), (east, north), (east, south), (west, south), (west, north)]
    d = x.layers.where("building is not null").select("tile_id", F.col("building").alias("height_m"), F.array(*[v for p in ring for v in p]).alias("ring"))
    pack = F.arrow_udf(_ring_wkb, "binary")
    grids = x.layers.select("tile_id").distinct().select("tile_id", *(F.lit(v).alias(n) for n, v in (("x0", 0.0), ("y0", 0.0), ("gsd_m", 10.0))), F.lit(10).alias("height"), F.lit(10).alias("width"))
    return raster.rasterize(d.select("tile_id", "height_m", pack("ring").alias("geometry")), grids)


# --- sky

_AZ = "az AS (SELECT range * 2.0::DOUBLE AS azimuth FROM range(0, 180))"
_WRAP = lambda v: f"((({v}) + 180.0) - 360.0 * floor((({v}) + 180.0) / 360.0) - 180.0)"
_W = lambda a: f"(CASE WHEN abs({_WRAP(a)}) > 55.000000001 THEN 0.0::DOUBLE ELSE 0.5 * (1.0 + cos(radians({_WRAP(a)}))) * CASE WHEN abs({_WRAP(a + ' - 180.0')}) <= 18 THEN 0.15 ELSE 1.0 END END)"


@query(f"WITH {_AZ} SELECT azimuth, round({_W('azimuth')}, 9) AS weight FROM az")
def azimuth_weights(x: Fixtures) -> DataFrame:
    d = x.spark.range(1).select(F.explode(sky.azimuths(2.0)).alias("azimuth"))
    return d.select("azimuth", F.round(sky.azimuth_weight(F.col("azimuth")), 9).alias("weight"))


@query("SELECT coord_id, round(greatest(0.0, least(65.0, least((coord_id % 120)::DOUBLE, 90.0) - 25.0)) / 65.0, 9) AS blocked FROM unique_coords", "unique_coords")
def blocked_fraction(x: Fixtures) -> DataFrame:
    return x.coords.select("coord_id", F.round(sky.blocked_fraction((F.col("coord_id") % 120).cast("double")), 9).alias("blocked"))


@query("SELECT coord_id, round((coord_id % 900)::DOUBLE * (coord_id % 900) * (0.87 / 12742000.0), 9) AS drop_m, round(greatest(0.0, ((coord_id % 60) - 20)::DOUBLE / tan(radians(25.0::DOUBLE))), 6) AS radius_m FROM unique_coords", "unique_coords")
def curvature_and_radius(x: Fixtures) -> DataFrame:
    r = (F.col("coord_id") % 900).cast("double")
    return x.coords.select("coord_id", F.round(sky.curvature_drop(r), 9).alias("drop_m"), F.round(sky.derived_radius((F.col("coord_id") % 60 - 20).cast("double"), F.lit(0.0), 25.0), 6).alias("radius_m"))


@query("SELECT location_id, CASE WHEN obstruction_pct IS NULL THEN 'undetermined' WHEN obstruction_pct <= 1 THEN 'clear' WHEN obstruction_pct < 10 THEN 'at_risk' ELSE 'severe' END AS tier FROM findings", "findings")
def classify_tier(x: Fixtures) -> DataFrame:
    return x.findings.select("location_id", sky.classify_tier(F.col("obstruction_pct")).alias("tier"))


@query("""SELECT id, CASE WHEN lvl >= 2 THEN 'high' WHEN lvl = 1 THEN 'medium' ELSE 'low' END AS confidence FROM (SELECT id,
 CASE coalesce(CASE provenance WHEN 'lidar' THEN 'high' WHEN 'pseudo' THEN 'medium' WHEN 'structure' THEN 'medium' WHEN 'dem_fill' THEN 'low' WHEN 'dem' THEN 'low' END, CASE WHEN surface_confidence IN ('low', 'medium', 'high') THEN surface_confidence END, 'medium') WHEN 'high' THEN 2 WHEN 'medium' THEN 1 ELSE 0 END
 - CASE WHEN near_fraction < 0.5 THEN 2 WHEN near_fraction < 0.9 THEN 1 ELSE 0 END - CASE WHEN abs(clearance) < 3 THEN 1 ELSE 0 END AS lvl FROM signals) q""", "signals")
def confidence_flag(x: Fixtures) -> DataFrame:
    return x.signals.select("id", sky.confidence_flag(F.col("provenance"), F.col("near_fraction"), F.col("clearance"), F.col("surface_confidence")).alias("confidence"))


def _observers(x: Fixtures) -> tuple[DataFrame, DataFrame]:
    surface = raster.surface_pixels(x.layers)
    points = surface.where("row_idx = 4 and col_idx = 5 and elevation is not null")
    points = points.select(F.concat(F.lit("o"), F.col("tile_id").cast("string")).alias("location_id"), "tile_id", F.lit(55.0).alias("x"), F.lit(45.0).alias("y"), (F.col("elevation") + 2.0).alias("z"))
    return points, surface


_RAYSQL = f"""{_COMPOSITE}, o AS (SELECT concat('o', CAST(tile_id AS VARCHAR)) AS location_id, tile_id, 55.0::DOUBLE AS x, 45.0::DOUBLE AS y, elevation + 2.0 AS z FROM s WHERE row_idx = 4 AND col_idx = 5 AND elevation IS NOT NULL),
r AS (SELECT o.*, a.range * 30.0::DOUBLE AS azimuth, b.range * 10.0::DOUBLE AS radius FROM o, range(0, 12) a, range(1, 4) b),
q AS (SELECT *, round((x + radius * sin(radians(azimuth))) / 10.0::DOUBLE - 0.5, 9) AS c, round((y - radius * cos(radians(azimuth))) / 10.0::DOUBLE - 0.5, 9) AS rr FROM r),
n AS (SELECT q.*, CAST(floor(rr) + d.dr AS BIGINT) AS row_idx, CAST(floor(c) + e.dc AS BIGINT) AS col_idx, (CASE WHEN e.dc = 1 THEN c - floor(c) ELSE 1 - (c - floor(c)) END) * (CASE WHEN d.dr = 1 THEN rr - floor(rr) ELSE 1 - (rr - floor(rr)) END) AS w FROM q, (SELECT range AS dr FROM range(0, 2)) d, (SELECT range AS dc FROM range(0, 2)) e),
g AS (SELECT location_id, n.tile_id, azimuth, radius, z, sum(w * elevation) / sum(w) AS ground FROM n JOIN s ON s.tile_id = n.tile_id AND s.row_idx = n.row_idx AND s.col_idx = n.col_idx WHERE w > 0 AND elevation IS NOT NULL GROUP BY 1, 2, 3, 4, 5),
h AS (SELECT location_id, tile_id, azimuth, max(degrees(atan2(ground - z, radius))) AS horizon_deg, min(radius * tan(radians(25.0::DOUBLE)) - (ground - z)) AS clearance_m, count(*) AS n_known FROM g GROUP BY 1, 2, 3)"""


@query(f", {_RAYSQL} SELECT location_id, azimuth, round(horizon_deg, 6) AS horizon_deg, n_known FROM h", "layers")
def horizon_relational(x: Fixtures) -> DataFrame:
    return horizon.profile_of_pixels(*_observers(x), _RAYS, 10.0).select("location_id", "azimuth", F.round("horizon_deg", 6).alias("horizon_deg"), "n_known")


@query(f", {_RAYSQL} SELECT location_id, azimuth, round(clearance_m, 6) AS clearance_m FROM h", "layers")
def clearance_relational(x: Fixtures) -> DataFrame:
    return horizon.profile_of_pixels(*_observers(x), _RAYS, 10.0).select("location_id", "azimuth", F.round("clearance_m", 6).alias("clearance_m"))


@query(f""", {_RAYSQL}, k AS (SELECT sum({_W('range * 30.0::DOUBLE')}) AS total FROM range(0, 12)),
v AS (SELECT location_id, round(100.0 * sum({_W('azimuth')} * greatest(0.0, least(65.0, least(horizon_deg, 90.0) - 25.0)) / 65.0) / (SELECT total FROM k), 2) AS obstruction_pct FROM h GROUP BY 1)
SELECT *, CASE WHEN obstruction_pct <= 1 THEN 'clear' WHEN obstruction_pct < 10 THEN 'at_risk' ELSE 'severe' END AS risk_tier FROM v""", "layers")
def obstruction_relational(x: Fixtures) -> DataFrame:
    return horizon.obstruction_of_profile(horizon.profile_of_pixels(*_observers(x), _RAYS, 10.0), _RAYS).select("location_id", "obstruction_pct", "risk_tier")


def _packed(x: Fixtures, surface: DataFrame) -> DataFrame:
    shape = (("height", 10), ("width", 10), ("epsg", 32617))
    grids = surface.select("tile_id").distinct().select("tile_id", *(F.lit(v).alias(n) for n, v in shape), *(F.lit(v).alias(n) for n, v in (("x0", 0.0), ("y0", 0.0), ("gsd_m", 10.0))))
    return raster.packed(surface, grids)


@query(f""", {_RAYSQL}, k AS (SELECT sum({_W('range * 30.0::DOUBLE')}) AS total FROM range(0, 12)),
v AS (SELECT location_id, round(100.0 * sum({_W('azimuth')} * greatest(0.0, least(65.0, least(horizon_deg, 90.0) - 25.0)) / 65.0) / (SELECT total FROM k), 2) AS obstruction_pct FROM h GROUP BY 1)
SELECT location_id, obstruction_pct, CASE WHEN obstruction_pct <= 1 THEN 'clear' WHEN obstruction_pct < 10 THEN 'at_risk' ELSE 'severe' END AS risk_tier FROM v""", "layers")
def horizon_kernel(x: Fixtures) -> DataFrame:
    points, surface = _observers(x)
    points = points.select("location_id", "tile_id", "x", (-F.col("y")).alias("y"), F.lit(2.0).alias("dish_height_m"))
    return horizon.score(points, _packed(x, surface), _RAYS).select("location_id", "obstruction_pct", "risk_tier")


def _every_pixel(x: Fixtures) -> tuple[DataFrame, DataFrame]:
    surface = raster.surface_pixels(x.layers)
    name = F.concat_ws("_", F.lit("o"), *(F.col(c).cast("string") for c in raster.PIXEL))
    points = surface.where("elevation is not null").select(name.alias("location_id"), "tile_id", (F.col("col_idx") * 10.0 + 5.0).alias("x"), (F.col("row_idx") * -10.0 - 5.0).alias("y"))
    return points, _packed(x, surface)


@query()
def horizon_every_pixel(x: Fixtures) -> DataFrame:
    """The operator as in production: an observer at every pixel with an elevation, all bearings, the whole radius."""
    return horizon.score(*_every_pixel(x), SkySpec()).select("location_id", "obstruction_pct", "risk_tier", "confidence", "clearance_margin_m", "sampled_fraction", "max_horizon_deg")


def _widened(packed: DataFrame, times: int, lift: float) -> DataFrame:
    """Packed surfaces with every pixel repeated ``times`` by ``times`` and heights multiplied by ``lift``: tiles of the size that
    production has, steep enough to block some sky."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                wide = {n: (np.frombuffer(r[n], t).reshape(r["height"], r["width"]).repeat(times, 0).repeat(times, 1) * t(up)).tobytes() for n, t, up in (("elevation", np.float32, lift), ("provenance", np.int8, 1))}
                yield pa.RecordBatch.from_pylist([r | wide | {"height": r["height"] * times, "width": r["width"] * times}], schema=b.schema)

    # few bytes become many: as packed, they would be merged into few partitions
    return packed.repartition(16 * packed.sparkSession.sparkContext.defaultParallelism).mapInArrow(run, packed.schema)


@query()
def horizon_full_tile(x: Fixtures) -> DataFrame:
    """The operator on tiles of 600 by 600 pixels: 100 observers a tile, and all 27,000 samples of each look at data."""
    points, packed = _every_pixel(x)
    points = points.withColumn("x", (F.col("x") - 5.0) * 60 + 305.0).withColumn("y", (F.col("y") + 5.0) * 60 - 305.0)
    return horizon.score(points, _widened(packed, 60, 12.0), SkySpec()).select("location_id", "obstruction_pct", "risk_tier", "confidence", "clearance_margin_m", "sampled_fraction", "max_horizon_deg")


@query()
def clear_spots(x: Fixtures) -> DataFrame:
    return horizon.find_spots(*_every_pixel(x), SkySpec()).select("location_id", "rank", "lon", "lat", "dx", "dy", "dish_height_m", "obstruction_pct", "baseline_pct", "improvement_pct", "n_candidates")


@query("""SELECT location_id, a.range * 10.0::DOUBLE - 20.0 AS dx, b.range * 10.0::DOUBLE - 20.0 AS dy, h.h::DOUBLE AS dish_height_m FROM findings f, range(0, 5) a, range(0, 5) b, (SELECT unnest([0.0, 0.3, 0.6]) AS h) h
WHERE (a.range * 10.0 - 20.0) * (a.range * 10.0 - 20.0) + (b.range * 10.0 - 20.0) * (b.range * 10.0 - 20.0) <= 400""", "findings")
def clear_spot_candidates(x: Fixtures) -> DataFrame:
    return horizon.candidates(x.findings.select("location_id"), 20.0, 10.0).select("location_id", "dx", "dy", "dish_height_m")


@query("""SELECT location_id, ord, dish_height_m, obstruction_pct FROM (SELECT *, row_number() OVER (PARTITION BY location_id ORDER BY CASE WHEN has THEN coalesce(dish_height_m, 'infinity'::DOUBLE) ELSE 0 END, ord) AS k
FROM (SELECT *, first_value(dish_height_m) OVER (PARTITION BY location_id ORDER BY ord) IS NOT NULL AS has FROM mounts) a) b WHERE k = 1""", "mounts")
def lowest_mount_merge(x: Fixtures) -> DataFrame:
    return horizon.lowest_mount(x.mounts).select("location_id", "ord", "dish_height_m", "obstruction_pct")


@query("""SELECT location_id, ord, dish_height_m, obstruction_pct FROM (SELECT *, row_number() OVER (PARTITION BY location_id ORDER BY CASE WHEN has THEN coalesce(dish_height_m, 'infinity'::DOUBLE) ELSE 0 END, ord) AS k
FROM (SELECT *, first_value(dish_height_m) OVER (PARTITION BY location_id ORDER BY ord) IS NOT NULL AS has FROM all_mounts) a) b WHERE k = 1""", "all_mounts")
def lowest_mount_merge_all(x: Fixtures) -> DataFrame:
    return horizon.lowest_mount(x.all_mounts).select("location_id", "ord", "dish_height_m", "obstruction_pct")


# --- quality

_SCORED = "risk_tier IN ('clear', 'at_risk', 'severe')"
_RISK = "risk_tier IN ('at_risk', 'severe')"
_SUMMARY = f"""z AS (SELECT count(*) AS n_findings, count(*) FILTER (WHERE {_SCORED}) AS n_scored, """ + ", ".join(f"count(*) FILTER (WHERE risk_tier = '{t}') AS n_{t}" for t in ("clear", "at_risk", "severe", "undetermined")) + ", " + ", ".join(f"count(*) FILTER (WHERE confidence = '{c}') AS n_confidence_{c}" for c in ("high", "medium", "low")) + f""",
 round((count(*) FILTER (WHERE risk_tier = 'undetermined'))::DOUBLE / count(*), 4) AS undetermined_rate, round((count(*) FILTER (WHERE confidence = 'low'))::DOUBLE / count(*), 4) AS low_confidence_rate,
 round((count(*) FILTER (WHERE {_RISK}))::DOUBLE / count(*) FILTER (WHERE {_SCORED}), 4) AS at_risk_rate, (SELECT string_agg(v, ',' ORDER BY v) FROM (SELECT DISTINCT spec_version AS v FROM findings) d) AS spec_versions FROM findings)"""


@query(f", {_SUMMARY} SELECT * FROM z", "findings")
def findings_summary(x: Fixtures) -> DataFrame:
    return quality.summary(x.findings)


@query("SELECT t AS risk_tier, (SELECT count(*) FROM findings WHERE risk_tier = t) AS n FROM (SELECT unnest(['clear', 'at_risk', 'severe', 'undetermined']) AS t) k", "findings")
def tier_histogram(x: Fixtures) -> DataFrame:
    return quality.tier_histogram(x.findings)


@query("SELECT count(*) AS n, min(obstruction_pct) AS min_pct, max(obstruction_pct) AS max_pct, round(avg(obstruction_pct), 4) AS mean_pct, median(obstruction_pct) AS median_pct, count(DISTINCT round(obstruction_pct, 6)) AS n_distinct FROM findings WHERE obstruction_pct IS NOT NULL", "findings")
def pct_distribution(x: Fixtures) -> DataFrame:
    return quality.pct_distribution(x.findings)


_BAND = "CASE WHEN obstruction_pct <= 1 THEN 'clear' WHEN obstruction_pct < 10 THEN 'at_risk' ELSE 'severe' END"
_RULES = {
    "tier_inconsistent": f"{_SCORED} AND obstruction_pct BETWEEN 0 AND 100 AND {_BAND} <> risk_tier",
    "pct_out_of_range": f"{_SCORED} AND obstruction_pct NOT BETWEEN 0 AND 100",
    "tier_pct_mismatch": f"(risk_tier = 'undetermined' AND obstruction_pct IS NOT NULL) OR ({_SCORED} AND obstruction_pct IS NULL)",
}
for _name, _test in _RULES.items():
    QUERIES[_name] = lambda spark, sf_dir, rule=_name: quality.offending(Fixtures(spark, sf_dir).findings, rule).select("location_id", "risk_tier", "obstruction_pct")
    ORACLE[_name] = f"{ctes('findings')} SELECT location_id, risk_tier, obstruction_pct FROM findings WHERE {_test}"


def _sample(test: str) -> str:
    return f"(SELECT list(location_id ORDER BY ord) FROM (SELECT location_id, ord FROM findings WHERE {test} ORDER BY ord LIMIT 10) q)"


@query(" UNION ALL ".join(f"SELECT '{r}' AS rule, '{'warn' if r == 'tier_pct_mismatch' else 'critical'}' AS severity, count(*)::DOUBLE AS metric, array_to_string({_sample(t)}, ',') AS sample_ids FROM findings WHERE {t} HAVING count(*) > 0" for r, t in _RULES.items()), "findings")
def consistency_anomalies(x: Fixtures) -> DataFrame:
    return quality.consistency(x.findings).select("rule", "severity", "metric", F.array_join("sample_ids", ",").alias("sample_ids"))


@query(f", {_SUMMARY} SELECT 'undetermined_rate' AS rule, undetermined_rate AS metric FROM z WHERE undetermined_rate > 0.2 UNION ALL SELECT 'low_confidence_rate', low_confidence_rate FROM z WHERE low_confidence_rate > 0.3", "findings")
def coverage_anomalies(x: Fixtures) -> DataFrame:
    return quality.coverage(quality.summary(x.findings)).where("rule <> 'spec_version_drift'").select("rule", "metric")


@query("SELECT 'spec_version_drift' AS rule, count(DISTINCT spec_version)::DOUBLE AS metric FROM findings HAVING count(DISTINCT spec_version) > 1", "findings")
def spec_drift(x: Fixtures) -> DataFrame:
    return quality.coverage(quality.summary(x.findings)).where("rule = 'spec_version_drift'").select("rule", "metric")


def _saturated_sql(key: str, w: str) -> str:
    return f"SELECT {key} AS region, sum({w})::DOUBLE AS scored_weight, round(sum(CASE WHEN {_RISK} THEN {w} ELSE 0 END)::DOUBLE / sum({w}), 4) AS rate FROM findings WHERE {_SCORED} AND {key} IS NOT NULL GROUP BY 1 HAVING sum({w}) >= 30 AND sum(CASE WHEN {_RISK} THEN {w} ELSE 0 END)::DOUBLE / sum({w}) >= 0.95"


@query(_saturated_sql("tile_id", "n_locations"), "findings")
def saturated_tiles(x: Fixtures) -> DataFrame:
    return quality.saturated(x.findings, "tile_id", "n_locations")


@query(_saturated_sql("county", "n_locations"), "findings")
def saturated_counties(x: Fixtures) -> DataFrame:
    return quality.saturated(x.findings, "county", "n_locations")


@query(f"SELECT tile_id AS region, count(*) AS n_scored, max(round(obstruction_pct, 6)) AS only_pct FROM findings WHERE {_SCORED} GROUP BY 1 HAVING count(*) >= 20 AND min(round(obstruction_pct, 6)) = max(round(obstruction_pct, 6)) AND max(obstruction_pct) > 0", "findings")
def degenerate_regions(x: Fixtures) -> DataFrame:
    return quality.degenerate(x.findings, "tile_id")


def _region_rules_sql(key: str, scope: str, weight: str, order: int) -> str:
    """Both rules of regions by one key, with the first ids of each region that was found."""
    ids = f"(SELECT string_agg(location_id, ',' ORDER BY ord) FROM (SELECT location_id, ord FROM findings x WHERE {_SCORED} AND x.{key} = f.region ORDER BY ord LIMIT 10) q)"
    head = lambda rule, text, metric, limit, found: f"SELECT '{rule}' AS rule, 'warn' AS severity, concat('{scope}:', f.region) AS scope, '{text}' AS detail, {metric} AS metric, {limit}::DOUBLE AS threshold, {ids} AS sample_ids, {order} AS rule_order FROM ({found}) f"
    alike = f"SELECT {key} AS region, count(*) AS n_scored FROM findings WHERE {_SCORED} AND {key} IS NOT NULL GROUP BY 1 HAVING count(*) >= 20 AND min(round(obstruction_pct, 6)) = max(round(obstruction_pct, 6)) AND max(obstruction_pct) > 0"
    return head("saturated_region", "nearly all scored locations are at risk", "f.rate", 0.95, _saturated_sql(key, weight)) + " UNION ALL " + head("degenerate_distribution", "all scored locations share one percentage", "f.n_scored::DOUBLE", 20, alike)


_DETAILS = {"tier_inconsistent": "the tier differs from the band of its percentage", "pct_out_of_range": "a percentage beyond 0 to 100", "tier_pct_mismatch": "undetermined with a percentage, or scored without one"}
_RUN_ROW = "SELECT '{}' AS rule, '{}' AS severity, 'run' AS scope, '{}' AS detail, {}::DOUBLE AS metric, {}::DOUBLE AS threshold, {} AS sample_ids, {} AS rule_order FROM {}"
_AUDIT = " UNION ALL ".join([
    *(_RUN_ROW.format(r, "warn" if r == "tier_pct_mismatch" else "critical", _DETAILS[r], "count(*)", 0, f"array_to_string({_sample(t)}, ',')", 0, f"findings WHERE {t} HAVING count(*) > 0") for r, t in _RULES.items()),
    _RUN_ROW.format("undetermined_rate", "warn", "too many findings without a surface", "undetermined_rate", 0.2, "''", 1, "z WHERE undetermined_rate > 0.2"),
    _RUN_ROW.format("low_confidence_rate", "warn", "too many findings of low confidence", "low_confidence_rate", 0.3, "''", 1, "z WHERE low_confidence_rate > 0.3"),
    _RUN_ROW.format("spec_version_drift", "critical", "findings of several spec versions in one run", "count(DISTINCT spec_version)", 1, "''", 1, "findings HAVING count(DISTINCT spec_version) > 1"),
    _region_rules_sql("tile_id", "tile", "1", 2),
    _region_rules_sql("county", "county", "n_locations", 3),
])


@query(f", {_SUMMARY} {_AUDIT}", "findings")
def output_audit(x: Fixtures) -> DataFrame:
    return quality.output_audit(x.findings, county="county", weight="n_locations").withColumn("sample_ids", F.array_join("sample_ids", ","))


@query(f", {_SUMMARY}, a AS ({_AUDIT}) SELECT count(*) AS n_anomalies, count(*) > 0 AS review_required, coalesce(bool_or(severity = 'critical'), false) AS has_critical FROM a", "findings")
def review_verdict(x: Fixtures) -> DataFrame:
    return quality.verdict(quality.output_audit(x.findings, county="county", weight="n_locations"))


# --- reports


def _rollup_sql(key: str, more: str = "") -> str:
    part = lambda t: f"CAST(sum(CASE WHEN {t} THEN n_locations ELSE 0 END) AS BIGINT)"
    tiers = ", ".join(f"{part(f"risk_tier = '{t}'")} AS {t}_households" for t in ("clear", "at_risk", "severe", "undetermined"))
    scored = "risk_tier <> 'undetermined'"
    return f"SELECT {key} AS region, CAST(sum(n_locations) AS BIGINT) AS households, {tiers}, {part(_RISK)} AS at_risk_total, CASE WHEN {part(scored)} > 0 THEN round({part(_RISK)}::DOUBLE / {part(scored)}, 4) ELSE 0.0::DOUBLE END AS at_risk_rate{more} FROM findings WHERE county IS NOT NULL AND county <> '' GROUP BY 1"


@query(_rollup_sql("county"), "findings")
def county_rollup(x: Fixtures) -> DataFrame:
    return rollup.by_county(x.findings)


@query(_rollup_sql("substr(county, 1, 2)", ", 'North Carolina' AS state_name"), "findings")
def state_rollup(x: Fixtures) -> DataFrame:
    return rollup.by_state(x.findings)


@query(f"SELECT 'county' AS level, region, households, at_risk_total FROM ({_rollup_sql('county')}) a UNION ALL SELECT 'state', region, households, at_risk_total FROM ({_rollup_sql('substr(county, 1, 2)')}) b", "findings")
def two_level_rollup(x: Fixtures) -> DataFrame:
    return rollup.two_levels(x.findings).select("level", "region", "households", "at_risk_total")


@query(f"SELECT * FROM ({_rollup_sql('county')}) a ORDER BY at_risk_total DESC, region LIMIT 15", "findings")
def top_counties(x: Fixtures) -> DataFrame:
    return rollup.top_counties(x.findings)


@query("SELECT risk_tier, concat(printf('%.1f', round(100.0::DOUBLE * n / total, 1)), '%') AS share FROM (SELECT risk_tier, count(*) AS n, (SELECT count(*) FROM findings) AS total FROM findings GROUP BY 1) q", "findings")
def percent_labels(x: Fixtures) -> DataFrame:
    d = x.findings.groupBy("risk_tier").agg(F.count("*").alias("n")).withColumn("total", F.sum("n").over(Window.partitionBy()))
    return d.select("risk_tier", text.percent(F.col("n"), F.col("total")).alias("share"))


@query("SELECT location_id, lon, lat, risk_tier, obstruction_pct, confidence, county, substr(county, 1, 2) AS state FROM findings", "findings")
def geojson_features(x: Fixtures) -> DataFrame:
    d = rollup.features(rollup.placed(x.findings.drop("lon", "lat"), x.coords))
    at = lambda p: F.get_json_object("feature", p)
    said = [at(f"$.properties.{c}").alias(c) for c in ("risk_tier", "confidence", "county", "state")]
    return d.select("location_id", at("$.geometry.coordinates[0]").cast("double").alias("lon"), at("$.geometry.coordinates[1]").cast("double").alias("lat"), at("$.properties.obstruction_pct").cast("double").alias("obstruction_pct"), *said)


@query("SELECT round((min(lon) + max(lon)) / 2, 6) AS center_lon, round((min(lat) + max(lat)) / 2, 6) AS center_lat, round(greatest(3.0, least(11.0, log2(360.0 / greatest(greatest(max(lon) - min(lon), max(lat) - min(lat)), 0.01)))), 4) AS zoom FROM findings", "findings")
def map_center_zoom(x: Fixtures) -> DataFrame:
    return rollup.centre_zoom(x.findings)


# --- discovery


@query("""SELECT * FROM (VALUES ('High Resolution Canopy Height Maps by WRI and Meta', 2), ('ETH Global Sentinel-2 10m Canopy Height 2020', 2)) t(name, score)""")
def registry_keyword_search(x: Fixtures) -> DataFrame:
    return catalog.search_sources(catalog.sources(x.spark), ["canopy", "height"], "canopy").select("name", "score")


@query("SELECT collection, id FROM (SELECT *, row_number() OVER (PARTITION BY collection ORDER BY coalesce(gsd_m, 1e9), coalesce(dt, ''), id) AS k FROM items) q WHERE k = 1", "items")
def stac_best_item(x: Fixtures) -> DataFrame:
    return catalog.best_items(x.items).select("collection", "id")


@query("""SELECT collection, href, m[1] AS gsd_m, m[2] AS dt, m[3] AS id FROM (SELECT collection, split_part(href, '?', 1) AS href, min((coalesce(gsd_m, 1e9), coalesce(dt, ''), id)) AS m FROM items GROUP BY 1, 2) q""", "items")
def stac_all_hrefs(x: Fixtures) -> DataFrame:
    return catalog.all_hrefs(raster.plain_hrefs(x.items)).select("collection", "href", "at.*")


@query(f"SELECT id, round(100.0::DOUBLE * greatest(0.0::DOUBLE, least(xmax, -75.46) - greatest(xmin, -84.32)) * greatest(0.0::DOUBLE, least(ymax, 36.59) - greatest(ymin, 33.84)) / {(AOI[2] - AOI[0]) * (AOI[3] - AOI[1])!r}::DOUBLE, 2) AS coverage_pct FROM items", "items")
def aoi_coverage_pct(x: Fixtures) -> DataFrame:
    return x.items.select("id", geo.overlap_pct(AOI, *(F.col(c) for c in ("xmin", "ymin", "xmax", "ymax"))).alias("coverage_pct"))


@query("""SELECT collection, count(*) AS n_items, array_to_string((list(id ORDER BY id))[1:5], ',') AS sample_ids FROM items WHERE xmin <= -75.46 AND xmax >= -84.32 AND ymin <= 36.59 AND ymax >= 33.84 GROUP BY 1""", "items")
def stac_probe(x: Fixtures) -> DataFrame:
    extents = x.items.groupBy("collection").agg(*(f(c).alias(c) for c, f in (("xmin", F.min), ("ymin", F.min), ("xmax", F.max), ("ymax", F.max))))
    return catalog.probe(x.items, extents, AOI, max_items=5).select("collection", "n_items", F.array_join("sample_ids", ",").alias("sample_ids"))


def _entries(x: Fixtures) -> DataFrame:
    return x.items.select(F.concat(F.lit("f"), "collection").alias("factor"), F.col("id").alias("dataset_id"), F.when(F.col("gsd_m") == 1, "web").otherwise("stac").alias("access"), F.col("gsd_m").isNotNull().alias("selected"), F.when(F.col("dt") > "2015", F.col("href")).alias("source_url"), F.lit(None).cast("string").alias("asset_href"), F.substring("id", 6, 9).cast("long").alias("ord"))


@query("SELECT id AS dataset_id, gsd_m IS NOT NULL AND NOT (coalesce(gsd_m, 0) = 1 AND coalesce(dt, '') <= '2015') AS selected FROM items", "items")
def manifest_grounding(x: Fixtures) -> DataFrame:
    return catalog.grounded(_entries(x)).select("dataset_id", "selected")


@query("SELECT id AS dataset_id, CASE WHEN gsd_m = 10 THEN 'web' WHEN gsd_m = 1 THEN 'web' ELSE 'stac' END AS access FROM items", "items")
def manifest_upsert(x: Fixtures) -> DataFrame:
    old = _entries(x)
    changed = old.join(x.items.where("gsd_m = 10").select(F.col("id").alias("dataset_id")), "dataset_id", "left_semi").withColumn("access", F.lit("web"))
    return catalog.upsert(old, changed.select(old.columns)).select("dataset_id", "access")


@query("SELECT concat('f', collection) AS factor, concat('item_', CAST(max(CAST(substr(id, 6) AS BIGINT)) AS VARCHAR)) AS dataset_id FROM items WHERE gsd_m IS NOT NULL GROUP BY 1", "items")
def manifest_selected(x: Fixtures) -> DataFrame:
    return catalog.selected_by_factor(_entries(x)).select("factor", "dataset_id")


# --- work


@query("SELECT DISTINCT tile_id FROM findings f WHERE NOT EXISTS (SELECT 1 FROM findings g WHERE g.tile_id = f.tile_id AND g.coord_id % 40 < 25)", "findings")
def todo_tiles_anti(x: Fixtures) -> DataFrame:
    return work.todo(x.findings.select("tile_id").distinct(), x.findings.where("coord_id % 40 < 25"))


@query("SELECT DISTINCT tile_id FROM findings WHERE coord_id % 40 < 25", "findings")
def rescore_semi(x: Fixtures) -> DataFrame:
    return work.rescorable(x.findings.select("tile_id").distinct(), x.findings.where("coord_id % 40 < 25"))


@query("SELECT tile_id, max(coord_id) AS coord_id FROM findings GROUP BY tile_id", "findings")
def latest_surface(x: Fixtures) -> DataFrame:
    return work.current_surfaces(x.findings.select("tile_id", "coord_id"), "coord_id")


@query("SELECT coord_id FROM unique_coords WHERE coord_id % 7 = 0", "unique_coords")
def strided_sample(x: Fixtures) -> DataFrame:
    return locations.strided(x.coords.select("coord_id"), ["coord_id"], 7)


@query("SELECT geoid_cb, count(*) AS n FROM locations GROUP BY 1 ORDER BY n DESC, geoid_cb LIMIT 20", "locations")
def query_guard_limit(x: Fixtures) -> DataFrame:
    return work.guarded_sql(x.spark, "SELECT geoid_cb, count(*) AS n FROM locations GROUP BY 1 ORDER BY n DESC, geoid_cb", 20, x.locations)


@query("SELECT location_id, CAST(substr(location_id, 7) AS BIGINT) AS n, tile_id AS tile FROM findings", "findings")
def id_codecs(x: Fixtures) -> DataFrame:
    uri = F.concat(F.lit("/cache/"), "tile_id", F.lit("__c84a0b92_dsm.tif"))
    return x.findings.select("location_id", text.coord_number(F.col("location_id")).alias("n"), text.tile_of_uri(uri).alias("tile"))


# --- the cache, the manifest's access rules and item times


@query("""SELECT concat('c', CAST(id % 3 AS VARCHAR)) AS k, CASE WHEN id % 4 = 0 THEN 'd' WHEN id % 4 = 1 THEN 's' END AS taken, count(*) AS n FROM signals GROUP BY 1, 2""", "signals")
def item_time(x: Fixtures) -> DataFrame:
    props = F.when(F.col("id") % 4 == 0, F.create_map(F.lit("datetime"), F.lit("d"), F.lit("start_datetime"), F.lit("s"))).when(F.col("id") % 4 == 1, F.create_map(F.lit("datetime"), F.lit(""), F.lit("start_datetime"), F.lit("s"))).otherwise(F.create_map(F.lit("gsd"), F.lit("1")))
    d = x.signals.select(F.concat(F.lit("c"), (F.col("id") % 3).cast("string")).alias("k"), catalog.item_time(props).alias("taken"))
    return d.groupBy("k", "taken").agg(F.count("*").alias("n"))


@query("""SELECT asset, count(*) AS n FROM (SELECT CASE WHEN id % 5 = 0 THEN 'data' WHEN id % 5 < 3 THEN 'dem' WHEN id % 5 = 3 THEN 'other' END AS asset FROM signals) q GROUP BY 1""", "signals")
def asset_pick(x: Fixtures) -> DataFrame:
    k = F.col("id") % 5
    lit = lambda *v: F.create_map(*map(F.lit, v))
    assets = F.when(k == 0, lit("visual", "visual", "data", "data")).when(k < 3, lit("thumb", "thumb", "dem", "dem")).when(k == 3, lit("other", "other"))
    return x.signals.select(catalog.asset_href(assets).alias("asset")).groupBy("asset").agg(F.count("*").alias("n"))


@query("SELECT tile_id, count(*) AS n FROM findings WHERE coord_id % 40 >= 25 GROUP BY tile_id", "findings")
def cache_missing(x: Fixtures) -> DataFrame:
    """Tiles that the cache lacks: what is left to build, by the key of what each is built from."""
    wanted = cache.keyed(x.findings.select("tile_id").distinct().selectExpr("tile_id", "-80.0D as min_lon", "35.0D as min_lat", "-79.0D as max_lon", "36.0D as max_lat"), {"dem": ["https://store/a.tif?sig=1"]}, "EPSG:32617", 10.0, "mosaic")
    there = wanted.where("cast(substr(tile_id, 2) as int) < 25").withColumn("built_at", F.lit(1))
    return cache.missing(wanted, there).join(x.findings, "tile_id").groupBy("tile_id").agg(F.count("*").alias("n"))
