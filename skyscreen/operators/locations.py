"""Profile, bounding boxes, de-duplication and tiling of locations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import geo
from ..functions.text import county_fips
from ..session import stored
from ..specs import CONUS, TileSpec


def _pair() -> Column:
    """A row value, so that pairs with a null count as a value too."""
    return F.struct("latitude", "longitude")


def profile(locations: DataFrame) -> DataFrame:
    """One row of counts over the raw table, in one scan."""
    lat, lon = F.col("latitude"), F.col("longitude")
    return locations.agg(
        F.count("*").alias("total_rows"),
        F.count_if(lat.isNull() | lon.isNull()).alias("null_coords"),
        F.count_if(~lat.between(-90, 90) | ~lon.between(-180, 180)).alias("out_of_range"),
        F.count_distinct(_pair()).alias("distinct_coords"),
        (F.count("*") - F.count_distinct("location_id")).alias("duplicate_ids"),
    )


def aoi_box(locations: DataFrame) -> DataFrame:
    """The box of all usable coordinates and their number."""
    d = locations.where(geo.usable(F.col("latitude"), F.col("longitude")))
    return d.agg(F.min("longitude").alias("min_lon"), F.min("latitude").alias("min_lat"), F.max("longitude").alias("max_lon"), F.max("latitude").alias("max_lat"), F.count("*").alias("n_points"), F.count_distinct(_pair()).alias("n_distinct"))


def resolve_aoi(locations: DataFrame | None, override: tuple[float, ...] | None = None) -> tuple[tuple[float, ...], str]:
    """The box to work on and where it comes from: what was asked for, else the locations' own, else the fallback."""
    if override is not None:
        if len(override) != 4 or override[0] >= override[2] or override[1] >= override[3]:
            raise ValueError("a box is min_lon, min_lat, max_lon, max_lat")
        return tuple(map(float, override)), "override"
    row = aoi_box(locations).first() if locations is not None else None
    if row is None or row["min_lon"] is None:
        return CONUS, "fallback"
    return (row["min_lon"], row["min_lat"], row["max_lon"], row["max_lat"]), "locations"


def count_in_box(locations: DataFrame, box) -> DataFrame:
    lat, lon = F.col("latitude"), F.col("longitude")
    d = locations.where(geo.usable(lat, lon) & geo.in_box(lat, lon, box))
    return d.agg(F.count("*").alias("n_points"), F.count_distinct(_pair()).alias("n_distinct"))


def audit_counts(locations: DataFrame, box) -> DataFrame:
    """One row of quarantine counts. A row may fall under several, as null and out of range do for half a coordinate."""
    lat, lon = F.col("latitude"), F.col("longitude")
    valid = geo.usable(lat, lon)
    island = (lat == 0) & (lon == 0)
    return locations.agg(
        F.count("*").alias("total"),
        F.count_if(lat.isNull() | lon.isNull()).alias("null_coords"),
        F.count_if(~lat.between(-90, 90) | ~lon.between(-180, 180)).alias("out_of_range"),
        F.count_if(island).alias("null_island"),
        F.count_if(valid & ~island & ~geo.in_box(lat, lon, box)).alias("off_aoi"),
        F.count_if(~geo.in_box(lat, lon, box) & geo.in_box(lon, lat, box)).alias("swapped_suspect"),
        F.count_distinct(_pair()).alias("distinct_coords"),
    )


def audit_report(locations: DataFrame, box) -> dict:
    """The audit as a summary with one issue for each kind of bad row that occurs."""
    n = audit_counts(locations, box).first().asDict()
    kinds = (
        ("null_coord", "null_coords", "a coordinate is missing"),
        ("out_of_range", "out_of_range", "a coordinate is beyond its range of degrees"),
        ("null_island", "null_island", "the coordinate is exactly (0, 0)"),
        ("off_aoi", "off_aoi", f"a valid coordinate outside {list(map(float, box))}"),
    )
    issues = [{"kind": k, "count": n[c], "detail": d} for k, c, d in kinds if n[c]]
    if n["swapped_suspect"]:
        issues.append({"kind": "lat_lon_swapped", "count": n["swapped_suspect"], "detail": "inside the area once latitude and longitude change places"})
    bad = sum(n[c] for _, c, _ in kinds)
    return {"total_rows": n["total"], "distinct_coords": n["distinct_coords"], "quarantine_total": bad, "quarantine_rate": round(bad / n["total"], 6) if n["total"] else 0.0, "swapped_suspect": n["swapped_suspect"], "issues": issues}


def keyed(locations: DataFrame, precision: int = 6) -> DataFrame:
    """Usable rows with their integer keys."""
    if precision < 0:
        raise ValueError("precision must not be negative")
    lat, lon = F.col("latitude"), F.col("longitude")
    return locations.where(geo.usable(lat, lon)).withColumn("lat_key", geo.micro_key(lat, precision)).withColumn("lon_key", geo.micro_key(lon, precision))


def dense_ids(keys: DataFrame, order: list[str], name: str, partitions: int | None = None) -> DataFrame:
    """``keys`` with dense ids from 0 in global order, without sorting all rows in one task.

    Range partitions are counted, each gets the sum of those before it, and rows are numbered within their partition. The
    running sum is over one row a partition. The dealt rows are written to the shared folder first: the ranges are found by
    sampling, and a second dealing of the same rows would have other bounds.
    """
    n = partitions or int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = stored(keys.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()), "dealt")
    bounds = dealt.groupBy("_part").agg(F.count("*").alias("_n"), F.min(F.struct(*order)).alias("_lo"))
    start = F.coalesce(F.sum("_n").over(Window.orderBy("_lo").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = bounds.select("_part", start.alias("_start"))
    number = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return dealt.withColumn("_k", number).join(starts, "_part").withColumn(name, (F.col("_start") + F.col("_k") - 1).cast("long")).drop("_part", "_k", "_start")


def unique_coords(locations: DataFrame, precision: int = 6, with_county: bool = False) -> DataFrame:
    """``coord_id, latitude, longitude, n_locations`` in the order of the keys, and the smallest ``county`` if asked for."""
    more = [county_fips(F.min("geoid_cb")).alias("county")] if with_county else []
    groups = keyed(locations, precision).groupBy("lat_key", "lon_key").agg(F.count("*").alias("n_locations"), *more)
    scale = F.lit(float(10**precision))
    d = dense_ids(groups, ["lat_key", "lon_key"], "coord_id")
    return d.select("coord_id", (F.col("lat_key").cast("double") / scale).alias("latitude"), (F.col("lon_key").cast("double") / scale).alias("longitude"), "n_locations", *(["county"] if with_county else []))


def location_map(locations: DataFrame, coords: DataFrame, precision: int = 6) -> DataFrame:
    """``location_id, coord_id`` of every usable location: the way back from a scored coordinate."""
    keys = keyed(coords, precision).select("lat_key", "lon_key", "coord_id")
    return keyed(locations, precision).join(keys, ["lat_key", "lon_key"]).select("location_id", "coord_id")


def coord_counties(locations: DataFrame, coords: DataFrame, bridge: DataFrame) -> DataFrame:
    """``coord_id, county, n_locations``: a county for each coordinate, the smallest block's."""
    d = coords.select("coord_id", "n_locations").join(bridge, "coord_id").join(locations.select("location_id", "geoid_cb"), "location_id")
    return d.groupBy("coord_id", "n_locations").agg(county_fips(F.min("geoid_cb")).alias("county")).select("coord_id", "county", "n_locations")


def duplicate_groups(locations: DataFrame) -> DataFrame:
    """How many raw coordinates repeat, and the rows that share them."""
    d = locations.where("latitude is not null and longitude is not null").groupBy("latitude", "longitude").agg(F.count("*").alias("n")).where("n > 1")
    return d.agg(F.count("*").alias("groups"), F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("rows_in_groups"), F.coalesce(F.max("n"), F.lit(0)).alias("largest"))


def grid_epsg(coords: DataFrame) -> int:
    """One zone for the whole grid: that of the mean coordinate."""
    row = coords.agg(F.avg("longitude").alias("lon"), F.avg("latitude").alias("lat")).select(geo.utm_epsg(F.col("lon"), F.col("lat")).alias("epsg")).first()
    if row["epsg"] is None:
        raise ValueError("there are no coordinates to tile")
    return int(row["epsg"])


def assign_tiles(coords: DataFrame, epsg: int, spec: TileSpec = TileSpec()) -> DataFrame:
    """``coords`` with their metric position and the tile that holds it: a projection, no join."""
    east, north = geo.utm_forward(F.col("longitude"), F.col("latitude"), F.lit(epsg))
    d = coords.withColumn("easting", east).withColumn("northing", north)
    return d.withColumn("tile_id", geo.tile_id(F.lit(epsg), F.col("easting"), F.col("northing"), spec.tile_size_m))


def tiles(assigned: DataFrame, epsg: int, spec: TileSpec = TileSpec()) -> DataFrame:
    """``tile_id, utm_epsg``, the buffered box in degrees and ``n_coords`` of every tile that holds a coordinate."""
    cell = lambda i: F.split_part("tile_id", F.lit("_"), F.lit(i)).cast("long")
    d = assigned.groupBy("tile_id").agg(F.count("*").alias("n_coords")).withColumn("ix", cell(2)).withColumn("iy", cell(3))
    size, pad = spec.tile_size_m, spec.tile_buffer_m
    corners = [geo.utm_inverse(F.col("ix") * size + dx, F.col("iy") * size + dy, F.lit(epsg)) for dx in (-pad, size + pad) for dy in (-pad, size + pad)]
    lons, lats = [c[0] for c in corners], [c[1] for c in corners]
    return d.select("tile_id", F.lit(epsg).alias("utm_epsg"), F.least(*lons).alias("min_lon"), F.least(*lats).alias("min_lat"), F.greatest(*lons).alias("max_lon"), F.greatest(*lats).alias("max_lat"), "n_coords").orderBy("tile_id")


def strided(d: DataFrame, order: list[str], stride: int, partitions: int | None = None) -> DataFrame:
    """Every ``stride``-th row in the given order."""
    return dense_ids(d, order, "_at", partitions).where(F.col("_at") % max(1, stride) == 0).drop("_at")
