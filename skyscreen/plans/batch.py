"""The whole deterministic run: locations to coordinates, tiles, findings, audit and report."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import horizon, locations, quality, rollup, work
from ..session import scratch, stored
from ..sources import tables
from ..specs import AOI, SkySpec, TileSpec


def prepare(spark: SparkSession, raw: DataFrame, out: str, precision: int = 6, tile: TileSpec = TileSpec()) -> dict:
    """Write ``coords`` with their tiles, the ``bridge`` back to locations, ``tiles`` and ``counties``; give the counts."""
    coords = locations.unique_coords(raw, precision)
    coords.write.mode("overwrite").parquet(f"{out}/raw_coords")
    coords = spark.read.parquet(f"{out}/raw_coords")
    epsg = locations.grid_epsg(coords)
    locations.assign_tiles(coords, epsg, tile).write.mode("overwrite").parquet(f"{out}/coords")
    assigned = spark.read.parquet(f"{out}/coords")
    locations.location_map(raw, coords, precision).write.mode("overwrite").parquet(f"{out}/bridge")
    bridge = spark.read.parquet(f"{out}/bridge")
    locations.tiles(assigned, epsg, tile).write.mode("overwrite").parquet(f"{out}/tiles")
    locations.coord_counties(raw, coords, bridge).write.mode("overwrite").parquet(f"{out}/counties")
    return {"epsg": epsg, "n_coords": assigned.count(), "n_tiles": spark.read.parquet(f"{out}/tiles").count()}


def score_tiles(spark: SparkSession, out: str, surfaces: DataFrame, spec: SkySpec = SkySpec(), rescore: bool = False, limit: int | None = None) -> dict:
    """Score the coordinates of all tiles that have a surface and no findings yet; each tile's findings are one partition.

    Tiles whose surface can't be read are not written, so the next run tries them again; until then they stand with their
    errors in ``failures``. ``limit`` takes the first so many tiles by name. Gives the numbers of tiles done and failed.
    """
    tiles = work.rescorable(spark.read.parquet(f"{out}/tiles"), surfaces)
    try:
        done = tables.read_findings(spark, f"{out}/findings")
    except AnalysisException as e:  # the first run has no findings
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        done = None
    if done is not None and not rescore:
        tiles = work.todo(tiles, done)
    if limit:
        tiles = work.first_tiles(tiles, limit)
    points = spark.read.parquet(f"{out}/coords").join(tiles.select("tile_id"), "tile_id", "left_semi")
    points = points.select(F.concat(F.lit("coord_"), F.col("coord_id").cast("string")).alias("location_id"), "tile_id", "longitude", "latitude")
    with scratch(spark):
        scored = stored(horizon.score(points, surfaces, spec), "scored")
        tables.write_findings(scored.where("error is null"), f"{out}/findings")
        failed = scored.where("error is not null").groupBy("tile_id").agg(F.min("error").alias("error"))
        failed.write.mode("overwrite").json(f"{out}/failures")
        n = scored.groupBy().agg(F.count_distinct("tile_id").alias("tiles"), F.count_distinct(F.when(F.col("error").isNotNull(), F.col("tile_id"))).alias("failed")).first()
    return {"done": n["tiles"] - n["failed"], "failed": n["failed"]}


def with_counties(spark: SparkSession, findings: DataFrame, out: str) -> DataFrame:
    """Findings with the county and the households of their coordinate."""
    found = findings.withColumn("coord_id", F.substring("location_id", 7, 20).try_cast("bigint")).withColumn("ord", F.col("coord_id"))
    return found.join(spark.read.parquet(f"{out}/counties"), "coord_id", "left")


def report(spark: SparkSession, out: str, folder: str) -> dict:
    """Join households and counties, audit, roll up, and write the deliverables into ``folder``."""
    found = with_counties(spark, tables.read_findings(spark, f"{out}/findings"), out)
    anomalies = [r.asDict() for r in quality.output_audit(found, county="county", weight="n_locations").collect()]
    got = rollup.aggregates(found)
    points = rollup.placed(found, spark.read.parquet(f"{out}/coords"))
    files = rollup.write_features(points, f"{folder}/features")
    tiled, said = rollup.write_tiles(f"{folder}/features", f"{folder}/findings.pmtiles")
    centre = rollup.centre_zoom(points).first().asDict()
    rollup.write_report(rollup.map_html(centre, [f"features/{f}" for f in files], got), "map.html", folder)
    rollup.write_report(rollup.decision_log(got, anomalies, "map.html"), "decision_log.md", folder)
    rollup.write_report(json.dumps(got, indent=1, default=str), "aggregates.json", folder)
    rollup.write_report(json.dumps(anomalies, indent=1, default=str), "qa_report.json", folder)
    return {"aggregates": got, "anomalies": anomalies, "tiles": {"made": tiled, "note": said}}


def run(spark: SparkSession, locations_csv: str, surfaces: DataFrame, out: str, folder: str, spec: SkySpec = SkySpec(), aoi=AOI) -> dict:
    raw = tables.read_locations(spark, locations_csv)
    audit = locations.audit_report(raw, aoi)
    counts = prepare(spark, raw, out)
    return {"input_audit": audit, **counts, "scoring": score_tiles(spark, out, surfaces, spec), **report(spark, out, folder)}
