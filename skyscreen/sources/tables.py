"""Readers and sinks for locations, coordinates, surfaces and findings. Schemas are stated, unless a caller asks for a look at all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOCATIONS = "location_id STRING, latitude DOUBLE, longitude DOUBLE, geoid_cb STRING"
FINDINGS = "location_id STRING, tile_id STRING, dish_height_m DOUBLE, obstruction_pct DOUBLE, risk_tier STRING, confidence STRING, surface_provenance STRING, blocked_azimuths ARRAY<DOUBLE>, spec_version STRING, lon DOUBLE, lat DOUBLE"
SURFACES = "tile_id STRING, height INT, width INT, x0 DOUBLE, y0 DOUBLE, gsd_m DOUBLE, epsg INT, elevation BINARY, provenance BINARY, confidence STRING"


def read_locations(spark: SparkSession, path: str, view: str | None = "locations") -> DataFrame:
    """Locations from CSV with a header; block codes stay text, so leading zeros live."""
    d = spark.read.schema(LOCATIONS).option("header", True).csv(path)
    if view:
        d.createOrReplaceTempView(view)
    return d


def infer_locations(spark: SparkSession, path: str) -> DataFrame:
    """A CSV of any columns, typed by a look at every row; block codes stay text, however their digits read."""
    kinds = spark.read.option("header", True).option("inferSchema", True).option("samplingRatio", 1.0).csv(path).schema
    kept = T.StructType([T.StructField(f.name, T.StringType() if f.name in ("geoid_cb", "location_id") else f.dataType) for f in kinds])
    return spark.read.schema(kept).option("header", True).csv(path)


def read_table(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    d = spark.read.parquet(path)
    return d.select(*columns) if columns else d


def write_sorted(d: DataFrame, path: str, *order: str) -> None:
    d.orderBy(*order).write.mode("overwrite").parquet(path)


def write_findings(findings: DataFrame, path: str) -> None:
    """Findings by tile; only the tiles at hand are overwritten."""
    findings.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("tile_id").parquet(path)


def read_findings(spark: SparkSession, path: str, tile: str | None = None) -> DataFrame:
    d = spark.read.parquet(path)
    d = d.withColumn("tile_id", F.col("tile_id").cast("string"))
    return d.where(F.col("tile_id") == tile) if tile else d


def read_findings_json(spark: SparkSession, path: str) -> DataFrame:
    """Findings from JSON files of one list each; rows that are no objects are left out."""
    return spark.read.schema(FINDINGS).option("multiLine", True).option("mode", "DROPMALFORMED").json(path).where("location_id is not null")


def read_surface_notes(spark: SparkSession, path: str) -> DataFrame:
    """The JSON notes beside surfaces, with ``file_name``; broken ones are left out."""
    d = spark.read.option("multiLine", True).option("mode", "DROPMALFORMED").schema("tile_id STRING, dsm_uri STRING, crs STRING, surface_mode STRING, coverage_flag STRING, confidence STRING, valid_fraction DOUBLE").json(path)
    return d.withColumn("file_name", F.element_at(F.split(F.input_file_name(), "/"), -1)).where("tile_id is not null")


def footprints_schema() -> T.StructType:
    """Building footprints as published: geometry, height text and a box struct that filters reach."""
    box = T.StructType([T.StructField(n, T.DoubleType()) for n in ("xmin", "ymin", "xmax", "ymax")])
    return T.StructType([T.StructField("geometry", T.BinaryType()), T.StructField("height", T.StringType()), T.StructField("bbox", box)])


def read_footprints(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Footprint files; those that are missing are skipped."""
    return spark.read.schema(footprints_schema()).option("ignoreMissingFiles", True).parquet(*paths)
