"""Guarded SQL and the bookkeeping of runs: what is done, what is left, which surface is current."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_ROWS = 1000


def guarded_sql(spark: SparkSession, sql: str, limit: int | None = 100, locations: DataFrame | None = None) -> DataFrame:
    """A read-only query, one statement, at most ``MAX_ROWS`` rows; ``locations`` is there by that name, for this query only.

    The query stands as a subquery, so the parser itself refuses whatever isn't a SELECT.
    """
    text = sql.strip().rstrip(";").strip()
    if not re.match(r"(select|with)\b", text, re.I) or ";" in text:
        raise ValueError("one SELECT or WITH statement, please")
    rows = max(1, min(int(limit or 100), MAX_ROWS))
    if locations is None:
        return spark.sql(f"SELECT * FROM ({text}) AS _q").limit(rows)
    view = f"_locations_{uuid.uuid4().hex}"
    locations.createOrReplaceTempView(view)
    try:
        return spark.sql(f"WITH locations AS (SELECT * FROM {view}) SELECT * FROM ({text}) AS _q").limit(rows)
    finally:
        spark.catalog.dropTempView(view)


def todo(tiles: DataFrame, findings: DataFrame) -> DataFrame:
    """Tiles without findings."""
    return tiles.join(findings.select("tile_id").distinct(), "tile_id", "left_anti")


def rescorable(tiles: DataFrame, surfaces: DataFrame) -> DataFrame:
    """Tiles with a surface at hand."""
    return tiles.join(surfaces.select("tile_id").distinct(), "tile_id", "left_semi")


def first_tiles(tiles: DataFrame, n: int) -> DataFrame:
    return tiles.orderBy("tile_id").limit(max(1, n))


def current_surfaces(surfaces: DataFrame, order: str = "file_name") -> DataFrame:
    """The surface of each tile that comes last by ``order``."""
    last = surfaces.groupBy("tile_id").agg(F.max_by(F.struct("*"), order).alias("s"))
    return last.select("s.*")


def missing(wanted: list[str], there: DataFrame) -> list[str]:
    spark = there.sparkSession
    return [r["tile_id"] for r in spark.createDataFrame([(t,) for t in wanted], "tile_id string").join(there, "tile_id", "left_anti").orderBy("tile_id").collect()]
