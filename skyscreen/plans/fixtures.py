"""Inputs derived from the star schema by integer arithmetic, the same in Spark and in any SQL engine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import locations as L

LOCATIONS = """SELECT concat('L', CAST(o_orderkey AS STRING)) AS location_id,
 CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN o_orderkey % 89 = 0 THEN CAST(95 AS DOUBLE) WHEN o_orderkey % 83 = 0 THEN CAST(0 AS DOUBLE) WHEN o_orderkey % 79 = 0 THEN CAST(-80 AS DOUBLE)
  ELSE CAST(33840000 + (o_custkey * 7919) % 2750000 AS DOUBLE) / CAST(1000000 AS DOUBLE) END AS latitude,
 CASE WHEN o_orderkey % 83 = 0 THEN CAST(0 AS DOUBLE) WHEN o_orderkey % 79 = 0 THEN CAST(35 AS DOUBLE)
  ELSE CAST(-84320000 + (o_custkey * 104729) % 8860000 AS DOUBLE) / CAST(1000000 AS DOUBLE) END AS longitude,
 concat('37', lpad(CAST(1 + 2 * (o_custkey % 100) AS STRING), 3, '0'), '0001001000') AS geoid_cb
FROM orders"""

KEYED = """SELECT location_id, latitude, longitude, geoid_cb, CAST(round(latitude * 1000000) AS BIGINT) AS lat_key, CAST(round(longitude * 1000000) AS BIGINT) AS lon_key
FROM locations WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180"""

UNIQUE = """SELECT CAST(row_number() OVER (ORDER BY lat_key, lon_key) - 1 AS BIGINT) AS coord_id, CAST(lat_key AS DOUBLE) / CAST(1000000 AS DOUBLE) AS latitude,
 CAST(lon_key AS DOUBLE) / CAST(1000000 AS DOUBLE) AS longitude, CAST(n_locations AS BIGINT) AS n_locations, county
FROM (SELECT lat_key, lon_key, count(*) AS n_locations, substr(min(geoid_cb), 1, 5) AS county FROM keyed GROUP BY lat_key, lon_key) u"""

FINDINGS = """SELECT concat('coord_', CAST(coord_id AS STRING)) AS location_id, coord_id, coord_id AS ord, tile_id, obstruction_pct,
 CASE WHEN coord_id % 401 = 3 THEN 'severe' WHEN coord_id % 449 = 9 THEN 'undetermined' WHEN obstruction_pct IS NULL THEN 'undetermined' WHEN obstruction_pct <= 1 THEN 'clear' WHEN obstruction_pct < 10 THEN 'at_risk' ELSE 'severe' END AS risk_tier,
 CASE WHEN obstruction_pct IS NULL OR coord_id % 10 < 4 THEN 'low' WHEN coord_id % 10 < 7 THEN 'medium' ELSE 'high' END AS confidence,
 CASE WHEN coord_id % 997 = 5 THEN 'spec-B' ELSE 'spec-A' END AS spec_version, n_locations, county, longitude AS lon, latitude AS lat
FROM (SELECT coord_id, n_locations, county, latitude, longitude, concat('T', CAST(coord_id % 40 AS STRING)) AS tile_id,
  CASE WHEN coord_id % 53 = 0 THEN NULL WHEN coord_id % 307 = 0 THEN CAST(150 AS DOUBLE) WHEN coord_id % 40 = 7 THEN CAST(40 AS DOUBLE)
       WHEN coord_id % 5 <> 0 THEN CAST(0 AS DOUBLE) ELSE CAST((coord_id * 37) % 2000 AS DOUBLE) / CAST(100 AS DOUBLE) END AS obstruction_pct FROM unique_coords) b"""

LAYERS = """SELECT CAST((p_partkey - p_partkey % 100) / 100 AS BIGINT) AS tile_id, CAST((p_partkey % 100 - p_partkey % 10) / 10 AS BIGINT) AS row_idx, CAST(p_partkey % 10 AS BIGINT) AS col_idx,
 CASE WHEN p_partkey % 29 = 0 THEN NULL ELSE CAST(100 + p_partkey % 17 AS DOUBLE) END AS dem,
 CASE WHEN p_partkey % 3 = 0 THEN CAST(110 + p_partkey % 23 AS DOUBLE) END AS lidar,
 CASE WHEN p_partkey % 4 = 1 THEN CAST(p_partkey % 11 AS DOUBLE) - CAST(2 AS DOUBLE) END AS canopy,
 CASE WHEN p_partkey % 5 = 2 THEN CAST(p_partkey % 31 AS DOUBLE) END AS building,
 CASE p_partkey % 8 WHEN 0 THEN 'HHT:15.00' WHEN 1 THEN 'H:2' WHEN 2 THEN 'HAPP:3' WHEN 3 THEN 'HBET:1-5' WHEN 4 THEN 'H:1+HHT:3.50' WHEN 5 THEN 'garbage' WHEN 6 THEN '' END AS gem, p_partkey
FROM part"""

ITEMS = """SELECT concat('item_', CAST(s_suppkey AS STRING)) AS id, concat('c', CAST(s_nationkey % 3 AS STRING)) AS collection,
 CASE s_suppkey % 4 WHEN 0 THEN CAST(1 AS DOUBLE) WHEN 1 THEN CAST(10 AS DOUBLE) WHEN 2 THEN CAST(30 AS DOUBLE) END AS gsd_m,
 CASE WHEN s_suppkey % 7 <> 0 THEN concat('20', lpad(CAST(10 + s_suppkey % 13 AS STRING), 2, '0'), '-01-01') END AS dt,
 CAST(-84 + s_suppkey % 8 AS DOUBLE) AS xmin, CAST(33 + s_suppkey % 3 AS DOUBLE) AS ymin, CAST(-83 + s_suppkey % 8 AS DOUBLE) AS xmax, CAST(34 + s_suppkey % 3 AS DOUBLE) AS ymax,
 concat('https://store/h', CAST(s_suppkey % 50 AS STRING), '.tif?sig=', CAST(s_suppkey AS STRING)) AS href FROM supplier"""

#: Numbered rows to score by hand: signals of the confidence flag, and findings at several mounts.
SIGNALS = """SELECT CAST(c_custkey AS BIGINT) AS id, CASE c_custkey % 6 WHEN 0 THEN 'lidar' WHEN 1 THEN 'pseudo' WHEN 2 THEN 'structure' WHEN 3 THEN 'dem_fill' WHEN 4 THEN NULL ELSE 'dem' END AS provenance,
 CAST(c_custkey % 11 AS DOUBLE) / CAST(10 AS DOUBLE) AS near_fraction, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE CAST(c_custkey % 19 AS DOUBLE) - CAST(9 AS DOUBLE) END AS clearance,
 CASE c_custkey % 4 WHEN 0 THEN 'high' WHEN 1 THEN 'low' WHEN 2 THEN 'odd' END AS surface_confidence FROM customer"""

MOUNTS = """SELECT concat('s', CAST(l_partkey AS STRING)) AS location_id, CAST(l_orderkey * 8 + l_linenumber AS BIGINT) AS ord,
 CASE WHEN l_orderkey % 13 = 0 THEN NULL ELSE CAST(l_linenumber % 3 AS DOUBLE) * CAST(0.3 AS DOUBLE) END AS dish_height_m, CAST(l_orderkey % 100 AS DOUBLE) AS obstruction_pct FROM lineitem WHERE l_linenumber <= 3"""

#: The same over the whole table.
ALL_MOUNTS = MOUNTS.removesuffix(" WHERE l_linenumber <= 3")

TABLES = {"orders": "orders", "part": "part", "supplier": "supplier", "customer": "customer", "lineitem": "lineitem"}
_VIEWS = {"locations": LOCATIONS, "keyed": KEYED, "unique_coords": UNIQUE, "findings": FINDINGS, "layers": LAYERS, "items": ITEMS, "signals": SIGNALS, "mounts": MOUNTS, "all_mounts": ALL_MOUNTS}


def ctes(*names: str) -> str:
    """The WITH clause of the views named, with those that they stand on."""
    needs = {"keyed": ("locations",), "unique_coords": ("locations", "keyed"), "findings": ("locations", "keyed", "unique_coords")}
    wanted = {n for name in names for n in (*needs.get(name, ()), name)}
    return "WITH " + ", ".join(f"{n} AS ({sql})" for n, sql in _VIEWS.items() if n in wanted)


class Fixtures:
    """The same views as DataFrames; coordinates come from this package's own de-duplication."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, str(sf_dir).rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def _sql(self, sql: str, **frames: DataFrame) -> DataFrame:
        for name in frames:
            sql = sql.replace(f"FROM {name}", f"FROM {{{name}}}")
        return self.spark.sql(sql, **frames)

    @property
    def locations(self) -> DataFrame:
        return self._sql(LOCATIONS, orders=self.table("orders"))

    @property
    def coords(self) -> DataFrame:
        return L.unique_coords(self.locations, 6, with_county=True)

    @property
    def findings(self) -> DataFrame:
        return self._sql(FINDINGS, unique_coords=self.coords)

    @property
    def layers(self) -> DataFrame:
        return self._sql(LAYERS, part=self.table("part"))

    @property
    def items(self) -> DataFrame:
        return self._sql(ITEMS, supplier=self.table("supplier"))

    @property
    def signals(self) -> DataFrame:
        return self._sql(SIGNALS, customer=self.table("customer"))

    @property
    def mounts(self) -> DataFrame:
        return self._sql(MOUNTS, lineitem=self.table("lineitem"))

    @property
    def all_mounts(self) -> DataFrame:
        return self._sql(ALL_MOUNTS, lineitem=self.table("lineitem"))
