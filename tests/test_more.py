"""Operators around the main path: the cache, the manifest, windows of rasters, map files, the shell, streams."""

import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyscreen import __main__ as shell
from skyscreen.functions import geo
from skyscreen.operators import cache, catalog, horizon, locations, rollup, surfaces, work
from skyscreen.sources import geotiff, tables
from skyscreen.specs import COUNTY_NAMES, BuildingSpec, SkySpec
from skyscreen.streaming import incremental

GRID = "tile_id string, height int, width int, x0 double, y0 double, gsd_m double, epsg int, elevation binary, provenance binary"


def flat(spark, tile="t", size=21, x0=500000.0, y0=3900000.0):
    z = np.full((size, size), 100.0, np.float32)
    z[: size // 2 - 1] = 130.0  # a wall to the north
    return spark.createDataFrame([(tile, size, size, x0, y0, 10.0, 32617, z.tobytes(), np.full((size, size), 3, np.int8).tobytes())], GRID)


def test_dense_ids_with_payload_at_any_partitioning(spark):
    rows = spark.range(100_000).select((F.col("id") * 7919 % 100_003).alias("k"), F.concat(F.lit("v"), F.col("id").cast("string")).alias("payload"), (F.col("id") * 7).alias("n"))
    for n in (4, 8, 200):
        got = locations.dense_ids(rows, ["k"], "i", n)
        assert got.select(F.count("*"), F.count_distinct("i"), F.min("i"), F.max("i")).first() == (100_000, 100_000, 0, 99_999)
        keys = [r["k"] for r in got.orderBy("i").select("k").limit(2000).collect()]
        assert keys == sorted(keys)
        assert got.where("n <> 7 * cast(substr(payload, 2) as bigint)").isEmpty()


def test_spots_score_the_site_itself_and_keep_any_name(spark):
    name = "a|b \"c\""
    sites = spark.createDataFrame([(name, "t", 500105.0, 3899895.0)], "location_id string, tile_id string, x double, y double")
    spec = SkySpec(azimuth_step_deg=30.0, max_radius_m=100.0)
    got = horizon.find_spots(sites, flat(spark), spec, buffer_m=12.0, grid_m=5.0).orderBy("rank").collect()
    offsets = [-12 + 5 * k for k in range(6)]
    assert {r["location_id"] for r in got} == {name} and len(got) == 10
    assert got[0]["n_candidates"] == 3 * sum(a * a + b * b <= 144 for a in offsets for b in offsets)
    own = horizon.score(sites.withColumn("dish_height_m", F.lit(0.0)), flat(spark), spec).first()["obstruction_pct"]
    for r in got:
        assert r["baseline_pct"] == own and r["improvement_pct"] == pytest.approx(own - r["obstruction_pct"], abs=0.0051)
        lon, lat = geo.unproject(np.array([500105.0 + r["dx"]]), np.array([3899895.0 + r["dy"]]), 32617)
        assert (r["lon"], r["lat"]) == (pytest.approx(lon[0], abs=1e-7), pytest.approx(lat[0], abs=1e-7))
    assert got[0]["obstruction_pct"] < own


def test_spots_are_those_of_all_candidates_scored_as_points(spark):
    """Sites on and off the grid, of a name in two tiles, off the surface, without a tile; shares of three sites."""
    rng = np.random.default_rng(5)
    z = (100 + 40 * rng.random((21, 21))).astype(np.float32)
    z[rng.random(z.shape) < 0.1] = np.nan
    grids = [(t, 21, 21, x0, 3900000.0, 10.0, 32617, (z + k).tobytes(), np.full((21, 21), 3, np.int8).tobytes()) for k, (t, x0) in enumerate((("t", 500000.0), ("u", 500300.0)))]
    surfaces = spark.createDataFrame([*grids, ("bad", 21, 21, 500000.0, 3900000.0, 10.0, 32617, b"123", b"")], GRID)
    sites = [(f"s{i}", "t", 500005.0 + 10 * i, 3899955.0 - 5 * i) for i in range(8)] + [("s1", "u", 500411.3, 3899907.7), ("s2", "none", 1.0, 1.0), ("s3", None, 500105.0, 3899895.0), ("far", "t", 1.0, 1.0), ("s4", "bad", 500105.0, 3899895.0), (None, "u", 500400.0, 3899900.0), ("edge", "t", 499985.0, 3899950.0)]
    sites = spark.createDataFrame(sites, "location_id string, tile_id string, x double, y double")
    spec = SkySpec(azimuth_step_deg=15.0, max_radius_m=120.0, az_weighting="uniform", az_halfwidth_deg=180.0)
    tried = horizon.candidates(sites, 30.0, 7.0, spec.mount_heights_m).withColumn("own", F.lit(0)).unionByName(sites.selectExpr("*", "0D as dx", "0D as dy", "0D as dish_height_m", "1 as own")).collect()
    points = spark.createDataFrame([(str(i), r["tile_id"], r["x"] + r["dx"], r["y"] + r["dy"], float(r["dish_height_m"])) for i, r in enumerate(tried)], "location_id string, tile_id string, x double, y double, dish_height_m double")
    scored, want = {int(r["location_id"]): r for r in horizon.score(points, surfaces, spec).collect()}, {}
    for name in {r["location_id"] for r in tried}:
        mine = [(scored[i], r) for i, r in enumerate(tried) if r["location_id"] == name and scored[i]["obstruction_pct"] is not None]
        own = max((s["obstruction_pct"] for s, r in mine if r["own"]), default=None)
        ranked = sorted((s["obstruction_pct"], r["dish_height_m"], r["dx"], r["dy"], s["tile_id"], s["risk_tier"], s["confidence"]) for s, r in mine if not r["own"])
        want |= {(name, k): (*row, own, len(ranked)) for k, row in enumerate(ranked[:10], 1)}
    old, horizon.SITES_PER_GROUP = horizon.SITES_PER_GROUP, 3
    try:
        found = horizon.find_spots(sites, surfaces, spec, 30.0, 7.0)
    finally:
        horizon.SITES_PER_GROUP = old
    got = {(r["location_id"], r["rank"]): (r["obstruction_pct"], r["dish_height_m"], r["dx"], r["dy"], r["tile_id"], r["risk_tier"], r["confidence"], r["baseline_pct"], r["n_candidates"]) for r in found.collect()}
    assert got == want and {"s1", "s7", None, "edge"} <= {k for k, _ in got} and not {"far"} & {k for k, _ in got}
    # candidates are made and ranked where the surface is, they are no rows: the one table that is multiplied is that of shares
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Generate ") == 1


def test_points_without_a_tile_are_undetermined(spark):
    points = spark.createDataFrame([("a", "t", 500105.0, 3899895.0), ("b", None, 1.0, 1.0), ("c", "none", 1.0, 1.0)], "location_id string, tile_id string, x double, y double")
    got = {r["location_id"]: r["risk_tier"] for r in horizon.score(points, flat(spark), SkySpec(azimuth_step_deg=30.0, max_radius_m=100.0)).collect()}
    assert got["b"] == got["c"] == "undetermined" and got["a"] != "undetermined"


def test_window_of_a_raster():
    rng = np.random.default_rng(2)
    bands = [rng.random((300, 500)).astype(np.float32), rng.random((300, 500)).astype(np.float32)]
    data = geotiff.write_geotiff(bands, 1000.0, 9000.0, 10.0, 32617, tile=64)
    for top, left, bottom, right in ((0, 0, 300, 500), (70, 130, 71, 131), (63, 64, 200, 333), (-5, -5, 10, 10), (290, 490, 400, 600)):
        got = geotiff.read_geotiff(data, lambda head, w=(top, left, bottom, right): w)
        t, left_, b, r = max(top, 0), max(left, 0), min(bottom, 300), min(right, 500)
        assert all(np.array_equal(x, y[t:b, left_:r]) for x, y in zip(got["bands"], bands, strict=True))
        assert (got["x0"], got["y0"]) == (1000.0 + left_ * 10, 9000.0 - t * 10)
    assert geotiff.read_geotiff(data, lambda head: (900, 900, 950, 950))["bands"][0].size == 0
    grid = {"height": 20, "width": 30, "x0": 2003.0, "y0": 8007.0, "gsd_m": 10.0, "epsg": 32617}
    part = surfaces.warp_to(geotiff.read_geotiff(data, surfaces.window_for(grid)), grid)
    assert np.allclose(part, surfaces.warp_to(geotiff.read_geotiff(data), grid), equal_nan=True)


def test_cache_is_looked_up_before_building(spark, tmp_path):
    folder, path = tmp_path / "tif", str(tmp_path / "cache")
    folder.mkdir()
    tiles = spark.createDataFrame([("a", 32617, -80.505, 35.495, -80.495, 35.505), ("b", 32617, -80.405, 35.495, -80.395, 35.505)], "tile_id string, utm_epsg int, min_lon double, min_lat double, max_lon double, max_lat double")
    for t, box in (("a", (-80.505, 35.495, -80.495, 35.505)), ("b", (-80.405, 35.495, -80.395, 35.505))):
        g = surfaces.grid_of(box, 32617, 10.0)
        (folder / f"{t}.tif").write_bytes(geotiff.write_geotiff([np.full((g["height"], g["width"]), 50.0, np.float32)], g["x0"], g["y0"], 10.0, 32617))
    rows = [("dem", 0, "a.tif", -80.505, 35.495, -80.495, 35.505), ("dem", 0, "b.tif", -80.405, 35.495, -80.395, 35.505)]
    catalogue = spark.createDataFrame(rows, "layer string, rank int, name string, xmin double, ymin double, xmax double, ymax double")
    assert cache.read(spark, path) is None
    assert cache.fetch(spark, tiles.where("tile_id = 'a'"), catalogue, str(folder), path, "EPSG:32617").count() == 1
    (folder / "a.tif").write_bytes(b"broken")  # what is in the cache is not built again
    assert {r["tile_id"] for r in cache.fetch(spark, tiles, catalogue, str(folder), path, "EPSG:32617").collect()} == {"a", "b"}
    assert [r["tile_id"] for r in cache.listing(cache.read(spark, path)).collect()] == ["a", "b"]
    assert [r["mode"] for r in cache.listing(cache.read(spark, path), "b").collect()] == ["cover_proxy"]


def test_where_buildings_are(spark):
    plain = BuildingSpec()
    assert catalog.building_access()["url_template"] == plain.url_template and catalog.building_access()["quadkey_zoom"] == 6
    own = catalog.building_access({"hrefs": ["https://x/a.parquet", "https://x/b.{quadkey}.parquet"], "access_params": {"quadkey_zoom": "7", "height_col": "h"}})
    assert (own["url_template"], own["quadkey_zoom"], own["height_col"], own["geom_col"]) == ("https://x/b.{quadkey}.parquet", 7, "h", "geometry")
    assert catalog.building_access(own) == own
    assert catalog.building_urls((-80.86, 35.21, -80.82, 35.25), spark, {"url_template": "f.{quadkey}.p"}) == ["f.032003.p"]


def test_target_system():
    box = (-80.6, 35.4, -80.4, 35.6)
    assert {geo.target_crs(w, box) for w in (None, "", "auto", "AUTO-UTM", 32617, "32617", "EPSG:32617")} == {"EPSG:32617"}
    assert geo.target_crs("auto", (-60, -36, -58, -34)) == "EPSG:32721" and geo.target_crs("ESRI:102008", box) == "ESRI:102008"


def test_manifest_is_edited(tmp_path, capsys):
    path = str(tmp_path / "m.json")
    entry = {"factor": "buildings", "dataset_id": "b", "access": "web", "selected": True, "access_params": {"url_template": "x.{quadkey}"}}
    assert shell.main(["manifest", "add", path, "--entry", json.dumps(entry), "--box", "-81", "35", "-80", "36"]) == 0
    assert shell.main(["manifest", "add", path, "--entry", json.dumps(entry | {"license": "ODbL"})]) == 0
    assert shell.main(["manifest", "add", path, "--entry", json.dumps({"factor": "canopy", "dataset_id": "c", "access": "web", "selected": True})]) == 0
    got = catalog.load_manifest(path)
    assert [(e["dataset_id"], e["selected"]) for e in got["entries"]] == [("b", True), ("c", False)] and got["aoi_bbox"] == [-81.0, 35.0, -80.0, 36.0]
    shell.main(["manifest", "list", path])
    assert "* buildings: b, web, ODbL x.{quadkey}" in capsys.readouterr().out
    assert shell.main(["manifest", "remove", path, "--dataset-id", "b", "--factor", "canopy"]) == 1
    assert shell.main(["manifest", "remove", path, "--dataset-id", "b"]) == 0
    assert [e["dataset_id"] for e in catalog.load_manifest(path)["entries"]] == ["c"]
    assert shell.main(["manifest", "delete", path]) == 0 and shell.main(["manifest", "delete", path]) == 1


def test_items_in_order(spark):
    items = spark.createDataFrame([("i2", "c", 1.0, None, "h1"), ("i1", "c", 1.0, None, "h1"), ("i3", "c", None, "2020", "h2"), ("i4", "d", 5.0, "2020", "h3")], "id string, collection string, gsd_m double, dt string, href string")
    got = catalog.all_hrefs(items).orderBy("collection", "at").collect()
    assert [(r["collection"], r["href"], r["at"]["id"]) for r in got] == [("c", "h1", "i1"), ("c", "h2", "i3"), ("d", "h3", "i4")]
    boxes = items.withColumns({"xmin": F.lit(0.0), "ymin": F.lit(0.0), "xmax": F.lit(1.0), "ymax": F.lit(1.0)})
    extents = boxes.groupBy("collection").agg(*(F.min(c).alias(c) for c in ("xmin", "ymin", "xmax", "ymax")))
    probed = {r["collection"]: r for r in catalog.probe(boxes, extents, (0.0, 0.0, 2.0, 1.0), 2).collect()}
    assert probed["c"]["n_items"] == 3 and probed["c"]["sample_ids"] == ["i1", "i2"] and probed["c"]["coverage_pct"] == 50.0
    named = spark.createDataFrame([({"thumb": "a", "dem": "b"},), ({"thumb": "a"},), ({},)], "m map<string,string>")
    assert [r[0] for r in named.select(catalog.asset_href(F.col("m"))).collect()] == ["b", "a", None]
    assert catalog.layer_hrefs([{"factor": "DSM", "asset_href": "x"}, {"factor": "canopy", "asset_href": "y", "selected": False}, {"factor": "buildings"}]) == {"surface": ["x"], "buildings": []}
    times = spark.createDataFrame([({"datetime": "a"},), ({"datetime": "", "start_datetime": "b"},), ({"x": "c"},)], "m map<string,string>")
    assert [r[0] for r in times.select(catalog.item_time(F.col("m"))).collect()] == ["a", "b", None]


def test_queries_leave_no_view(spark):
    d = spark.range(3).selectExpr("cast(id as string) as location_id")
    before = {t.name for t in spark.catalog.listTables()}
    assert work.guarded_sql(spark, "WITH a AS (SELECT * FROM locations) SELECT count(*) AS n FROM a", 5, d).first()["n"] == 3
    assert {t.name for t in spark.catalog.listTables()} == before


def test_files_of_the_map(spark, tmp_path):
    points = spark.createDataFrame([("a", "clear", 0.5, "high", "37119", -80.5, 35.5), ("b", None, None, None, None, -80.4, 35.4)], "location_id string, risk_tier string, obstruction_pct double, confidence string, county string, lon double, lat double")
    assert rollup.feature_collection(points, str(tmp_path / "f" / "all.geojson")) == 2
    got = {f["properties"]["location_id"]: f for f in json.loads((tmp_path / "f" / "all.geojson").read_text())["features"]}
    assert got["a"]["properties"] == {"location_id": "a", "risk_tier": "clear", "obstruction_pct": 0.5, "confidence": "high", "county": "37119", "state": "37"}
    assert got["b"]["properties"] == {"location_id": "b", "risk_tier": "undetermined"} and got["b"]["geometry"]["coordinates"] == [-80.4, 35.4]
    assert rollup.feature_collection(points.where("1 = 0"), str(tmp_path / "none.geojson")) == 0 and json.loads((tmp_path / "none.geojson").read_text())["features"] == []
    made, said = rollup.write_tiles(str(tmp_path / "f"), str(tmp_path / "t.pmtiles"), program="no-such-program")
    assert not made and "not installed" in said
    made, said = rollup.write_tiles(str(tmp_path / "none.geojson"), str(tmp_path / "t.pmtiles"), program="false")
    assert not made and "ended with 1" in said
    page = rollup.map_html({"zoom": 8, "center_lon": -80.0, "center_lat": 35.0}, ["x"], {"states": [{"region": "37", "state_name": "North Carolina"}], "counties": [{"region": "37119"}, {"region": "37001"}]}, outlines="counties.geojson")
    assert page.index("Alamance (37001)") < page.index("Mecklenburg (37119)") and 'data-state="37"' in page and "counties.geojson" in page
    assert len(COUNTY_NAMES) == 100 and COUNTY_NAMES["37199"] == "Yancey" and COUNTY_NAMES["37129"] == "New Hanover"


def test_readers_of_text(spark, tmp_path):
    (tmp_path / "in.csv").write_text("location_id,latitude,longitude,geoid_cb,units\n001,35.5,-80.5,010010001001000,3\n2,36,-80.25,020010001001000,\n")
    got = tables.infer_locations(spark, str(tmp_path / "in.csv"))
    assert dict(got.dtypes) == {"location_id": "string", "latitude": "double", "longitude": "double", "geoid_cb": "string", "units": "int"}
    assert [tuple(r) for r in got.collect()] == [("001", 35.5, -80.5, "010010001001000", 3), ("2", 36.0, -80.25, "020010001001000", None)]
    (tmp_path / "f").mkdir()
    (tmp_path / "f" / "a.json").write_text(json.dumps([{"location_id": "x", "obstruction_pct": 1.5, "blocked_azimuths": [2.0]}, {"other": 1}]))
    (tmp_path / "f" / "b.json").write_text("{ not json")
    assert [(r["location_id"], r["obstruction_pct"], r["blocked_azimuths"]) for r in tables.read_findings_json(spark, str(tmp_path / "f")).collect()] == [("x", 1.5, [2.0])]
    (tmp_path / "s").mkdir()
    (tmp_path / "s" / "t__1.json").write_text(json.dumps({"tile_id": "t", "crs": "EPSG:32617", "valid_fraction": 0.5}))
    (tmp_path / "s" / "bad.json").write_text("[")
    assert [(r["tile_id"], r["file_name"]) for r in tables.read_surface_notes(spark, str(tmp_path / "s")).collect()] == [("t", "t__1.json")]


def test_new_points_are_scored_once(spark, tmp_path):
    spec, surface = SkySpec(azimuth_step_deg=30.0, max_radius_m=100.0), flat(spark)
    row = lambda i: spark.createDataFrame([(i, "t", 500105.0, 3899895.0, 0.0)], incremental.POINTS)
    for name in ("a", "b"):
        row(name).write.mode("append").parquet(str(tmp_path / "in"))
        incremental.score_stream(spark, str(tmp_path / "in"), surface, str(tmp_path / "out"), str(tmp_path / "state"), spec).awaitTermination(120)
    got = [r["location_id"] for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert sorted(got) == ["a", "b"]


def test_bearing_weights_are_those_of_the_formula():
    spec, az = SkySpec(), horizon.bearings(2.0)
    for a, w in zip(az, horizon.weights(az, spec), strict=True):
        delta = (a - spec.az_center_deg + 180) % 360 - 180
        expect = 0.0 if abs(delta) > spec.az_halfwidth_deg + 1e-9 else (1 + math.cos(math.radians(delta))) / 2 * (0.15 if abs((a - 180 + 180) % 360 - 180) <= spec.gso_keepout_halfwidth_deg else 1)
        assert w == pytest.approx(expect)
