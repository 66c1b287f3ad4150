import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyscreen.functions import geo, sky
from skyscreen.operators import catalog, horizon, locations, quality, raster, rollup, work
from skyscreen.plans.fixtures import Fixtures
from skyscreen.plans.queries import QUERIES, _every_pixel
from skyscreen.sources import geotiff, tables
from skyscreen.specs import AOI, COUNTY_NAMES, SkySpec


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("lon,lat,epsg", [(-80.5, 35.5, 32617), (-75.5, 36.0, 32618), (-122.4, 37.8, 32610), (-58.4, -34.6, 32721)])
def test_zones(spark, lon, lat, epsg):
    assert one(spark, geo.utm_epsg(F.lit(lon), F.lit(lat))) == epsg


def test_projection_both_ways(spark):
    e, n = geo.utm_forward(F.lit(-80.5), F.lit(35.5), F.lit(32617))
    lon, lat = geo.utm_inverse(F.lit(545346.739), F.lit(3928608.358), F.lit(32617))
    row = spark.range(1).select(e.alias("e"), n.alias("n"), lon.alias("lon"), lat.alias("lat")).first()
    assert row["e"] == pytest.approx(545346.739, abs=1e-3) and row["n"] == pytest.approx(3928608.358, abs=1e-3)
    assert row["lon"] == pytest.approx(-80.5, abs=1e-8) and row["lat"] == pytest.approx(35.5, abs=1e-8)


def test_quadkey_and_heights(spark):
    assert one(spark, geo.box_quadkeys(*map(F.lit, (-80.86, 35.21, -80.82, 35.25)), 6)) == ["032003"]
    cases = {"HHT:15.00": 15.0, "H:2": 6.0, "HAPP:3": 9.0, "HBET:1-5": 9.0, "HBET:1-3": 6.0, "H:1+HHT:3.50": 3.5, "garbage": None, "": None, None: None, "HHT:900": 500.0}
    got = spark.createDataFrame([(k,) for k in cases], "raw string").select("raw", sky.gem_height(F.col("raw")).alias("h")).collect()
    assert {r["raw"]: r["h"] for r in got} == cases


def test_composite(spark):
    rows = [(0, 100.0, 150.0, 5.0, None), (1, 100.0, None, 8.0, None), (2, 100.0, None, None, None), (3, 100.0, None, 3.0, None), (4, 100.0, None, 5.0, 20.0), (5, 100.0, None, 8.0, 0.0), (6, None, None, 4.0, None)]
    d = spark.createDataFrame([(0, 0, *r) for r in rows], "tile_id long, row_idx long, col_idx long, dem double, lidar double, canopy double, building double")
    got = [(r["elevation"], r["provenance"]) for r in raster.surface_pixels(d).orderBy("col_idx").collect()]
    assert got == [(150.0, 3), (108.0, 2), (100.0, 1), (103.0, 2), (120.0, 4), (108.0, 2), (None, 0)]


def surface(wall=None, size=61):
    z = np.full((size, size), 100.0, np.float32)
    if wall:
        z[wall] = 160.0
    return horizon.Surface(z, np.full((size, size), 3, np.int8), 0.0, size * 10.0, 10.0)


def test_horizon_kernel():
    spec = SkySpec(max_radius_m=250.0)
    x, y, mount = np.array([305.0]), np.array([305.0]), np.array([2.0])
    score = lambda s, m=mount, spec=spec: horizon.score_block(s, x, y, m, spec)[0]
    assert score(surface())["obstruction_pct"] == 0 and score(surface())["risk_tier"] == "clear"
    north = surface((slice(24, 26), slice(None)))
    assert score(north)["obstruction_pct"] > 5 and score(north, np.array([30.0]))["obstruction_pct"] < score(north)["obstruction_pct"]
    south = surface((slice(35, 37), slice(None)))
    assert score(south)["obstruction_pct"] == 0
    assert score(south, spec=SkySpec(max_radius_m=250.0, az_weighting="uniform", az_halfwidth_deg=180.0))["obstruction_pct"] > 5
    hole = surface()
    hole.elevation[25:36, 25:36] = np.nan
    assert score(hole)["risk_tier"] == "undetermined" and score(hole)["obstruction_pct"] is None
    post = surface((slice(25, 26), slice(30, 31)))
    post.elevation[post.elevation > 100] = 130.0
    h = horizon.horizons(post, x, y, np.array([100.0]), spec)[0][0]
    assert h[0] == pytest.approx(np.degrees(np.arctan2(30, 50)), abs=3)


def plain_score(z, x, y, mount, spec):
    """(percentage, share of samples with data) of one point on pixels of 10 m from (0, 0) down, sample by sample."""

    def at(px, py):
        r, c = np.asarray(-py / 10.0 - 0.5), np.asarray(px / 10.0 - 0.5)
        padded = np.pad(z, 2, constant_values=np.nan)
        total, weight = 0.0, 0.0
        for i, wr in ((np.floor(r), 1 - r + np.floor(r)), (np.floor(r) + 1, r - np.floor(r))):
            for j, wc in ((np.floor(c), 1 - c + np.floor(c)), (np.floor(c) + 1, c - np.floor(c))):
                v = padded[np.clip(i + 2, 0, len(padded) - 1).astype(int), np.clip(j + 2, 0, len(padded[0]) - 1).astype(int)]
                total, weight = total + np.nan_to_num(v) * wr * wc, weight + np.isfinite(v) * wr * wc
        return np.where(weight > 0, total / np.maximum(weight, 1e-300), np.nan)

    azimuth = np.arange(0, 360, spec.azimuth_step_deg)
    radius = np.arange(1, spec.max_radius_m // 10 + 1) * 10.0
    a = np.radians(azimuth)[:, None]
    ground = at(x + radius * np.sin(a), y + radius * np.cos(a))
    angle = np.where(np.isfinite(ground), np.degrees(np.arctan2(ground - float(at(x, y)) - mount, radius)), -90.0)
    return round(horizon.obstruction(angle.max(1), azimuth, spec)[0], 2), round(float(np.isfinite(ground).mean()), 4)


def test_whole_queries_equal_brute_force(spark):
    sf, spec = "/root/testdata/sf0.001", SkySpec()
    tiles = {}
    for r in raster.surface_pixels(Fixtures(spark, sf).layers).collect():
        tiles.setdefault(r["tile_id"], np.full((10, 10), np.nan))[r["row_idx"], r["col_idx"]] = np.nan if r["elevation"] is None else r["elevation"]
    spots = {(t, r, c, m): plain_score(z, c * 10.0 + 5, -r * 10.0 - 5, m, spec) for t, z in tiles.items() for r in range(10) for c in range(10) if np.isfinite(z[r, c]) for m in spec.mount_heights_m}
    got = {tuple(map(int, r["location_id"].split("_")[1:])): (r["obstruction_pct"], r["sampled_fraction"]) for r in QUERIES["horizon_every_pixel"](spark, sf).collect()}
    want = {k[:3]: v for k, v in spots.items() if k[3] == 0}
    assert got.keys() == want.keys() and all(abs(got[k][0] - want[k][0]) < 0.0101 and abs(got[k][1] - want[k][1]) < 1.01e-4 for k in want)
    found = [r for r in horizon.find_spots(*_every_pixel(Fixtures(spark, sf)), spec, grid_m=10.0).collect() if r["rank"] == 1]
    assert {tuple(map(int, r["location_id"].split("_")[1:])) for r in found} == want.keys()
    for r in found:
        t, row, col = map(int, r["location_id"].split("_")[1:])
        near = [v[0] for (u, i, j, _), v in spots.items() if u == t and (i - row) ** 2 + (j - col) ** 2 <= 25]
        assert r["n_candidates"] == len(near) and r["obstruction_pct"] == pytest.approx(min(near), abs=0.0101)


def test_full_tiles_equal_brute_force(spark):
    sf, spec, tiles = "/root/testdata/sf0.001", SkySpec(), {}
    for r in raster.surface_pixels(Fixtures(spark, sf).layers).collect():
        tiles.setdefault(r["tile_id"], np.full((10, 10), np.nan))[r["row_idx"], r["col_idx"]] = np.nan if r["elevation"] is None else r["elevation"]
    wide = {t: 12 * z.repeat(60, 0).repeat(60, 1) for t, z in tiles.items()}
    got = {tuple(map(int, r["location_id"].split("_")[1:])): (r["obstruction_pct"], r["sampled_fraction"]) for r in QUERIES["horizon_full_tile"](spark, sf).collect()}
    want = {(t, r, c): plain_score(wide[t], c * 600.0 + 305, -r * 600.0 - 305, 0.0, spec) for t, z in tiles.items() for r in range(10) for c in range(10) if np.isfinite(z[r, c])}
    assert got.keys() == want.keys() and all(abs(got[k][0] - want[k][0]) < 0.0101 and abs(got[k][1] - want[k][1]) < 1.01e-4 for k in want)
    assert max(v[1] for v in want.values()) > 0.9 and len({v[0] for v in want.values()}) > 20


def test_shared_looks_are_those_of_single_points():
    rng, size, spec = np.random.default_rng(3), 40, SkySpec(max_radius_m=300.0, azimuth_step_deg=5.0, earth_curvature=True)
    lattice = [(5.0 + 20 * i, -5.0 - 20 * j) for i in range(20) for j in range(20)] + [(30.0 * i, -30.0 * j) for i in range(14) for j in range(14)]
    x, y = np.array(lattice + [tuple(v) for v in rng.random((30, 2)) * (400, -400)]).T
    for share, x0 in ((0.0, 0.0), (0.1, 0.0), (0.6, 500000.3)):
        z = (100 + 50 * rng.random((size, size))).astype(np.float32)
        z[rng.random(z.shape) < share] = np.nan
        s = horizon.Surface(z, None, x0, 0.0, 10.0)
        looks, done = horizon._Looks(s, spec), []
        px, py = x[np.isfinite(s.at(x + x0, y))] + x0, y[np.isfinite(s.at(x + x0, y))]
        order = np.lexsort((py, px, *s.phase(px, py)))
        px, py, alike = px[order], py[order], []
        keep, looks.ground_alike = looks.ground_alike, lambda *a: alike.append(len(a[0])) or keep(*a)
        for a, b, g in looks.batches(px, py):
            e, n = px[a:b, None, None] + looks.east[: g.shape[1]], py[a:b, None, None] + looks.north[: g.shape[1]]
            want = s.at(e, n) - looks.drop[: g.shape[1]]
            assert np.array_equal(np.isfinite(want), g > -np.inf) and np.nanmax(np.abs(np.where(np.isfinite(want), g - want, 0.0))) < 1e-6
            assert not np.isfinite(s.at(px[a:b, None, None] + looks.east[g.shape[1] :], py[a:b, None, None] + looks.north[g.shape[1] :])).any()
            done += range(a, b)
        assert done == list(range(len(px))) and sum(alike) > 0.8 * len(px)


def test_tiles_are_scored_on_all_cores(spark):
    surfaces = spark.range(40).selectExpr("concat('t', id) as tile_id", "4 as height", "4 as width", "0D as x0", "0D as y0", "10D as gsd_m").withColumn("elevation", F.lit(np.ones(16, np.float32).tobytes())).withColumn("provenance", F.lit(np.ones(16, np.int8).tobytes()))
    points = spark.range(400).selectExpr("concat('p', id) as location_id", "concat('t', id % 40) as tile_id", "15D as x", "-15D as y", "0D as dish_height_m")
    got = horizon.score(points, surfaces, SkySpec(azimuth_step_deg=30.0)).select("location_id", F.spark_partition_id().alias("k")).collect()
    assert len(got) == 400 and len({r["k"] for r in got}) >= 16


def test_lowest_mount_of_the_whole_table(spark):
    sf, lines = "/root/testdata/sf0.001", {}
    for r in spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").select("l_partkey", "l_orderkey", "l_linenumber").collect():
        ord_ = r["l_orderkey"] * 8 + r["l_linenumber"]
        lines.setdefault(f"s{r['l_partkey']}", []).append((ord_, None if r["l_orderkey"] % 13 == 0 else r["l_linenumber"] % 3 * 0.3))
    want = {}
    for s, rows in lines.items():
        rows.sort(key=lambda x: x[0])
        want[s] = rows[0][0] if rows[0][1] is None else min((h, o) for o, h in rows if h is not None)[1]
    assert {r["location_id"]: r["ord"] for r in QUERIES["lowest_mount_merge_all"](spark, sf).collect()} == want


def test_worked_obstruction():
    azimuth = np.array([0.0, 30.0, 50.0])
    pct, _ = horizon.obstruction(np.array([40.0, 30.0, 0.0]), azimuth, SkySpec())
    w = horizon.weights(azimuth, SkySpec())
    assert pct == pytest.approx(100 * (w[0] * 15 / 65 + w[1] * 5 / 65) / w.sum())


def test_confidence():
    spec = SkySpec()
    flag = lambda p, near=1.0, room=None, tile=None: horizon.confidence_of(p, near, room, tile, spec)
    assert [flag(p) for p in ("lidar", "pseudo", "structure", "dem_fill")] == ["high", "medium", "medium", "low"]
    assert (flag("lidar", 0.4), flag("lidar", 0.7), flag("lidar", room=1.0), flag("lidar", room=-20.0), flag(None, tile="low")) == ("low", "medium", "medium", "high", "low")


def test_input_audit(spark):
    rows = [("a", 35.0, -80.0, "x"), ("b", None, -80.0, "x"), ("c", 95.0, -80.0, "x"), ("d", 0.0, 0.0, "x"), ("e", 50.0, -80.0, "x"), ("f", -80.0, 35.0, "x")]
    got = locations.audit_report(spark.createDataFrame(rows, tables.LOCATIONS), AOI)
    assert (got["total_rows"], got["quarantine_total"], got["swapped_suspect"]) == (6, 5, 1)
    assert {i["kind"]: i["count"] for i in got["issues"]} == {"null_coord": 1, "out_of_range": 1, "null_island": 1, "off_aoi": 2, "lat_lon_swapped": 1}


def test_dedup_ids_are_dense_and_ordered(spark):
    rows = [(str(i), 30 + (i * 7 % 50) / 10, -80 + (i % 9) / 10, "010010201001000") for i in range(500)]
    d = spark.createDataFrame(rows, tables.LOCATIONS)
    coords = locations.unique_coords(d, with_county=True).orderBy("coord_id").collect()
    assert [r["coord_id"] for r in coords] == list(range(len(coords)))
    assert [(r["latitude"], r["longitude"]) for r in coords] == sorted((r["latitude"], r["longitude"]) for r in coords)
    assert sum(r["n_locations"] for r in coords) == 500 and coords[0]["county"] == "01001"


def test_dense_ids_beyond_the_range_sample(spark):
    d = spark.range(20_000).select((F.col("id") * 7919 % 20_011).alias("a"), (F.col("id") % 13).alias("b")).groupBy("a", "b").agg(F.count("*").alias("n"))
    got = sorted((r["a"], r["b"], r["i"]) for r in locations.dense_ids(d, ["a", "b"], "i").collect())
    assert [i for _, _, i in got] == list(range(20_000))


def finding(i, pct, tier, conf="high", spec="s", tile="t", county="37001", n=1):
    return (f"coord_{i}", i, i, tile, pct, tier, conf, spec, n, county)


FIELDS = "location_id string, coord_id long, ord long, tile_id string, obstruction_pct double, risk_tier string, confidence string, spec_version string, n_locations long, county string"


def test_quality_rules(spark):
    rows = [finding(0, 0.0, "severe"), finding(1, 150.0, "severe"), finding(2, None, "clear"), finding(3, 5.0, "undetermined", spec="t")]
    rows += [finding(10 + i, 40.0, "severe", tile="hot") for i in range(40)]
    got = {r["rule"] + r["scope"]: r for r in quality.output_audit(spark.createDataFrame(rows, FIELDS)).collect()}
    assert got["tier_inconsistentrun"]["metric"] == 1 and got["pct_out_of_rangerun"]["metric"] == 1 and got["tier_pct_mismatchrun"]["metric"] == 2
    assert "spec_version_driftrun" in got and "saturated_regiontile:hot" in got and "degenerate_distributiontile:hot" in got
    assert got["saturated_regiontile:hot"]["sample_ids"] == [f"coord_{i}" for i in range(10, 20)]


def test_rollup_weights(spark):
    rows = [finding(i, 20.0, "severe", county="45001", n=10) for i in range(4)] + [finding(9, 0.0, "clear", n=60), finding(8, 5.0, "at_risk", n=10), finding(7, 5.0, "at_risk", county="")]
    got = rollup.by_state(spark.createDataFrame(rows, FIELDS)).collect()
    assert [(r["region"], r["households"], r["at_risk_total"]) for r in got] == [("45", 40, 40), ("37", 70, 10)]
    assert COUNTY_NAMES["37119"] == "Mecklenburg" and COUNTY_NAMES["37199"] == "Yancey" and len(COUNTY_NAMES) == 100


def test_geotiff_round_trip():
    a = np.arange(300 * 270, dtype=np.float32).reshape(300, 270)
    got = geotiff.read_geotiff(geotiff.write_geotiff([a, a % 5], 500000.0, 3900000.0, 10.0, 32617))
    assert np.array_equal(got["bands"][0], a) and np.array_equal(got["bands"][1], a % 5)
    assert (got["x0"], got["y0"], got["gsd_m"], got["epsg"], got["nodata"]) == (500000.0, 3900000.0, 10.0, 32617, -9999.0)


def test_rings_and_burn():
    ring = np.array([(0, 0), (40, 0), (40, -20), (0, -20), (0, 0)], "<f8")
    wkb = struct.pack("<BII", 1, 3, 1) + struct.pack("<I", 5) + ring.tobytes()
    rows, cols = raster.burn(raster.rings(wkb), 0.0, 0.0, 10.0, 10, 10)
    assert set(zip(rows.tolist(), cols.tolist(), strict=True)) == {(r, c) for r in range(2) for c in range(4)}


def test_guards(spark, tmp_path):
    for bad in ("drop table x", "select 1; select 2", "with a as (select 1) insert into b select * from a"):
        with pytest.raises(Exception):
            work.guarded_sql(spark, bad).collect()
    assert work.guarded_sql(spark, "select 1 as a", 0).collect()[0]["a"] == 1
    for content, name in (("", "a.md"), ("x", "../a.md"), ("x", "a.py")):
        with pytest.raises(ValueError):
            rollup.write_report(content, name, str(tmp_path))


def test_manifest():
    got = catalog.build_manifest(AOI, [{"factor": "canopy", "dataset_id": "a", "access": "web", "selected": True}, {"factor": "terrain", "dataset_id": "b", "access": "stac", "selected": True}])
    assert [e["selected"] for e in got["entries"]] == [False, True] and got["factors_missing"] == ["surface", "canopy", "buildings"]
