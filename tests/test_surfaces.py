import struct

import numpy as np
import pytest

from skyscreen.functions import geo
from skyscreen.operators import horizon, surfaces
from skyscreen.plans import batch
from skyscreen.sources import geotiff, tables
from skyscreen.specs import SkySpec

X0, Y0 = 545000.0, 3929000.0
PARTS = "tile_id string, layer string, rank int, content binary"


def grid(spark, n=20):
    return spark.createDataFrame([("t", n, n, X0, Y0, 10.0, 32617), ("u", n, n, X0, Y0, 10.0, 32617)], "tile_id string, height int, width int, x0 double, y0 double, gsd_m double, epsg int")


def tif(values, epsg=32617, x0=X0, y0=Y0, gsd=10.0):
    return geotiff.write_geotiff([np.asarray(values, np.float32)], x0, y0, gsd, epsg)


def test_array_projection_agrees():
    lon, lat = geo.unproject(np.array([545346.739]), np.array([3928608.358]), 32617)
    assert (lon[0], lat[0]) == (pytest.approx(-80.5, abs=1e-8), pytest.approx(35.5, abs=1e-8))
    x, y = geo.reproject(lon, lat, 4326, 32617)
    assert (x[0], y[0]) == (pytest.approx(545346.739, abs=1e-4), pytest.approx(3928608.358, abs=1e-4))
    x, y = geo.project(np.array([-58.4]), np.array([-34.6]), 32721)
    assert geo.unproject(x, y, 32721)[1][0] == pytest.approx(-34.6, abs=1e-9) and y[0] > 6e6
    with pytest.raises(ValueError):
        geo.reproject(x, y, 3857, 32617)


def test_mosaic_and_modes(spark):
    first, second = np.full((20, 20), 150.0), np.full((20, 20), 160.0)
    first[:, 10:] = -9999.0
    second[:, 15:] = -9999.0
    rows = [("t", "dem", 0, tif(np.full((20, 20), 100.0))), ("t", "lidar", 1, tif(second)), ("t", "lidar", 0, tif(first)), ("t", "canopy", 0, tif(np.where(np.arange(400).reshape(20, 20) % 20 == 19, 5.0, -9999.0))), ("u", "canopy", 0, tif(first))]
    ring = np.array([(X0 + 150, Y0), (X0 + 170, Y0), (X0 + 170, Y0 - 20), (X0 + 150, Y0 - 20), (X0 + 150, Y0)], "<f8")
    homes = spark.createDataFrame([("t", struct.pack("<BII", 1, 3, 1) + struct.pack("<I", 5) + ring.tobytes(), 9.0)], "tile_id string, geometry binary, height_m double")
    granules = spark.createDataFrame(rows, PARTS)
    got = {r["tile_id"]: r for r in surfaces.build(granules, grid(spark), homes).collect()}
    z, code = np.frombuffer(got["t"]["elevation"], np.float32).reshape(20, 20), np.frombuffer(got["t"]["provenance"], np.int8).reshape(20, 20)
    assert z[5, [3, 12, 16, 19]].tolist() == [150.0, 160.0, 100.0, 105.0] and z[0, 15:17].tolist() == [109.0, 109.0]
    assert code[5, [3, 12, 16, 19]].tolist() == [3, 3, 1, 2] and code[1, 15] == 4
    assert (got["t"]["mode"], got["t"]["coverage_flag"], got["t"]["confidence"]) == ("mosaic", "ok", "high")
    assert got["u"]["elevation"] is None and "terrain" in got["u"]["error"]
    lidar = surfaces.build(granules, grid(spark), mode="true_dsm").where("tile_id = 't'").first()
    assert (lidar["valid_fraction"], lidar["coverage_flag"]) == (0.75, "partial")
    broken = surfaces.build(granules.unionByName(spark.createDataFrame([("t", "lidar", 2, b"II*no")], PARTS)), grid(spark)).where("tile_id = 't'").first()
    assert broken["error"].startswith("lidar") and broken["elevation"] is None


def test_warp_from_degrees():
    step = 0.0002
    lon0, lat0 = -80.51, 35.51
    lon, lat = np.meshgrid(lon0 + (np.arange(120) + 0.5) * step, lat0 - (np.arange(120) + 0.5) * step)
    source = {"bands": [1000 * (lon - lon0) + 500 * (lat - lat0)], "x0": lon0, "y0": lat0, "gsd_x": step, "gsd_m": step, "epsg": 4326, "nodata": None}
    target = surfaces.grid_of((-80.505, 35.495, -80.495, 35.505), 32617, 10.0)
    got = surfaces.warp_to(source, target)
    x, y = np.meshgrid(target["x0"] + (np.arange(target["width"]) + 0.5) * 10, target["y0"] - (np.arange(target["height"]) + 0.5) * 10)
    a, b = geo.unproject(x, y, 32617)
    assert np.allclose(got, 1000 * (a - lon0) + 500 * (b - lat0), atol=1e-3)


def test_whole_run(spark, tmp_path):
    csv, rng = tmp_path / "in.csv", np.random.default_rng(1)
    lines = [f"l{i},{35.5 + rng.uniform(-0.01, 0.01):.6f},{-80.5 + rng.uniform(-0.01, 0.01):.6f},371190001001000" for i in range(40)]
    csv.write_text("\n".join(["location_id,latitude,longitude,geoid_cb", *lines, lines[0].replace("l0", "again")]))
    raw = tables.read_locations(spark, str(csv))
    out, before = str(tmp_path / "out"), str(tmp_path / "before")
    batch.prepare(spark, raw, before)
    tiles = spark.read.parquet(f"{before}/tiles")
    boxes = [(r["tile_id"], surfaces.grid_of((r["min_lon"], r["min_lat"], r["max_lon"], r["max_lat"]), r["utm_epsg"], 10.0)) for r in tiles.collect()]
    folder = tmp_path / "tif"
    folder.mkdir()
    for k, (_, g) in enumerate(boxes):
        (folder / f"{k}.tif").write_bytes(tif(np.full((g["height"], g["width"]), 200.0), x0=g["x0"], y0=g["y0"]))
    area = [("dem", 0, f"{k}.tif", r["min_lon"], r["min_lat"], r["max_lon"], r["max_lat"]) for k, r in enumerate(tiles.collect())]
    catalogue = spark.createDataFrame(area, "layer string, rank int, name string, xmin double, ymin double, xmax double, ymax double")
    surfaces.build(surfaces.granules_of(spark, tiles, catalogue, str(folder)), surfaces.grids(tiles)).write.parquet(f"{before}/surfaces")
    built = spark.read.parquet(f"{before}/surfaces")
    assert built.count() == len(boxes) and built.where("error is not null").count() == 0
    got = batch.run(spark, str(csv), built, out, str(tmp_path / "report"), SkySpec(azimuth_step_deg=30.0, max_radius_m=100.0))
    assert got["n_coords"] == 40 and got["aggregates"]["counties"][0]["households"] == 41
    assert got["aggregates"]["summary"]["n_clear"] == 40
    page, parts = (tmp_path / "report" / "map.html").read_text(), list((tmp_path / "report" / "features").glob("part-*"))
    assert parts and all(f"features/{p.name}" in page for p in parts)
    assert horizon.score(spark.read.parquet(f"{out}/coords").selectExpr("'a' as location_id", "tile_id", "longitude", "latitude"), built).count() == 40
