"""``python -m skyscreen COMMAND``: the steps of a run from a shell. ``--help`` lists them."""

from __future__ import annotations

import argparse
import json
import sys
from pathlib import Path

from pyspark.sql import SparkSession

from .operators import cache, catalog, locations, quality
from .plans import batch
from .session import ship
from .sources import geotiff, tables
from .specs import AOI, SkySpec


def _session() -> SparkSession:
    return ship(SparkSession.builder.appName("skyscreen").getOrCreate())


def _show(value: object) -> None:
    print(json.dumps(value, indent=1, default=str))


def _surfaces(spark: SparkSession, path: str):
    """Built surfaces: the cache's table, or a folder of GeoTIFF files."""
    return geotiff.read_surfaces(spark, path) if path.endswith((".tif", "/*")) else spark.read.parquet(path)


def _findings(spark: SparkSession, out: str):
    d = tables.read_findings(spark, f"{out}/findings")
    return batch.with_counties(spark, d, out)


def sources(a) -> None:
    _show([r.asDict() for r in catalog.search_sources(catalog.sources(_session()), a.keyword, a.factor).collect()])


def manifest(a) -> int:
    got = catalog.load_manifest(a.path)
    if a.what == "list":
        print("\n".join(catalog.list_entries(got)) or "the manifest is empty")
    elif a.what == "add":
        if a.box and not got.get("aoi_bbox"):
            got["aoi_bbox"] = a.box
        catalog.save_manifest(catalog.add_entry(got, json.loads(a.entry)), a.path)
    elif a.what == "remove":
        got, n = catalog.remove_entry(got, a.dataset_id, a.factor)
        if not n:
            print(f"no entry is called {a.dataset_id}", file=sys.stderr)
            return 1
        catalog.save_manifest(got, a.path)
    else:
        try:
            Path(a.path).unlink()
        except FileNotFoundError:
            print("there is no manifest", file=sys.stderr)
            return 1
    return 0


def tile(a) -> None:
    spark = _session()
    _show(batch.prepare(spark, tables.read_locations(spark, a.locations), a.out))


def build(a) -> None:
    spark = _session()
    catalogue, tiles = spark.read.parquet(a.catalogue), spark.read.parquet(f"{a.out}/tiles")
    crs = f"EPSG:{tiles.first()['utm_epsg']}"
    _show({"surfaces": cache.fetch(spark, tiles, catalogue, a.granules, a.cache, crs, a.mode).count()})


def cached(a) -> None:
    got = cache.read(_session(), a.cache)
    _show([] if got is None else [r.asDict() for r in cache.listing(got, a.tile).collect()])


def score(a) -> None:
    spark = _session()
    _show(batch.score_tiles(spark, a.out, _surfaces(spark, a.surfaces), SkySpec(), a.rescore, a.limit))


def qa(a) -> None:
    spark = _session()
    found = {}
    if a.locations:
        found["input"] = locations.audit_report(tables.read_locations(spark, a.locations), a.box or AOI)
    found["output"] = [r.asDict() for r in quality.output_audit(_findings(spark, a.out), county="county", weight="n_locations").collect()]
    _show(found)


def report(a) -> None:
    _show(batch.report(_session(), a.out, a.folder))


def full(a) -> None:
    spark = _session()
    _show(batch.run(spark, a.locations, _surfaces(spark, a.surfaces), a.out, a.folder))


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser("python -m skyscreen", description=__doc__)
    commands = p.add_subparsers(required=True)

    def command(run, *names: str, **more):
        c = commands.add_parser(run.__name__, help=more.pop("help"))
        for n in names:
            c.add_argument(n)
        c.set_defaults(run=run)
        return c

    box = {"type": float, "nargs": 4, "metavar": ("WEST", "SOUTH", "EAST", "NORTH")}
    c = command(sources, help="search the registry of sources")
    c.add_argument("keyword", nargs="*")
    c.add_argument("--factor")
    c = command(manifest, help="list, add, remove or delete manifest entries")
    c.add_argument("what", choices=("list", "add", "remove", "delete"))
    c.add_argument("path")
    c.add_argument("--entry", help="an entry as JSON, to add", default="{}")
    c.add_argument("--dataset-id")
    c.add_argument("--factor")
    c.add_argument("--box", **box)
    command(tile, "locations", "out", help="coordinates, tiles and counties of a CSV of locations")
    c = command(build, "out", "catalogue", "granules", "cache", help="build the surfaces that the cache lacks")
    c.add_argument("--mode")
    c = command(cached, "cache", help="what the cache of surfaces holds")
    c.add_argument("--tile")
    c = command(score, "out", "surfaces", help="score the tiles that have a surface and no findings")
    c.add_argument("--rescore", action="store_true")
    c.add_argument("--limit", type=int)
    c = command(qa, "out", help="audit findings, and locations if given")
    c.add_argument("--locations")
    c.add_argument("--box", **box)
    command(report, "out", "folder", help="roll-ups, map and decision log")
    command(full, "locations", "surfaces", "out", "folder", help="all of it, on built surfaces")
    return p


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    return a.run(a) or 0


if __name__ == "__main__":
    sys.exit(main())
