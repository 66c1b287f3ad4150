"""Dataset discovery over tables: catalogue items, the registry of sources and the data manifest."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import geo
from ..functions.text import keyword_score
from ..specs import FACTORS, BuildingSpec

#: Vetted sources outside item catalogues (factor, name, registry id, address, metres a pixel, licence, text, keywords).
SOURCES = (
    ("canopy", "High Resolution Canopy Height Maps by WRI and Meta", "dataforgood-fb-forests", "https://registry.opendata.aws/dataforgood-fb-forests/", 1.0, "CC-BY-4.0", "Tree canopy height worldwide at about a metre, modelled from satellite images.", "canopy height tree forest chm vegetation"),
    ("canopy", "ETH Global Sentinel-2 10m Canopy Height 2020", None, "https://langnico.github.io/globalcanopyheight/", 10.0, "CC-BY-4.0", "Canopy height worldwide at 10 m; the coarser choice.", "canopy height tree forest eth sentinel"),
    ("buildings", "OpenBuildingMap (GFZ/GEM)", None, "https://www.openbuildingmap.org/", None, "ODbL-1.0", "Footprints of buildings with height or storeys, a file for each quadkey of level 6.", "building height storeys obm openbuildingmap gem"),
    ("buildings", "Overture Maps Foundation", "overturemaps", "https://registry.opendata.aws/overturemaps/", None, "CDLA-Permissive-2.0", "Footprints of buildings as vectors; many have a height.", "building footprint height overture structure"),
)


def sources(spark: SparkSession) -> DataFrame:
    rows = [(i, *s) for i, s in enumerate(SOURCES)]
    return spark.createDataFrame(rows, "ord int, factor string, name string, registry_id string, registry_url string, gsd_m double, license string, description string, keywords string")


def search_sources(table: DataFrame, keywords: list[str], factor: str | None = None, max_results: int | None = 5) -> DataFrame:
    """Sources by the number of keywords they hold, then in their own order; those that hold none are left out."""
    n = max(1, min(int(max_results or 5), 25))
    d = table.where(F.col("factor") == factor.strip().lower()) if factor and factor.strip() else table
    d = d.withColumn("score", keyword_score(keywords, *(F.col(c) for c in ("factor", "name", "description", "keywords"))))
    return d.where("score > 0").orderBy(F.desc("score"), "ord").limit(n)


def _in_order() -> list[Column]:
    """Finest first, unknown resolution last; then the oldest; then by id."""
    return [F.coalesce("gsd_m", F.lit(1e9)), F.coalesce("dt", F.lit("")), F.col("id")]


def best_items(items: DataFrame, box=None, newest: bool = False) -> DataFrame:
    """The best item of each collection. Of equal resolution the oldest comes first; ``newest`` turns that round."""
    d = items.where(geo.boxes_overlap(*(F.col(c) for c in ("xmin", "ymin", "xmax", "ymax")), box)) if box else items
    order = _in_order()
    if newest:
        order[1] = order[1].desc()
    return d.withColumn("_k", F.row_number().over(Window.partitionBy("collection").orderBy(*order))).where("_k = 1").drop("_k")


def item_time(properties: Column) -> Column:
    """When an item was taken: its ``datetime``, else the start of its span."""
    named = lambda k: F.nullif(F.try_element_at(properties, F.lit(k)), F.lit(""))
    return F.coalesce(named("datetime"), named("start_datetime"))


def all_hrefs(items: DataFrame) -> DataFrame:
    """``collection, href, at``: every address of a collection once, a row each; ``at`` puts them in order, finest first.

    Rows stay apart, so a collection of any size is no task's alone; sort by ``collection, at, href`` to list them.
    """
    at = F.struct(*(c.alias(n) for c, n in zip(_in_order(), ("gsd_m", "dt", "id"), strict=True)))
    return items.groupBy("collection", "href").agg(F.min(at).alias("at"))


def probe(items: DataFrame, extents: DataFrame, box, max_items: int = 50) -> DataFrame:
    """``collection, coverage_pct, n_items, sample_ids``: how much of the box a collection's extent covers, and what it holds there.

    Items are counted before they are shuffled, and each task ranks its own and hands on ``max_items`` of a collection at most.
    """
    corners = [F.col(c) for c in ("xmin", "ymin", "xmax", "ymax")]
    hits = items.where(geo.boxes_overlap(*corners, box)).select("collection", "id")
    held = hits.groupBy("collection").agg(F.count("*").alias("n_items"))
    first = hits.withColumn("_k", F.row_number().over(Window.partitionBy("collection").orderBy("id"))).where(F.col("_k") <= max_items)
    first = first.groupBy("collection").agg(F.sort_array(F.collect_list("id")).alias("sample_ids"))
    d = extents.select("collection", geo.overlap_pct(box, *corners).alias("coverage_pct"))
    return d.join(held, "collection", "left").join(first, "collection", "left").withColumn("n_items", F.coalesce("n_items", F.lit(0)).cast("long"))


def asset_href(assets: Column) -> Column:
    """The address of the asset that holds the data: by usual names, else any."""
    named = [F.try_element_at(assets, F.lit(k)) for k in ("data", "dsm", "dem", "elevation", "cog", "image", "visual")]
    return F.coalesce(*named, F.try_element_at(F.map_values(assets), F.lit(1)))


@dataclass
class Entry:
    """A dataset that was looked at for one factor."""

    factor: str
    dataset_id: str
    access: str
    selected: bool
    source_url: str | None = None
    asset_href: str | None = None
    url_template: str | None = None
    gsd_m: float | None = None
    vintage: str | None = None
    coverage_pct: float | None = None
    license: str | None = None
    rationale: str | None = None
    access_params: dict = field(default_factory=dict)


def build_manifest(box, entries: list[dict], notes: list[str] = (), generated_at: str = "") -> dict:
    """Check the entries and take back web picks without a source; says which factors are covered."""
    if not isinstance(entries, list) or not entries:
        raise ValueError("a manifest needs at least one entry")
    known, made, said = set(Entry.__dataclass_fields__), [], list(notes)
    for e in entries:
        if missing := {"factor", "dataset_id", "access", "selected"} - set(e):
            raise ValueError(f"an entry lacks {sorted(missing)}")
        made.append(Entry(**{k: v for k, v in e.items() if k in known}))
        if made[-1].access == "web" and made[-1].selected and not (made[-1].source_url or made[-1].asset_href):
            made[-1].selected = False
            said.append(f"{made[-1].dataset_id} ({made[-1].factor}) has no source and is not selected")
    covered = sorted({e.factor for e in made if e.selected})
    return {"aoi_bbox": list(box), "generated_at": generated_at, "entries": [asdict(e) for e in made], "notes": said, "factors_covered": covered, "factors_missing": [f for f in FACTORS if f not in covered]}


def grounded(entries: DataFrame, templates_count: bool = False) -> DataFrame:
    """The same rule over a table: ``selected`` holds only with a source, ``ungrounded`` marks what was taken back."""
    has = F.col("source_url").isNotNull() | F.col("asset_href").isNotNull()
    if templates_count and "url_template" in entries.columns:
        has = has | F.col("url_template").isNotNull()
    bad = (F.col("access") == "web") & F.col("selected") & ~has
    return entries.withColumn("ungrounded", bad).withColumn("selected", F.col("selected") & ~bad)


def upsert(manifest: DataFrame, changes: DataFrame) -> DataFrame:
    """Entries by (factor, dataset_id): changed ones replace the old."""
    return manifest.join(changes, ["factor", "dataset_id"], "left_anti").unionByName(changes, allowMissingColumns=True)


def selected_by_factor(manifest: DataFrame) -> DataFrame:
    """The entry to use for each factor: of the selected ones the last by ``ord``."""
    return manifest.where("selected").withColumn("_k", F.row_number().over(Window.partitionBy("factor").orderBy(F.desc("ord")))).where("_k = 1").drop("_k")


def layer_hrefs(entries: list[dict]) -> dict[str, list[str]]:
    """Addresses by layer, whatever name an entry gives its factor; a buildings entry counts without one."""
    alias = {"surface": "surface", "dsm": "surface", "true_dsm": "surface", "terrain": "terrain", "dem": "terrain", "canopy": "canopy", "buildings": "buildings", "building": "buildings"}
    out: dict[str, list[str]] = {}
    for e in entries:
        layer, href = alias.get(str(e.get("factor", "")).lower()), e.get("asset_href") or e.get("source_url")
        if layer and e.get("selected", True):
            found = href if isinstance(href, list) else [href] if href else []
            if found or layer == "buildings":
                out[layer] = found
    return out


def building_access(entry: dict | None = None, spec: BuildingSpec = BuildingSpec()) -> dict:
    """Where footprints are and what their columns are called: as the entry says, else as the spec does.

    A template may stand among the addresses too; it is the one with ``{quadkey}`` in it. What was resolved stays as it is.
    """
    said = {k: v for k, v in {**((entry or {}).get("access_params") or {}), **(entry or {})}.items() if v not in (None, "")}
    hrefs = said.get("hrefs") or said.get("asset_href") or []
    inside = [h for h in ([hrefs] if isinstance(hrefs, str) else hrefs) if "{quadkey}" in str(h)]
    out = {k: said.get(k, v) for k, v in asdict(spec).items()}
    if "url_template" not in said and inside:
        out["url_template"] = inside[0]
    return out | {"quadkey_zoom": int(out["quadkey_zoom"])}


def building_urls(box, spark: SparkSession, entry: dict | None = None) -> list[str]:
    """Addresses of the footprint files that cover a box."""
    access = building_access(entry)
    return [access["url_template"].replace("{quadkey}", k) for k in building_keys(box, access["quadkey_zoom"], spark)]


def save_manifest(manifest: dict, path: str) -> None:
    """Write a manifest with the time of writing."""
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps(manifest | {"generated_at": datetime.now(UTC).isoformat(timespec="seconds")}, indent=2, default=str))


def load_manifest(path: str) -> dict:
    """The manifest of a file; an empty one if there is no file."""
    return json.loads(Path(path).read_text()) if Path(path).exists() else {"aoi_bbox": None, "entries": [], "notes": []}


def add_entry(manifest: dict, entry: dict) -> dict:
    """The manifest with an entry in place of that of the same factor and dataset; an unfounded web pick is taken back."""
    template = (entry.get("access_params") or {}).get("url_template")
    made = build_manifest(manifest.get("aoi_bbox") or (), [entry | ({"source_url": template} if template and not entry.get("source_url") else {})])
    new = made["entries"][0] | {"source_url": entry.get("source_url")}
    kept = [e for e in manifest.get("entries", []) if (e.get("factor"), e.get("dataset_id")) != (new["factor"], new["dataset_id"])]
    return manifest | {"entries": [*kept, new], "notes": [*manifest.get("notes", []), *made["notes"]]}


def remove_entry(manifest: dict, dataset_id: str, factor: str | None = None) -> tuple[dict, int]:
    """The manifest without a dataset, of one factor or of all, and how many entries went."""
    kept = [e for e in manifest.get("entries", []) if e.get("dataset_id") != dataset_id or factor not in (None, e.get("factor"))]
    return manifest | {"entries": kept}, len(manifest.get("entries", [])) - len(kept)


def list_entries(manifest: dict) -> list[str]:
    """A line for each entry, selected ones marked, then the notes."""
    lines = []
    for e in manifest.get("entries", []):
        where = e.get("source_url") or e.get("asset_href") or (e.get("access_params") or {}).get("url_template") or ""
        lines.append(f"{'*' if e.get('selected') else '-'} {e.get('factor')}: {e.get('dataset_id')}, {e.get('access')}, {e.get('license') or 'no licence stated'} {where}".rstrip())
    return lines + [f"note: {n}" for n in manifest.get("notes", [])]


def building_keys(box, zoom: int, spark: SparkSession) -> list[str]:
    """Quadkeys of the building files that cover a box."""
    return list(spark.range(1).select(geo.box_quadkeys(*(F.lit(float(v)) for v in box), zoom).alias("k")).first()["k"])


def buildings_in(box, footprints: DataFrame) -> DataFrame:
    """Footprints with a height whose ``bbox`` struct overlaps the box: a filter on nested columns, which reaches the scan."""
    b = lambda n: F.col(f"bbox.{n}")
    return footprints.where(F.col("height").isNotNull() & geo.boxes_overlap(b("xmin"), b("ymin"), b("xmax"), b("ymax"), box))


def overlap_join(boxes: DataFrame, others: DataFrame, zoom: int) -> DataFrame:
    """Pairs of boxes (id, xmin..ymax) of two tables that overlap: equal quadkeys first, the overlap itself after, each once."""
    key = lambda d: geo.box_quadkeys(*(F.col(c) for c in ("xmin", "ymin", "xmax", "ymax")), zoom)
    a = boxes.select(F.explode(key(boxes)).alias("quadkey"), F.struct("id", "xmin", "ymin", "xmax", "ymax").alias("a"))
    b = others.select(F.explode(key(others)).alias("quadkey"), F.struct("id", "xmin", "ymin", "xmax", "ymax").alias("b"))
    touch = (F.col("a.xmin") <= F.col("b.xmax")) & (F.col("a.xmax") >= F.col("b.xmin")) & (F.col("a.ymin") <= F.col("b.ymax")) & (F.col("a.ymax") >= F.col("b.ymin"))
    return a.join(b, "quadkey").where(touch).select(F.col("a.id").alias("id_a"), F.col("b.id").alias("id_b")).distinct()
