"""Household-weighted roll-ups, map features and the deliverables that are built from them."""

from __future__ import annotations

import json
import shutil
import subprocess
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import state_fips, state_name
from ..specs import AT_RISK, COUNTY_NAMES, TIERS, ReportSpec
from .quality import summary, tier


def _sums(weight: Column) -> list[Column]:
    """Households of a region: all, by tier, at risk. The rate is over households that were scored."""
    part = lambda when: F.sum(F.when(when, weight).otherwise(0.0))
    risky, scored = part(tier().isin(*AT_RISK)), part(tier() != "undetermined")
    whole = lambda c: F.round(c).cast("long")
    return [
        whole(F.sum(weight)).alias("households"),
        *(whole(part(tier() == t)).alias(f"{t}_households") for t in TIERS),
        whole(risky).alias("at_risk_total"),
        F.when(scored > 0, F.round(risky / F.when(scored > 0, scored), 4)).otherwise(0.0).alias("at_risk_rate"),
    ]


def _weight(weight: str | None) -> Column:
    return F.coalesce(F.col(weight).cast("double"), F.lit(1.0)) if weight else F.lit(1.0)


def by_county(findings: DataFrame, county: str = "county", weight: str | None = "n_locations") -> DataFrame:
    """One row a county, the most households at risk first; rows without a county are left out."""
    d = findings.where(F.col(county).isNotNull() & (F.col(county) != ""))
    return d.groupBy(F.col(county).alias("region")).agg(*_sums(_weight(weight))).orderBy(F.desc("at_risk_total"), "region")


def by_state(findings: DataFrame, county: str = "county", weight: str | None = "n_locations") -> DataFrame:
    d = findings.where(F.col(county).isNotNull() & (F.col(county) != ""))
    return d.groupBy(state_fips(F.col(county)).alias("region")).agg(*_sums(_weight(weight))).withColumn("state_name", state_name(F.col("region"))).orderBy(F.desc("at_risk_total"), "region")


def two_levels(findings: DataFrame, county: str = "county", weight: str | None = "n_locations") -> DataFrame:
    """Counties and states from one pass: grouping sets over the same rows. ``level`` tells them apart."""
    w = _weight(weight)
    d = findings.where(F.col(county).isNotNull() & (F.col(county) != "")).select(F.col(county).alias("county"), state_fips(F.col(county)).alias("state"), tier().alias("risk_tier"), w.alias("w"))
    return d.groupingSets([["state", "county"], ["state"]], "state", "county").agg(F.when(F.grouping("county") == 1, "state").otherwise("county").alias("level"), *_sums(F.col("w"))).withColumn("region", F.coalesce("county", "state"))


def top_counties(findings: DataFrame, report: ReportSpec = ReportSpec(), **kw) -> DataFrame:
    return by_county(findings, **kw).limit(report.top_n_counties)


def placed(findings: DataFrame, coords: DataFrame) -> DataFrame:
    """Findings with a position: their own if both halves are there, else that of their coordinate; the rest is left out."""
    own = [c in findings.columns for c in ("lon", "lat")]
    d = findings if all(own) else findings.withColumn("lon", F.lit(None).cast("double")).withColumn("lat", F.lit(None).cast("double"))
    found = coords.select(F.col("coord_id").alias("_id"), F.col("longitude").alias("_lon"), F.col("latitude").alias("_lat"))
    d = d.join(found, F.col("coord_id") == F.col("_id"), "left")
    missing = F.col("lon").isNull() | F.col("lat").isNull()
    d = d.withColumn("_x", F.when(missing, F.col("_lon")).otherwise(F.col("lon"))).withColumn("_y", F.when(missing, F.col("_lat")).otherwise(F.col("lat")))
    return d.withColumn("lon", F.col("_x")).withColumn("lat", F.col("_y")).drop("_id", "_lon", "_lat", "_x", "_y").where("lon is not null and lat is not null")


def features(points: DataFrame, county: str | None = "county") -> DataFrame:
    """``feature``: one GeoJSON point a row, as text. Rows without a county have no county or state; null values stay out."""
    props = ["location_id", tier().alias("risk_tier"), "obstruction_pct", "confidence"]
    if county:
        known = F.nullif(F.col(county), F.lit(""))
        props += [known.alias("county"), state_fips(known).alias("state")]
    shape = F.struct(F.lit("Point").alias("type"), F.array("lon", "lat").alias("coordinates"))
    return points.select("location_id", F.to_json(F.struct(F.lit("Feature").alias("type"), shape.alias("geometry"), F.struct(*props).alias("properties"))).alias("feature"))


def feature_collection(points: DataFrame, path: str, county: str | None = "county") -> int:
    """One GeoJSON FeatureCollection in a file, for readers that take nothing else; gives the number of features.

    Rows reach the driver partition by partition and go straight to the file, so it never holds more than one of them.
    """
    n = 0
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w") as f:
        f.write('{"type": "FeatureCollection", "features": [')
        for row in features(points, county).select("feature").toLocalIterator():
            f.write(("," if n else "") + "\n" + row["feature"])
            n += 1
        f.write("\n]}\n")
    return n


def write_tiles(features_path: str, target: str, report: ReportSpec = ReportSpec(), program: str = "tippecanoe") -> tuple[bool, str]:
    """Map tiles from written features, by the public tile builder if it is installed: (whether they were made, what happened).

    The step is optional: without the program, or if it fails, the features remain and the message says so.
    """
    if not shutil.which(program):
        return False, f"{program} is not installed; the features are there without tiles"
    files = [str(p) for p in sorted(Path(features_path).glob("part-*"))] if Path(features_path).is_dir() else [features_path]
    order = [program, "-o", target, "--force", "-l", "findings", "-Z", str(report.min_zoom), "-z", str(report.max_zoom), "-r1", "--cluster-distance=8", *files]
    try:
        done = subprocess.run(order, capture_output=True, text=True, timeout=600)
    except (OSError, subprocess.TimeoutExpired) as e:
        return False, f"{program} did not run: {e}"
    return (True, f"wrote {Path(target).name}") if done.returncode == 0 else (False, f"{program} ended with {done.returncode}: {done.stderr.strip()[:300]}")


def centre_zoom(points: DataFrame) -> DataFrame:
    """The middle of all points and the zoom that shows them."""
    span = F.greatest(F.max("lon") - F.min("lon"), F.max("lat") - F.min("lat"))
    zoom = F.greatest(F.lit(3.0), F.least(F.lit(11.0), F.log2(F.lit(360.0) / F.greatest(span, F.lit(0.01)))))
    return points.agg(F.round((F.min("lon") + F.max("lon")) / 2, 6).alias("center_lon"), F.round((F.min("lat") + F.max("lat")) / 2, 6).alias("center_lat"), F.round(zoom, 4).alias("zoom"))


def write_features(points: DataFrame, path: str, county: str | None = "county") -> list[str]:
    """Newline-delimited GeoJSON, written by the executors: what tile builders read, at any size. Gives the files' names."""
    features(points, county).select("feature").write.mode("overwrite").text(path)
    return sorted(f.rsplit("/", 1)[-1] for f in points.sparkSession.read.text(path).inputFiles())


def aggregates(findings: DataFrame, county: str = "county", weight: str | None = "n_locations") -> dict:
    """The run's summary and both roll-ups as plain values: as many rows as there are counties."""
    return {"summary": summary(findings).first().asDict(), "counties": [r.asDict() for r in by_county(findings, county, weight).collect()], "states": [r.asDict() for r in by_state(findings, county, weight).collect()]}


def _share(part: int, whole: int) -> str:
    return f"{100 * part / whole:.1f}%" if whole else "—"


def decision_log(got: dict, anomalies: list[dict] = (), map_name: str | None = None, when: str | None = None, report: ReportSpec = ReportSpec()) -> str:
    """A Markdown summary for readers who decide, from the values of :func:`aggregates`."""
    s, n = got["summary"], got["summary"]["n_findings"]
    out = ["# Sky obstruction screening", "", f"Made {when or datetime.now(UTC).isoformat(timespec='seconds')}, report {report.report_version}, spec {s['spec_versions'] or 'not stamped'}.", "", "## Result", "", f"{n:,} coordinates were looked at.", "", "| Tier | Coordinates | Share |", "|---|--:|--:|"]
    out += [f"| {t} | {s[f'n_{t}']:,} | {_share(s[f'n_{t}'], n)} |" for t in TIERS]
    row = lambda name, r: f"| {name} | {r['households']:,} | {r['at_risk_total']:,} | {_share(r['at_risk_total'], r['households'])} | {r['undetermined_households']:,} |"
    head = ["| Region | Households | At risk | Share | Undetermined |", "|---|--:|--:|--:|--:|"]
    if got["states"]:
        out += ["", "## States", "", *head, *(row(r["state_name"], r) for r in got["states"])]
    if got["counties"]:
        top = got["counties"][: report.top_n_counties]
        out += ["", f"## The {len(top)} counties with the most households at risk", "", *head, *(row(COUNTY_NAMES.get(r["region"], r["region"]), r) for r in top)]
        if len(got["counties"]) > len(top):
            out.append(f"\n{len(got['counties']) - len(top):,} more counties are in the JSON file.")
    out += ["", "## Limits", "", f"- {s['undetermined_rate']:.1%} have no surface to judge by and {s['low_confidence_rate']:.1%} are of low confidence: look at the site first.", "- The bands of the tiers are defaults until they are calibrated on labelled sites."]
    if anomalies:
        critical = sum(a["severity"] == "critical" for a in anomalies)
        out += ["", "## Review", "", f"{len(anomalies)} anomalies, {critical} of them critical.", *(f"- {a['severity']}: {a['rule']} ({a['scope']}), {a['detail']}" for a in anomalies[:10])]
    if map_name:
        out += ["", f"Map: [{map_name}]({map_name})"]
    return "\n".join([*out, ""])


_PAGE = """<!DOCTYPE html>
<html lang="en"><head><meta charset="utf-8"><title>{title}</title>
<style>body{{margin:0;font:14px system-ui}}canvas{{width:100vw;height:90vh;display:block}}header{{padding:8px}}label{{margin-right:12px}}</style></head>
<body><header><b>{title}</b> {toggles} <select id="state"><option value="">all states</option>{states}</select>
<select id="county"><option value="">all counties</option>{counties}</select></header><canvas id="c"></canvas>
<script>
const colours = {colours}, sources = {sources}, outlines = {outlines};
const canvas = document.getElementById("c"), g = canvas.getContext("2d");
let points = [], borders = [];
function draw() {{
  canvas.width = canvas.clientWidth; canvas.height = canvas.clientHeight;
  const on = new Set([...document.querySelectorAll("input:checked")].map(x => x.value));
  const state = document.getElementById("state").value, county = document.getElementById("county").value;
  const scale = 256 * 2 ** {zoom} / 360;
  for (const [id, shapes] of borders) {{
    g.strokeStyle = id === county ? "#c80" : "#bbb";
    for (const rings of shapes) for (const ring of rings) {{
      g.beginPath();
      for (const [lon, lat] of ring) g.lineTo(canvas.width / 2 + (lon - {lon}) * scale, canvas.height / 2 - (lat - {lat}) * scale * 1.2);
      g.stroke();
    }}
  }}
  for (const p of points) {{
    const q = p.properties, [lon, lat] = p.geometry.coordinates;
    if (!on.has(q.risk_tier) || (state && q.state !== state) || (county && q.county !== county)) continue;
    g.fillStyle = colours[q.risk_tier] || "#000";
    g.fillRect(canvas.width / 2 + (lon - {lon}) * scale, canvas.height / 2 - (lat - {lat}) * scale * 1.2, 2, 2);
  }}
}}
// a state narrows the counties down; one that lies elsewhere is no longer chosen
document.getElementById("state").addEventListener("change", e => {{
  const county = document.getElementById("county");
  for (const o of county.options) o.hidden = Boolean(o.value && e.target.value && o.dataset.state !== e.target.value);
  if (county.selectedOptions[0].hidden) county.value = "";
}});
document.querySelectorAll("input,select").forEach(x => x.addEventListener("change", draw));
if (outlines) fetch(outlines).then(r => r.json()).then(t => {{
  for (const f of t.features) borders.push([f.properties.GEOID, f.geometry.type === "Polygon" ? [f.geometry.coordinates] : f.geometry.coordinates]);
  draw();
}});
for (const s of sources) fetch(s).then(r => r.text()).then(t => {{
  for (const line of t.split("\\n")) if (line) points.push(JSON.parse(line));
  draw();
}});
</script></body></html>
"""


def map_html(centre: dict, sources: list[str], got: dict | None = None, title: str = "Sky obstruction", report: ReportSpec = ReportSpec(), outlines: str | None = None) -> str:
    """A page that draws newline-delimited features by tier, with tier, state and county filters; a state narrows the counties.

    ``outlines`` names a GeoJSON file of counties (GEOID) beside the page, drawn as lines with the chosen one marked.
    """
    option = lambda value, name, more="": f'<option value="{value}"{more}>{name}</option>'
    toggles = "".join(f'<label style="color:{c}"><input type="checkbox" value="{t}" checked>{t}</label>' for t, c in report.tier_colours)
    states = "".join(option(r["region"], r["state_name"]) for r in (got or {}).get("states", []))
    names = sorted((COUNTY_NAMES.get(r["region"], r["region"]), r["region"]) for r in (got or {}).get("counties", []))
    counties = "".join(option(v, f"{n} ({v})", f' data-state="{v[:2]}"') for n, v in names)
    return _PAGE.format(title=title, toggles=toggles, states=states, counties=counties, colours=json.dumps(dict(report.tier_colours)), sources=json.dumps(sources), outlines=json.dumps(outlines), zoom=centre["zoom"], lon=centre["center_lon"], lat=centre["center_lat"])


def write_report(content: str, filename: str, folder: str) -> str:
    """Write a small text deliverable; only plain names of known kinds."""
    if not content or not content.strip():
        raise ValueError("there is nothing to write")
    if filename != Path(filename).name or Path(filename).suffix not in (".md", ".json", ".txt", ".html"):
        raise ValueError(f"not a plain .md, .json, .txt or .html name: {filename!r}")
    Path(folder).mkdir(parents=True, exist_ok=True)
    target = Path(folder, filename)
    target.write_text(content)
    return str(target)
