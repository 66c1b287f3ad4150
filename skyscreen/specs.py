"""Version-stamped parameters. The numbers and names are fixed values: results depend on them."""

from __future__ import annotations

from dataclasses import dataclass

TIERS = ("clear", "at_risk", "severe", "undetermined")
SCORED = ("clear", "at_risk", "severe")
AT_RISK = ("at_risk", "severe")
SURFACE_MODES = ("mosaic", "true_dsm", "pseudo_dsm", "cover_proxy")
FACTORS = ("terrain", "surface", "canopy", "buildings")
#: Provenance of a surface pixel by code.
PROVENANCE = ("none", "dem_fill", "pseudo", "lidar", "structure")
#: What the data under a point warrant.
BASE_CONFIDENCE = {"lidar": "high", "pseudo": "medium", "structure": "medium", "dem_fill": "low", "dem": "low"}
NODATA = -9999.0
CONUS = (-125.0, 24.0, -66.5, 49.5)
AOI = (-84.32, 33.84, -75.46, 36.59)
EARTH_RADIUS_M, REFRACTION = 6_371_000.0, 0.13


@dataclass(frozen=True)
class SkySpec:
    """Reception geometry, risk bands and confidence inputs of one scoring run; metres and degrees."""

    spec_version: str = "spec-2026.07-roof0"
    min_elevation_deg: float = 25.0
    az_center_deg: float = 0.0
    az_halfwidth_deg: float = 55.0
    az_weighting: str = "north_biased"
    gso_keepout_halfwidth_deg: float = 18.0
    band_clear_max_pct: float = 1.0
    band_severe_min_pct: float = 10.0
    azimuth_step_deg: float = 2.0
    max_radius_m: float = 1500.0
    earth_curvature: bool = False
    sigma_h_m: float = 3.0
    confidence_near_field_m: float = 500.0
    conf_near_sampled_high: float = 0.9
    conf_near_sampled_med: float = 0.5
    mount_heights_m: tuple[float, ...] = (0.0, 0.3, 0.6)


@dataclass(frozen=True)
class TileSpec:
    tile_size_m: float = 5000.0
    tile_buffer_m: float = 300.0
    target_gsd_m: float = 10.0
    building_quadkey_zoom: int = 6
    meters_per_level: float = 3.0
    height_min: float = 0.0
    height_max: float = 500.0


@dataclass(frozen=True)
class BuildingSpec:
    """Where building footprints are published, a file a quadkey, and the names of their columns."""

    url_template: str = "https://data.source.coop/tge-labs/openbuildingmap/building.{quadkey}.parquet"
    quadkey_zoom: int = 6
    geom_col: str = "geometry"
    height_col: str = "height"
    bbox_col: str = "bbox"


@dataclass(frozen=True)
class QaSpec:
    qa_spec_version: str = "qa-2026.06-v1"
    saturated_region_rate: float = 0.95
    min_region_size: int = 30
    degenerate_group_min: int = 20
    max_undetermined_rate: float = 0.20
    max_low_confidence_rate: float = 0.30
    max_samples: int = 10


@dataclass(frozen=True)
class ReportSpec:
    report_version: str = "report-1"
    top_n_counties: int = 15
    min_zoom: int = 3
    max_zoom: int = 14
    tier_colours: tuple[tuple[str, str], ...] = (("clear", "#2e9e4f"), ("at_risk", "#e8b10c"), ("severe", "#c8322b"), ("undetermined", "#8a8f98"))


#: The public FIPS codes of the states.
STATE_NAMES = {
    "01": "Alabama", "02": "Alaska", "04": "Arizona", "05": "Arkansas", "06": "California", "08": "Colorado",
    "09": "Connecticut", "10": "Delaware", "11": "District of Columbia", "12": "Florida", "13": "Georgia",
    "15": "Hawaii", "16": "Idaho", "17": "Illinois", "18": "Indiana", "19": "Iowa", "20": "Kansas", "21": "Kentucky",
    "22": "Louisiana", "23": "Maine", "24": "Maryland", "25": "Massachusetts", "26": "Michigan", "27": "Minnesota",
    "28": "Mississippi", "29": "Missouri", "30": "Montana", "31": "Nebraska", "32": "Nevada", "33": "New Hampshire",
    "34": "New Jersey", "35": "New Mexico", "36": "New York", "37": "North Carolina", "38": "North Dakota",
    "39": "Ohio", "40": "Oklahoma", "41": "Oregon", "42": "Pennsylvania", "44": "Rhode Island",
    "45": "South Carolina", "46": "South Dakota", "47": "Tennessee", "48": "Texas", "49": "Utah", "50": "Vermont",
    "51": "Virginia", "53": "Washington", "54": "West Virginia", "55": "Wisconsin", "56": "Wyoming",
}
#: The public FIPS codes of the counties of state 37.
COUNTY_NAMES = {
    "37001": "Alamance", "37003": "Alexander", "37005": "Alleghany", "37007": "Anson", "37009": "Ashe",
    "37011": "Avery", "37013": "Beaufort", "37015": "Bertie", "37017": "Bladen", "37019": "Brunswick",
    "37021": "Buncombe", "37023": "Burke", "37025": "Cabarrus", "37027": "Caldwell", "37029": "Camden",
    "37031": "Carteret", "37033": "Caswell", "37035": "Catawba", "37037": "Chatham", "37039": "Cherokee",
    "37041": "Chowan", "37043": "Clay", "37045": "Cleveland", "37047": "Columbus", "37049": "Craven",
    "37051": "Cumberland", "37053": "Currituck", "37055": "Dare", "37057": "Davidson", "37059": "Davie",
    "37061": "Duplin", "37063": "Durham", "37065": "Edgecombe", "37067": "Forsyth", "37069": "Franklin",
    "37071": "Gaston", "37073": "Gates", "37075": "Graham", "37077": "Granville", "37079": "Greene",
    "37081": "Guilford", "37083": "Halifax", "37085": "Harnett", "37087": "Haywood", "37089": "Henderson",
    "37091": "Hertford", "37093": "Hoke", "37095": "Hyde", "37097": "Iredell", "37099": "Jackson",
    "37101": "Johnston", "37103": "Jones", "37105": "Lee", "37107": "Lenoir", "37109": "Lincoln",
    "37111": "McDowell", "37113": "Macon", "37115": "Madison", "37117": "Martin", "37119": "Mecklenburg",
    "37121": "Mitchell", "37123": "Montgomery", "37125": "Moore", "37127": "Nash", "37129": "New Hanover",
    "37131": "Northampton", "37133": "Onslow", "37135": "Orange", "37137": "Pamlico", "37139": "Pasquotank",
    "37141": "Pender", "37143": "Perquimans", "37145": "Person", "37147": "Pitt", "37149": "Polk",
    "37151": "Randolph", "37153": "Richmond", "37155": "Robeson", "37157": "Rockingham", "37159": "Rowan",
    "37161": "Rutherford", "37163": "Sampson", "37165": "Scotland", "37167": "Stanly", "37169": "Stokes",
    "37171": "Surry", "37173": "Swain", "37175": "Transylvania", "37177": "Tyrrell", "37179": "Union",
    "37181": "Vance", "37183": "Wake", "37185": "Warren", "37187": "Washington", "37189": "Watauga",
    "37191": "Wayne", "37193": "Wilkes", "37195": "Wilson", "37197": "Yadkin", "37199": "Yancey",
}
