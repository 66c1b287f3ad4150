"""Horizon profiles and obstruction scores.

:func:`score` runs the numpy kernel on one tile's surface and a bounded share of its points at a time. :func:`profile_of_pixels`
computes the same horizon with joins alone, for checks and for small rasters.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import geo, sky
from ..specs import BASE_CONFIDENCE, EARTH_RADIUS_M, PROVENANCE, REFRACTION, SkySpec
from .raster import warp_bilinear

#: Points of a tile that one group scores, sites of a tile whose candidates one group tries, and samples that the kernel holds at once.
POINTS_PER_GROUP, SITES_PER_GROUP, SAMPLES_AT_ONCE = 4096, 512, 32_768


def spec_with(spec: SkySpec = SkySpec(), **changes) -> SkySpec:
    """The spec with what was given; None leaves a value as it is."""
    return replace(spec, **{k: v for k, v in changes.items() if v is not None})


def bearings(step_deg: float) -> np.ndarray:
    n = max(1, round(360.0 / max(0.1, step_deg)))
    return np.arange(n) * (360.0 / n)


def weights(azimuth: np.ndarray, spec: SkySpec) -> np.ndarray:
    wrap = lambda d: (d + 180.0) % 360.0 - 180.0
    delta = wrap(azimuth - spec.az_center_deg)
    w = np.ones(len(azimuth))
    if spec.az_weighting != "uniform":
        w = (1 + np.cos(np.radians(delta))) / 2
        w[np.abs(wrap(azimuth - 180.0)) <= spec.gso_keepout_halfwidth_deg] *= 0.15
    w[np.abs(delta) > spec.az_halfwidth_deg + 1e-9] = 0.0
    return w


@dataclass
class Surface:
    """A tile's elevations (NaN: none) and provenance codes, north up; x0 and y0 are its upper left corner."""

    elevation: np.ndarray
    provenance: np.ndarray | None
    x0: float
    y0: float
    gsd: float

    def at(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return warp_bilinear(self.elevation, (self.y0 - y) / self.gsd - 0.5, (x - self.x0) / self.gsd - 0.5)

    def phase(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where in its pixel each place lies, to a billionth."""
        return tuple(np.round(v - np.floor(v), 9) for v in ((self.y0 - y) / self.gsd, (x - self.x0) / self.gsd))

    def provenance_at(self, x: float, y: float) -> str | None:
        r, c = int(np.rint((self.y0 - y) / self.gsd - 0.5)), int(np.rint((x - self.x0) / self.gsd - 0.5))
        if self.provenance is None or not (0 <= r < self.provenance.shape[0] and 0 <= c < self.provenance.shape[1]):
            return None
        code = int(self.provenance[r, c])
        return PROVENANCE[code] if 0 < code < len(PROVENANCE) else None


class _Looks:
    """A surface laid out for many looks: pixels without data all round it, and how many of the four under a look have data."""

    def __init__(self, surface: Surface, spec: SkySpec):
        self.surface, self.spec = surface, spec
        self.azimuth, step = bearings(spec.azimuth_step_deg), max(1.0, surface.gsd)
        self.radius = np.arange(step, spec.max_radius_m + step * 1e-9, step)
        self.n, self.n_near = (len(self.azimuth) * k for k in (len(self.radius), int((self.radius <= spec.confidence_near_field_m).sum())))
        self.east, self.north = (self.radius[:, None] * f(np.radians(self.azimuth)) for f in (np.sin, np.cos))
        self.level = (self.radius * np.tan(np.radians(max(1e-3, spec.min_elevation_deg))))[:, None]
        self.drop = (self.radius**2 * ((1 - REFRACTION) / (2 * EARTH_RADIUS_M)))[:, None]
        height, width = surface.elevation.shape
        # as far as a place on the surface looks at most, so that a look never leaves what is laid out
        self.pad = int(min(spec.max_radius_m / surface.gsd, np.hypot(height, width) + 8)) + 4
        self.height, self.width, self.stride = height, width, width + 2 * self.pad
        inner = slice(self.pad, self.pad + height), slice(self.pad, self.pad + width)
        self.elevation, known = np.full((height + 2 * self.pad, self.stride), np.nan), np.zeros((height + 2 * self.pad, self.stride), np.uint8)
        known[inner] = np.isfinite(surface.elevation)
        self.elevation[inner] = np.where(known[inner], surface.elevation, np.nan)
        self.elevation, self.corners = self.elevation.ravel(), np.zeros_like(known)
        self.corners[:-1, :-1] = known[:-1, :-1] + known[:-1, 1:] + known[1:, :-1] + known[1:, 1:]
        self.corners = self.corners.ravel()

    def held(self, x: np.ndarray, y: np.ndarray) -> int:
        """Radii to look at: samples beyond the farthest corner have no data, they count as samples and need no look."""
        s = self.surface
        reach = np.fmax.reduce(np.hypot(np.fmax(np.abs(x - s.x0), np.abs(s.x0 + self.width * s.gsd - x)), np.fmax(np.abs(s.y0 - y), np.abs(y - s.y0 + self.height * s.gsd)))) + 2 * s.gsd
        return max(1, int((self.radius <= reach).sum()))

    def batches(self, x: np.ndarray, y: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        """(first, last, ground between them). Places that follow each other and lie alike in their pixels share one pattern of looks."""
        if not len(x):
            return
        size = max(1, SAMPLES_AT_ONCE // (self.held(x, y) * len(self.azimuth)))
        phases = np.stack(self.surface.phase(x, y))
        starts = np.flatnonzero(np.append(True, (phases[:, 1:] != phases[:, :-1]).any(0)))
        runs = [(a, b) for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(x)], strict=True) if b - a >= 4]
        done = 0
        for start, end in [*runs, (len(x), len(x))]:
            for a in range(done, start, size):
                b = min(a + size, start)
                yield a, b, self.ground(x[a:b], y[a:b])
            if end > start:
                pattern = self.pattern(x[start:end], y[start:end])
            for a in range(start, end, size):
                b = min(a + size, end)
                yield a, b, self.ground_alike(x[a:b], y[a:b], *pattern)
            done = end

    def positions(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, ...]:
        """(index of the upper left of the four pixels under a look, distances from its row and column)."""
        s = self.surface
        row, col = (s.y0 - y) / s.gsd, (x - s.x0) / s.gsd
        row -= 0.5
        col -= 0.5
        top, left = np.floor(row), np.floor(col)
        row -= top
        col -= left
        for v, most in ((top, self.height), (left, self.width)):
            if not (v.min() >= -self.pad and v.max() <= most + self.pad - 2):  # looks from places off the surface
                np.fmin(v, most, out=v)
                np.maximum(v, -2, out=v)
        top *= self.stride
        top += left
        top += self.pad * (self.stride + 1)
        return top.astype(np.intp), row, col

    def blend(self, at: np.ndarray, row: np.ndarray, col: np.ndarray) -> np.ndarray:
        """What four pixels that have data say between them."""
        a, b, c, d = (self.elevation[k:].take(at) for k in (0, 1, self.stride, self.stride + 1))
        for p, q in ((a, b), (c, d)):
            q -= p
            q *= col
            p += q
        c -= a
        c *= row
        a += c
        return a

    def look(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Elevation at positions, as :meth:`Surface.at` has it; -inf where there is none."""
        at, row, col = self.positions(x, y)
        corners = self.corners.take(at)
        if not len(at) or corners.min() == 4:
            return self.blend(at, row, col)
        got, seen = np.full(len(at), -np.inf), np.flatnonzero(corners == 4)
        got[seen] = self.blend(at[seen], row[seen], col[seen])
        part = np.flatnonzero((corners > 0) & (corners < 4))
        at, fr, fc, total, weight = at[part], row[part], col[part], np.zeros(len(part)), np.zeros(len(part))
        for k, w in ((0, (1 - fr) * (1 - fc)), (1, (1 - fr) * fc), (self.stride, fr * (1 - fc)), (self.stride + 1, fr * fc)):
            value = self.elevation[k:].take(at)
            w = np.where(np.isfinite(value), w, 0.0)
            total += np.where(w > 0, value, 0.0) * w
            weight += w
        got[part] = np.where(weight > 0, total / np.where(weight > 0, weight, 1.0), -np.inf)
        return got

    def ground(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Elevation by point, radius and bearing; -inf where there is none."""
        held = self.held(x, y)
        east, north = x[:, None, None] + self.east[:held], y[:, None, None] + self.north[:held]
        got = self.look(east.ravel(), north.ravel()).reshape(east.shape)
        return got - self.drop[:held] if self.spec.earth_curvature else got

    def pattern(self, x: np.ndarray, y: np.ndarray) -> tuple:
        """The looks of the first of places that lie alike in their pixels: position of the place, and of its looks, and which of
        these are so close to a row or column of pixels that rounding decides on which side they are."""
        held = self.held(x, y)
        at, row, col = self.positions((x[0] + self.east[:held]).ravel(), (y[0] + self.north[:held]).ravel())
        return x[0], y[0], at, row, col, (np.abs(row - np.rint(row)) < 1e-6) | (np.abs(col - np.rint(col)) < 1e-6)

    def ground_alike(self, x: np.ndarray, y: np.ndarray, x1: float, y1: float, at: np.ndarray, row: np.ndarray, col: np.ndarray, close: np.ndarray) -> np.ndarray:
        """:meth:`ground` of places on the surface by a pattern; looks that lack some pixels are taken for themselves."""
        s, held = self.surface, self.held(x, y)
        n, shape = held * len(self.azimuth), (len(x), held, len(self.azimuth))
        row, col, close = row[:n], col[:n], close[:n]
        shift = np.rint((y1 - y) / s.gsd).astype(np.intp) * self.stride + np.rint((x - x1) / s.gsd).astype(np.intp)
        at = at[:n] + shift[:, None]
        corners = self.corners.take(at)
        if corners.min() == 4:
            got = self.blend(at, row, col)
        else:
            full = corners == 4
            if np.count_nonzero(full) > 0.4 * full.size:
                got = self.blend(at, row, col)
                np.copyto(got, -np.inf, where=~full)
            else:
                got, seen = np.full(full.size, -np.inf), np.flatnonzero(full)
                of = seen % n
                got[seen] = self.blend(at.ravel()[seen], row[of], col[of])
            got, odd = got.ravel(), np.flatnonzero(~full & ((corners > 0) | close))
            place, of = odd // n, odd % n
            got[odd] = self.look(x[place] + self.east.ravel()[of], y[place] + self.north.ravel()[of])
        got = got.reshape(shape)
        return got - self.drop[:held] if self.spec.earth_curvature else got

    def shares(self, ground: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """By point, the share of all samples that have data, and of those nearby."""
        known, near = ground > -np.inf, self.n_near // len(self.azimuth)
        share = np.array([np.count_nonzero(k) for k in known]) / self.n if self.n else np.zeros(len(known))
        return share, np.array([np.count_nonzero(k[:near]) for k in known]) / self.n_near if self.n_near else share

    def horizon(self, ground: np.ndarray, z: np.ndarray) -> np.ndarray:
        """By point, seen from the height z, and bearing: the greatest angle; arctan grows with the slope, so one a bearing does."""
        rise = ground - z[:, None, None]
        rise /= self.radius[: ground.shape[1], None]
        return np.degrees(np.arctan(rise.max(1)))

    def room(self, ground: np.ndarray) -> np.ndarray:
        """By point and bearing: how far the lowest needed ray from height 0 stays above ground; inf where nothing is known."""
        return (self.level[: ground.shape[1]] - ground).min(1)


def horizons(surface: Surface, x: np.ndarray, y: np.ndarray, z: np.ndarray, spec: SkySpec) -> tuple[np.ndarray, ...]:
    """(horizon by point and bearing, clearance likewise, share of samples with data, the same of those nearby)."""
    looks = _Looks(surface, spec)
    ground = looks.ground(x, y)
    return looks.horizon(ground, z), looks.room(ground) + z[:, None], *looks.shares(ground)


def obstruction(horizon: np.ndarray, azimuth: np.ndarray, spec: SkySpec) -> tuple[float, list[float]]:
    """(weighted percentage of the needed sky that is blocked, bearings that are blocked at all)."""
    span = max(1e-9, 90.0 - spec.min_elevation_deg)
    blocked, w = np.clip(np.minimum(horizon, 90.0) - spec.min_elevation_deg, 0.0, span) / span, weights(azimuth, spec)
    pct = 100.0 * float((w * blocked).sum()) / float(w.sum()) if w.sum() > 0 else 0.0
    return pct, [round(float(a), 1) for a in azimuth[(w > 0) & (blocked > 1e-6)]]


def tier_of(pct: float | None, spec: SkySpec) -> str:
    if pct is None:
        return "undetermined"
    return "clear" if pct <= spec.band_clear_max_pct else "at_risk" if pct < spec.band_severe_min_pct else "severe"


def confidence_of(provenance: str | None, near: float, clearance: float | None, surface_confidence: str | None, spec: SkySpec) -> str:
    base = BASE_CONFIDENCE.get(provenance) or (surface_confidence if surface_confidence in sky.LEVELS else "medium")
    level = sky.LEVELS.index(base) - (2 if near < spec.conf_near_sampled_med else 1 if near < spec.conf_near_sampled_high else 0)
    level -= clearance is not None and abs(clearance) < spec.sigma_h_m
    return sky.LEVELS[max(0, min(2, level))]


def _distinct(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of one row of each kind, by the columns' order; the kind of every row)."""
    order = np.lexsort(columns[::-1])
    new = np.ones(len(order), bool)
    new[1:] = np.any([c[order[1:]] != c[order[:-1]] for c in columns], axis=0)
    kind = np.empty(len(order), np.intp)
    kind[order] = np.cumsum(new) - 1
    return order[new], kind


def _measured(surface: Surface, x: np.ndarray, y: np.ndarray, at: np.ndarray, mount: np.ndarray, spec: SkySpec, bearings_too: bool = True) -> dict[str, np.ndarray | list]:
    """What is seen from heights over places, which are all on the surface: ``mount`` over the place of index ``at``, ascending.

    By place: ground, sampled, near. By height: pct, clearance (NaN: no data), max_horizon, mean_horizon, blocked.
    """
    looks, n = _Looks(surface, spec), len(mount)
    w, span = weights(looks.azimuth, spec), max(1e-9, 90.0 - spec.min_elevation_deg)
    cone, total, names = w > 0, w.sum(), np.array([round(float(a), 1) for a in looks.azimuth])
    ground, (sampled, near), (pct, clearance, most, mean), blocked = surface.at(x, y), np.zeros((2, len(x))), np.zeros((4, n)), []
    for a, b, g in looks.batches(x, y):
        sampled[a:b], near[a:b] = looks.shares(g)
        room = looks.room(g)[:, cone].min(1, initial=np.inf)
        first, last = np.searchsorted(at, (a, b))
        for i in range(first, last, b - a):
            k = slice(i, min(i + b - a, last))
            p = at[k]
            z = ground[p] + mount[k]
            horizon = looks.horizon(g if len(p) == b - a and np.array_equal(p, np.arange(a, b)) else g[p - a], z)
            hidden = np.clip(np.minimum(horizon, 90.0) - spec.min_elevation_deg, 0.0, span) / span
            pct[k] = 100.0 * (w * hidden).sum(1) / total if total > 0 else 0.0
            clearance[k] = np.where(np.isfinite(room[p - a]), room[p - a] + z, np.nan)
            most[k], mean[k] = horizon.max(1), horizon.mean(1)
            if bearings_too:
                blocked += [names[v].tolist() for v in cone & (hidden > 1e-6)]
    return {"ground": ground, "sampled": sampled, "near": near, "pct": pct, "clearance": clearance, "max_horizon": most, "mean_horizon": mean, "blocked": blocked}


def _rounded(values: np.ndarray, digits: int) -> list[float | None]:
    return [round(v, digits) if v == v else None for v in values.tolist()]


def score_block(surface: Surface, x: np.ndarray, y: np.ndarray, mount: np.ndarray, spec: SkySpec, surface_confidence: str | None = None) -> list[dict]:
    """A finding for each point: scored on the surface, or undetermined where there is none under it.

    Points at one place and height are scored once, and points at one place share what is seen from there.
    """
    on = np.flatnonzero(np.isfinite(surface.at(x, y)))
    one, kind = _distinct(*surface.phase(x[on], y[on]), x[on], y[on], mount[on])
    x, y, heights = x[on][one], y[on][one], mount[on][one]
    place, at = _distinct(*surface.phase(x, y), x, y)
    x, y = x[place], y[place]
    m = _measured(surface, x, y, at, heights, spec)
    provenance = [surface.provenance_at(*p) for p in zip(x.tolist(), y.tolist(), strict=True)]
    sampled, near, ground = _rounded(m["sampled"], 4), _rounded(m["near"], 4), _rounded(m["ground"], 2)
    found = []
    for p, pct, free, high, mean, blocked in zip(at.tolist(), _rounded(m["pct"], 2), _rounded(m["clearance"], 2), _rounded(m["max_horizon"], 2), _rounded(m["mean_horizon"], 2), m["blocked"], strict=True):
        found.append({"obstruction_pct": pct, "risk_tier": tier_of(pct, spec), "confidence": confidence_of(provenance[p], near[p], free, surface_confidence, spec), "surface_provenance": provenance[p], "clearance_margin_m": free, "sampled_fraction": sampled[p], "near_sampled_fraction": near[p], "blocked_azimuths": blocked, "max_horizon_deg": high, "mean_horizon_deg": mean, "z_surface_m": ground[p]})
    out = [{"obstruction_pct": None, "risk_tier": "undetermined", "confidence": "low", "surface_provenance": None, "clearance_margin_m": None, "sampled_fraction": None, "near_sampled_fraction": 0.0, "blocked_azimuths": [], "max_horizon_deg": None, "mean_horizon_deg": None, "z_surface_m": None}] * len(mount)
    for i, k in zip(on.tolist(), kind.tolist(), strict=True):
        out[i] = found[k]
    return out


_FINDING = pa.schema([("location_id", pa.string()), ("tile_id", pa.string()), ("dish_height_m", pa.float64()), ("obstruction_pct", pa.float64()), ("risk_tier", pa.string()), ("confidence", pa.string()), ("surface_provenance", pa.string()), ("clearance_margin_m", pa.float64()), ("sampled_fraction", pa.float64()), ("near_sampled_fraction", pa.float64()), ("blocked_azimuths", pa.list_(pa.float64())), ("max_horizon_deg", pa.float64()), ("mean_horizon_deg", pa.float64()), ("z_surface_m", pa.float64()), ("spec_version", pa.string()), ("error", pa.string())])
_FINDING_DDL = "location_id string, tile_id string, dish_height_m double, obstruction_pct double, risk_tier string, confidence string, surface_provenance string, clearance_margin_m double, sampled_fraction double, near_sampled_fraction double, blocked_azimuths array<double>, max_horizon_deg double, mean_horizon_deg double, z_surface_m double, spec_version string, error string"


def _held(row: dict) -> Surface:
    """The surface of a packed row."""
    shape = row["height"], row["width"]
    codes = np.frombuffer(row["provenance"], np.int8).reshape(shape) if row["provenance"] else None
    return Surface(np.frombuffer(row["elevation"], np.float32).reshape(shape), codes, row["x0"], row["y0"], row["gsd_m"])


def _numbers(table: pa.Table, *names: str) -> list[np.ndarray]:
    return [np.array(table.column(n).to_numpy(), float) for n in names]


def _by_share(points: DataFrame, copies: DataFrame, f: Callable[[pa.Table, pa.Table], pa.Table], ddl: str) -> DataFrame:
    """``f`` over the points of a tile's share and the surface that is copied to it.

    Rows are few bytes and much work: a stated number of partitions keeps them from being merged by size, which would leave most
    cores idle.
    """
    spark, key = points.sparkSession, ("tile_id", "share")
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 16 * spark.sparkContext.defaultParallelism)
    copies = copies.withColumns({c: F.lit(None).cast(kind) for c, kind in (("confidence", "string"), ("epsg", "int")) if c not in copies.columns})
    wanted = copies.select(*key, "height", "width", "x0", "y0", "gsd_m", "epsg", "elevation", "provenance", "confidence")
    return points.repartition(n, *key).groupBy(*key).cogroup(wanted.repartition(n, *key).groupBy(*key)).applyInArrow(f, ddl)


def score(points: DataFrame, surfaces: DataFrame, spec: SkySpec = SkySpec()) -> DataFrame:
    """A finding for every point (location_id, tile_id, x, y, dish_height_m; or longitude, latitude in place of x, y).

    Points are dealt by tile and, in dense tiles, by a share of ``POINTS_PER_GROUP``, to which the tile's packed surface is
    copied; so no task holds more than one surface and one share. A surface that can't be read gives findings with an
    ``error`` and no score, and the others go on. Points of tiles without a surface, and points without a tile, are
    undetermined.
    """
    if "x" not in points.columns:
        zones = surfaces.select("tile_id", F.col("epsg").alias("_epsg"))
        points = points.join(zones, "tile_id", "left")
        east, north = geo.utm_forward(F.col("longitude"), F.col("latitude"), F.col("_epsg"))
        points = points.withColumn("x", east).withColumn("y", north)
    height = F.col("dish_height_m").cast("double") if "dish_height_m" in points.columns else F.lit(spec.mount_heights_m[0])
    points = points.select(F.col("location_id").cast("string").alias("location_id"), F.col("tile_id").cast("string").alias("tile_id"), "x", "y", F.coalesce(height, F.lit(spec.mount_heights_m[0])).alias("mount"))
    shares = points.groupBy(F.col("tile_id").alias("_tile")).agg(F.ceil(F.count("*") / POINTS_PER_GROUP).cast("int").alias("shares"))
    # points at one place meet in one share, where they are scored once
    points = points.join(shares, F.col("tile_id").eqNullSafe(F.col("_tile"))).withColumn("share", F.pmod(F.xxhash64("x", "y", "mount"), F.col("shares")).cast("int")).drop("shares", "_tile")
    copies = surfaces.withColumn("tile_id", F.col("tile_id").cast("string")).join(shares.withColumnRenamed("_tile", "tile_id"), "tile_id").withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1))).drop("shares")

    def run(some: pa.Table, held: pa.Table) -> pa.Table:
        x, y, mount = _numbers(some, "x", "y", "mount")
        error, rows = None, None
        if held.num_rows:
            s = held.slice(0, 1).to_pylist()[0]
            try:
                rows = score_block(_held(s), x, y, mount, spec, s["confidence"])
            except (ValueError, TypeError) as e:
                error = f"{type(e).__name__}: {e}"[:200]
        if rows is None:
            rows = [{"obstruction_pct": None, "risk_tier": "undetermined", "confidence": "low", "near_sampled_fraction": 0.0, "blocked_azimuths": []}] * len(x)
        ids, tiles = some.column("location_id").to_pylist(), some.column("tile_id").to_pylist()
        return pa.Table.from_pylist([{"location_id": i, "tile_id": t, "dish_height_m": m, "spec_version": spec.spec_version, "error": error, **r} for i, t, m, r in zip(ids, tiles, mount.tolist(), rows, strict=True)], schema=_FINDING)

    return _by_share(points, copies, run, _FINDING_DDL)


def sweep(points: DataFrame, spec: SkySpec = SkySpec()) -> DataFrame:
    """Every point at every mount height."""
    return points.withColumn("dish_height_m", F.explode(F.array(*map(F.lit, spec.mount_heights_m))))


def lowest_mount(findings: DataFrame) -> DataFrame:
    """One finding a location: that of the lowest mount, the first by ``ord`` among equals.

    A first finding without a height stays, and one without a height never replaces another.
    """
    w = Window.partitionBy("location_id")
    first_has = F.first("dish_height_m").over(w.orderBy("ord")).isNotNull()
    rank = F.when(first_has, F.coalesce("dish_height_m", F.lit(float("inf")))).otherwise(F.lit(0.0))
    d = findings.withColumn("_rank", rank).withColumn("_k", F.row_number().over(w.orderBy("_rank", "ord")))
    return d.where("_k = 1").drop("_rank", "_k")


def candidates(sites: DataFrame, buffer_m: float = 50.0, grid_m: float = 10.0, heights: tuple[float, ...] = (0.0, 0.3, 0.6)) -> DataFrame:
    """Places to try around each site (location_id, x, y): a grid within the buffer at every height, as points to score."""
    steps = int(2 * buffer_m // grid_m)
    offsets = F.transform(F.sequence(F.lit(0), F.lit(steps)), lambda k: F.lit(-float(buffer_m)) + k * F.lit(float(grid_m)))
    d = sites.withColumn("dx", F.explode(offsets)).withColumn("dy", F.explode(offsets)).where(F.col("dx") * F.col("dx") + F.col("dy") * F.col("dy") <= buffer_m * buffer_m + 1e-9)
    return d.withColumn("dish_height_m", F.explode(F.array(*map(F.lit, map(float, heights)))))


def best_spots(tried: DataFrame, limit: int = 10) -> DataFrame:
    """The best candidates of each site, least obstructed and lowest first, with what they gain on the site itself.

    ``tried``: location_id, dx, dy, dish_height_m and obstruction_pct of each part's best candidates, or of all (null: none), with
    ``baseline_pct``, the site's own score, and ``n_candidates``, how many scores the row stands for.
    """
    site = Window.partitionBy("location_id")
    d = tried.withColumn("rank", F.row_number().over(site.orderBy(F.col("obstruction_pct").asc_nulls_last(), "dish_height_m", "dx", "dy")))
    d = d.withColumn("baseline_pct", F.max("baseline_pct").over(site)).withColumn("n_candidates", F.sum("n_candidates").over(site))
    return d.where((F.col("rank") <= limit) & F.col("obstruction_pct").isNotNull()).withColumn("improvement_pct", F.round(F.col("baseline_pct") - F.col("obstruction_pct"), 2))


_SPOT = pa.schema([("location_id", pa.string()), ("x", pa.float64()), ("y", pa.float64()), ("dx", pa.float64()), ("dy", pa.float64()), ("tile_id", pa.string()), ("dish_height_m", pa.float64()), ("obstruction_pct", pa.float64()), ("risk_tier", pa.string()), ("confidence", pa.string()), ("baseline_pct", pa.float64()), ("n_candidates", pa.int64()), ("epsg", pa.int32())])
_SPOT_DDL = "location_id string, x double, y double, dx double, dy double, tile_id string, dish_height_m double, obstruction_pct double, risk_tier string, confidence string, baseline_pct double, n_candidates long, epsg int"


def spots_block(surface: Surface, x: np.ndarray, y: np.ndarray, spec: SkySpec, buffer_m: float, grid_m: float, limit: int, surface_confidence: str | None = None) -> dict[str, np.ndarray | list]:
    """Columns of the best candidates of each site, ``site`` being its index; all candidates are scored, equal places once.

    A site's first row stands for all its candidates that have a score. A site with a score of its own and no candidate has a row
    without a score.
    """
    steps = -float(buffer_m) + np.arange(int(2 * buffer_m // grid_m) + 1) * float(grid_m)
    dx, dy = (v.ravel() for v in np.meshgrid(steps, steps, indexing="ij"))
    near = dx * dx + dy * dy <= buffer_m * buffer_m + 1e-9
    dx, dy, heights = np.append(dx[near], 0.0), np.append(dy[near], 0.0), np.sort(np.array(spec.mount_heights_m, float))  # the last place is the site's own
    px, py = (x[:, None] + dx).ravel(), (y[:, None] + dy).ravel()
    row, col = (surface.y0 - py) / surface.gsd, (px - surface.x0) / surface.gsd
    on = np.flatnonzero((row > -1) & (row < surface.elevation.shape[0] + 1) & (col > -1) & (col < surface.elevation.shape[1] + 1))
    one, kind = _distinct(*surface.phase(px[on], py[on]), px[on], py[on])
    one = on[one]
    known = np.isfinite(surface.at(px[one], py[one]))
    ux, uy, m, h = px[one][known], py[one][known], int(known.sum()), len(heights)
    seen = _measured(surface, ux, uy, np.arange(m).repeat(h), np.tile(heights, m), spec, bearings_too=False)
    pct = np.array(_rounded(seen["pct"], 2), float).reshape(m, h)
    # by site and place: the place's row among those scored, or m
    place = np.full(len(px), m)
    place[on] = np.where(known, np.cumsum(known) - 1, m)[kind]
    place = place.reshape(len(x), len(dx))
    baseline = np.append(pct[:, 0], np.nan)[place[:, -1]]
    place = place[:, :-1]
    # hundredths of a percentage, then the order by height, dx and dy, as one number
    n, none = place.shape[1] * h, np.int64(1) << 40
    keys = np.append(np.rint(pct * 100).astype(np.int64), np.full((1, h), none), axis=0)[place].transpose(0, 2, 1).reshape(len(x), n) * n + np.arange(n)
    count, k = (keys < none * n).sum(1), min(limit, n)
    best = np.sort(np.partition(keys, k - 1, axis=1)[:, :k], axis=1) if k else keys[:, :0]
    site, rank = np.nonzero((best < none * n) | ((np.arange(k) == 0) & (np.isfinite(baseline) & (count == 0))[:, None]))
    got, at = best[site, rank], best[site, rank] % n
    scored, height, offset = got < none * n, at // place.shape[1], at % place.shape[1]
    spot = np.where(scored, place[site, offset], 0) * h + height
    ways = {}
    for e in np.unique(spot[scored]).tolist():
        p, free = e // h, float(seen["clearance"][e])
        flag = confidence_of(surface.provenance_at(float(ux[p]), float(uy[p])), round(float(seen["near"][p]), 4), round(free, 2) if free == free else None, surface_confidence, spec)
        ways[e] = float(pct[p, e % h]), tier_of(float(pct[p, e % h]), spec), flag
    ways = [ways[e] if s else (None, None, None) for e, s in zip(spot.tolist(), scored.tolist(), strict=True)]
    score, tier, flag = zip(*ways, strict=True) if ways else ((), (), ())
    own = [None if v != v else v for v in baseline[site].tolist()]
    return {"site": site, "x": x[site] + dx[offset], "y": y[site] + dy[offset], "dx": dx[offset], "dy": dy[offset], "dish_height_m": heights[height], "obstruction_pct": score, "risk_tier": tier, "confidence": flag, "baseline_pct": own, "n_candidates": np.where(rank == 0, count[site], 0)}


def find_spots(sites: DataFrame, surfaces: DataFrame, spec: SkySpec = SkySpec(), buffer_m: float = 50.0, grid_m: float = 5.0, limit: int = 10) -> DataFrame:
    """Score all candidates around each site (location_id, tile_id, x, y), as :func:`candidates` names them, and rank them; with
    their positions in degrees.

    The site itself is scored at the lowest mount as a point of its own, whether or not the grid hits it. Sites are dealt by tile
    and, in dense tiles, by shares of ``SITES_PER_GROUP`` that lie together, as neighbours have candidates in common. A share makes
    its candidates, scores all of them and hands on the best of each site, so that candidates are never rows of a table.
    """
    strip = F.floor(F.col("y") / (10.0 * buffer_m)) if buffer_m > 0 else F.col("y")
    place = Window.partitionBy("tile_id").orderBy(strip, "x", "y")
    points = sites.select(F.col("location_id").cast("string").alias("location_id"), F.col("tile_id").cast("string").alias("tile_id"), F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
    points = points.where("tile_id is not null").withColumn("share", F.floor((F.row_number().over(place) - 1) / SITES_PER_GROUP).cast("int"))
    shares = points.groupBy("tile_id").agg((F.max("share") + 1).alias("shares"))
    copies = surfaces.withColumn("tile_id", F.col("tile_id").cast("string")).join(shares, "tile_id").withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1))).drop("shares")

    def run(some: pa.Table, held: pa.Table) -> pa.Table:
        if not (some.num_rows and held.num_rows):
            return _SPOT.empty_table()
        s = held.slice(0, 1).to_pylist()[0]
        try:
            got = spots_block(_held(s), *_numbers(some, "x", "y"), spec, buffer_m, grid_m, limit, s["confidence"])
        except (ValueError, TypeError):  # a surface that can't be read has no score to rank
            return _SPOT.empty_table()
        site = pa.array(got.pop("site"))
        got |= {c: some.column(c).take(site) for c in ("location_id", "tile_id")} | {"epsg": [s["epsg"]] * len(site)}
        return pa.table({f.name: pa.chunked_array(got[f.name].chunks, f.type) if isinstance(got[f.name], pa.ChunkedArray) else pa.array(got[f.name], f.type) for f in _SPOT}, schema=_SPOT)

    got = best_spots(_by_share(points, copies, run, _SPOT_DDL), limit)
    lon, lat = geo.utm_inverse(F.col("x"), F.col("y"), F.col("epsg"))
    return got.withColumn("lon", F.round(lon, 7)).withColumn("lat", F.round(lat, 7)).select("tile_id", "location_id", "x", "y", "dx", "dy", "dish_height_m", "obstruction_pct", "risk_tier", "confidence", "baseline_pct", "n_candidates", "rank", "improvement_pct", "lon", "lat")


def ray_samples(points: DataFrame, spec: SkySpec, gsd: float) -> DataFrame:
    """``point columns, azimuth, radius, weight, row_idx, col_idx``: the four pixels round every sample of every ray.

    ``points`` has x and y in metres from the upper left corner, y downward. Positions are rounded to a billionth of a pixel,
    so that engines agree on which pixels those are.
    """
    steps = int(spec.max_radius_m // max(1.0, gsd))
    d = points.withColumn("azimuth", F.explode(sky.azimuths(spec.azimuth_step_deg))).withColumn("radius", F.explode(F.transform(F.sequence(F.lit(1), F.lit(steps)), lambda k: k * F.lit(float(max(1.0, gsd))))))
    col = F.round((F.col("x") + F.col("radius") * F.sin(F.radians("azimuth"))) / gsd - 0.5, 9)
    row = F.round((F.col("y") - F.col("radius") * F.cos(F.radians("azimuth"))) / gsd - 0.5, 9)
    d = d.withColumn("_c", col).withColumn("_r", row).withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(3))))
    dc, dr = F.col("_k") % 2, F.floor(F.col("_k") / 2)
    fc, fr = F.col("_c") - F.floor("_c"), F.col("_r") - F.floor("_r")
    weight = F.when(dc == 1, fc).otherwise(1 - fc) * F.when(dr == 1, fr).otherwise(1 - fr)
    return d.withColumn("weight", weight).withColumn("row_idx", (F.floor("_r") + dr).cast("long")).withColumn("col_idx", (F.floor("_c") + dc).cast("long")).where("weight > 0").drop("_c", "_r", "_k")


def profile_of_pixels(points: DataFrame, surface: DataFrame, spec: SkySpec, gsd: float) -> DataFrame:
    """``location_id, azimuth, horizon_deg, clearance_m, n_known`` from joins: points (location_id, tile_id, x, y, z) on surface pixels."""
    pixels = surface.where("elevation is not null").select("tile_id", "row_idx", "col_idx", "elevation")
    d = ray_samples(points, spec, gsd).join(pixels, ["tile_id", "row_idx", "col_idx"])
    d = d.groupBy("location_id", "tile_id", "z", "azimuth", "radius").agg((F.sum(F.col("weight") * F.col("elevation")) / F.sum("weight")).alias("ground"))
    rise = F.col("ground") - F.col("z")
    tan = F.tan(F.radians(F.lit(max(1e-3, spec.min_elevation_deg))))
    return d.groupBy("location_id", "tile_id", "azimuth").agg(F.max(F.degrees(F.atan2(rise, F.col("radius")))).alias("horizon_deg"), F.min(F.col("radius") * tan - rise).alias("clearance_m"), F.count("*").alias("n_known"))


def obstruction_of_profile(profile: DataFrame, spec: SkySpec) -> DataFrame:
    """``location_id, obstruction_pct, risk_tier`` from horizons; bearings without data block nothing."""
    every = profile.sparkSession.range(1).select(F.explode(sky.azimuths(spec.azimuth_step_deg)).alias("azimuth")).select("azimuth", sky.azimuth_weight(F.col("azimuth"), spec).alias("w"))
    total = every.agg(F.sum("w")).first()[0]
    w = sky.azimuth_weight(F.col("azimuth"), spec)
    pct = F.round(100.0 * F.sum(w * sky.blocked_fraction(F.col("horizon_deg"), spec)) / F.lit(total), 2)
    d = profile.groupBy("location_id", "tile_id").agg(pct.alias("obstruction_pct"))
    return d.withColumn("risk_tier", sky.classify_tier(F.col("obstruction_pct"), spec))
