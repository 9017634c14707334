"""Geometry as Spark column expressions.

A polygon is held as ``rings: array<array<struct<x,y>>>`` (ring 0 = outer, others = holes) and
``edges: array<struct<x1,y1,x2,y2>>`` — every ring's closed edge list flattened together.  The even-odd
rule over all edges treats holes correctly, so no ring bookkeeping is needed for point tests.

Everything here is a built-in higher-order / math expression evaluated in the JVM — no Python on the
executors.  Higher-order lambdas are interpreted inside their codegen stage, so callers keep the
number of (row × edge) evaluations small: per-bin edge filtering in the spatial join, short-circuit
order in the predicates.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# WGS84 / Web-Mercator / UTM constants (EPSG:4326, EPSG:3857, UTM zones).
EARTH_RADIUS_M = 6378137.0
WGS84_A = 6378137.0
WGS84_F = 1.0 / 298.257223563
UTM_K0 = 0.9996
UTM_FALSE_EASTING = 500000.0
UTM_FALSE_NORTHING_SOUTH = 10000000.0


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------------------------------------
# Building geometry columns
# ---------------------------------------------------------------------------------------------

def ring_from_coords(coords: Column) -> Column:
    """``array<array<double>>`` GeoJSON ring → closed ``array<struct<x,y>>``."""
    pts = F.transform(coords, lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))
    first = F.element_at(pts, 1)
    last = F.element_at(pts, -1)
    closed = (first["x"] == last["x"]) & (first["y"] == last["y"])
    return F.when(F.size(pts) == 0, pts).when(closed, pts).otherwise(F.concat(pts, F.array(first)))


def ring_edges(ring: Column) -> Column:
    """Closed ring ``array<struct<x,y>>`` → ``array<struct<x1,y1,x2,y2>>``."""
    return F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(ring) - 2, F.lit(-1)), F.lit(1)),
        lambda i: F.struct(
            ring[i]["x"].alias("x1"), ring[i]["y"].alias("y1"),
            ring[i + 1]["x"].alias("x2"), ring[i + 1]["y"].alias("y2"),
        ),
    )


def polygon_edges(rings: Column | str) -> Column:
    """All rings' edges flattened (outer ring and holes together)."""
    rings = _c(rings)
    return F.flatten(F.transform(rings, ring_edges))


def box_ring(minx: Column, miny: Column, maxx: Column, maxy: Column) -> Column:
    """Counter-clockwise closed ring of an axis-aligned box."""
    def p(x, y):
        return F.struct(x.alias("x"), y.alias("y"))
    return F.array(p(minx, miny), p(maxx, miny), p(maxx, maxy), p(minx, maxy), p(minx, miny))


# ---------------------------------------------------------------------------------------------
# Measures
# ---------------------------------------------------------------------------------------------

def ring_signed_area(ring: Column) -> Column:
    """Shoelace over one closed ring (positive when counter-clockwise)."""
    e = ring_edges(ring)
    return F.aggregate(e, F.lit(0.0), lambda acc, s: acc + (s["x1"] * s["y2"] - s["x2"] * s["y1"])) / 2.0


def polygon_area(rings: Column | str) -> Column:
    """Planar area: |outer| − Σ|holes| in the units of the coordinates."""
    rings = _c(rings)
    outer = F.abs(ring_signed_area(F.element_at(rings, 1)))
    holes = F.aggregate(
        F.slice(rings, 2, F.greatest(F.size(rings) - 1, F.lit(0))),
        F.lit(0.0),
        lambda acc, r: acc + F.abs(ring_signed_area(r)),
    )
    return outer - holes


def edges_bounds(edges: Column | str) -> dict[str, Column]:
    """Bounds of an edge list."""
    e = _c(edges)
    return {
        "minx": F.array_min(F.transform(e, lambda s: F.least(s["x1"], s["x2"]))),
        "miny": F.array_min(F.transform(e, lambda s: F.least(s["y1"], s["y2"]))),
        "maxx": F.array_max(F.transform(e, lambda s: F.greatest(s["x1"], s["x2"]))),
        "maxy": F.array_max(F.transform(e, lambda s: F.greatest(s["y1"], s["y2"]))),
    }


# ---------------------------------------------------------------------------------------------
# Predicates
# ---------------------------------------------------------------------------------------------

def edge_crosses_ray(e: Column, px: Column, py: Column) -> Column:
    """Half-open even-odd test: does the rightward ray from (px, py) cross edge ``e``?

    Written without division — ``x_int > px`` ⇔ ``cross·(y2−y1) > 0`` — so a horizontal edge can never
    raise under ANSI mode and the same arithmetic runs in any SQL engine.
    """
    straddles = (e["y1"] > py) != (e["y2"] > py)
    cross = (e["x2"] - e["x1"]) * (py - e["y1"]) - (px - e["x1"]) * (e["y2"] - e["y1"])
    return straddles & (cross * (e["y2"] - e["y1"]) > 0)


def point_in_polygon(edges: Column | str, px: Column | str, py: Column | str) -> Column:
    """Pixel centre strictly/half-open inside the polygon by the even-odd rule (P4 residual)."""
    edges, px, py = _c(edges), _c(px), _c(py)
    return F.aggregate(edges, F.lit(False), lambda acc, e: acc != edge_crosses_ray(e, px, py))


def segment_intersects_box(e: Column, bx0: Column, by0: Column, bx1: Column, by1: Column) -> Column:
    """Closed segment–box test by separating axes (box axes + segment normal); touching counts."""
    bbox_overlap = (
        (F.least(e["x1"], e["x2"]) <= bx1) & (F.greatest(e["x1"], e["x2"]) >= bx0)
        & (F.least(e["y1"], e["y2"]) <= by1) & (F.greatest(e["y1"], e["y2"]) >= by0)
    )

    def side(cx, cy):
        return (e["x2"] - e["x1"]) * (cy - e["y1"]) - (e["y2"] - e["y1"]) * (cx - e["x1"])

    s = [side(bx0, by0), side(bx1, by0), side(bx1, by1), side(bx0, by1)]
    # the segment's line separates the box only when all four corners lie strictly on one side
    return bbox_overlap & (F.least(*s) <= 0) & (F.greatest(*s) >= 0)


def box_intersects_polygon(edges: Column | str, bx0: Column, by0: Column, bx1: Column, by1: Column) -> Column:
    """Box ∩ polygon ≠ ∅ (G7): an edge meets the box, or the box lies inside the polygon."""
    edges = _c(edges)
    any_edge = F.exists(edges, lambda e: segment_intersects_box(e, bx0, by0, bx1, by1))
    centre_in = point_in_polygon(edges, (bx0 + bx1) / 2.0, (by0 + by1) / 2.0)
    return any_edge | centre_in


# ---------------------------------------------------------------------------------------------
# CRS: EPSG:4326 ⇄ EPSG:3857 (G2), and UTM
# ---------------------------------------------------------------------------------------------

def lonlat_to_mercator(lon: Column | str, lat: Column | str) -> tuple[Column, Column]:
    lon, lat = _c(lon), _c(lat)
    x = F.lit(EARTH_RADIUS_M) * F.radians(lon)
    y = F.lit(EARTH_RADIUS_M) * F.log(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2.0))
    return x, y


def mercator_to_lonlat(x: Column | str, y: Column | str) -> tuple[Column, Column]:
    x, y = _c(x), _c(y)
    lon = F.degrees(x / F.lit(EARTH_RADIUS_M))
    lat = F.degrees(F.lit(2.0) * F.atan(F.exp(y / F.lit(EARTH_RADIUS_M))) - F.lit(math.pi / 2))
    return lon, lat


def transform_edges(edges: Column | str, fn) -> Column:
    """Apply a point transform ``fn(x, y) -> (x', y')`` to every edge end."""
    def tr(e):
        x1, y1 = fn(e["x1"], e["y1"])
        x2, y2 = fn(e["x2"], e["y2"])
        return F.struct(x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"))
    return F.transform(_c(edges), tr)


def transform_rings(rings: Column | str, fn) -> Column:
    def tp(p):
        x, y = fn(p["x"], p["y"])
        return F.struct(x.alias("x"), y.alias("y"))
    return F.transform(_c(rings), lambda r: F.transform(r, tp))


def _utm_series():
    n = WGS84_F / (2.0 - WGS84_F)
    big_a = WGS84_A / (1.0 + n) * (1.0 + n ** 2 / 4.0 + n ** 4 / 64.0)
    alpha = [n / 2 - 2 * n ** 2 / 3 + 5 * n ** 3 / 16, 13 * n ** 2 / 48 - 3 * n ** 3 / 5, 61 * n ** 3 / 240]
    beta = [n / 2 - 2 * n ** 2 / 3 + 37 * n ** 3 / 96, n ** 2 / 48 + n ** 3 / 15, 17 * n ** 3 / 480]
    delta = [2 * n - 2 * n ** 2 / 3 - 2 * n ** 3, 7 * n ** 2 / 3 - 8 * n ** 3 / 5, 56 * n ** 3 / 15]
    return n, big_a, alpha, beta, delta


def utm_zone_of(lon: Column | str) -> Column:
    return (F.floor((_c(lon) + 180.0) / 6.0) % 60 + 1).cast("int")


def lonlat_to_utm(lon: Column | str, lat: Column | str, zone: int, south: bool = False) -> tuple[Column, Column]:
    """Transverse Mercator by the Krüger n-series (3rd order, sub-millimetre inside a zone)."""
    return lonlat_to_utm_zone(lon, lat, F.lit(int(zone)), F.lit(bool(south)))


def lonlat_to_utm_zone(lon: Column | str, lat: Column | str, zone: Column, south: Column) -> tuple[Column, Column]:
    """The same with zone and hemisphere by row."""
    lon, lat = _c(lon), _c(lat)
    n, big_a, alpha, _, _ = _utm_series()
    lon0 = F.radians((zone - 1) * 6.0 - 177.0)
    c = 2.0 * math.sqrt(n) / (1.0 + n)
    phi = F.radians(lat)
    dlam = F.radians(lon) - lon0
    t = F.sinh(F.atanh(F.sin(phi)) - F.lit(c) * F.atanh(F.lit(c) * F.sin(phi)))
    xi_p = F.atan(t / F.cos(dlam))
    eta_p = F.atanh(F.sin(dlam) / F.sqrt(F.lit(1.0) + t * t))
    e_sum = eta_p
    n_sum = xi_p
    for j, a in enumerate(alpha, start=1):
        e_sum = e_sum + F.lit(a) * F.cos(2 * j * xi_p) * F.sinh(2 * j * eta_p)
        n_sum = n_sum + F.lit(a) * F.sin(2 * j * xi_p) * F.cosh(2 * j * eta_p)
    easting = F.lit(UTM_FALSE_EASTING) + F.lit(UTM_K0 * big_a) * e_sum
    northing = F.when(south, F.lit(UTM_FALSE_NORTHING_SOUTH)).otherwise(0.0) + F.lit(UTM_K0 * big_a) * n_sum
    return easting, northing


def utm_to_lonlat(easting: Column | str, northing: Column | str, zone: int, south: bool = False) -> tuple[Column, Column]:
    easting, northing = _c(easting), _c(northing)
    n, big_a, _, beta, delta = _utm_series()
    lon0 = math.radians((zone - 1) * 6 - 180 + 3)
    n0 = UTM_FALSE_NORTHING_SOUTH if south else 0.0
    xi = (northing - F.lit(n0)) / F.lit(UTM_K0 * big_a)
    eta = (easting - F.lit(UTM_FALSE_EASTING)) / F.lit(UTM_K0 * big_a)
    xi_p = xi
    eta_p = eta
    for j, b in enumerate(beta, start=1):
        xi_p = xi_p - F.lit(b) * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        eta_p = eta_p - F.lit(b) * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    chi = F.asin(F.sin(xi_p) / F.cosh(eta_p))
    phi = chi
    for j, d in enumerate(delta, start=1):
        phi = phi + F.lit(d) * F.sin(2 * j * chi)
    lam = F.lit(lon0) + F.atan(F.sinh(eta_p) / F.cos(xi_p))
    return F.degrees(lam), F.degrees(phi)
