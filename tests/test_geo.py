import math

from pyspark.sql import functions as F

from pixelframe.functions import geo
from pixelframe.operators import grid as G
from pixelframe.operators.regions import area, with_geometry


def _poly(spark, rings, rid=1):
    df = spark.createDataFrame([(rid, 0, [[{"x": float(x), "y": float(y)} for x, y in r] for r in rings], 3857)],
                               "region_id bigint, part int, rings array<array<struct<x:double,y:double>>>, srid int")
    return with_geometry(df)


SQUARE = [(0, 0), (10, 0), (10, 10), (0, 10), (0, 0)]
HOLE = [(2, 2), (2, 4), (4, 4), (4, 2), (2, 2)]


def test_area_square_and_hole(spark):
    assert area(_poly(spark, [SQUARE])).first()["area"] == 100.0
    assert area(_poly(spark, [SQUARE, HOLE])).first()["area"] == 96.0


def test_bounds(spark):
    r = _poly(spark, [SQUARE]).first()
    assert (r["minx"], r["miny"], r["maxx"], r["maxy"]) == (0.0, 0.0, 10.0, 10.0)


def test_point_in_polygon_half_open_and_hole(spark):
    p = _poly(spark, [SQUARE, HOLE])
    pts = spark.createDataFrame([(5.0, 5.0), (3.0, 3.0), (0.0, 5.0), (10.0, 5.0), (5.0, 0.0), (5.0, 10.0), (11.0, 5.0)],
                                "px double, py double")
    res = {(r.px, r.py): r.inside for r in pts.crossJoin(p).select(
        "px", "py", geo.point_in_polygon("edges", F.col("px"), F.col("py")).alias("inside")).collect()}
    assert res[(5.0, 5.0)] is True
    assert res[(3.0, 3.0)] is False          # in the hole
    assert res[(0.0, 5.0)] is True           # left border belongs to the box (x0 <= x < x1)
    assert res[(10.0, 5.0)] is False         # right border does not
    assert res[(5.0, 0.0)] is True           # bottom border belongs (y0 <= y < y1)
    assert res[(5.0, 10.0)] is False
    assert res[(11.0, 5.0)] is False


def test_mercator_known_points(spark):
    df = spark.createDataFrame([(0.0, 0.0), (180.0, 0.0), (0.0, 45.0)], "lon double, lat double")
    x, y = geo.lonlat_to_mercator("lon", "lat")
    rows = df.select(x.alias("x"), y.alias("y")).collect()
    assert abs(rows[0].x) < 1e-9 and abs(rows[0].y) < 1e-9
    assert abs(rows[1].x - 20037508.342789244) < 1e-6
    assert abs(rows[2].y - 5621521.486192066) < 1e-3


def test_utm_known_point_and_roundtrip(spark):
    # central meridian of zone 43 (75°E) on the equator → (500000, 0)
    df = spark.createDataFrame([(75.0, 0.0), (73.1, 24.06), (77.9, 48.5)], "lon double, lat double")
    e, n = geo.lonlat_to_utm("lon", "lat", zone=43)
    u = df.select("lon", "lat", e.alias("e"), n.alias("n"))
    lon, lat = geo.utm_to_lonlat("e", "n", zone=43)
    rows = u.select("lon", "lat", "e", "n", lon.alias("lon2"), lat.alias("lat2")).collect()
    assert abs(rows[0].e - 500000.0) < 1e-6 and abs(rows[0].n) < 1e-6
    for r in rows:
        # round trip under a millimetre (1e-8 degrees ≈ 1 mm)
        assert abs(r.lon - r.lon2) < 1e-8 and abs(r.lat - r.lat2) < 1e-8
    # scale factor 0.9996 on the central meridian: 1 degree of latitude ≈ 110574 m · 0.9996
    assert abs(rows[0].n) < 1e-6


def test_grid_counts_probe(spark):
    # 12000 × 9000 bounds, size 5000, overlap 500 → ceil(12000/4500)=3 × ceil(9000/4500)=2 = 6 cells
    r = _poly(spark, [[(0, 0), (12000, 0), (12000, 9000), (0, 9000), (0, 0)]])
    assert G.grid_cells(r, 5000.0, 500.0).count() == 6


def test_grid_zero_width_and_bad_overlap(spark):
    import pytest
    r = _poly(spark, [[(0, 0), (0, 10), (0, 20), (0, 0)]])
    assert G.grid_cells(r, 5000.0, 500.0, keep_intersecting=False).count() == 0
    with pytest.raises(ValueError):
        G.grid_cells(r, 100.0, 100.0)


def test_segment_touching_box_counts(spark):
    df = spark.createDataFrame([(0.0, 0.0, 10.0, 0.0)], "x1 double, y1 double, x2 double, y2 double")
    e = F.struct("x1", "y1", "x2", "y2")
    touch = df.select(geo.segment_intersects_box(e, F.lit(5.0), F.lit(0.0), F.lit(6.0), F.lit(1.0)).alias("t")).first().t
    miss = df.select(geo.segment_intersects_box(e, F.lit(5.0), F.lit(0.1), F.lit(6.0), F.lit(1.0)).alias("t")).first().t
    assert touch is True and miss is False


def test_area_branch_strict(spark):
    # area exactly at the threshold stays whole; above it is gridded
    r_at = _poly(spark, [[(0, 0), (100, 0), (100, 100), (0, 100), (0, 0)]])
    out = G.add_grids_if_needed(r_at, min_area=10000.0, grid_size=50.0, grid_overlap=10.0)
    assert out.count() == 1 and out.first().ix == -1
    out2 = G.add_grids_if_needed(r_at, min_area=9999.0, grid_size=50.0, grid_overlap=10.0)
    assert out2.count() == 9 and math.isclose(out2.agg(F.min("ix")).first()[0], 0)
