"""Grid cells by walking edges and filling rows: the same cells as testing each against every edge."""

import math
import random

import pytest

from pixelframe.operators import grid, regions

RING = "array<array<struct<x:double,y:double>>>"


def polygons(spark, shapes):
    rows = [(i, p, [[{"x": float(x), "y": float(y)} for x, y in ring] for ring in rings], 3857) for i, p, rings in shapes]
    return regions.with_geometry(spark.createDataFrame(rows, f"region_id long, part int, rings {RING}, srid int"))


def star(cx, cy, n, r, seed):
    rng = random.Random(seed)
    ring = [(cx + r * rng.uniform(0.2, 1) * math.cos(2 * math.pi * k / n), cy + r * rng.uniform(0.2, 1) * math.sin(2 * math.pi * k / n))
            for k in range(n)]
    return ring + ring[:1]


def box(x, y, w, h):
    return [(x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y)]


SHAPES = [
    (1, 0, [star(0, 0, 60, 900, 1)]), (1, 1, [star(5000, 100, 7, 300, 2)]), (2, 0, [star(-300, 40, 200, 700, 3)]),
    # a ring with a hole that has an island's notch, on the lattice: corners and sides touch the cells exactly
    (3, 0, [box(0, 0, 1000, 800), box(200, 200, 400, 300)]),
    (4, 0, [[(0, 0), (500, 0), (500, 500), (250, 250), (0, 500), (0, 0)]]),
    # a sliver, a diamond whose corners lie on cell corners, a zigzag of level edges, a figure that crosses itself
    (5, 0, [[(0, 0), (2000, 1), (2000, 2), (0, 0)]]), (6, 0, [[(0, 100), (100, 0), (200, 100), (100, 200), (0, 100)]]),
    (7, 0, [[(0, 0), (300, 0), (300, 100), (200, 100), (200, 200), (100, 200), (100, 300), (0, 300), (0, 0)]]),
    (8, 0, [[(0, 0), (600, 600), (600, 0), (0, 600), (0, 0)]]), (9, 0, [[(0, 0), (0, 10), (0, 20), (0, 0)]]),
]


def cells(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("size,overlap", [(100.0, 0.0), (100.0, 50.0), (70.0, 13.0), (100.0, 90.0), (3000.0, 10.0)])
def test_walked_cells_equal_tested_cells(spark, monkeypatch, size, overlap):
    reg = polygons(spark, SHAPES)
    monkeypatch.setattr(grid, "SPREAD_WORK_LIMIT", 10 ** 12)
    want = cells(grid.grid_cells(reg, size, overlap))
    monkeypatch.setattr(grid, "SPREAD_WORK_LIMIT", -1)
    got = cells(grid.grid_cells(reg.repartition(3), size, overlap))
    assert got == want and len({r[0] for r in got}) == len(got)


def test_many_random_polygons(spark, monkeypatch):
    shapes = [(i, 0, [star(i * 37.5, -i * 11.25, 3 + i % 40, 20 + i * 3, i)]) for i in range(120)]
    reg = polygons(spark, shapes)
    monkeypatch.setattr(grid, "SPREAD_WORK_LIMIT", 10 ** 12)
    want = cells(grid.grid_cells(reg, 16.0, 3.0))
    monkeypatch.setattr(grid, "SPREAD_WORK_LIMIT", -1)
    assert cells(grid.grid_cells(reg, 16.0, 3.0)) == want


def test_work_follows_perimeter_and_output(spark):
    """A polygon of 4,000 edges over 250,000 cells: a billion tests in place, some ten thousand cells walked."""
    n = 4000
    ring = [(1000 * math.cos(2 * math.pi * k / n), 1000 * math.sin(2 * math.pi * k / n)) for k in range(n)]
    reg = polygons(spark, [(1, 0, [ring + ring[:1]])])
    out = grid.grid_cells(reg, 4.0, 0.0)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "NestedLoop" not in plan
    got = {(r["ix"], r["iy"]) for r in out.select("ix", "iy").collect()}
    lower = lambda i: -1000 + 4 * i
    near = lambda i: min(abs(lower(i)), abs(lower(i) + 4)) if lower(i) * (lower(i) + 4) > 0 else 0
    far = lambda i: max(abs(lower(i)), abs(lower(i) + 4))
    for ix in range(0, 500, 3):
        for iy in range(0, 500, 3):
            if math.hypot(far(ix), far(iy)) < 999:
                assert (ix, iy) in got
            elif math.hypot(near(ix), near(iy)) > 1001:
                assert (ix, iy) not in got
    assert abs(len(got) * 16 - math.pi * 1e6) < 40_000


def test_empty_table(spark):
    assert grid.walked_cells(polygons(spark, SHAPES).limit(0), 10.0, 10.0).count() == 0


def test_ordinary_regions_are_tested_where_they_stand(spark, monkeypatch):
    """Many small regions send no cell and no edge through a shuffle, only themselves; a large one among them walks."""
    shapes = [(i, 0, [star(i * 37.5, -i * 11.25, 5 + i % 9, 40, i)]) for i in range(300)] + [(1000, 0, [star(0, 0, 90, 900, 7)])]
    reg = polygons(spark, shapes)
    monkeypatch.setattr(grid, "SPREAD_WORK_LIMIT", 10 ** 12)
    want = cells(grid.grid_cells(reg, 16.0, 3.0))
    monkeypatch.setattr(grid, "SPREAD_WORK_LIMIT", 20_000)
    assert cells(grid.grid_cells(reg, 16.0, 3.0)) == want
    monkeypatch.setattr(grid, "PASS_TESTS", 50)
    small = reg.where("region_id < 1000")
    plan = grid.grid_cells(small, 16.0, 3.0)
    assert plan._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert cells(plan) == [c for c in want if c[1] < 1000]
