"""Hierarchical covers: the rows of the ray cast over the whole polygon, cells in proportion to the perimeter."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pixelframe.operators import cover, spatial
from pixelframe.session import scratch_path

from test_grid_walk import SHAPES, box, polygons, star


def brute(points, shapes):
    """``{(point, region, part)}`` by the even-odd ray over every edge."""
    out, px, py = set(), points[:, 0], points[:, 1]
    for rid, part, rings in shapes:
        odd = np.zeros(len(points), bool)
        for ring in rings:
            ring = ring if ring[0] == ring[-1] else [*ring, ring[0]]
            for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
                odd ^= ((y1 > py) != (y2 > py)) & (((x2 - x1) * (py - y1) - (px - x1) * (y2 - y1)) * (y2 - y1) > 0)
        out |= {(int(i), rid, part) for i in np.flatnonzero(odd)}
    return out


def sample(n, seed):
    """Random points, points on the lattice and on vertices, and one place with a third of all."""
    rng = random.Random(seed)
    rows = [(rng.uniform(-1300, 2300), rng.uniform(-1000, 1200)) for _ in range(n)]
    rows += [(float(x), float(y)) for x in range(-200, 1100, 50) for y in range(-200, 900, 50)]
    rows += [p for _, _, rings in SHAPES for ring in rings for p in ring]
    return np.array(rows + [(310.0, 30.0)] * (len(rows) // 2), float)


def table(spark, points):
    return spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(points)], "id long, x double, y double")


KEYS = ["region_id", "part"]


@pytest.mark.parametrize("size", [9.0, 100.0])
def test_same_rows_as_every_edge(spark, size):
    points, regions = sample(4000, 1), polygons(spark, SHAPES)
    want = brute(points, SHAPES)
    pts = table(spark, points)
    for bc in (True, False):
        got = spatial.cover_join(pts, regions, size, region_cols=KEYS, broadcast=bc).collect()
        assert len(got) == len(want) and {(r["id"], r["region_id"], r["part"]) for r in got} == want
        under = {w[0] for w in want}
        semi = [r["id"] for r in spatial.cover_join(pts, regions, size, how="semi", region_cols=KEYS, broadcast=bc).collect()]
        anti = [r["id"] for r in spatial.cover_join(pts, regions, size, how="anti", region_cols=KEYS, broadcast=bc).collect()]
        assert sorted(semi) == sorted(under) and sorted(anti) == sorted(set(range(len(points))) - under)


def test_join_takes_the_cover_past_the_limit(spark, monkeypatch):
    points, regions = sample(500, 2), polygons(spark, SHAPES)
    want = {(r["id"], r["region_id"], r["part"])
            for r in spatial.spatial_join(table(spark, points), regions, 40.0, region_cols=KEYS).collect()}
    monkeypatch.setattr(spatial, "SPREAD_WORK_LIMIT", 0)
    monkeypatch.setattr(cover, "SPREAD_EDGES", 3)
    monkeypatch.setattr(cover, "BATCH_ROWS", 5)
    got = spatial.spatial_join(table(spark, points), regions, 40.0, region_cols=KEYS)
    assert got.columns == ["id", "x", "y", *KEYS]
    assert {(r["id"], r["region_id"], r["part"]) for r in got.collect()} == want == brute(points, SHAPES)


def test_rows_follow_the_perimeter(spark):
    shape = [(1, 0, [[(5000 * math.cos(a), 5000 * math.sin(a)) for a in np.linspace(0, 2 * math.pi, 4000, False)]])]
    regions = polygons(spark, shape)
    n = {s: cover.cover(regions, s, KEYS).agg(F.count("*").alias("n"), F.sum(F.size("_edges")).alias("e"),
                                             F.max(F.size("_flips")).alias("f")).first() for s in (40.0, 20.0, 10.0)}
    for a, b in ((40.0, 20.0), (20.0, 10.0)):
        assert n[b]["n"] < 2.6 * n[a]["n"]          # bins would be four times as many
    assert n[10.0]["n"] < 40_000 < 0.05 * (10_000 / 10.0) ** 2
    assert n[10.0]["e"] < 6 * n[10.0]["n"] and n[10.0]["f"] <= 8
    # the area is kept: whole cells and border cells tile the disc
    area = (cover.cover(regions, 10.0, KEYS).where("_full")
            .agg(F.sum(F.pow(F.lit(100.0), F.lit(1)) * F.pow(F.lit(16.0), "_lv"))).first()[0])
    assert 0.98 < area / (math.pi * 5000 ** 2) < 1


def test_hot_cell_is_split_without_a_broadcast(spark):
    regions = polygons(spark, [(1, 0, [star(0, 0, 300, 900, 4)])])
    rows = spark.range(0, 60_000, 1, 16).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, 101.0).otherwise((F.col("id") * 7919 % 1800 - 900).cast("double")).alias("x"),
        F.when(F.col("id") % 3 == 0, 11.0).otherwise((F.col("id") * 104729 % 1800 - 900).cast("double")).alias("y"))
    path = scratch_path(spark, "hot-cell")
    rows.write.parquet(path)
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
                                                "spark.sql.adaptive.advisoryPartitionSizeInBytes",
                                                "spark.sql.adaptive.skewJoin.skewedPartitionFactor",
                                                "spark.sql.autoBroadcastJoinThreshold")}
    try:
        for k, v in zip(old, ("20000", "20000", "1.5", "-1")):
            spark.conf.set(k, v)
        got = spatial.cover_join(spark.read.parquet(path).repartition(16), regions, 20.0, broadcast=False)
        n = got.count()
        plan = got.groupBy().count()
        plan.collect()
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "Broadcast" not in text.split("Initial Plan")[0] and "skew=true" in text
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert n == spatial.spatial_join(spark.read.parquet(path), regions, 2000.0).count()


def test_tiles_are_pruned(spark):
    regions = polygons(spark, [(1, 0, [star(150, 150, 400, 120, 4)])])
    pts = (spark.range(0, 40_000).select("id", (F.col("id") % 200 * 8.0 + 0.5).alias("x"), (F.floor(F.col("id") / 200) * 8.0).alias("y"))
           .withColumn("tile_x", F.floor(F.col("x") / 320).cast("int")).withColumn("tile_y", F.floor(F.col("y") / 320).cast("int")))
    path = scratch_path(spark, "cover-tiles")
    pts.write.partitionBy("tile_x", "tile_y").parquet(path)
    read = spark.read.parquet(path)
    got = spatial.cover_join(read, regions, 10.0, tiles=("tile_x", "tile_y", 320.0))
    assert "dynamicpruning" in got._jdf.queryExecution().executedPlan().toString().lower()
    want = spatial.spatial_join(read, regions, 1000.0)
    assert {r["id"] for r in got.collect()} == {r["id"] for r in want.collect()} != set()


def test_nothing_to_join(spark):
    regions = polygons(spark, [(1, 0, [box(0, 0, 10, 10)])])
    pts = table(spark, sample(10, 3))
    none = regions.limit(0)
    assert spatial.cover_join(pts, none, 5.0, how="anti").count() == pts.count()
    for how in ("inner", "semi"):
        assert spatial.cover_join(pts, none, 5.0, how=how).count() == 0
        assert spatial.cover_join(pts.limit(0), regions, 5.0, how=how).count() == 0
    odd = spark.createDataFrame([(1, None, 1.0), (2, float("nan"), 2.0), (3, 5.0, None), (4, 5.0, 5.0)], "id long, x double, y double")
    assert [r["id"] for r in spatial.cover_join(odd, regions, 5.0).collect()] == [4]
    assert sorted(r["id"] for r in spatial.cover_join(odd, regions, 5.0, how="anti").collect()) == [1, 2, 3]


def small_shapes(n=60):
    """Kites and squares, some holed, darts, bow ties and triangles, some with level edges on cell borders; keys by pair."""
    rng, out = random.Random(7), []
    for k in range(n):
        x, y, h = rng.randrange(-900, 1900, 50), rng.randrange(-700, 900, 50), rng.choice([40, 50, 100, 137.5])
        ring = [[(x - h, y), (x, y - 0.6 * h), (x + h, y), (x, y + h)], [(x - h, y - h), (x, y + h), (x + h, y - h), (x, y - h / 5)],
                [(x, y), (x, y + h), (x + h, y + h), (x + h, y)], [(x - h, y - h), (x + h, y + h), (x + h, y - h), (x - h, y + h)],
                [(x - h, y), (x + h, y), (x, y)]][k % 5]
        hole = [[(x - h / 4, y - h / 4), (x - h / 4, y + h / 4), (x + h / 4, y + h / 4), (x + h / 4, y - h / 4)]] if k % 2 and k % 5 in (0, 2) else []
        out.append((k // 2, k % 2, [[*r, r[0]] for r in (ring, *hole)]))
    return out


@pytest.mark.parametrize("size", [23.0, 50.0, 400.0])
def test_plain_regions_join_by_their_cells(spark, size, monkeypatch):
    monkeypatch.setattr(cover, "PASS_TESTS", 200)
    shapes, points = small_shapes(), sample(6000, 5)
    regions = polygons(spark, [*shapes, *((1000 + i, p, r) for i, p, r in SHAPES)])
    small = regions.where("region_id < 1000")
    assert small.where(cover.is_plain(size)).count() == len(shapes)
    want = brute(points, shapes)
    for bc in (True, False, None):
        got = spatial.cover_join(table(spark, points), small, size, region_cols=KEYS, broadcast=bc).collect()
        assert len(got) == len(want) and {(r["id"], r["region_id"], r["part"]) for r in got} == want
    # beside regions that take the descent
    got = spatial.cover_join(table(spark, points), regions, size, region_cols=KEYS, broadcast=False).collect()
    want = brute(points, [*shapes, *((1000 + i, p, r) for i, p, r in SHAPES)])
    assert len(got) == len(want) and {(r["id"], r["region_id"], r["part"]) for r in got} == want


def test_regions_of_many_edges_at_a_height_are_not_plain(spark):
    comb = [(0, 0), *(p for i in range(5) for p in ((20 * i, 50), (20 * i + 10, 5))), (100, 50), (100, 0), (0, 0)]
    level = polygons(spark, [(1, 0, [comb]), (2, 0, [[(0, 0), (50, 0), (20, 0), (0, 0)]])])
    assert [r["region_id"] for r in level.where(cover.is_plain(10.0)).collect()] == [2]
    assert cover.plain_cells(level.where("region_id = 2"), 10.0, KEYS).count() == 0


def test_plain_join_is_compiled_and_merged(spark):
    """No lambda in the join, and a sort-merge join even where the planner takes the cells for few."""
    got = spatial.cover_join(table(spark, sample(500, 6)), polygons(spark, small_shapes()), 50.0, region_cols=KEYS, broadcast=False)
    plan = got._jdf.queryExecution().executedPlan().toString()
    join = plan[plan.index("SortMergeJoin"):].split("\n")[0]
    assert "lambda" not in join and "Broadcast" not in plan
