import numpy as np

from pixelframe.operators import spatial
from pixelframe.plans import fixtures as fx

from conftest import SF_MID


def _brute(pts_pdf, polys):
    """numpy even-odd rule over all edges — the reference for the bin join."""
    out = set()
    for rid, ring in polys.items():
        r = fx.closed(ring)
        inside = np.zeros(len(pts_pdf), dtype=bool)
        px, py = pts_pdf["x"].to_numpy(), pts_pdf["y"].to_numpy()
        for (x1, y1), (x2, y2) in zip(r[:-1], r[1:]):
            straddle = (y1 > py) != (y2 > py)
            cross = (x2 - x1) * (py - y1) - (px - x1) * (y2 - y1)
            inside ^= straddle & (cross * (y2 - y1) > 0)
        out |= {(int(e), rid) for e in pts_pdf["event_id"].to_numpy()[inside]}
    return out


def test_bin_join_equals_brute_force_for_any_bin_and_plan(spark):
    pts = fx.events_points(spark, SF_MID)
    regions = fx.probe_regions(spark)
    expected = _brute(pts.toPandas(), fx.PROBE_POLYGONS)
    assert len(expected) == 2455 + 1923
    for b in (3.0, 25.0, 200.0):
        for bc in (True, False):
            got = {(r.event_id, r.region_id) for r in
                   spatial.spatial_join(pts, regions, b, broadcast=bc).select("event_id", "region_id").collect()}
            assert got == expected, (b, bc)


def test_semi_and_anti_partition_points(spark):
    pts = fx.events_points(spark, SF_MID)
    regions = fx.probe_regions(spark)
    semi = spatial.spatial_join(pts, regions, 25.0, how="semi").count()
    anti = spatial.spatial_join(pts, regions, 25.0, how="anti").count()
    assert semi + anti == pts.count()


def test_mask_keeps_bbox_and_flags_inside(spark):
    pts = fx.events_points(spark, SF_MID)
    regions = fx.probe_regions(spark)
    m = spatial.spatial_join(pts, regions, 25.0, how="mask")
    inner = spatial.spatial_join(pts, regions, 25.0)
    assert m.where("_inside").count() == inner.count()


def test_coverage_flags_empty_region(spark):
    regions = fx.probe_regions(spark)
    inner = spatial.spatial_join(fx.events_points(spark, SF_MID), regions, 25.0)
    rep = {r.region_id: (r.pixel_count, r.empty) for r in spatial.coverage_report(regions, inner).collect()}
    assert rep[1] == (2455, False) and rep[2] == (1923, False) and rep[3] == (0, True)


def test_plan_is_broadcast_hash_join_with_pruned_scan(spark):
    pts = fx.events_points(spark, SF_MID)
    df = spatial.spatial_join(pts, fx.probe_regions(spark), 25.0).groupBy("region_id").count()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert "NestedLoop" not in plan
    assert "CartesianProduct" not in plan


def test_tile_partitioned_source_is_pruned_dynamically(spark):
    from pyspark.sql import functions as F
    from pixelframe.session import scratch_path
    pts = fx.events_points(spark, SF_MID)
    path = scratch_path(spark, "test-tiles")
    (pts.withColumn("tile_x", F.floor(F.col("x") / 50.0)).withColumn("tile_y", F.floor(F.col("y") / 50.0))
        .write.partitionBy("tile_x", "tile_y").parquet(path))
    px = spark.read.parquet(path)
    j = spatial.spatial_join(px, fx.probe_regions(spark), 25.0, tiles=("tile_x", "tile_y", 50.0))
    plan = j._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruningexpression" in plan
    got = {(r.event_id, r.region_id) for r in j.select("event_id", "region_id").collect()}
    assert got == _brute(pts.toPandas(), fx.PROBE_POLYGONS)


def test_hot_bin_on_the_shuffle_path(spark):
    """A third of the points in one bin: sort-merge path (no broadcast) gives the brute-force answer."""
    from pyspark.sql import functions as F
    pts = fx.events_points(spark, SF_MID)
    hot = pts.withColumn("x", F.when(F.col("event_id") % 3 == 0, F.lit(40.5)).otherwise(F.col("x"))) \
             .withColumn("y", F.when(F.col("event_id") % 3 == 0, F.lit(40.5)).otherwise(F.col("y")))
    regions = fx.probe_regions(spark)
    got = {(r.event_id, r.region_id) for r in
           spatial.spatial_join(hot, regions, 25.0, broadcast=False).select("event_id", "region_id").collect()}
    assert got == _brute(hot.toPandas(), fx.PROBE_POLYGONS)


def test_mosaic_and_sample_do_not_depend_on_partitioning(spark):
    from pyspark.sql import functions as F
    from pixelframe.operators import grid as G
    from pixelframe.operators import raster
    ev = spark.read.parquet(f"{SF_MID}/events.parquet")
    px = ev.select("event_id", F.floor(F.col("event_id") / 1000).alias("grid_id"), F.col("user_id").alias("col"),
                   F.floor(F.col("value") / 5).alias("row"), (F.length("event_type") % 3).alias("pred"))
    a = raster.mosaic_first(px, ("col", "row"), "pred", ["grid_id", "event_id"])
    b = raster.mosaic_first(px.repartition(7, "event_id"), ("col", "row"), "pred", ["grid_id", "event_id"])
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    cells = G.grid_cells(fx.customer_regions(spark, SF_MID), 5000.0, 500.0)
    s1 = G.sample_grids(cells, 25, seed=3).select("grid_id")
    s2 = G.sample_grids(cells.repartition(5), 25, seed=3).select("grid_id")
    assert s1.count() == 25 and s1.exceptAll(s2).count() == 0


def test_spread_path_gives_the_same_rows(spark, monkeypatch):
    """Force the spread layout (bins/cells repartitioned, edges broadcast) and compare with in-place."""
    from pixelframe.operators import grid as G
    pts = fx.events_points(spark, SF_MID)
    regions = fx.probe_regions(spark)
    cust = fx.customer_regions(spark, SF_MID)
    inplace_join = {(r.event_id, r.region_id) for r in spatial.spatial_join(pts, regions, 5.0).collect()}
    inplace_cells = G.grid_cells(cust, 5000.0, 500.0).select("grid_id")
    inplace_ids = {r.grid_id for r in inplace_cells.collect()}
    monkeypatch.setattr(spatial, "SPREAD_WORK_LIMIT", 0)
    monkeypatch.setattr(G, "SPREAD_WORK_LIMIT", 0)
    spread_join = {(r.event_id, r.region_id) for r in spatial.spatial_join(pts, regions, 5.0).collect()}
    spread_ids = {r.grid_id for r in G.grid_cells(cust, 5000.0, 500.0).select("grid_id").collect()}
    assert spread_join == inplace_join == _brute(pts.toPandas(), fx.PROBE_POLYGONS)
    assert spread_ids == inplace_ids
