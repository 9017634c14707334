"""Widths, identities, layouts and reference systems: what must not depend on size or be lost."""

import json

import pytest
from pyspark.sql import functions as F

from pixelframe import session
from pixelframe.operators import cube, grid, learn, prep, raster, regions, spatial
from pixelframe.plans import fixtures as fx
from pixelframe.plans import jobs
from pixelframe.session import scratch_path
from pixelframe.sources import geojson, tables

from conftest import SF_MID, SF_SMALL

NAN = float("nan")


def _two_parts(spark, sf):
    one = fx.customer_regions(spark, sf).select("region_id", "part", "rings", "srid")
    moved = F.transform("rings", lambda r: F.transform(r, lambda p: F.struct((p["x"] + 6000.0).alias("x"), p["y"].alias("y"))))
    two = one.withColumn("rings", moved).withColumn("part", F.lit(1))
    return regions.with_geometry(one.unionByName(two).withColumn("region_id", F.col("region_id") + 10_000_000))


@pytest.mark.parametrize("limits", [{}, {"DEFAULT_BROADCAST_ROW_LIMIT": 0}])
def test_grid_cells_of_parts_are_the_same_on_both_sides_of_the_limit(spark, monkeypatch, limits):
    reg = _two_parts(spark, SF_SMALL)
    cols = ["grid_id", "region_id", "part", "ix", "iy"]
    inplace = sorted(map(tuple, grid.grid_cells(reg, 5000.0, 500.0).select(*cols).collect()))
    assert len({r[0] for r in inplace}) == len(inplace)
    monkeypatch.setattr(grid, "SPREAD_WORK_LIMIT", 0)
    for name, value in limits.items():
        monkeypatch.setattr(spatial, name, value)
    assert sorted(map(tuple, grid.grid_cells(reg, 5000.0, 500.0).select(*cols).collect())) == inplace


@pytest.mark.parametrize("how", ["inner", "mask"])
def test_spatial_join_of_parts_by_rows_of_edges(spark, monkeypatch, how):
    reg, pts = _two_parts(spark, SF_SMALL), fx.order_points(spark, SF_SMALL)
    cols = ["o_orderkey", "region_id", "part"] + (["_inside"] if how == "mask" else [])

    def rows():
        j = spatial.spatial_join(pts, reg, 3000.0, how=how, region_cols=["region_id", "part"])
        return sorted(map(tuple, j.select(*cols).collect()))

    plain = rows()
    assert plain
    for name in ("SPREAD_WORK_LIMIT", "DEFAULT_BROADCAST_ROW_LIMIT", "DEFAULT_BROADCAST_EDGE_LIMIT"):
        monkeypatch.setattr(spatial, name, 0)
    assert rows() == plain


def test_composite_keeps_every_band_and_refuses_mixed_widths(spark):
    for width in (10, 64, 128):
        df = spark.range(6).select((F.col("id") % 2).alias("p"), F.lit(0).alias("t"),
                                   F.transform(F.sequence(F.lit(1), F.lit(width)), lambda i: (i + F.col("id")).cast("float")).alias("bands"))
        got = {r.p: r.bands for r in cube.composite_max(df, ["p"]).collect()}
        assert got[1] == [i + 5.0 for i in range(1, width + 1)]
    mixed = df.unionByName(spark.createDataFrame([(9, 0, [1.0])], "p bigint, t int, bands array<float>"))
    with pytest.raises(Exception, match="array of width"):
        cube.composite_max(mixed, ["p"]).collect()
    with pytest.raises(Exception, match="array of width"):
        tables.spread_features(mixed, "bands", n=128).collect()
    assert len(tables.spread_features(df, "bands").columns) == 2 + 128


def test_width_hint_changes_nothing(spark):
    rows = [(1, [1.0, 2.0, 3.0]), (2, [1.0, NAN, 3.0]), (3, None), (4, [1.0]), (5, [1.0, 2.0, 3.0, None]), (6, [])]
    df = spark.createDataFrame(rows, "id int, bands array<float>")
    for n in (1, 3, 4):
        assert cube.drop_missing(df, n_bands=n).collect() == cube.drop_missing(df).collect()
        a, b = cube.fill_missing(df, n_bands=n).collect(), cube.fill_missing(df).collect()
        assert [(r.id, r.bands) for r in a] == [(r.id, r.bands) for r in b]


def test_null_arrays_are_all_missing(spark):
    df = spark.createDataFrame([(1, [NAN, NAN]), (2, None), (3, [1.0, NAN]), (4, None)], "id int, features array<double>")
    out = {r.id: r.features for r in prep.cap_all_missing(df, "id", "features", cap=2).collect()}
    assert out[1] == [0.0, 0.0] and out[2] == [0.0, 0.0] and 4 not in out and out[3][0] == 1.0
    assert len(prep.cap_all_missing(df, "id", "features").collect()) == 4


def test_rows_without_label_are_no_class(spark):
    df = spark.createDataFrame([(i, ["a", "b"][i % 2]) for i in range(20)] + [(99, None)], "id int, class_ string")
    assert {r.class_: r.n for r in prep.balance_classes(df, ["id"]).groupBy("class_").agg(F.count("*").alias("n")).collect()} == {"a": 10, "b": 10}


def test_background_rows_take_the_given_ids(spark):
    df = spark.createDataFrame([(f"r{i}", i, [1.0, 2.0], i % 2) for i in range(40)],
                               "region string, px bigint, features array<double>, class_ int")
    out = prep.prepare_training(df, ["region", "px"], n_background=50, background=5)
    bg = out.where("class_ = 5")
    assert bg.select("region", "px").distinct().count() == 50 and bg.where("region is null or px is null").count() == 0
    test = bg.where(prep.split_flag(["region", "px"])).count()
    assert 5 <= test <= 25


def _features(spark):
    return spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select(
        F.col("vec_id").alias("pixel_id"), F.col("embedding").alias("features"), F.col("label").alias("class_"))


def test_forest_does_not_depend_on_the_layout(spark):
    f = _features(spark)
    preds = []
    for n in (1, 4, 8):
        model = learn.fit_random_forest(f.repartition(n, "class_"), 64, num_trees=5, max_depth=5)
        preds.append([r.pred for r in learn.predict(model, f, "pred").orderBy("pixel_id").collect()])
    assert preds[0] == preds[1] == preds[2]


def test_saved_forest_predicts_unlabelled_bands(spark):
    path = scratch_path(spark, "rules-model")
    learn.save_model(learn.fit_random_forest(_features(spark), 64, num_trees=3, max_depth=4), path)
    model = learn.load_model(path)
    px = _features(spark).limit(3).select(F.col("pixel_id").alias("x"), F.col("features").alias("bands"))
    px = px.unionByName(spark.createDataFrame([(-1, None), (-2, [NAN] * 64)], "x bigint, bands array<float>"))
    got = {r.x: r.pred for r in learn.predict(model, px, "pred", features="bands").collect()}
    assert got[-1] is None and got[-2] is None and all(v is not None for k, v in got.items() if k >= 0)
    assert learn.predict(model, px, "pred", features="bands").columns == ["x", "bands", "pred"]
    filled = {r.x: r.pred for r in learn.predict(model, px, "pred", features="bands", on_missing=5).collect()}
    assert filled[-1] == filled[-2] == 5


def _line(crs=None, **feature):
    f = {"type": "Feature", "properties": {}, "geometry": {"type": "Polygon", "coordinates": [[[500000, 0], [500100, 0], [500100, 100], [500000, 0]]]}}
    if crs:
        f["crs"] = {"type": "name", "properties": {"name": crs}}
    return json.dumps(f | feature)


def test_geojson_ids_and_reference_systems(spark, tmp_path):
    p = tmp_path / "a.jsonl"
    p.write_text("\n".join([_line("urn:ogc:def:crs:EPSG::32643", id="north-1"), _line("EPSG:3857", id="7"), _line(id=8),
                            _line("urn:ogc:def:crs:OGC:1.3:CRS84")]))
    rows = geojson.read_geojson(spark, str(p), sequence=True).select("region_id", "srid").collect()
    assert sorted(r.srid for r in rows) == [3857, 4326, 4326, 32643]
    assert {7, 8} <= {r.region_id for r in rows} and len({r.region_id for r in rows}) == 4
    doc = tmp_path / "b.geojson"
    doc.write_text(json.dumps({"type": "FeatureCollection", "crs": {"type": "name", "properties": {"name": "EPSG:32643"}},
                               "features": [json.loads(_line(id="x")), json.loads(_line())]}))
    r = geojson.read_geojson(spark, str(doc))
    assert {x.srid for x in r.collect()} == {32643}
    ll = regions.reproject(r, 4326).first()
    assert abs(ll.minx - 75.0) < 1e-9 and abs(ll.miny) < 1e-9  # zone 43's central meridian
    doc.write_text(json.dumps({"type": "FeatureCollection", "crs": {"type": "name", "properties": {"name": "EPSG:2154"}},
                               "features": [json.loads(_line())]}))
    with pytest.raises(Exception, match="unsupported CRS"):
        geojson.read_geojson(spark, str(doc)).collect()


def test_reproject_goes_round_and_refuses_what_it_does_not_know(spark):
    r = fx.polygons_df(spark, fx.LONLAT_POLYGONS).withColumn("srid", F.lit(4326))
    back = regions.reproject(regions.reproject(regions.reproject(r, 32643), 3857), 4326)
    for a, b in zip(sorted(r.collect()), sorted(back.collect())):
        assert all(abs(getattr(a, c) - getattr(b, c)) < 1e-6 for c in ("minx", "miny", "maxx", "maxy"))
    with pytest.raises(ValueError, match="unsupported CRS"):
        regions.reproject(r.withColumn("srid", F.lit(2154)), 4326)
    with pytest.raises(ValueError, match="unsupported CRS"):
        regions.reproject(r, 2154)
    with pytest.raises(Exception, match="CRS not listed"):
        regions.reproject(r.withColumn("srid", F.lit(32643)), 4326, from_srids=(3857,)).collect()


def test_two_pixels_of_a_grid_in_a_cell(spark):
    region = fx.polygons_df(spark, {1: [(0.0, -4.0), (8.0, -4.0), (8.0, 4.0), (0.0, 4.0)]})
    rows = [(1.2, 1.2, 1), (1.7, 1.2, 2), (1.2, 1.9, 3), (5.0, 2.0, 4)]
    out = set()
    for order in (rows, rows[::-1]):
        px = spark.createDataFrame(order, "x double, y double, v int")
        m = jobs.save_predictions(region, px, lambda d: d.withColumn("pred", F.col("v")), 4.0, 0.0, 4.0, 2.0)
        out.add(tuple(sorted((r.col, r.row, r.pred) for r in m.collect())))
    assert out == {((0, 1, 1), (2, 1, 4))}


def test_tiles_are_pruned_before_they_are_unnested(spark):
    tiles = spark.range(50).select(
        F.col("id").alias("tile_id"), F.lit(2).alias("h"), F.lit(2).alias("w"),
        F.array(F.col("id") * 100.0, F.lit(10.0), F.lit(0.0), F.lit(20.0), F.lit(0.0), F.lit(-10.0)).alias("affine"),
        F.array_repeat(F.array(F.lit(1.0).cast("float")), 4).alias("data"))
    region = fx.polygons_df(spark, {1: [(195.0, 0.0), (225.0, 0.0), (225.0, 30.0), (195.0, 30.0)]})
    assert [r.tile_id for r in jobs.tiles_under(tiles, region, 16.0, ["tile_id"]).collect()] == [2]
    out = jobs.extract_from_tiles(tiles, region, 16.0)
    assert out.count() == 4
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate posexplode") < plan.rindex("LeftSemi")  # the semi join stands below


@pytest.mark.parametrize("drop", [True, False])
def test_clip_reads_only_the_tiles_under_a_region(spark, drop):
    path = scratch_path(spark, "rules-tiles")
    pts = fx.events_points(spark, SF_MID).withColumn("tile_x", F.floor(F.col("x") / 50.0)).withColumn("tile_y", F.floor(F.col("y") / 50.0))
    pts.write.partitionBy("tile_x", "tile_y").parquet(path)
    px, reg = spark.read.parquet(path), fx.probe_regions(spark)
    out = spatial.clip(px, reg, 25.0, ["class"], drop=drop, tiles=("tile_x", "tile_y", 50.0))
    plain = spatial.clip(px, reg, 25.0, ["class"], drop=drop)
    cols = ["event_id", "region_id", "class"]
    assert out.select(*cols).exceptAll(plain.select(*cols)).isEmpty() and out.count() == plain.count()
    assert "dynamicpruning" in out._jdf.queryExecution().executedPlan().toString().lower()


def test_a_cluster_must_name_its_shared_folder(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)
        getConf = staticmethod(lambda: type("C", (), {"get": staticmethod(lambda k, d=None: d)}))

    class Session:
        sparkContext = Context()
        conf = type("C", (), {"get": staticmethod(lambda k, d=None: d)})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


def test_crop_keeps_the_cells_of_the_boxes(spark):
    ref = spark.range(100).select((F.col("id") % 10).alias("col"), F.floor(F.col("id") / 10).alias("row"), F.lit(1).alias("value"))
    boxes = spark.createDataFrame([(2.0, -4.0, 3.5, -3.0)], "minx double, miny double, maxx double, maxy double")
    got = {(r.col, r.row) for r in raster.crop(ref, boxes, 0.0, 0.0, 1.0).collect()}
    assert {(2, 3), (3, 3)} <= got and max(c for c, _ in got) <= 5 and max(r for _, r in got) <= 5
    assert raster.crop(ref, boxes.limit(0), 0.0, 0.0, 1.0).count() == 0


def test_customers_of_one_file_become_polygons_in_many_tasks(spark, monkeypatch):
    one = fx.customer_regions(spark, SF_MID)
    monkeypatch.setattr(fx, "DEAL_ROWS", 400)
    many = fx.customer_regions(spark, SF_MID)
    sizes = [r["n"] for r in many.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert many.rdd.getNumPartitions() == 4 and max(sizes) < 2 * 400
    assert many.schema == one.schema and many.count() == one.count() == 1500
    assert many.select("region_id", "edges", "minx", "maxy").exceptAll(one.select("region_id", "edges", "minx", "maxy")).isEmpty()
