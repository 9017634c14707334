import json

from pyspark.sql import functions as F

from pixelframe.operators import spatial
from pixelframe.plans import fixtures as fx
from pixelframe.session import scratch_path
from pixelframe.sources import geojson
from pixelframe.streaming import extract_stream

from conftest import SF_MID


def test_stream_extraction_equals_batch(spark):
    pts = fx.events_points(spark, SF_MID).withColumn("bands", F.array(F.col("y").cast("float")))
    src = scratch_path(spark, "stream-src")
    pts.repartition(4).write.parquet(src)
    out = scratch_path(spark, "stream-out")
    schema = "event_id bigint, x double, y double, t timestamp, class string, bands array<float>"
    q = extract_stream.start_extraction(spark, src, schema, fx.probe_regions(spark), 25.0, out, year=2024, cls=3,
                                        checkpoint=out + "-ckpt")
    q.awaitTermination()
    got = spark.read.parquet(out).select("event_id", "region_id")
    exp = spatial.spatial_join(pts, fx.probe_regions(spark), 25.0).select("event_id", "region_id")
    assert got.count() == 2455 + 1923
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0


def test_feature_collection_document(spark, tmp_path):
    doc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"name": "a", "n": 3},
         "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [10, 0], [10, 10], [0, 10], [0, 0]],
                                                         [[2, 2], [2, 4], [4, 4], [4, 2], [2, 2]]]}},
        {"type": "Feature", "properties": {},
         "geometry": {"type": "MultiPolygon", "coordinates": [[[[20, 20], [30, 20], [30, 30]]],
                                                              [[[40, 40], [50, 40], [50, 50], [40, 40]]]]}},
    ]}
    p = tmp_path / "r.geojson"
    p.write_text(json.dumps(doc))
    from pixelframe.operators.regions import area
    rows = sorted(area(geojson.read_geojson(spark, str(p))).select("region_id", "part", "area", "props").collect())
    assert [(r.region_id, r.part) for r in rows] == [(0, 0), (1, 0), (1, 1)]
    assert rows[0].area == 96.0 and rows[1].area == 50.0 and rows[2].area == 50.0   # open ring gets closed
    assert rows[0].props["n"] == "3"


def _layers(spark, n=600):
    """Four layers a pixel of a 30 × 5 lattice, with missing bands; layer times differ within a pixel."""
    import random
    rng = random.Random(9)
    rows = [(i, float(i % 30) + 0.5, float(i // 30 % 5) + 0.5, f"2024-0{1 + i // 150}-01 00:00:00",
             [rng.choice([None, float("nan"), rng.uniform(-1, 1)]) for _ in range(3)]) for i in range(n)]
    return spark.createDataFrame(rows, "id long, x double, y double, t string, bands array<float>").withColumn(
        "t", F.col("t").cast("timestamp_ntz"))


SCHEMA = "id bigint, x double, y double, t timestamp_ntz, bands array<float>"


def test_streamed_composite_in_any_order_equals_the_batch(spark):
    from pixelframe.plans import jobs
    from test_grid_walk import box, polygons
    layers = _layers(spark)
    regions = polygons(spark, [(1, 0, [box(2, 0, 11, 3)]), (2, 0, [box(10, 1, 15, 9)])])
    for how, seed in (("max", 1), ("max", 2), ("latest", 3)):
        src, out = scratch_path(spark, "comp-src"), scratch_path(spark, "comp-out")
        layers.repartition(6, F.xxhash64("id", F.lit(seed))).write.parquet(src)

        def stream():
            q = extract_stream.start_composite(spark, src, SCHEMA, regions, 5.0, out, 3, how=how, tie="id",
                                               max_files_per_trigger=1, checkpoint=out + "-ckpt")
            q.awaitTermination()
            assert q.exception() is None

        stream()
        cols = ["region_id", "x", "y", "bands", "n_steps" if how == "max" else "t"]
        want = jobs.extract_from_cube(regions, layers, None, 5.0, how, n_bands=3, tie="id").select(*cols)
        got = lambda **k: extract_stream.read_composite(spark, out, 3, how, **k)
        same = lambda a: str(sorted(map(str, a.select(*cols).collect()))) == str(sorted(map(str, want.collect())))
        assert want.count() and same(got())
        # a batch that runs again replaces what it wrote
        part = extract_stream.partial_composite(
            extract_stream.clip_stream(spark.read.schema(SCHEMA).parquet(src).limit(0), regions, 5.0), ["region_id", "x", "y"], 3, how, "id")
        again = spark.read.parquet(out).where("batch = 2").drop("batch")
        assert part.columns == again.columns
        # folded: the first batches as a base, and a late layer that arrives in a new file
        fold = scratch_path(spark, "comp-fold")
        extract_stream.merge_composites(spark.read.parquet(out).where("batch <= 3").drop("batch"), ["region_id", "x", "y"], 3, how).write.parquet(fold)
        assert same(got(base=spark.read.parquet(fold), after=3))
        late = spark.sql("SELECT 10000L id, 12.5D x, 2.5D y, timestamp_ntz'2023-01-01 00:00:00' t, array(9f, -9f, 9f) bands")
        late.write.mode("append").parquet(src)
        stream()
        want = jobs.extract_from_cube(regions, layers.unionByName(late), None, 5.0, how, n_bands=3, tie="id").select(*cols)
        assert same(got())


def test_a_batch_that_runs_twice_counts_once(spark):
    from test_grid_walk import box, polygons
    regions = polygons(spark, [(1, 0, [box(0, 0, 30, 5)])])
    src, out = scratch_path(spark, "twice-src"), scratch_path(spark, "twice-out")
    _layers(spark).repartition(2).write.parquet(src)
    for k in range(2):  # a fresh checkpoint forgets what was read: every batch runs again under its number
        extract_stream.start_composite(spark, src, SCHEMA, regions, 5.0, out, 3, max_files_per_trigger=2,
                                       checkpoint=f"{out}-ckpt{k}").awaitTermination()
    got = extract_stream.read_composite(spark, out, 3).agg(F.sum("n_steps"), F.count("*")).first()
    assert tuple(got) == (600, 150)
