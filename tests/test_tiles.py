"""Tiles in chunks against whole tiles, absent pixels, pruning of folders, and one large tile in little memory."""

import os
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from pixelframe.operators import cube, tiles
from pixelframe.session import scratch_path

from conftest import ROOT

META = "tile_id long, h int, w int, affine array<double>"
AFFINES = {1: (7, 5, [100.25, 0.1, 0.0, 50.5, 0.0, -0.1]), 2: (3, 8, [0.0, 1.0, 0.25, 0.0, -0.5, 2.0]),
           3: (1, 1, [5.0, 1.0, 0.0, 5.0, 0.0, -1.0]), 4: (6, 6, [0.0, 1.0, 0.0, 0.0, 0.0, -1.0])}


def _pixels(absent=lambda t, r, c: False):
    return [(t, r, c, [float(t), float(r), None if c == 2 else float(c)]) for t, (h, w, _) in AFFINES.items()
            for r in range(h) for c in range(w) if not absent(t, r, c)]


def _tables(spark, rows):
    meta = spark.createDataFrame([(t, h, w, a) for t, (h, w, a) in AFFINES.items()], META)
    return spark.createDataFrame(rows, "tile_id long, row int, col int, bands array<float>"), meta


def _whole(spark):
    rows = [(t, h, w, a, [[float(t), float(r), None if c == 2 else float(c)] for r in range(h) for c in range(w)])
            for t, (h, w, a) in AFFINES.items()]
    return spark.createDataFrame(rows, META + ", data array<array<float>>")


def _rows(df):
    return sorted((r.tile_id, r.row, r.col, r.x, r.y, None if r.bands is None else tuple(str(b) for b in r.bands))
                  for r in df.collect())


@pytest.mark.parametrize("side", [1, 2, 3, 5, 64])
def test_chunks_unnest_to_the_whole_tiles(spark, side):
    whole = _whole(spark)
    want = _rows(cube.unnest_tiles(whole, ["tile_id"]))
    px, meta = _tables(spark, _pixels())
    for chunks in (tiles.chunk_tiles(whole, side, ["tile_id"]), tiles.chunk_pixels(px, meta, ["tile_id"], side)):
        assert _rows(cube.unnest_tiles(chunks, ["tile_id"])) == want  # coordinates bit by bit
        assert chunks.agg(F.max(F.size("data"))).first()[0] <= side * side
        inside = cube.unnest_tiles(chunks, ["tile_id", *tiles.BOUNDS]).where(
            "x < minx or x > maxx or y < miny or y > maxy").count()
        assert inside == 0


def test_absent_null_twice_and_outside(spark):
    px, meta = _tables(spark, _pixels(lambda t, r, c: t == 4 and r < 3 or t == 1 and (r + c) % 3 == 0))
    got = _rows(cube.unnest_tiles(tiles.chunk_pixels(px, meta, ["tile_id"], 3), ["tile_id"]))
    have = {(r[0], r[1], r[2]) for r in got if r[5] is not None}
    assert have == {(r.tile_id, r.row, r.col) for r in px.collect()}
    assert not [r for r in got if r[0] == 4 and r[1] < 3]  # chunks without pixels are absent
    assert len([r for r in got if r[0] == 1]) == 35        # absent pixels of a chunk are NULL
    null_bands = spark.createDataFrame([(3, 0, 0, None)], px.schema)
    assert _rows(cube.unnest_tiles(tiles.chunk_pixels(null_bands, meta, ["tile_id"], 3), ["tile_id"]))[0][5] is None
    with pytest.raises(Exception, match="comes twice"):
        tiles.chunk_pixels(px.unionByName(px.where("tile_id = 3")), meta, ["tile_id"], 3).collect()
    for place in ((3, 1, 0), (3, 0, -1), (3, None, 0)):
        with pytest.raises(Exception, match="outside its tile"):
            tiles.chunk_pixels(spark.createDataFrame([(*place, [1.0])], px.schema), meta, ["tile_id"], 3).collect()
    assert tiles.chunk_pixels(px.limit(0), meta, ["tile_id"]).count() == 0
    empty = _whole(spark).withColumn("data", F.when(F.col("tile_id") > 1, F.col("data")))
    assert {r.tile_id for r in tiles.chunk_tiles(empty.withColumn("h", F.when(F.col("tile_id") == 2, 0).otherwise(F.col("h"))),
                                                 2, ["tile_id"]).collect()} == {3, 4}


def _stored(spark, bin_size):
    px = spark.range(400 * 400).select(F.lit(1).alias("tile_id"), F.floor(F.col("id") / 400).cast("int").alias("row"),
                                       (F.col("id") % 400).cast("int").alias("col"), F.array(F.col("id").cast("float")).alias("bands"))
    meta = spark.createDataFrame([(1, 400, 400, [0.0, 1.0, 0.0, 400.0, 0.0, -1.0])], META)
    path = scratch_path(spark, "chunks")
    tiles.write_chunks(tiles.chunk_pixels(px, meta, ["tile_id"], 16), path, bin_size)
    return path


@pytest.mark.parametrize("listed", [10_000, 1])
def test_folders_away_from_every_region_are_not_read(spark, monkeypatch, listed):
    monkeypatch.setattr(tiles, "TILE_LIST", listed)
    path = _stored(spark, 50.0)
    schema = spark.read.parquet(path).schema
    boxes = spark.createDataFrame([(60.0, 60.0, 70.0, 75.0), (310.5, 360.0, 311.0, 361.0), (60.0, 60.0, 70.0, 75.0),
                                   (float("nan"), 0.0, 1.0, 1.0), (None, 0.0, 400.0, 400.0)],
                                  "minx double, miny double, maxx double, maxy double")
    whole = spark.read.parquet(path).drop("bin_x", "bin_y")
    near = [(60, 60, 70, 75), (310.5, 360, 311, 361)]
    want = {(r.row0, r.col0) for r in whole.select("row0", "col0", *tiles.BOUNDS).collect()
            if any(r.minx <= b[2] and r.maxx >= b[0] and r.miny <= b[3] and r.maxy >= b[1] for b in near)}
    for folder in ("bin_x=4/bin_y=4", "bin_x=1/bin_y=7", "bin_x=6/bin_y=1")[:3 if listed > 1 else 1]:
        root = Path(path.removeprefix("file:")) / folder
        assert list(root.glob("*.parquet"))
        for f in root.glob("*.parquet"):
            f.write_bytes(b"no parquet")
        for f in root.glob(".*.crc"):
            f.unlink()
    got = tiles.chunks_under(spark.read.schema(schema).parquet(path), boxes, 50.0)
    rows = [(r.row0, r.col0) for r in got.collect()]
    assert set(rows) == want and len(rows) == len(want) > 0
    assert tiles.chunks_under(spark.read.schema(schema).parquet(path), boxes.where("minx is null"), 50.0).count() == 0


def test_a_chunk_wider_than_its_bin_raises(spark):
    px, meta = _tables(spark, _pixels())
    with pytest.raises(Exception, match="larger than bin_size"):
        tiles.write_chunks(tiles.chunk_pixels(px, meta, ["tile_id"], 4), scratch_path(spark, "wide"), 2.0)


BIG = """
from pyspark.sql import functions as F
from pixelframe.operators import cube, tiles
from pixelframe.session import local_session, scratch_path
spark = local_session(2, 16)
n = 1100
px = spark.range(0, n * n, 1, 16).select(F.lit(1).alias("tile_id"), F.floor(F.col("id") / n).cast("int").alias("row"),
    (F.col("id") % n).cast("int").alias("col"), F.array_repeat((F.col("id") % 1009).cast("float"), 128).alias("bands"))
meta = spark.createDataFrame([(1, n, n, [0.0, 10.0, 0.0, 0.0, 0.0, -10.0])], "tile_id long, h int, w int, affine array<double>")
path = scratch_path(spark, "big")
tiles.write_chunks(tiles.chunk_pixels(px, meta, ["tile_id"], 32), path, 1000.0)
out = cube.unnest_tiles(spark.read.parquet(path)).agg(F.count("bands"), F.sum(F.col("bands")[127].cast("long")), F.sum("x")).first()
total = sum(i % 1009 for i in range(n * n))
assert (out[0], out[1]) == (n * n, total), out
assert abs(out[2] - n * n * n * 10 / 2) < 1, out
print("WHOLE")
spark.stop()
"""


def test_a_tile_of_600_mb_passes_through_a_small_heap():
    """1,100² pixels of 128 bands (620 MB) where the whole heap has 512 MB: no row ever holds the tile."""
    env = dict(os.environ, PIXELFRAME_DRIVER_MEMORY="512m", PYTHONPATH=str(ROOT))
    got = subprocess.run([sys.executable, "-c", BIG], env=env, capture_output=True, text=True, timeout=600)
    assert "WHOLE" in got.stdout, got.stderr[-3000:]
