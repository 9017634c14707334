"""The reference is cropped box by box: what lies between distant boxes is not read."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from pixelframe.operators import raster
from pixelframe.session import scratch_path
from pixelframe.sources import tables

BOXES = "minx double, miny double, maxx double, maxy double"
FAR = [(3.0, -9.0, 11.0, -4.0), (950.0, -960.0, 961.0, -930.5), (950.0, -960.0, 961.0, -930.5)]


def cells(spark, n=1000):
    return spark.range(n * n).select((F.col("id") % n).alias("col"), F.floor(F.col("id") / n).alias("row"),
                                     (F.col("id") % 9).alias("value"))


def want(boxes):
    out = set()
    for x0, y0, x1, y1 in boxes:
        out |= {(c, r) for c in range(1000) for r in range(1000)
                if x0 - 1 <= c <= x1 + 1 and -y1 - 1 <= r <= -y0 + 1}
    return out


def local(path):
    return Path(path.removeprefix("file:"))


@pytest.mark.parametrize("block", [7, 64, 5000])
def test_each_box_by_itself(spark, block):
    got = raster.crop(cells(spark), spark.createDataFrame(FAR, BOXES), 0.0, 0.0, 1.0, block=block)
    assert got.columns == ["col", "row", "value"]
    rows = [(r.col, r.row) for r in got.collect()]
    # a side that falls inside a cell takes that cell whole, with its neighbour
    assert len(rows) == len(set(rows)) and set(rows) >= want(FAR) and len(rows) < len(want(FAR)) + 2 * 60
    assert raster.crop(cells(spark), spark.createDataFrame([(float("nan"), 0.0, 1.0, 1.0), (None, 0.0, 1.0, 1.0)], BOXES),
                       0.0, 0.0, 1.0).count() == 0


@pytest.mark.parametrize("listed", [10_000, 1])
def test_tiles_between_distant_boxes_are_not_read(spark, monkeypatch, listed):
    monkeypatch.setattr(raster, "TILE_LIST", listed)
    path = scratch_path(spark, "ref-tiles")
    tables.write_map(cells(spark), path, 100)
    # what lies between, or in the row of one box and the column of another, cannot be read
    for tile in ("tile_x=4/tile_y=4", "tile_x=0/tile_y=9", "tile_x=9/tile_y=0")[:3 if listed > 1 else 1]:
        for f in local(path).joinpath(tile).glob("*.parquet"):
            f.write_bytes(b"no parquet")
        for f in local(path).joinpath(tile).glob(".*.crc"):
            f.unlink()
    ref = spark.read.schema("col bigint, row bigint, value bigint, tile_x int, tile_y int").parquet(path)
    got = raster.crop(ref, spark.createDataFrame(FAR, BOXES), 0.0, 0.0, 1.0, tile_size=100)
    assert "dynamicpruning" in got._jdf.queryExecution().executedPlan().toString().lower()
    plain = raster.crop(cells(spark), spark.createDataFrame(FAR, BOXES), 0.0, 0.0, 1.0)
    assert {(r.col, r.row) for r in got.collect()} == {(r.col, r.row) for r in plain.collect()}
    with pytest.raises(Exception):
        raster.crop(ref.drop("tile_x", "tile_y"), spark.createDataFrame([(0.0, -999.0, 999.0, 0.0)], BOXES), 0.0, 0.0, 1.0).collect()


def test_corners_in_another_crs(spark):
    ref = cells(spark)
    got = raster.crop(ref, spark.createDataFrame([(1.0, -1.0, 1.5, -0.5), (90.0, -91.0, 90.5, -90.0)], BOXES), 0.0, 0.0, 1.0,
                      to_ref=lambda x, y: (x * 10, y * 10), block=16)
    rows = {(r.col, r.row) for r in got.collect()}
    assert {(10, 5), (15, 10), (900, 900), (905, 910)} <= rows and not any(20 < c < 880 for c, _ in rows)
