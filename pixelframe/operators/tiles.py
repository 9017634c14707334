"""Dense tiles in bounded chunks (S8, P8): no row holds a whole tile, and a region reads the chunks under it.

A chunk is a tile's row with ``row0, col0``, its own ``h, w`` and the tile's ``affine``: coordinates come out as
those of the whole tile, bit by bit.  ``minx … maxy`` bound its cells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .raster import TILE_LIST
from .spatial import checked_broadcast

BOUNDS = ("minx", "miny", "maxx", "maxy")


def with_bounds(chunks: DataFrame) -> DataFrame:
    """``minx, miny, maxx, maxy`` of a chunk (or a whole tile) from its affine transform, turned ones included."""
    a = F.col("affine")
    r0, c0 = (F.col("row0"), F.col("col0")) if "row0" in chunks.columns else (F.lit(0), F.lit(0))
    corners = [(r, c) for r in (r0, r0 + F.col("h")) for c in (c0, c0 + F.col("w"))]
    xs, ys = ([a[k] + c * a[k + 1] + r * a[k + 2] for r, c in corners] for k in (0, 3))
    return chunks.withColumns(dict(zip(BOUNDS, (F.least(*xs), F.least(*ys), F.greatest(*xs), F.greatest(*ys)))))


def chunk_tiles(tiles: DataFrame, side: int = 64, keep: list[str] | None = None) -> DataFrame:
    """Whole-tile rows (``h, w, affine, data``) → chunks of at most ``side`` × ``side`` pixels, without a shuffle.

    For tables that hold whole tiles already; :func:`chunk_pixels` never has one in a row.  A tile without data,
    without rows or without columns has no chunks.
    """
    at = lambda i, n: F.least(F.lit(side), F.col(n) - i * side)
    parts = lambda n: F.sequence(F.lit(0), F.floor((F.col(n) - 1) / side).cast("int"))
    w = F.col("w")

    def piece(r: Column, c: Column) -> Column:
        rows = F.transform(F.sequence(r * side, r * side + at(r, "h") - 1),
                           lambda y: F.slice("data", y * w + c * side + 1, at(c, "w")))
        return F.struct((r * side).alias("row0"), (c * side).alias("col0"), at(r, "h").alias("h"), at(c, "w").alias("w"),
                        F.flatten(rows).alias("data"))

    cut = F.transform(parts("h"), lambda r: F.transform(parts("w"), lambda c: piece(r, c)))
    some = tiles.where("data is not null and h > 0 and w > 0")
    out = some.select(*(keep or []), "affine", F.explode(F.flatten(cut)).alias("_c")).select(*(keep or []), "affine", "_c.*")
    return with_bounds(out)


def chunk_pixels(pixels: DataFrame, tiles: DataFrame, keys: list[str], side: int = 64) -> DataFrame:
    """Pixels (``keys, row, col, bands``) and their tiles (``keys, h, w, affine``) → chunks.

    One shuffle by chunk; a group has at most ``side²`` pixels.  Absent pixels of a chunk are NULL, a chunk
    without pixels is absent, as are pixels of no listed tile.  Two rows for one pixel, or one outside its tile,
    raise.
    """
    part = lambda c: F.floor(F.col(c) / side).cast("int") * side
    got = (pixels.select(*keys, part("row").alias("row0"), part("col").alias("col0"), F.struct("row", "col", "bands").alias("_p"))
           .groupBy(*keys, "row0", "col0").agg(F.collect_list("_p").alias("_p")))
    got = got.join(tiles.select(*keys, F.col("h").alias("_h"), F.col("w").alias("_w"), "affine"), keys)
    got = (got.withColumn("h", F.least(F.lit(side), F.col("_h") - F.col("row0")).cast("int"))
           .withColumn("w", F.least(F.lit(side), F.col("_w") - F.col("col0")).cast("int")))
    fits = lambda p: (p["row"] >= 0) & (p["col"] >= 0) & (p["row"] < F.col("_h")) & (p["col"] < F.col("_w"))
    got = got.withColumn("_p", F.when(F.forall("_p", lambda p: F.coalesce(fits(p), F.lit(False))), F.col("_p"))
                         .otherwise(F.raise_error(F.lit("a pixel lies outside its tile"))))
    # pixels by place; each brings the gap before it
    place = lambda p: ((p["row"] - F.col("row0")) * F.col("w") + p["col"] - F.col("col0")).cast("int")
    got = got.withColumn("_p", F.array_sort(F.transform("_p", lambda p: F.struct(place(p).alias("at"), p["bands"].alias("bands"))),
                                            lambda a, b: a["at"] - b["at"]))
    ats = F.transform("_p", lambda p: p["at"])
    last = F.concat(F.array(F.lit(-1)), F.slice(ats, 1, F.size(ats) - 1))
    null = F.lit(None).cast(pixels.schema["bands"].dataType)

    def one(before: Column, p: Column) -> Column:
        gap = p["at"] - before - 1
        twice = F.raise_error(F.lit("a pixel of a tile comes twice")).cast("int")
        return F.concat(F.array_repeat(null, F.when(gap < 0, twice).otherwise(gap)), F.array(p["bands"]))

    rest = F.array_repeat(null, F.col("h") * F.col("w") - 1 - F.element_at(ats, -1))
    data = F.concat(F.flatten(F.zip_with(last, F.col("_p"), one)), rest)
    return with_bounds(got.select(*keys, "affine", "row0", "col0", "h", "w", data.alias("data")))


def write_chunks(chunks: DataFrame, path: str, bin_size: float, partition_by: list[str] | None = None,
                 mode: str = "overwrite") -> None:
    """Chunks → parquet in folders ``bin_x, bin_y`` of their lower left corner, after those of ``partition_by``.

    No chunk may be wider or higher than ``bin_size``; one that is raises.
    """
    size = F.lit(float(bin_size))
    wide = F.greatest(F.col("maxx") - F.col("minx"), F.col("maxy") - F.col("miny")) > size
    key = lambda c: F.when(wide, F.raise_error(F.lit("a chunk is larger than bin_size")).cast("long")).otherwise(
        F.floor(F.col(c) / size))
    folders = [*(partition_by or []), "bin_x", "bin_y"]
    out = chunks.withColumn("bin_x", key("minx")).withColumn("bin_y", key("miny"))
    # AQE may cut a bin with very many chunks into several files
    out.repartition(*folders).sortWithinPartitions(*folders, "miny", "minx").write.mode(mode).partitionBy(*folders).parquet(path)


def chunks_under(chunks: DataFrame, regions: DataFrame, bin_size: float) -> DataFrame:
    """The chunks, as :func:`write_chunks` keeps them, whose bounds meet those of some region.

    Only folders near a region are read: up to TILE_LIST of them are named to the scan, beyond, dynamic partition
    pruning works by either key.  Regions without finite bounds meet nothing.
    """
    b = F.lit(float(bin_size))
    fine = F.lit(True)
    for c in BOUNDS:
        fine = fine & F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    box = regions.where(fine).select(*[F.col(c).alias("_" + c) for c in BOUNDS]).distinct()
    m = box.agg(F.min("_minx"), F.min("_miny"), F.max("_maxx"), F.max("_maxy")).first()
    if m[0] is None:
        return chunks.limit(0)
    # a chunk reaches at most one bin beyond the one its corner lies in
    for k, lo, hi in (("_bx", "_minx", "_maxx"), ("_by", "_miny", "_maxy")):
        box = box.withColumn(k, F.explode(F.sequence(F.floor(F.col(lo) / b) - 1, F.floor(F.col(hi) / b))))
    near = chunks.where((F.col("maxx") >= m[0]) & (F.col("maxy") >= m[1]) & (F.col("minx") <= m[2]) & (F.col("miny") <= m[3]))
    under = box.select("_bx", "_by").distinct().limit(TILE_LIST + 1).collect()
    if len(under) <= TILE_LIST:
        near = near.where(F.concat_ws(",", "bin_x", "bin_y").isin([f"{r['_bx']},{r['_by']}" for r in under]))
    box = (box.withColumn("_bx", F.col("_bx").cast(chunks.schema["bin_x"].dataType))
           .withColumn("_by", F.col("_by").cast(chunks.schema["bin_y"].dataType)))
    # a comparison on the regions' side: what Spark takes as selective for dynamic partition pruning
    box = checked_broadcast(box.where("_minx <= _maxx"))
    meet = ((near["minx"] <= box["_maxx"]) & (near["maxx"] >= box["_minx"])
            & (near["miny"] <= box["_maxy"]) & (near["maxy"] >= box["_miny"]))
    return near.join(box, (near["bin_x"] == box["_bx"]) & (near["bin_y"] == box["_by"]) & meet, "left_semi")
