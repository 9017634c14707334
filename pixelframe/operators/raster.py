"""Prediction-raster operators on long pixel tables.

A raster is ``(col, row, value)`` on an affine lattice ``x = x0 + (col + 0.5)·res``,
``y = y0 − (row + 0.5)·res``.  Cell identity is always the integer (col, row) — never a double x/y.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .spatial import checked_broadcast

# Sentinels that mean "no prediction" on the prediction side.
PRED_SENTINELS = (-9223372036854775808, 255)
TARGET_CODE = 8
# Reference tiles that a crop names one by one; above it the scan is pruned by column and by row of tiles.
TILE_LIST = 10_000


def to_cell(x: Column | str, y: Column | str, x0: float, y0: float, res: float) -> tuple[Column, Column]:
    """Inverse affine, nearest cell: the cell whose footprint holds (x, y)."""
    x = F.col(x) if isinstance(x, str) else x
    y = F.col(y) if isinstance(y, str) else y
    return (F.floor((x - F.lit(x0)) / F.lit(res)).alias("col"),
            F.floor((F.lit(y0) - y) / F.lit(res)).alias("row"))


def cell_centre(col: Column | str, row: Column | str, x0: float, y0: float, res: float) -> tuple[Column, Column]:
    col = F.col(col) if isinstance(col, str) else col
    row = F.col(row) if isinstance(row, str) else row
    return (F.lit(x0) + (col + 0.5) * F.lit(res)).alias("x"), (F.lit(y0) - (row + 0.5) * F.lit(res)).alias("y")


def cast_pred(df: DataFrame, pred: str = "pred") -> DataFrame:
    """Class labels as a small integer (R3); Spark has no unsigned byte, smallint holds 0..255."""
    return df.withColumn(pred, F.col(pred).cast("smallint"))


def clamp(df: DataFrame, pred: str = "pred", lo: int = 0, hi: int = 1) -> DataFrame:
    """Clamp to ``lo..hi``."""
    return df.withColumn(pred, F.least(F.greatest(F.col(pred), F.lit(lo)), F.lit(hi)).cast(df.schema[pred].dataType))


def mosaic_first(df: DataFrame, keys: tuple[str, str] = ("col", "row"), pred: str = "pred",
                 order: list[str] | None = None) -> DataFrame:
    """Overlapping grids → one value per cell (R5): the non-missing value of the lowest grid id wins.

    ``min_by`` under a hash aggregate: partial per task, one shuffle on the cell key.  Cells hold only
    as many rows as grids overlap there, so no key can be hot.
    """
    order = list(order or ["grid_id"])
    rank = F.struct(*[F.col(c) for c in order]) if len(order) > 1 else F.col(order[0])
    return (df.where(F.col(pred).isNotNull()).groupBy(*keys)
            .agg(F.min_by(F.col(pred), rank).alias(pred),
                 *([F.min(order[0]).alias(order[0])] if order[0] not in ("x", "y") else [])))


def crop(reference: DataFrame, boxes: DataFrame, x0: float, y0: float, res: float, to_ref=None,
         tile_size: int | None = None, block: int = 2048) -> DataFrame:
    """The reference cells within the bounds of any of ``boxes`` (R8), one cell more on each side.

    Every box is cut into the blocks of cells it covers, and a cell meets them by an equality on its block:
    distant boxes read what lies under them, not what lies between.  A reference that is partitioned by
    ``tile_x, tile_y = floor(col / tile_size), floor(row / tile_size)`` (as :func:`sources.tables.write_map`
    writes) names its ``tile_size``: tiles are then the blocks, and only folders under some box are read.  Up to
    TILE_LIST tiles are named to the scan; beyond, dynamic partition pruning leaves the folders whose ``tile_x``
    and whose ``tile_y`` occur.  The range of all boxes goes to the scan as a filter on ``col`` and ``row``.
    ``to_ref`` brings a box's corners into the reference's CRS; a tenth of its extent more covers sides that
    bend there.  Boxes with a null or non-finite corner hold no cells; no boxes: no rows.
    """
    span = _cell_ranges(boxes, x0, y0, res, to_ref)
    m = span.agg(F.min("_c0"), F.max("_c1"), F.min("_r0"), F.max("_r1")).first()
    if m[0] is None:
        return reference.limit(0)
    size = F.lit(int(tile_size or block))
    for k, lo, hi in (("_bx", "_c0", "_c1"), ("_by", "_r0", "_r1")):
        span = span.withColumn(k, F.explode(F.sequence(F.floor(F.col(lo) / size), F.floor(F.col(hi) / size))))
    ranged = reference.where(F.col("col").between(m[0], m[1]) & F.col("row").between(m[2], m[3]))
    if tile_size:
        under = span.select("_bx", "_by").distinct().limit(TILE_LIST + 1).collect()
        if len(under) <= TILE_LIST:
            ranged = ranged.where(F.concat_ws(",", "tile_x", "tile_y").isin([f"{r['_bx']},{r['_by']}" for r in under]))
        # keys typed like the partition columns, so that the join compares the bare column
        tx, ty = ranged["tile_x"], ranged["tile_y"]
        span = (span.withColumn("_bx", F.col("_bx").cast(reference.schema["tile_x"].dataType))
                .withColumn("_by", F.col("_by").cast(reference.schema["tile_y"].dataType)))
    else:
        tx, ty = F.floor(ranged["col"] / size), F.floor(ranged["row"] / size)
    # a comparison on the boxes' side: what Spark takes as selective for dynamic partition pruning
    span = checked_broadcast(span.where("_c0 <= _c1"))
    inside = ranged["col"].between(span["_c0"], span["_c1"]) & ranged["row"].between(span["_r0"], span["_r1"])
    return ranged.join(span, (tx == span["_bx"]) & (ty == span["_by"]) & inside, "left_semi")


def _cell_ranges(boxes: DataFrame, x0: float, y0: float, res: float, to_ref) -> DataFrame:
    """``_c0, _c1, _r0, _r1``: the columns and rows of each different box, both ends included."""
    corners = F.explode(F.array(*[F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
                                  for x in ("minx", "maxx") for y in ("miny", "maxy")])).alias("p")
    key = ["minx", "miny", "maxx", "maxy"]
    p = boxes.select(*key).distinct().select(*key, corners).select(*key, "p.x", "p.y")
    if to_ref is not None:
        x, y = to_ref(F.col("x"), F.col("y"))
        p = p.select(*key, x.alias("x"), y.alias("y"))
    fine = F.lit(True)
    for c in ("x", "y"):
        fine = fine & F.coalesce(F.abs(c) < float("inf"), F.lit(False))
    p = p.withColumn("_fine", fine).groupBy(*key).agg(
        F.min("x").alias("ax"), F.max("x").alias("bx"), F.min("y").alias("ay"), F.max("y").alias("by"), F.min("_fine").alias("_fine"))
    bend = 0.0 if to_ref is None else 0.1
    mx, my = (F.lit(res) + bend * (F.col(b) - F.col(a)) for a, b in (("ax", "bx"), ("ay", "by")))
    return p.where("_fine").select(
        F.floor((F.col("ax") - mx - x0) / res).alias("_c0"), F.ceil((F.col("bx") + mx - x0) / res).alias("_c1"),
        F.floor((y0 - F.col("by") - my) / res).alias("_r0"), F.ceil((y0 - F.col("ay") + my) / res).alias("_r1"))


def mask_sentinels(df: DataFrame, pred: str = "pred", sentinels=PRED_SENTINELS) -> DataFrame:
    """Sentinel predictions → NULL."""
    c = F.col(pred)
    for s in sentinels:
        c = F.when(c.cast("bigint") == F.lit(s).cast("bigint"), F.lit(None)).otherwise(c)
    return df.withColumn(pred, c.cast(df.schema[pred].dataType))


def drop_unpaired(df: DataFrame, cols: tuple[str, str] = ("pred", "value")) -> DataFrame:
    """Drop pairs missing on either side."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    return df.where(cond)


def binarise(df: DataFrame, value: str = "value", target: int = TARGET_CODE, out: str = "truth") -> DataFrame:
    """Truth = 1 where the reference code equals ``target``."""
    return df.withColumn(out, (F.col(value) == F.lit(target)).cast("int"))


def align_nearest(pred: DataFrame, reference: DataFrame, pred_x0: float, pred_y0: float, pred_res: float,
                  ref_x0: float, ref_y0: float, ref_res: float, keys: list[str] | None = None,
                  ref_to_pred=None) -> DataFrame:
    """Prediction resampled onto the reference lattice by nearest neighbour.

    For every reference cell centre the prediction cell holding it is found by the inverse affine and
    joined on integer (col, row) — an equi-join, planned as hash/sort-merge join on the cell key.
    ``keys`` (e.g. ``grid_id``) stay with the prediction side.  When the two maps are in different CRSs,
    ``ref_to_pred(x, y) -> (x', y')`` takes reference cell centres into the prediction CRS first (R7):
    the prediction is resampled at the *target* cell centres, as a warp to the reference grid does.
    """
    keys = list(keys or [])
    rx, ry = cell_centre(F.col("col"), F.col("row"), ref_x0, ref_y0, ref_res)
    if ref_to_pred is not None:
        tx, ty = ref_to_pred(rx, ry)
        rx, ry = tx.alias("x"), ty.alias("y")
    ref = reference.select(F.col("col").alias("ref_col"), F.col("row").alias("ref_row"), "value", rx, ry)
    pc, pr = to_cell(F.col("x"), F.col("y"), pred_x0, pred_y0, pred_res)
    ref = ref.select("*", pc.alias("_pc"), pr.alias("_pr")).drop("x", "y")
    p = pred.select(*keys, F.col("col").alias("_pc"), F.col("row").alias("_pr"), "pred")
    return ref.join(p, ["_pc", "_pr"], "inner").drop("_pc", "_pr")


def with_legend(df: DataFrame, legend: DataFrame, pred: str = "pred") -> DataFrame:
    """Class code → display name/colour (R12): the legend is a handful of rows, broadcast after a count."""
    lg = checked_broadcast(legend.withColumnRenamed("code", "_code"), max_rows=10_000)
    return df.join(lg, F.col(pred) == F.col("_code"), "left").drop("_code")
