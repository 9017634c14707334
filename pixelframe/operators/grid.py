"""Processing grids over regions.

Cells are stepped over each region's bounds and kept when they intersect the polygon (touching counts).  An
ordinary region is tested where it stands, many regions in one numpy pass and nothing shuffled but the regions.
Where cells × edges of one region would be much work, no cell meets an edge list: each edge walks
through the cells it crosses, and the cells between are filled by parity along their row.  A region is identified by (region_id, part) and a cell by (region_id, part, ix,
iy); the grid id is that key as text, so it is unique for every part, has no range to overflow and is
stable under any partitioning.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..functions import geo
from ..session import materialize
from . import regions as R
from .cover import _edges_of
from .spatial import SPREAD_WORK_LIMIT

#: Cell–edge tests of one numpy pass, unless a single region has more.
PASS_TESTS = 500_000


def grid_id_expr(region_id, part, ix, iy):
    """``region_id:part:ix:iy`` as text; an unsplit region has ix = iy = −1."""
    return F.concat_ws(":", *[c.cast("string") for c in (region_id, part, ix, iy)])


def _with_part(regions: DataFrame) -> DataFrame:
    """Regions without a ``part`` column are single parts."""
    return regions if "part" in regions.columns else regions.withColumn("part", F.lit(0))


def grid_cells(regions: DataFrame, grid_size: float = 5000.0, overlap: float = 100.0,
               keep_intersecting: bool = True) -> DataFrame:
    """Square cells of ``grid_size`` stepping by ``grid_size − overlap`` from each region's lower-left
    bound, x-major (G6); the last cells may pass the bound.  Optionally only cells meeting the polygon (G7).

    A region of up to ``SPREAD_WORK_LIMIT`` cell–edge tests is tested in its task (:func:`tested_cells`); for larger
    ones, :func:`walked_cells` finds the same cells with work in proportion to perimeter and output.
    (region_id, part) must be unique in ``regions``.
    """
    regions = _with_part(regions)
    step = float(grid_size) - float(overlap)
    if step <= 0:
        raise ValueError("overlap must be smaller than grid_size (step would not advance)")
    size = float(grid_size)
    # zero-width bounds give no cells (sequence(0, -1) would count down)
    boxes = (regions.withColumn("_nx", F.ceil((F.col("maxx") - F.col("minx")) / step).cast("int"))
             .withColumn("_ny", F.ceil((F.col("maxy") - F.col("miny")) / step).cast("int")).where("_nx > 0 and _ny > 0"))
    if keep_intersecting:
        large = F.col("_nx").cast("double") * F.col("_ny") * F.size("edges") > SPREAD_WORK_LIMIT
        cells = tested_cells(boxes.where(~large), step, size)
        if not boxes.where(large).isEmpty():
            cells = cells.unionByName(walked_cells(boxes.where(large).drop("_nx", "_ny"), step, size).select(*cells.columns))
        return _as_cells(cells, step, size)
    cells = (boxes.withColumn("ix", F.explode(F.sequence(F.lit(0), F.col("_nx") - 1)))
             .withColumn("iy", F.explode(F.sequence(F.lit(0), F.col("_ny") - 1))))
    return _as_cells(cells, step, size)


def tested_cells(boxes: DataFrame, step: float, size: float) -> DataFrame:
    """``region_id, part, minx, miny, ix, iy`` of the cells that meet the polygon, for regions with ``_nx × _ny`` cells.

    The tests are those of :func:`geo.box_intersects_polygon`, operation by operation, for some regions at once.
    """
    keep = ["region_id", "part", "minx", "miny"]
    schema = StructType([*boxes.select(*keep).schema.fields, StructField("ix", IntegerType()), StructField("iy", IntegerType())])

    def kept(b: pa.RecordBatch) -> pa.RecordBatch:
        xy, off = _edges_of(b.column("edges"))
        low_x, low_y, nx, ny = (b.column(c).to_numpy() for c in ("minx", "miny", "_nx", "_ny"))
        n_edges, n_cells = np.diff(off), nx.astype(np.int64) * ny
        region = np.repeat(np.arange(b.num_rows), n_cells)
        local = np.arange(len(region)) - np.repeat(np.cumsum(n_cells) - n_cells, n_cells)
        ix, iy = local // ny[region], local % ny[region]
        x0, y0 = low_x[region] + ix * step, low_y[region] + iy * step
        x1, y1 = x0 + size, y0 + size
        tests = n_edges[region]
        first = np.cumsum(tests) - tests
        cell = np.repeat(np.arange(len(region)), tests)
        ax, ay, bx, by = xy[np.repeat(off[region] - first, tests) + np.arange(len(cell))].T
        dx, dy = bx - ax, by - ay
        # the bounds overlap, and the segment's line does not leave all four corners strictly on one side
        left, right, low, high = x0[cell], x1[cell], y0[cell], y1[cell]
        side = [dx * (v - ay) - dy * (u - ax) for u, v in ((left, low), (right, low), (right, high), (left, high))]
        meets = ((np.minimum(ax, bx) <= right) & (np.maximum(ax, bx) >= left) & (np.minimum(ay, by) <= high)
                 & (np.maximum(ay, by) >= low) & (np.minimum.reduce(side) <= 0) & (np.maximum.reduce(side) >= 0))
        px, py = ((x0 + x1) / 2.0)[cell], ((y0 + y1) / 2.0)[cell]
        crossed = ((ay > py) != (by > py)) & ((dx * (py - ay) - (px - ax) * dy) * dy > 0)
        hit = np.logical_or.reduceat(meets, first) | (np.add.reduceat(crossed.astype(np.int64), first) % 2 == 1)
        take = pa.array(region[hit])
        return pa.RecordBatch.from_arrays([*(b.column(c).take(take) for c in keep), pa.array(ix[hit].astype(np.int32)),
                                           pa.array(iy[hit].astype(np.int32))], names=[*keep, "ix", "iy"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            work = np.cumsum(b.column("_nx").to_numpy().astype(np.int64) * b.column("_ny").to_numpy() * b.column("_ne").to_numpy())
            start = 0
            while start < b.num_rows:
                done = work[start - 1] if start else 0
                end = max(start + 1, int(np.searchsorted(work, done + PASS_TESTS, "right")))
                yield kept(b.slice(start, end - start))
                start = end

    # no cell meets a polygon without edges
    some = boxes.select(*keep, "_nx", "_ny", F.size("edges").alias("_ne"), "edges").where("_ne > 0")
    return some.repartition("region_id", "part").mapInArrow(run, schema)


def _as_cells(cells: DataFrame, step: float, size: float) -> DataFrame:
    """Id and bounds of cells ``region_id, part, ix, iy`` of regions whose lower-left bound is ``minx, miny``."""
    x0, y0 = F.col("minx") + F.col("ix") * step, F.col("miny") + F.col("iy") * step
    return cells.select(
        grid_id_expr(F.col("region_id"), F.col("part"), F.col("ix"), F.col("iy")).alias("grid_id"),
        "region_id", "part", "ix", "iy", x0.alias("minx"), y0.alias("miny"), (x0 + size).alias("maxx"), (y0 + size).alias("maxy"))


def walked_cells(regions: DataFrame, step: float, size: float) -> DataFrame:
    """``region_id, part, ix, iy, minx, miny`` of the cells that meet the polygon; ``minx, miny`` are the region's.

    *Border*: an edge explodes into the rows of cells it may touch, its clip to a row into the cells there (one more on
    every side than the arithmetic says), and the exact segment–box test keeps those it meets.
    *Inside*: a cell that no edge meets lies wholly in or out, so the even-odd rule at its centre decides.  An
    edge that straddles a row's centre line toggles the row's first ``k`` cells.  Sorted, these ``k`` are the ends of
    the runs inside; equal ones cancel out before the shuffle.
    Edges are dealt over all tasks first, so one huge polygon is nobody's alone; no edge list meets a cell.
    """
    box = (regions.select("region_id", "part", "minx", "miny", "edges",
                          F.ceil((F.col("maxx") - F.col("minx")) / step).cast("int").alias("_nx"),
                          F.ceil((F.col("maxy") - F.col("miny")) / step).cast("int").alias("_ny"))
           .where((F.col("_nx") > 0) & (F.col("_ny") > 0)))
    key = ["region_id", "part", "minx", "miny", "_nx", "_ny"]
    e = F.col("e")
    edges = box.select(*key, F.explode("edges").alias("e")).repartition(
        "region_id", "part", F.col("e.x1"), F.col("e.y1"), F.col("e.x2"), F.col("e.y2"))
    low, high = F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"])

    def span(first, last, n):
        """All of ``first..last`` that lies in ``0..n - 1``."""
        a, b = F.greatest(first, F.lit(0)).cast("int"), F.least(last, n - 1).cast("int")
        return F.explode(F.when(a <= b, F.sequence(a, b)).otherwise(F.array().cast("array<int>")))

    rows = edges.withColumn("iy", span(F.ceil((low - F.col("miny") - size) / step) - 1,
                                       F.floor((high - F.col("miny")) / step) + 1, F.col("_ny")))
    y0 = F.col("miny") + F.col("iy") * step
    x_at = lambda y: F.coalesce(e["x1"] + F.least(F.greatest(F.try_divide(y - e["y1"], e["y2"] - e["y1"]), F.lit(0.0)), F.lit(1.0))
                                * (e["x2"] - e["x1"]), e["x1"])
    flat = e["y1"] == e["y2"]
    xa, xb = F.when(flat, e["x1"]).otherwise(x_at(y0)), F.when(flat, e["x2"]).otherwise(x_at(y0 + size))
    cells = rows.withColumn("ix", span(F.ceil((F.least(xa, xb) - F.col("minx") - size) / step) - 1,
                                       F.floor((F.greatest(xa, xb) - F.col("minx")) / step) + 1, F.col("_nx")))
    x0 = F.col("minx") + F.col("ix") * step
    border = (cells.where(geo.segment_intersects_box(e, x0, y0, x0 + size, y0 + size))
              .select("region_id", "part", "minx", "miny", "ix", "iy"))

    middle = y0 + size / 2.0
    crossing = rows.where((e["y1"] > middle) != (e["y2"] > middle))
    k = F.ceil((x_at(middle) - F.col("minx") - size / 2.0) / step)
    toggles = (crossing.withColumn("k", F.least(F.greatest(k, F.lit(0)), F.col("_nx")).cast("int"))
               .groupBy("region_id", "part", "minx", "miny", "iy", "k").agg(F.count(F.lit(1)).alias("_n")).where("_n % 2 = 1"))
    row = Window.partitionBy("region_id", "part", "iy").orderBy(F.desc("k"))
    runs = (toggles.withColumn("_r", F.row_number().over(row)).withColumn("_from", F.lead("k", 1, 0).over(row))
            .where((F.col("_r") % 2 == 1) & (F.col("_from") < F.col("k"))))
    inside = runs.select("region_id", "part", "minx", "miny", F.explode(F.sequence(F.col("_from"), F.col("k") - 1)).alias("ix"), "iy")
    return border.unionByName(inside).distinct()


def cells_as_regions(cells: DataFrame) -> DataFrame:
    """Give grid cells box geometry so they can be used wherever regions are."""
    ring = geo.box_ring(F.col("minx"), F.col("miny"), F.col("maxx"), F.col("maxy"))
    return cells.withColumn("rings", F.array(ring)).withColumn("edges", geo.polygon_edges(F.col("rings")))


def add_grids_if_needed(regions: DataFrame, min_area: float = 1e8, grid_size: float = 5000.0,
                        grid_overlap: float = 500.0) -> DataFrame:
    """Area branch (G8/G10/G11): area > ``min_area`` → its intersecting cells, else the region itself."""
    with_area = R.area(_with_part(regions), "_area")
    big = with_area.where(F.col("_area") > F.lit(float(min_area)))
    small = with_area.where(~(F.col("_area") > F.lit(float(min_area))))
    cells = cells_as_regions(grid_cells(big, grid_size, grid_overlap))
    keep_cols = ["grid_id", "region_id", "part", "ix", "iy", "minx", "miny", "maxx", "maxy", "rings", "edges"]
    kept = small.select(
        grid_id_expr(F.col("region_id"), F.col("part"), F.lit(-1), F.lit(-1)).alias("grid_id"), "region_id", "part",
        F.lit(-1).alias("ix"), F.lit(-1).alias("iy"), "minx", "miny", "maxx", "maxy", "rings", "edges")
    return cells.select(*keep_cols).unionByName(kept)


def read_with_grids(regions_4326: DataFrame, min_area: float = 1e8, grid_size: float = 5000.0,
                    grid_overlap: float = 500.0) -> DataFrame:
    """Regions → processing grids: to 3857, area branch, back to 4326."""
    merc = materialize(R.reproject(regions_4326, R.SRID_MERCATOR))
    grids = add_grids_if_needed(merc, min_area, grid_size, grid_overlap)
    # x gives lon and y gives lat, each rising: bounds go to bounds
    low, high = (geo.mercator_to_lonlat(f"{m}x", f"{m}y") for m in ("min", "max"))
    return (grids.withColumn("rings", geo.transform_rings("rings", geo.mercator_to_lonlat))
            .withColumn("edges", geo.transform_edges("edges", geo.mercator_to_lonlat))
            .withColumns(dict(zip(("minx", "miny", "maxx", "maxy"), (*low, *high)))).withColumn("srid", F.lit(R.SRID_LONLAT)))


def sample_grids(grids: DataFrame, n: int | None, seed: int = 42, id_col: str = "grid_id") -> DataFrame:
    """Seeded random subset of ``n`` grids without replacement (G15); ``None``/0 = all.

    A top-k on a seeded hash: ``TakeOrderedAndProject`` keeps k rows per task, then k overall.
    """
    if not n:
        return grids
    key = F.md5(F.concat_ws(":", F.col(id_col).cast("string"), F.lit(str(seed))))
    return grids.withColumn("_k", key).orderBy("_k", id_col).limit(int(n)).drop("_k")

