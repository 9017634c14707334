"""Hierarchical covers of regions: large cells inside, small cells along the border.

A cell of level ``l`` is ``bin_size * 4**l`` wide, so the cell of a point at any level is a prefix of its bin:
``bin >> 2 l``.  A region descends from the few cells that hold its bounds.  A cell that no edge comes near is
all inside or all outside and ends there; the others split into sixteen.  The rows of a cover thus follow the
region's perimeter and not its area, and a cell is only ever tested against the edges of the cell above it.

A border cell carries what the even-odd ray to the right needs and no more: the edges near the cell, and for
all edges beyond its right side the heights (``_flips``) at which the parity of those crossed changes, with the
parity at its lower side (``_odd``).  Heights where one edge beyond takes over from another cancel, so there are
about as many as edges near the cell.  The answers are those of the ray against the whole polygon.

A plain region, of few edges and cells, needs no descent: its smallest cells meet its edges, many regions in one numpy
pass, and carry the few edges their points need in columns of their own (:func:`plain_cells`), so the test is compiled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, IntegerType, LongType, StructField, StructType

from ..functions.geo import point_in_polygon

#: Cells with more edges than this are dealt to other tasks before they split further.
SPREAD_EDGES = 4096
#: Rows and edges of a batch that leaves a task.
BATCH_ROWS, BATCH_EDGES = 4096, 200_000
#: A plain region has at most so many edges, cells of the smallest size, and edges at one height.
PLAIN_EDGES, PLAIN_CELLS, PLAIN_SLOTS = 32, 256, 4
PLAIN_EDGE_COLS = tuple(f"_{k}{i}" for i in range(PLAIN_SLOTS) for k in ("ax", "ay", "dx", "dy"))
#: Cell–edge pairs of one numpy pass over plain regions, unless a single region has more.
PASS_TESTS = 100_000
BOUNDS = ("minx", "miny", "maxx", "maxy")
_EDGE = ("x1", "y1", "x2", "y2")


def _narrow(e: np.ndarray, flips: np.ndarray, odd: bool, xs: np.ndarray, ys: np.ndarray, s: float, margin: float):
    """``i, j, edges, flips, odd`` of the cells at columns ``xs`` and rows ``ys`` of width ``s``, from those of a
    cell around them; cells outside the region, away from its edges, are left out."""
    x1, y1, x2, y2 = e.T
    left, right = xs[:, None] * s - margin, (xs[:, None] + 1) * s + margin
    lo, hi = ys[:, None] * s - margin, (ys[:, None] + 1) * s + margin
    bottom, top = np.minimum(y1, y2), np.maximum(y1, y2)
    in_x = (np.minimum(x1, x2) <= right) & (np.maximum(x1, x2) >= left)
    in_y = (bottom <= hi) & (top >= lo)
    # which edges meet the closed boxes: overlapping bounds, and corners not all on one side of the line
    up = np.sort(np.stack([(x2 - x1) * (lo - y1), (x2 - x1) * (hi - y1)]), 0)
    along = np.sort(np.stack([(y2 - y1) * (left - x1), (y2 - y1) * (right - x1)]), 0)
    # the others, within a cell's rows, lie on one side of it: look half-way up their part there
    mid = (np.maximum(bottom, lo) + np.minimum(top, hi)) / 2
    level = y1 == y2
    cross = x1 + (mid - y1) * ((x2 - x1) / np.where(level, 1.0, y2 - y1))
    for i, x in enumerate(xs.tolist()):
        near = in_y & in_x[i] & (up[0] - along[1, i] <= 0) & (up[1] - along[0, i] >= 0)
        beyond = in_y & ~near & ~level & (cross > (x + 0.5) * s)
        for j, y in enumerate(ys.tolist()):
            f, o = flips, odd
            if beyond[j].any():
                f = np.concatenate([f, y1[beyond[j]], y2[beyond[j]]])
            if len(f):
                values, times = np.unique(f, return_counts=True)
                values = values[times % 2 == 1]
                o ^= bool(np.searchsorted(values, lo[j, 0], "right") % 2)
                f = values[(values > lo[j, 0]) & (values <= hi[j, 0])]
            if o or len(f) or near[j].any():
                yield x, y, e[near[j]], f, o


def _descend(cell: tuple, size: float, margin: float, cap: int, most: int | None) -> Iterator[tuple]:
    """The cover of ``(level, cx, cy, edges, flips, odd)``: ended cells, depth first.

    With ``most``, cells of no more than so many edges come out as they are, unfinished.
    """
    todo = [cell]
    while todo:
        lv, cx, cy, e, flips, odd = todo.pop()
        even = not len(e) and not len(flips)
        if even and not odd:
            continue
        if lv <= cap and (even or lv == 0) or most is not None and len(e) <= most:
            yield lv, cx, cy, e, flips, odd
            continue
        for child in _narrow(e, flips, odd, np.arange(4 * cx, 4 * cx + 4), np.arange(4 * cy, 4 * cy + 4),
                             size * 4 ** (lv - 1), margin):
            todo.append((lv - 1, *child))


def _edges_of(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    flat = col.flatten()
    xy = np.stack([flat.field(k).to_numpy(zero_copy_only=False) for k in _EDGE], 1) if len(flat) else np.zeros((0, 4))
    return xy, np.concatenate([[0], np.cumsum(col.value_lengths().fill_null(0).to_numpy())])


def cover(regions: DataFrame, bin_size: float, region_cols: list[str], tile_size: float | None = None) -> DataFrame:
    """``region_cols, bounds, _lv, _cx, _cy, _full, _edges, _flips, _odd``: the cells under each region.

    No two cells of a region overlap.  ``tile_size``: no cell is larger than such a tile.  Regions without
    edges have no cells.  A first pass splits only cells of more than SPREAD_EDGES edges; the parts are dealt
    over the tasks, which finish them.
    """
    size, cap = float(bin_size), 31
    if tile_size is not None:
        ratio, cap = int(round(tile_size / size)), 0
        while ratio % 4 ** (cap + 1) == 0 and cap < 31:
            cap += 1
    keep = list(dict.fromkeys([*region_cols, *BOUNDS]))
    edge = ArrayType(StructType([StructField(k, DoubleType()) for k in _EDGE]))
    schema = StructType([*(regions.select(*keep).schema.fields), StructField("_lv", IntegerType()),
                         StructField("_cx", LongType()), StructField("_cy", LongType()), StructField("_edges", edge),
                         StructField("_flips", ArrayType(DoubleType())), StructField("_odd", BooleanType())])
    names = schema.fieldNames()
    at = {k: names.index(k) for k in names}
    edge_type = to_arrow_type(edge)

    def batch(source: pa.RecordBatch, rows: list[tuple]) -> pa.RecordBatch:
        take = pa.array([r[0] for r in rows], pa.int64())
        e = np.concatenate([r[4] for r in rows])
        f = np.concatenate([r[5] for r in rows])
        offsets = [pa.array(np.cumsum([0, *(len(r[k]) for r in rows)]).astype(np.int32)) for k in (4, 5)]
        points = pa.StructArray.from_arrays([pa.array(e[:, k]) for k in range(4)], fields=list(edge_type.value_type))
        made = [pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.int64()),
                pa.array([r[3] for r in rows], pa.int64()), pa.ListArray.from_arrays(offsets[0], points),
                pa.ListArray.from_arrays(offsets[1], pa.array(f)), pa.array([bool(r[6]) for r in rows])]
        return pa.RecordBatch.from_arrays([*(source.column(k).take(take) for k in keep), *made], names=names)

    def run(batches: Iterator[pa.RecordBatch], first: bool) -> Iterator[pa.RecordBatch]:
        for b in batches:
            xy, off = _edges_of(b.column("edges" if first else "_edges"))
            low_x, low_y, high_x, high_y = (b.column(k).to_numpy(zero_copy_only=False) for k in BOUNDS)
            rows, held = [], 0
            for i in range(b.num_rows):
                e = xy[off[i]:off[i + 1]]
                box = (low_x[i], low_y[i], high_x[i], high_y[i])
                if first and not len(e):
                    continue
                margin = size * 1e-6 + 1e-12 * float(np.abs(box).max())
                if first:
                    wide = max(box[2] - box[0], box[3] - box[1], size)
                    lv = max(0, math.ceil(math.log(wide / size, 4)))
                    s = size * 4 ** lv
                    xs, ys = (np.arange(math.floor(box[k] / s), math.floor(box[k + 2] / s) + 1) for k in (0, 1))
                    cells = [(lv, *c) for c in _narrow(e, np.zeros(0), False, xs, ys, s, margin)]
                else:
                    cells = [(*(b.column(at[k])[i].as_py() for k in ("_lv", "_cx", "_cy")), e,
                              np.array(b.column(at["_flips"])[i].as_py() or [], float), b.column(at["_odd"])[i].as_py())]
                for cell in cells:
                    for c in _descend(cell, size, margin, cap, SPREAD_EDGES if first else None):
                        rows.append((i, *c))
                        held += len(c[3])
                        if len(rows) >= BATCH_ROWS or held >= BATCH_EDGES:
                            yield batch(b, rows)
                            rows, held = [], 0
            if rows:
                yield batch(b, rows)

    parts = regions.select(*keep, "edges").mapInArrow(lambda it: run(it, True), schema)
    ends = parts.repartition(*keep, "_lv", "_cx", "_cy").mapInArrow(lambda it: run(it, False), schema)
    return ends.withColumn("_full", (F.size("_edges") == 0) & (F.size("_flips") == 0))


def is_plain(bin_size: float) -> Column:
    """Whether a region is plain: few edges, few cells, and at no height more than PLAIN_SLOTS edges side by side."""
    b = F.lit(float(bin_size))
    nx, ny = (F.floor(F.col(f"max{k}") / b).cast("double") - F.floor(F.col(f"min{k}") / b) + 1 for k in "xy")
    few = F.size("edges").between(1, PLAIN_EDGES) & (nx * ny <= PLAIN_CELLS) & ~F.isnan("maxx") & ~F.isnan("maxy")

    def beside(v: Column) -> Column:
        """The edges at the height where ``v`` begins; nowhere else do they grow in number."""
        h = F.least(v["y1"], v["y2"])
        return F.filter("edges", lambda e: (e["y1"] > h) != (e["y2"] > h))

    slots = F.forall("edges", lambda v: F.size(beside(v)) <= PLAIN_SLOTS)
    return F.coalesce(F.when(few, slots), F.lit(False))


def _ranges(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which range, and which of its whole numbers, for all of ``low..high`` of each."""
    n = np.maximum(high - low + 1, 0)
    which = np.repeat(np.arange(len(n)), n)
    return which, low[which] + np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)


def plain_cells(regions: DataFrame, bin_size: float, region_cols: list[str]) -> DataFrame:
    """``region_cols, minx, maxx, _cx, _cy, _low, _high, _odd, _ax1, _ay1, _dx1, _dy1, …``: plain regions by cells and strips.

    The ends of a region's edges cut it into strips ``_low <= y < _high``, in each of which the same edges cross every ray.
    A strip's part of a cell of the smallest size carries the edges near it (start and direction, noughts for none) and
    whether the number of those beyond its right side is odd.  Parts outside the region are left out.  A point lies in one
    part of a region at most.  Regions are dealt over the tasks; each meets its own edges only, many in one numpy pass.
    """
    size = float(bin_size)
    keep = list(dict.fromkeys([*region_cols, "minx", "maxx"]))
    made = ["_cx", "_cy", "_low", "_high", "_odd", *PLAIN_EDGE_COLS]
    types = [LongType(), LongType(), DoubleType(), DoubleType(), BooleanType(), *[DoubleType()] * len(PLAIN_EDGE_COLS)]
    schema = StructType([*regions.select(*keep).schema.fields, *(StructField(c, t, False) for c, t in zip(made, types))])

    def cells(b: pa.RecordBatch) -> pa.RecordBatch:
        xy, off = _edges_of(b.column("edges"))
        low_x, low_y, high_x, high_y = box = np.stack([b.column(k).to_numpy(zero_copy_only=False) for k in BOUNDS])
        margin = size * 1e-6 + 1e-12 * np.abs(box).max(0)
        ends = np.unique(np.stack([np.repeat(np.repeat(np.arange(b.num_rows), np.diff(off)), 2), xy[:, [1, 3]].ravel()], 1), axis=0)
        ends = ends[np.isfinite(ends[:, 1])]
        strip = np.flatnonzero(ends[1:, 0] == ends[:-1, 0])
        region, low, high = ends[strip, 0].astype(np.int64), ends[strip, 1], ends[strip + 1, 1]
        # the edges of each strip
        of, edge = _ranges(off[region], off[region + 1] - 1)
        there = (np.minimum(xy[edge, 1], xy[edge, 3]) <= low[of]) & (np.maximum(xy[edge, 1], xy[edge, 3]) > low[of])
        of, edge = of[there], edge[there]
        first = np.searchsorted(of, np.arange(len(strip) + 1))
        # its parts by rows and columns of cells
        of, cy = _ranges(*(np.floor(v / size).astype(np.int64) for v in (low, high)))
        row, cx = _ranges(*(np.floor(v[region[of]] / size).astype(np.int64) for v in (low_x, high_x)))
        of, cy = of[row], cy[row]
        m = margin[region[of]]
        part, at = _ranges(first[of], first[of + 1] - 1)
        ax, ay, bx, by = xy[edge[at]].T
        dx, dy = bx - ax, by - ay
        left, right, bottom, top = (v[part] for v in (cx * size - m, (cx + 1) * size + m, np.maximum(low[of], cy * size - m),
                                                      np.minimum(high[of], (cy + 1) * size + m)))
        # above nought where the edge crosses the ray to the right from a corner
        side = [(dx * (v - ay) - (u - ax) * dy) * np.sign(dy) for u, v in ((left, bottom), (right, bottom), (right, top), (left, top))]
        beyond, near = np.minimum.reduce(side) > 0, np.maximum.reduce(side) >= 0
        near &= ~beyond
        odd = np.bincount(part, beyond, len(cx)).astype(np.int64) % 2 == 1
        n = np.bincount(part, near, len(cx)).astype(np.int64)
        out = odd | (n > 0)
        slots = np.zeros((len(cx), PLAIN_SLOTS, 4))
        p = part[near]
        slots[p, np.arange(len(p)) - (np.cumsum(n) - n)[p]] = np.stack([ax, ay, dx, dy], 1)[near]
        take = pa.array(region[of[out]])
        values = [cx, cy, low[of], high[of], odd, *slots.reshape(len(cx), len(PLAIN_EDGE_COLS)).T]
        return pa.RecordBatch.from_arrays([*(b.column(c).take(take) for c in keep), *(pa.array(v[out]) for v in values)],
                                          names=schema.fieldNames())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            low_x, low_y, high_x, high_y = (np.floor(b.column(k).to_numpy(zero_copy_only=False) / size) for k in BOUNDS)
            work = np.cumsum((high_x - low_x + 1) * (high_y - low_y + 1) * b.column("edges").value_lengths().to_numpy())
            start = 0
            while start < b.num_rows:
                end = max(start + 1, int(np.searchsorted(work, (work[start - 1] if start else 0) + PASS_TESTS, "right")))
                yield cells(b.slice(start, end - start))
                start = end

    some = list(dict.fromkeys([*keep, *BOUNDS]))
    return regions.select(*some, "edges").repartition(*some).mapInArrow(run, schema)


def plain_inside(px: Column, py: Column) -> Column:
    """Whether a point of its cell is inside, by the edges of :func:`plain_cells`: even-odd, without a lambda."""
    odd = F.col("_odd")
    for i in range(0, len(PLAIN_EDGE_COLS), 4):
        ax, ay, dx, dy = (F.col(c) for c in PLAIN_EDGE_COLS[i:i + 4])
        odd = odd != ((dx * (py - ay) - (px - ax) * dy) * dy > 0)
    return (py >= F.col("_low")) & (py < F.col("_high")) & px.between(F.col("_minx"), F.col("_maxx")) & odd


def inside(px: Column, py: Column) -> Column:
    """Whether a point of a cover's cell is inside the region."""
    flipped = F.size(F.filter("_flips", lambda f: f <= py)) % 2 == 1
    return F.col("_full") | ((F.col("_odd") != flipped) != point_in_polygon(F.col("_edges"), px, py))


def levels_of(cells: DataFrame) -> list[int]:
    """The levels that occur, lowest first: at most 32."""
    return sorted(r[0] for r in cells.select("_lv").distinct().collect())


def without_nested(cells: DataFrame, levels: list[int]) -> DataFrame:
    """The cells that lie in no larger whole cell of any region.

    Whatever is left under a point has one level, so a semi-join by cell meets a point once.
    """
    for lv in (v for v in levels if v > 0):
        full = (cells.where((F.col("_lv") == lv) & F.col("_full"))
                .select(F.col("_cx").alias("_fx"), F.col("_cy").alias("_fy")).distinct())
        up = F.lit(2 * lv) - 2 * F.col("_lv")
        above = F.when(F.col("_lv") < lv, F.call_function("shiftright", "_cx", up)), \
            F.when(F.col("_lv") < lv, F.call_function("shiftright", "_cy", up))
        cells = (cells.withColumn("_ax", above[0]).withColumn("_ay", above[1])
                 .join(full, (F.col("_ax") == F.col("_fx")) & (F.col("_ay") == F.col("_fy")), "left_anti").drop("_ax", "_ay"))
    return cells


def prefixes(points: DataFrame, levels: list[int]) -> DataFrame:
    """Each point once per level, with its cell there (``_plv, _px, _py``) from its bin (``_bx, _by``)."""
    shifted = points.withColumn("_plv", F.explode(F.array(*[F.lit(v) for v in levels])) if len(levels) > 1 else F.lit(levels[0]))
    return (shifted.withColumn("_px", F.call_function("shiftright", "_bx", 2 * F.col("_plv")))
            .withColumn("_py", F.call_function("shiftright", "_by", 2 * F.col("_plv"))))
