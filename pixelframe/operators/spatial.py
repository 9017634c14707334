"""Spatial joins as bin-keyed equi-joins.

A theta join on "point inside polygon" would plan as a nested-loop join.  Instead both sides get an
integer bin key — a point has exactly one bin ``(floor(x/B), floor(y/B))``, a region explodes into the
bins its bounding box covers — and the join is an equality on ``(bx, by)`` with the bounding box and the
even-odd ray cast as residual.  Catalyst then picks a broadcast-hash join (region side small, size
checked first) or a sort-merge join with AQE skew splitting (region side large).

Per (region, bin) only the edges a rightward ray from inside that bin can cross are kept, so a large
polygon does not drag its whole edge list into every bin; bins no edge can reach are outside and are
dropped before the join.  Each point lands in one bin and each (region, bin) pair is unique, so the join
never creates duplicates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import lonlat_to_utm_zone, point_in_polygon, segment_intersects_box, utm_zone_of
from ..session import materialize
from . import cover

# A region side is broadcast below these: rows, edges, and bytes as estimated from its rows.
DEFAULT_BROADCAST_EDGE_LIMIT = 1_000_000
DEFAULT_BROADCAST_ROW_LIMIT = 500_000
DEFAULT_BROADCAST_BYTES = 64 << 20
EDGE_BYTES = 48  # four doubles and their place in the array


def point_bins(points: DataFrame, bin_size: float, x: str = "x", y: str = "y") -> DataFrame:
    b = F.lit(float(bin_size))
    return points.withColumn("_bx", F.floor(F.col(x) / b)).withColumn("_by", F.floor(F.col(y) / b))


# (region × bin) × edge evaluations above which bin filtering is spread over tasks
SPREAD_WORK_LIMIT = 200_000


def region_stats(regions: DataFrame, bin_size: float) -> dict:
    """One aggregate over the (small) region table: regions, edges, bins and bin×edge work."""
    b = F.lit(float(bin_size))
    nb = ((F.floor(F.col("maxx") / b) - F.floor(F.col("minx") / b) + 1)
          * (F.floor(F.col("maxy") / b) - F.floor(F.col("miny") / b) + 1))
    row = regions.agg(F.count(F.lit(1)).alias("regions"), F.coalesce(F.sum(F.size("edges")), F.lit(0)).alias("edges"),
                      F.coalesce(F.sum(nb), F.lit(0)).alias("bins"),
                      F.coalesce(F.sum(nb * F.size("edges")), F.lit(0)).alias("work")).first()
    return row.asDict()


def region_bins(regions: DataFrame, bin_size: float, keep_edges: bool = True,
                key_cols: list[str] | None = None, spread: bool | None = None) -> DataFrame:
    """Explode each region into the bins its bounding box covers, with per-bin relevant edges.

    ``_full`` marks interior bins — no edge touches the closed bin and its centre is inside — whose
    points are all inside: they skip the per-point ray cast (``_edges`` is emptied).  Large polygons
    over small bins are mostly interior, so the per-pixel work drops to an equality join.

    When the bin×edge work is large (``spread``; decided from :func:`region_stats` when ``None``), bins
    are exploded from the bounds alone, spread over tasks by (region, bin), and meet their region's
    edges through a size-checked broadcast: a huge polygon's bins are filtered by many tasks and its
    edge list is never shuffled.  ``key_cols`` (+ ``part`` when present) must identify a region.
    """
    b = F.lit(float(bin_size))
    if keep_edges and spread is None:
        spread = region_stats(regions, bin_size)["work"] > SPREAD_WORK_LIMIT
    geom = [c for c in ("edges", "rings") if c in regions.columns] if (keep_edges and spread) else \
        [c for c in ("rings",) if c in regions.columns]
    out = (
        regions.drop(*geom)
        .withColumn("_bx", F.explode(F.sequence(F.floor(F.col("minx") / b), F.floor(F.col("maxx") / b))))
        .withColumn("_by", F.explode(F.sequence(F.floor(F.col("miny") / b), F.floor(F.col("maxy") / b))))
    )
    if not keep_edges:
        return out
    # bins past the right bound never exist; the comparison stays a Filter on the bin side, which is
    # what Spark's dynamic-partition-pruning heuristic looks for on the build side of a pixel join
    out = out.where(F.col("_bx") <= F.floor(F.col("maxx") / b))
    if spread:
        key = list(key_cols or ["region_id"])
        if "part" in regions.columns and "part" not in key:
            key.append("part")
        if edges_fit(regions):
            out = out.repartition(*key, "_bx", "_by").join(F.broadcast(regions.select(*key, "edges")), key)
        else:
            none = F.array().cast(regions.schema["edges"].dataType)
            out = (out.repartition(*key, "_bx", "_by").join(edge_rows(regions, key, b), [*key, "_by"], "left")
                   .withColumn("edges", F.coalesce("edges", none)))
    lo = F.col("_by") * b
    hi = (F.col("_by") + 1) * b
    left = F.col("_bx") * b
    right = (F.col("_bx") + 1) * b
    touched = F.exists("edges", lambda e: segment_intersects_box(e, left, lo, right, hi))
    centre_in = point_in_polygon(F.col("edges"), (left + right) / 2.0, (lo + hi) / 2.0)
    out = out.withColumn("_full", ~touched & centre_in).withColumn(
        "_edges",
        F.when(F.col("_full"), F.array().cast(regions.schema["edges"].dataType)).otherwise(F.filter(
            "edges",
            lambda e: (F.greatest(e["y1"], e["y2"]) >= lo)
            & (F.least(e["y1"], e["y2"]) <= hi)
            & (F.greatest(e["x1"], e["x2"]) >= left),
        )),
    )
    return out


def edges_fit(regions: DataFrame) -> bool:
    """Whether all edges and keys of the regions may be broadcast."""
    row = regions.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.size("edges")), F.lit(0)).alias("e")).first()
    return (row["n"] <= DEFAULT_BROADCAST_ROW_LIMIT and row["e"] <= DEFAULT_BROADCAST_EDGE_LIMIT
            and row["n"] * 64 + row["e"] * EDGE_BYTES <= DEFAULT_BROADCAST_BYTES)


def edge_rows(regions: DataFrame, key: list[str], b: Column) -> DataFrame:
    """``key, _by, edges``: the edges that touch each row of bins, closed bounds included.

    A test inside a bin only looks at edges of its row, so a country-sized polygon is dealt by rows and
    never meets all of its bins under one key.
    """
    e = regions.select(*key, F.explode("edges").alias("e"))
    lo = F.ceil(F.least("e.y1", "e.y2") / b) - 1
    rows = F.sequence(lo, F.floor(F.greatest("e.y1", "e.y2") / b))
    return e.withColumn("_by", F.explode(rows)).groupBy(*key, "_by").agg(F.collect_list("e").alias("edges"))


def checked_broadcast(df: DataFrame, weight: Column | None = None,
                      max_rows: int = DEFAULT_BROADCAST_ROW_LIMIT,
                      max_weight: int = DEFAULT_BROADCAST_EDGE_LIMIT) -> DataFrame:
    """Broadcast ``df`` only after counting it (and an optional weight such as edge count).

    The bytes are those of a row's fixed part, its weight (edges) and its strings and binaries.  Beyond a
    limit the frame is returned as is and the join falls back to a shuffle join.
    """
    aggs = [F.count(F.lit(1)).alias("n")]
    if weight is not None:
        aggs.append(F.coalesce(F.sum(weight), F.lit(0)).alias("w"))
    texts = [c for c, t in df.dtypes if t in ("string", "binary")]
    size = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in texts), F.lit(16 + 16 * len(df.columns)))
    row = df.agg(*aggs, F.coalesce(F.sum(size), F.lit(0)).alias("b")).first()
    n = row["n"]
    w = row["w"] if weight is not None else 0
    if n <= max_rows and w <= max_weight and row["b"] + w * EDGE_BYTES <= DEFAULT_BROADCAST_BYTES:
        return F.broadcast(df)
    return df


def _small(st: dict) -> bool:
    """Whether every bin with every edge would fit a broadcast."""
    return (st["bins"] <= DEFAULT_BROADCAST_ROW_LIMIT and st["work"] <= DEFAULT_BROADCAST_EDGE_LIMIT
            and st["bins"] * 256 + st["work"] * EDGE_BYTES <= DEFAULT_BROADCAST_BYTES)


def _region_side(regions: DataFrame, bin_size: float, region_cols: list[str], broadcast: bool | None) -> DataFrame:
    st = region_stats(regions, bin_size)
    # a bin with no edge a rightward ray can reach, and not interior, holds no inside point
    # (written as one comparison, which Spark also treats as selective for dynamic partition pruning)
    rb = region_bins(regions, bin_size, key_cols=region_cols, spread=st["work"] > SPREAD_WORK_LIMIT)
    rb = rb.where(F.size("_edges") + F.col("_full").cast("int") > 0)
    rb = rb.select(*region_cols, "minx", "miny", "maxx", "maxy", "_bx", "_by", "_full", "_edges")
    if broadcast is None:
        # upper bounds from the stats (every bin, every edge) decide without another job when small
        if _small(st):
            return F.broadcast(rb)
        return checked_broadcast(rb, F.size("_edges"))
    return F.broadcast(rb) if broadcast else rb


def spatial_join(points: DataFrame, regions: DataFrame, bin_size: float, x: str = "x", y: str = "y",
                 how: str = "inner", region_cols: list[str] | None = None,
                 broadcast: bool | None = None, tiles: tuple[str, str, float] | None = None) -> DataFrame:
    """Points × regions where the point lies inside the region.

    ``how``: ``inner`` (clip with drop: one row per (point, containing region)),
    ``semi`` (points inside any region, each once — G14/R6), ``anti`` (inside none),
    ``mask`` (every point in a region's bounding box, with ``_inside`` flag — P4 ``drop=False``).

    ``tiles=(tile_x_col, tile_y_col, tile_size)``: the pixel table is partitioned by integer tile keys
    ``floor(x / tile_size)``, ``floor(y / tile_size)`` (``tile_size`` a multiple of ``bin_size``).  The
    region bins then carry the same keys and the join includes them, so dynamic partition pruning reads
    only the tile folders some region touches.

    Regions of many bins and edges (more than SPREAD_WORK_LIMIT tests) are joined by their hierarchical
    cover instead (:func:`cover_join`), with the same answers.
    """
    region_cols = list(region_cols or ["region_id"])
    pts = point_bins(points, bin_size, x, y)
    if how == "mask":
        return _mask_join(pts, regions, bin_size, region_cols, broadcast, x, y, tiles)
    if how in ("inner", "semi", "anti") and region_stats(regions, bin_size)["work"] > SPREAD_WORK_LIMIT:
        return cover_join(points, regions, bin_size, x, y, how, region_cols, broadcast, tiles)
    rs = _region_side(regions, bin_size, region_cols, broadcast)
    rs = rs.select(*[F.col(c).alias(c) for c in region_cols],
                   F.col("minx").alias("_minx"), F.col("miny").alias("_miny"),
                   F.col("maxx").alias("_maxx"), F.col("maxy").alias("_maxy"),
                   F.col("_bx").alias("_rbx"), F.col("_by").alias("_rby"), "_full", "_edges")
    px, py = F.col(x), F.col(y)
    rs, key = _bin_key(pts, rs, bin_size, tiles)
    in_box = px.between(rs["_minx"], rs["_maxx"]) & py.between(rs["_miny"], rs["_maxy"])
    inside = rs["_full"] | point_in_polygon(rs["_edges"], px, py)
    if how == "inner":
        out = pts.join(rs, key & in_box & inside, "inner")
        return out.drop("_bx", "_by", "_rbx", "_rby", "_rtx", "_rty", "_full", "_edges", "_minx", "_miny", "_maxx", "_maxy")
    if how in ("semi", "anti"):
        out = pts.join(rs, key & in_box & inside, "left_semi" if how == "semi" else "left_anti")
        return out.drop("_bx", "_by")
    raise ValueError(f"unknown how={how!r}")


def cover_join(points: DataFrame, regions: DataFrame, bin_size: float, x: str = "x", y: str = "y", how: str = "inner",
               region_cols: list[str] | None = None, broadcast: bool | None = None,
               tiles: tuple[str, str, float] | None = None) -> DataFrame:
    """:func:`spatial_join` (``inner``, ``semi``, ``anti``) by the regions' hierarchical cover.

    The cover's rows follow the regions' perimeter.  A point meets it by an equality on the level and its cell
    there, once for each level that occurs: about log4 of the region's extent in bins.  Past the broadcast limit this is a
    shuffle join whose hot cells AQE splits.  The cover is written once to the checkpoint folder.  An inner join
    meets plain regions (:func:`cover.is_plain`) by their smallest cells (:func:`plain_join`).
    """
    region_cols = list(region_cols or ["region_id"])
    if tiles is not None and not _whole_ratio(tiles[2], bin_size):
        raise ValueError("tile_size must be a whole multiple of bin_size")
    if how == "inner":
        plain = cover.is_plain(bin_size)
        n = regions.agg(F.count_if(plain).alias("plain"), F.count_if(~plain).alias("rest")).first()
        if n["plain"]:
            met = plain_join(points, regions.where(plain), bin_size, x, y, region_cols, broadcast, tiles)
            if not n["rest"]:
                return met
            return met.unionByName(cover_join(points, regions.where(~plain), bin_size, x, y, how, region_cols, broadcast, tiles))
    cells = materialize(cover.cover(regions, bin_size, region_cols, tiles[2] if tiles else None))
    levels = cover.levels_of(cells)
    if not levels:
        if how == "anti":
            return points
        empty = points.limit(0)
        return empty if how == "semi" else empty.join(regions.select(*region_cols).limit(0), how="cross")
    if how == "semi":
        cells = cover.without_nested(cells, levels)
    px, py = F.col(x), F.col(y)
    inner = [F.col(c) for c in region_cols] if how == "inner" else []
    # a comparison on the region side: what Spark takes as selective for dynamic partition pruning
    rs = cells.withColumnsRenamed({c: "_" + c for c in cover.BOUNDS}).where("_minx <= _maxx")
    rs = rs.select(*inner, "_minx", "_miny", "_maxx", "_maxy", "_lv", "_cx", "_cy", "_full", "_edges", "_flips", "_odd")
    if tiles is not None:
        low = [F.call_function("shiftleft", F.col(c), 2 * F.col("_lv")) for c in ("_cx", "_cy")]
        rs = _tile_keys(points, rs, *low, bin_size, tiles)
    if broadcast or broadcast is None and _cover_fits(cells):
        rs = F.broadcast(rs)
    made = ["_bx", "_by", "_plv", "_px", "_py"]
    hit = px.between(F.col("_minx"), F.col("_maxx")) & py.between(F.col("_miny"), F.col("_maxy")) & cover.inside(px, py)

    def join(pts: DataFrame, rs: DataFrame, levels: list[int], how: str) -> DataFrame:
        pts = cover.prefixes(point_bins(pts, bin_size, x, y), levels)
        key = (pts["_plv"] == rs["_lv"]) & (pts["_px"] == rs["_cx"]) & (pts["_py"] == rs["_cy"])
        if tiles is not None:
            key = key & (pts[tiles[0]] == rs["_rtx"]) & (pts[tiles[1]] == rs["_rty"])
        return pts.join(rs, key & hit, how).drop(*made)

    if how == "anti":  # a point is outside when it is so at every level
        for lv in levels:
            points = join(points, rs.where(F.col("_lv") == lv), [lv], "left_anti")
        return points
    if how == "semi":
        return join(points, rs, levels, "left_semi")
    return join(points, rs, levels, "inner").drop("_minx", "_miny", "_maxx", "_maxy", "_lv", "_cx", "_cy", "_full", "_edges",
                                                  "_flips", "_odd", "_rtx", "_rty")


def plain_join(points: DataFrame, regions: DataFrame, bin_size: float, x: str, y: str, region_cols: list[str],
               broadcast: bool | None, tiles: tuple[str, str, float] | None = None) -> DataFrame:
    """Inner :func:`spatial_join` with plain regions: a point meets the cells of its own bin only, by a compiled test.

    Past the broadcast limit a sort-merge join, whatever the planner guesses of the cells' size; AQE splits its hot cells.
    The cells are written to the checkpoint folder only where they must be counted for that (``broadcast=None``).
    """
    rs = cover.plain_cells(regions, bin_size, region_cols)
    # a comparison on the region side: what Spark takes as selective for dynamic partition pruning
    rs = rs.select(*region_cols, *(F.col(c).alias("_" + c) for c in ("minx", "maxx")), *rs.columns[rs.columns.index("_cx"):]).where("_minx <= _maxx")
    if tiles is not None:
        rs = _tile_keys(points, rs, F.col("_cx"), F.col("_cy"), bin_size, tiles)
    if broadcast is None:
        rs = materialize(rs)
        n = rs.count()
        broadcast = n <= DEFAULT_BROADCAST_ROW_LIMIT and n * 16 * len(rs.columns) <= DEFAULT_BROADCAST_BYTES
    rs = F.broadcast(rs) if broadcast else rs.hint("merge")
    pts = point_bins(points, bin_size, x, y)
    key = (pts["_bx"] == rs["_cx"]) & (pts["_by"] == rs["_cy"])
    if tiles is not None:
        key = key & (pts[tiles[0]] == rs["_rtx"]) & (pts[tiles[1]] == rs["_rty"])
    made = [c for c in rs.columns if c not in region_cols]
    return pts.join(rs, key & cover.plain_inside(F.col(x), F.col(y)), "inner").drop("_bx", "_by", *made)


def _tile_keys(points: DataFrame, rs: DataFrame, cx: Column, cy: Column, bin_size: float, tiles: tuple[str, str, float]) -> DataFrame:
    """``_rtx, _rty`` of bins ``cx, cy``, typed like the partition columns: the join compares the bare column (needed for pruning)."""
    ratio = int(round(float(tiles[2]) / float(bin_size)))
    return rs.withColumns({c: F.floor(v / F.lit(ratio)).cast(points.schema[k].dataType)
                           for c, k, v in (("_rtx", tiles[0], cx), ("_rty", tiles[1], cy))})


def _whole_ratio(tile_size: float, bin_size: float) -> bool:
    ratio = float(tile_size) / float(bin_size)
    return ratio >= 1 and abs(ratio - round(ratio)) <= 1e-9


def _cover_fits(cells: DataFrame) -> bool:
    """Whether a written cover may be broadcast, by its counted cells, edges and flips."""
    row = cells.agg(F.count(F.lit(1)).alias("n"),
                    F.coalesce(F.sum(F.size("_edges") + F.size("_flips")), F.lit(0)).alias("e")).first()
    return (row["n"] <= DEFAULT_BROADCAST_ROW_LIMIT and row["e"] <= DEFAULT_BROADCAST_EDGE_LIMIT
            and row["n"] * 192 + row["e"] * EDGE_BYTES <= DEFAULT_BROADCAST_BYTES)


def _bin_key(pts: DataFrame, rs: DataFrame, bin_size: float,
             tiles: tuple[str, str, float] | None) -> tuple[DataFrame, Column]:
    """The region side and the equality on the bin, with tile keys on the tile partitions as well."""
    key = (pts["_bx"] == rs["_rbx"]) & (pts["_by"] == rs["_rby"])
    if tiles is None:
        return rs, key
    tx, ty, tsize = tiles
    if not _whole_ratio(tsize, bin_size):
        raise ValueError("tile_size must be a whole multiple of bin_size")
    ratio = float(tsize) / float(bin_size)
    # keys typed like the partition columns, so the join compares the bare column (needed for pruning)
    rs = (rs.withColumn("_rtx", F.floor(F.col("_rbx") / F.lit(int(round(ratio)))).cast(pts.schema[tx].dataType))
          .withColumn("_rty", F.floor(F.col("_rby") / F.lit(int(round(ratio)))).cast(pts.schema[ty].dataType)))
    key = (pts["_bx"] == rs["_rbx"]) & (pts["_by"] == rs["_rby"])
    return rs, key & (pts[tx] == rs["_rtx"]) & (pts[ty] == rs["_rty"])


def _mask_join(pts: DataFrame, regions: DataFrame, bin_size: float, region_cols: list[str],
               broadcast: bool | None, x: str, y: str, tiles: tuple[str, str, float] | None = None) -> DataFrame:
    px, py = F.col(x), F.col(y)
    # every point of the bounding box, whether or not a bin edge survives the filter
    st = region_stats(regions, bin_size)
    rs_all = region_bins(regions, bin_size, key_cols=region_cols, spread=st["work"] > SPREAD_WORK_LIMIT).select(
        *region_cols, F.col("minx").alias("_minx"), F.col("miny").alias("_miny"),
        F.col("maxx").alias("_maxx"), F.col("maxy").alias("_maxy"),
        F.col("_bx").alias("_rbx"), F.col("_by").alias("_rby"), "_full", "_edges")
    if broadcast is None:
        rs_all = F.broadcast(rs_all) if _small(st) else checked_broadcast(rs_all, F.size("_edges"))
    elif broadcast:
        rs_all = F.broadcast(rs_all)
    # a comparison on the region side: what Spark takes as selective for dynamic partition pruning
    rs_all, key = _bin_key(pts, rs_all.where(F.col("_minx") <= F.col("_maxx")), bin_size, tiles)
    in_box = px.between(rs_all["_minx"], rs_all["_maxx"]) & py.between(rs_all["_miny"], rs_all["_maxy"])
    out = pts.join(rs_all, key & in_box, "inner").withColumn(
        "_inside", F.col("_full") | point_in_polygon(F.col("_edges"), px, py))
    return out.drop("_bx", "_by", "_rbx", "_rby", "_rtx", "_rty", "_full", "_edges", "_minx", "_miny", "_maxx", "_maxy")


def clip(points: DataFrame, regions: DataFrame, bin_size: float, value_cols: list[str], x: str = "x",
         y: str = "y", drop: bool = True, region_cols: list[str] | None = None,
         tiles: tuple[str, str, float] | None = None) -> DataFrame:
    """Clip to geometry (P4): ``drop=True`` keeps inside pixels; ``False`` keeps the bbox with values → NULL."""
    if drop:
        return spatial_join(points, regions, bin_size, x, y, "inner", region_cols, tiles=tiles)
    out = spatial_join(points, regions, bin_size, x, y, "mask", region_cols, tiles=tiles)
    for c in value_cols:
        out = out.withColumn(c, F.when(F.col("_inside"), F.col(c)))
    return out


def coverage_report(regions: DataFrame, matched: DataFrame, region_cols: list[str] | None = None) -> DataFrame:
    """Per-region pixel counts with empty regions flagged (P13): regions LEFT JOIN counts."""
    region_cols = list(region_cols or ["region_id"])
    counts = matched.groupBy(*region_cols).agg(F.count(F.lit(1)).alias("pixel_count"))
    return (regions.select(*region_cols).join(counts, region_cols, "left")
            .withColumn("pixel_count", F.coalesce("pixel_count", F.lit(0)).cast("bigint"))
            .withColumn("empty", (F.col("pixel_count") == 0)))


def within_radius(points: DataFrame, centres: DataFrame, radius: float, x: str = "x", y: str = "y",
                  cx: str = "cx", cy: str = "cy", shape: str = "square", centre_cols: list[str] | None = None,
                  broadcast: bool | None = None) -> DataFrame:
    """Extent by centre and radius (P3): bbox bin join + square or disc predicate."""
    centre_cols = list(centre_cols or ["centre_id"])
    r = float(radius)
    b = 2.0 * r if r > 0 else 1.0
    cs = centres.select(*centre_cols, F.col(cx).alias("_cx"), F.col(cy).alias("_cy"))
    cs = (cs.withColumn("_rbx", F.explode(F.sequence(F.floor((F.col("_cx") - r) / b), F.floor((F.col("_cx") + r) / b))))
          .withColumn("_rby", F.explode(F.sequence(F.floor((F.col("_cy") - r) / b), F.floor((F.col("_cy") + r) / b)))))
    if broadcast is None:
        cs = checked_broadcast(cs)
    elif broadcast:
        cs = F.broadcast(cs)
    pts = point_bins(points, b, x, y)
    dx = F.col(x) - F.col("_cx")
    dy = F.col(y) - F.col("_cy")
    if shape == "square":
        pred = (F.abs(dx) <= r) & (F.abs(dy) <= r)
    elif shape == "disc":
        pred = dx * dx + dy * dy <= r * r
    else:
        raise ValueError("shape must be 'square' or 'disc'")
    out = pts.join(cs, (pts["_bx"] == cs["_rbx"]) & (pts["_by"] == cs["_rby"]) & pred, "inner")
    return out.drop("_bx", "_by", "_rbx", "_rby", "_cx", "_cy")


def within_metres(points: DataFrame, centres: DataFrame, radius_m: float, lon: str = "lon", lat: str = "lat",
                  clon: str = "clon", clat: str = "clat", shape: str = "disc",
                  centre_cols: list[str] | None = None) -> DataFrame:
    """Extent by a lon/lat centre and a radius in metres.

    Every centre has its own UTM zone: points within the zone's reach are taken to it, and the square or disc
    is tested there.  A degree box around the centre (with a margin for the projection's scale) makes the
    bins of the equality join; where it passes 180°, a copy of it one turn away meets the points on the other side.
    """
    centre_cols = list(centre_cols or ["centre_id"])
    r = float(radius_m)
    dlat = r * 1.5 / 110_000.0
    cs = centres.select(*centre_cols, F.col(clon).alias("_clon"), F.col(clat).alias("_clat"),
                        utm_zone_of(F.col(clon)).alias("_zone"), (F.col(clat) < 0).alias("_south"))
    cs = cs.withColumn("_dlon", F.lit(dlat) / F.greatest(F.cos(F.radians(F.col("_clat"))), F.lit(0.01)))
    b = F.lit(max(2 * dlat, 1e-6))
    cs = cs.withColumn("_turn", F.explode(F.array(*[F.lit(t) for t in (-360.0, 0.0, 360.0)])))
    west, east = (F.col("_clon") + F.col("_turn") + sign * F.col("_dlon") for sign in (-1, 1))
    cs = cs.where((F.col("_turn") == 0) | ((east >= -180) & (west <= 180)))
    # a turned box only needs the bins of the globe's own degrees
    west, east = (F.when(F.col("_turn") == 0, x).otherwise(F.least(F.greatest(x, F.lit(-180.0)), F.lit(180.0))) for x in (west, east))
    cs = (cs.withColumn("_rbx", F.explode(F.sequence(F.floor(west / b), F.floor(east / b))))
          .withColumn("_rby", F.explode(F.sequence(F.floor((F.col("_clat") - dlat) / b), F.floor((F.col("_clat") + dlat) / b)))))
    pts = points.withColumn("_bx", F.floor(F.col(lon) / b)).withColumn("_by", F.floor(F.col(lat) / b))
    off = F.col(lon) - F.col("_turn") - F.col("_clon")  # of all turns, the one that brings the point nearest
    out = pts.join(checked_broadcast(cs), (F.col("_bx") == F.col("_rbx")) & (F.col("_by") == F.col("_rby"))
                   & (off > -180) & (off <= 180))
    x, y = lonlat_to_utm_zone(F.col(lon) - F.col("_turn"), F.col(lat), F.col("_zone"), F.col("_south"))
    cx, cy = lonlat_to_utm_zone(F.col("_clon"), F.col("_clat"), F.col("_zone"), F.col("_south"))
    out = out.withColumn("_dx", x - cx).withColumn("_dy", y - cy)
    if shape == "square":
        out = out.where((F.abs("_dx") <= r) & (F.abs("_dy") <= r))
    elif shape == "disc":
        out = out.where(F.col("_dx") * F.col("_dx") + F.col("_dy") * F.col("_dy") <= r * r)
    else:
        raise ValueError("shape must be 'square' or 'disc'")
    return out.select(*points.columns, *centre_cols)


def bbox_filter(points: DataFrame, minx: float, miny: float, maxx: float, maxy: float,
                x: str = "x", y: str = "y") -> DataFrame:
    """Extent by a single bounding box (P2 for one polygon): a range predicate parquet can push down."""
    return points.where(F.col(x).between(minx, maxx) & F.col(y).between(miny, maxy))


def tile_cover(regions: DataFrame, tile_size: float, region_cols: list[str] | None = None) -> DataFrame:
    """Tile keys covering each region's bounds (G12); the inverse index (G13) is the same rows."""
    region_cols = list(region_cols or ["region_id"])
    t = F.lit(float(tile_size))
    return (regions.select(*region_cols, "minx", "miny", "maxx", "maxy")
            .withColumn("tile_x", F.explode(F.sequence(F.floor(F.col("minx") / t), F.floor(F.col("maxx") / t))))
            .withColumn("tile_y", F.explode(F.sequence(F.floor(F.col("miny") / t), F.floor(F.col("maxy") / t))))
            .select(*region_cols, "tile_x", "tile_y"))


def tile_to_regions(regions: DataFrame, tile_size: float, region_cols: list[str] | None = None) -> DataFrame:
    """Tile → regions (G13) as an aggregate over the cover rows: count and key range per tile."""
    region_cols = list(region_cols or ["region_id"])
    cover = tile_cover(regions, tile_size, region_cols)
    rid = region_cols[0]
    return cover.groupBy("tile_x", "tile_y").agg(
        F.count(F.lit(1)).alias("n_regions"), F.min(rid).alias("first_region"), F.max(rid).alias("last_region"))
