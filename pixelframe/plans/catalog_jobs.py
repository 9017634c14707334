"""Driver queries for the end-to-end plans (P14, P15, R13, E7) and the sources / sinks."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cube, learn, raster, spatial, tiles
from ..sources import geojson, tables
from ..session import scratch_path
from . import fixtures as fx
from . import jobs
from .catalog import _t, register
from .catalog_data import _MISSING_SQL, _RASTER_SQL, SQL_TILE_UNNEST, _embedding_tiles, _pred_pixels
from .catalog_models import _SQ_DIST, SQL_LABEL_MEANS, marked

_EXTRACT_EDGES = fx.sql_block_edges(fx.EXTRACT_POLYGONS, fx.EXTRACT_BLOCK, fx.EXTRACT_SHIFT)
_TILE_EDGES = fx.sql_block_edges(fx.TILE_POLYGONS, fx.TILE_BLOCK, fx.TILE_SHIFT)


# ---------------------------------------------------------------------------------------------
# Dataset extraction
# ---------------------------------------------------------------------------------------------

_EXTRACT_CUBE_SQL = f"""
WITH {fx.SQL_CUBE_PIXELS},
ins AS ({fx.sql_ray_inside("cpx", "cpx.x", "cpx.y", "cpx.vec_id", _EXTRACT_EDGES)}),
j AS (SELECT ins.region_id, cpx.x, cpx.y, cpx.embedding FROM ins JOIN cpx ON ins.vec_id = cpx.vec_id
      WHERE cpx.t >= TIMESTAMP '2024-01-01 00:00:00' AND cpx.t < TIMESTAMP '2025-08-20 00:00:00'),
n AS (SELECT region_id, x, y, CAST(count(*) AS BIGINT) AS n_steps FROM j GROUP BY ALL),
u AS (SELECT region_id, x, y, unnest(embedding) AS v, unnest(range(0, len(embedding))) AS i FROM j),
m AS (SELECT region_id, x, y, i, max(CASE WHEN isnan(v) THEN NULL ELSE CAST(v AS DOUBLE) END) AS mv FROM u GROUP BY ALL)
SELECT m.region_id, m.x, m.y, n.n_steps, round(sum(mv), 4) AS band_sum, 1 AS class
FROM m JOIN n ON m.region_id = n.region_id AND m.x = n.x AND m.y = n.y
GROUP BY m.region_id, m.x, m.y, n.n_steps
"""


@register("extract_cube", _EXTRACT_CUBE_SQL)
def extract_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions → pixels of map year 2024 → clip → per-pixel max composite → class 1."""
    out = jobs.extract_from_cube(fx.extract_regions(spark, sf_dir), fx.cube_pixels(spark, sf_dir),
                                 2024, bin_size=4.0, composite="max", cls=1)
    return out.select("region_id", "x", "y", "n_steps", fx.band_sum("bands").alias("band_sum"), "class")


_EXTRACT_TILES_SQL = f"""
WITH tp AS (SELECT vec_id, vec_id // 64 AS tile_id, CAST((vec_id % 64) // 8 AS INTEGER) AS "row",
                   CAST(vec_id % 8 AS INTEGER) AS col,
                   CAST(vec_id // 64 AS DOUBLE) * 80.0 + (CAST(vec_id % 8 AS DOUBLE) + 0.5) * 10.0 AS x,
                   1000.0 + (CAST((vec_id % 64) // 8 AS DOUBLE) + 0.5) * -10.0 AS y, embedding FROM embeddings),
ins AS ({fx.sql_ray_inside("tp", "tp.x", "tp.y", "tp.vec_id", _TILE_EDGES)})
SELECT ins.region_id, tp.tile_id, tp."row", tp.col,
       round(list_sum(list_transform(tp.embedding, lambda v: CAST(v AS DOUBLE))), 4) AS band_sum, 2 AS class
FROM ins JOIN tp ON ins.vec_id = tp.vec_id
WHERE NOT list_bool_or(list_transform(tp.embedding, lambda v: v IS NULL OR isnan(v)))
"""


@register("extract_tiles", _EXTRACT_TILES_SQL)
def extract_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles → pixel rows → clip per region → drop missing → class 2."""
    out = jobs.extract_from_tiles(_embedding_tiles(spark, sf_dir).where(F.size("data") > 0),
                                  fx.tile_regions(spark, sf_dir), bin_size=64.0, cls=2, n_bands=64)
    return out.select("region_id", "tile_id", "row", "col", fx.band_sum("bands").alias("band_sum"), "class")


def _stored_chunks(spark: SparkSession, sf_dir: str, side: int, bin_size: float) -> DataFrame:
    """``embeddings`` as the pixels of 8 × 8 tiles, packed into chunks, written and read back."""
    e = _t(spark, sf_dir, "embeddings").withColumn("tile_id", F.floor(F.col("vec_id") / 64))
    at = F.col("vec_id") % 64
    px = e.select("tile_id", F.floor(at / 8).cast("int").alias("row"), (at % 8).cast("int").alias("col"),
                  F.col("embedding").alias("bands"))
    affine = F.array((F.col("tile_id") * 80).cast("double"), F.lit(10.0), F.lit(0.0), F.lit(1000.0), F.lit(0.0), F.lit(-10.0))
    meta = e.select("tile_id").distinct().select("tile_id", F.lit(8).alias("h"), F.lit(8).alias("w"), affine.alias("affine"))
    path = scratch_path(spark, "tile-chunks")
    tiles.write_chunks(tiles.chunk_pixels(px, meta, ["tile_id"], side), path, bin_size)
    return spark.read.parquet(path)


@register("tile_chunks", SQL_TILE_UNNEST)
def tile_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles stored as chunks of 3 × 3 pixels at most, unnested with the coordinates of their tiles."""
    px = cube.unnest_tiles(_stored_chunks(spark, sf_dir, 3, 65536.0), keep=["tile_id"]).where(F.col("bands").isNotNull())
    return px.select("tile_id", "row", "col", "x", "y", fx.band_sum("bands").alias("band_sum"))


@register("extract_tile_chunks", _EXTRACT_TILES_SQL)
def extract_tile_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extraction from tiles stored as chunks: only chunks under some region are read."""
    out = jobs.extract_from_tiles(_stored_chunks(spark, sf_dir, 5, 65536.0), fx.tile_regions(spark, sf_dir), bin_size=64.0,
                                  cls=2, n_bands=64, chunk_bin=65536.0)
    return out.select("region_id", "tile_id", "row", "col", fx.band_sum("bands").alias("band_sum"), "class")


# ---------------------------------------------------------------------------------------------
# Map and evaluation (R1, R2, R13, E7): nearest-centre model (the labels' means), grids of 6 with
# overlap 1 over regions above 100 units², lattice x0 = 0, y0 = 0, res = 1.
# ---------------------------------------------------------------------------------------------

_MAP_MIN_AREA = 100.0
_MAP_GRID = 6.0
_MAP_OVERLAP = 1.0


def _map_inputs(spark: SparkSession, sf_dir: str):
    px = fx.cube_pixels(spark, sf_dir)
    latest = cube.latest_layer(px.withColumn("lb", F.struct("bands", "label")), ["x", "y"], "lb", "t")
    latest = latest.select("x", "y", F.col("lb.bands").alias("bands"), F.col("lb.label").alias("label"))
    e = _t(spark, sf_dir, "embeddings")
    centres = learn.label_means(e, "label", "embedding")

    def predict_fn(df: DataFrame) -> DataFrame:
        return learn.nearest_centre(df, centres, "bands", "pred")

    return latest, predict_fn


_MO_KEY = 'mo.col, mo."row"'

_MAP_SQL = f"""
{fx.SQL_CUBE_PIXELS},
lp AS (SELECT x, y, arg_max(embedding, step) AS emb, arg_max(label, step) AS label FROM cpx GROUP BY x, y),
{SQL_LABEL_MEANS},
d AS (SELECT lp.x, lp.y, c.centre_id, {_SQ_DIST.format(a="lp.emb", b="c.ce")} AS d2 FROM lp, c),
pr AS (SELECT x, y, CAST(centre_id AS SMALLINT) AS pred FROM (
         SELECT *, row_number() OVER (PARTITION BY x, y ORDER BY d2, centre_id) AS rn FROM d) WHERE rn = 1),
ce AS (SELECT region_id, 0 AS ring, x1, y1, x2, y2 FROM {_EXTRACT_EDGES}),
cb AS (SELECT region_id, min(least(x1, x2)) AS minx, min(least(y1, y2)) AS miny,
              max(greatest(x1, x2)) AS maxx, max(greatest(y1, y2)) AS maxy FROM ce GROUP BY region_id),
ar AS (SELECT region_id, abs(sum(x1 * y2 - x2 * y1) / 2.0) AS area FROM ce GROUP BY region_id),
gn AS (SELECT cb.region_id, minx, miny, CAST(ceil((maxx - minx) / {_MAP_GRID - _MAP_OVERLAP!r}) AS BIGINT) AS nx,
              CAST(ceil((maxy - miny) / {_MAP_GRID - _MAP_OVERLAP!r}) AS BIGINT) AS ny
       FROM cb JOIN ar ON cb.region_id = ar.region_id WHERE ar.area > {_MAP_MIN_AREA!r}),
gx AS (SELECT region_id, minx, miny, ny, unnest(range(0, nx)) AS ix FROM gn WHERE nx > 0 AND ny > 0),
gxy AS (SELECT region_id, minx, miny, ix, unnest(range(0, ny)) AS iy FROM gx),
cells AS (SELECT region_id, ix, iy, minx + ix * {_MAP_GRID - _MAP_OVERLAP!r} AS cx0, miny + iy * {_MAP_GRID - _MAP_OVERLAP!r} AS cy0,
                 minx + ix * {_MAP_GRID - _MAP_OVERLAP!r} + {_MAP_GRID!r} AS cx1, miny + iy * {_MAP_GRID - _MAP_OVERLAP!r} + {_MAP_GRID!r} AS cy1 FROM gxy),
tests AS (
  SELECT c.region_id, c.ix, c.iy, c.cx0, c.cy0, c.cx1, c.cy1,
    bool_or(least(e.x1, e.x2) <= c.cx1 AND greatest(e.x1, e.x2) >= c.cx0
            AND least(e.y1, e.y2) <= c.cy1 AND greatest(e.y1, e.y2) >= c.cy0
            AND NOT ((e.x2 - e.x1) * (c.cy0 - e.y1) - (e.y2 - e.y1) * (c.cx0 - e.x1) > 0
                 AND (e.x2 - e.x1) * (c.cy0 - e.y1) - (e.y2 - e.y1) * (c.cx1 - e.x1) > 0
                 AND (e.x2 - e.x1) * (c.cy1 - e.y1) - (e.y2 - e.y1) * (c.cx1 - e.x1) > 0
                 AND (e.x2 - e.x1) * (c.cy1 - e.y1) - (e.y2 - e.y1) * (c.cx0 - e.x1) > 0)
            AND NOT ((e.x2 - e.x1) * (c.cy0 - e.y1) - (e.y2 - e.y1) * (c.cx0 - e.x1) < 0
                 AND (e.x2 - e.x1) * (c.cy0 - e.y1) - (e.y2 - e.y1) * (c.cx1 - e.x1) < 0
                 AND (e.x2 - e.x1) * (c.cy1 - e.y1) - (e.y2 - e.y1) * (c.cx1 - e.x1) < 0
                 AND (e.x2 - e.x1) * (c.cy1 - e.y1) - (e.y2 - e.y1) * (c.cx0 - e.x1) < 0)) AS any_edge,
    sum(CASE WHEN ((e.y1 > (c.cy0 + c.cy1) / 2.0) <> (e.y2 > (c.cy0 + c.cy1) / 2.0))
              AND ((e.x2 - e.x1) * ((c.cy0 + c.cy1) / 2.0 - e.y1) - ((c.cx0 + c.cx1) / 2.0 - e.x1) * (e.y2 - e.y1)) * (e.y2 - e.y1) > 0
             THEN 1 ELSE 0 END) % 2 = 1 AS centre_in
  FROM cells c JOIN ce e ON c.region_id = e.region_id
  GROUP BY c.region_id, c.ix, c.iy, c.cx0, c.cy0, c.cx1, c.cy1),
kept AS (SELECT concat(region_id, ':0:', ix, ':', iy) AS grid_id, cx0, cy0, cx1, cy1
         FROM tests WHERE any_edge OR centre_in),
small AS (SELECT region_id FROM ar WHERE NOT (area > {_MAP_MIN_AREA!r})),
sedges AS (SELECT ce.region_id, ce.x1, ce.y1, ce.x2, ce.y2 FROM ce JOIN small ON ce.region_id = small.region_id),
gp AS (SELECT kept.grid_id, pr.x, pr.y, pr.pred FROM pr JOIN kept
         ON pr.x >= kept.cx0 AND pr.x < kept.cx1 AND pr.y >= kept.cy0 AND pr.y < kept.cy1
       UNION ALL
       SELECT concat(s.region_id, ':0:-1:-1') AS grid_id, pr.x, pr.y, pr.pred FROM pr JOIN (
         {fx.sql_ray_inside("pr", "pr.x", "pr.y", "pr.x, pr.y", "sedges r")}) s ON s.x = pr.x AND s.y = pr.y),
mo AS (SELECT CAST(floor(x) AS BIGINT) AS col, CAST(floor(0.0 - y) AS BIGINT) AS "row", x, y,
              arg_min(pred, grid_id) AS pred, min(grid_id) AS grid_id FROM gp GROUP BY ALL),
inreg AS ({fx.sql_ray_inside("mo", "mo.x", "mo.y", _MO_KEY, _EXTRACT_EDGES)})"""


@register("map_job", f"""
WITH {_MAP_SQL}
SELECT DISTINCT mo.col, mo."row", mo.pred, mo.grid_id FROM mo JOIN inreg ON mo.col = inreg.col AND mo."row" = inreg."row"
""")
def map_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full map: grids → pixels → predict → mosaic (lowest grid) → clip to the regions' union."""
    pixels, predict_fn = _map_inputs(spark, sf_dir)
    regions = fx.extract_regions(spark, sf_dir)
    out = jobs.save_predictions(regions, pixels, predict_fn, bin_size=4.0, x0=0.0, y0=0.0, res=1.0,
                                min_area=_MAP_MIN_AREA, grid_size=_MAP_GRID, grid_overlap=_MAP_OVERLAP)
    return out.select("col", "row", "pred", "grid_id")


@register("evaluate_job", f"""
WITH {_MAP_SQL},
pairs AS (SELECT gp.grid_id, CAST(lp.label = 8 AS INTEGER) AS truth, CAST(gp.pred = 8 AS INTEGER) AS p
          FROM gp JOIN lp ON gp.x = lp.x AND gp.y = lp.y WHERE gp.pred IS NOT NULL AND gp.pred <> 255),
s AS (SELECT grid_id,
             count(*) FILTER (WHERE truth = 1 AND p = 1) AS tp, count(*) FILTER (WHERE truth <> 1 AND p = 1) AS fp,
             count(*) FILTER (WHERE truth = 1 AND p <> 1) AS fn,
             CAST(count(*) FILTER (WHERE truth = p) AS DOUBLE) / count(*) AS accuracy FROM pairs GROUP BY grid_id),
sc AS (SELECT CASE WHEN tp + fp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END AS precision,
              CASE WHEN tp + fn = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fn) END AS recall, accuracy FROM s)
SELECT round(avg(precision), 6) AS precision, round(avg(recall), 6) AS recall, round(avg(accuracy), 6) AS accuracy,
       CAST(count(*) AS BIGINT) AS n_groups FROM sc
""")
def evaluate_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Map evaluation: per-grid scores against the reference (label = 8), averaged over grids."""
    pixels, predict_fn = _map_inputs(spark, sf_dir)
    regions = fx.extract_regions(spark, sf_dir)
    ref_path = scratch_path(spark, "reference")
    pixels.select(F.floor("x").alias("col"), F.floor(F.lit(0.0) - F.col("y")).alias("row"),
                  F.col("label").alias("value")).write.parquet(ref_path)
    reference = tables.read_reference(spark, ref_path)  # reference map as a pixel table (S9)
    m = jobs.evaluate_predictions(regions, pixels.drop("label"), reference, predict_fn, bin_size=4.0, x0=0.0, y0=0.0,
                                  res=1.0, target=8, positive=8, min_area=_MAP_MIN_AREA, grid_size=_MAP_GRID,
                                  grid_overlap=_MAP_OVERLAP)
    return m.select(*[F.round(c, 6).alias(c) for c in ("precision", "recall", "accuracy")], "n_groups")


_X_TO_M = "6378137.0 * radians({x})"
_Y_TO_M = "6378137.0 * ln(tan(pi() / 4 + radians({y}) / 2.0))"
_REF_RES = 40000.0


@register("evaluate_reprojected", f"""
WITH {_MAP_SQL},
g AS ({fx.sql_ray_inside("pr", "pr.x", "pr.y", "pr.x, pr.y", _EXTRACT_EDGES)}),
gc AS (SELECT g.region_id, CAST(floor(pr.x) AS BIGINT) AS col, CAST(floor(0.0 - pr.y) AS BIGINT) AS "row", pr.pred
       FROM g JOIN pr ON g.x = pr.x AND g.y = pr.y),
rf AS (SELECT floor(({_X_TO_M.format(x="x")}) / {_REF_RES!r}) AS rc, floor((0.0 - ({_Y_TO_M.format(y="y")})) / {_REF_RES!r}) AS rr,
              label AS value FROM lp),
rp AS (SELECT value, CAST(floor(degrees((rc + 0.5) * {_REF_RES!r} / 6378137.0)) AS BIGINT) AS col,
              CAST(floor(0.0 - degrees(2.0 * atan(exp((0.0 - (rr + 0.5) * {_REF_RES!r}) / 6378137.0)) - pi() / 2)) AS BIGINT) AS "row" FROM rf),
pairs AS (SELECT gc.region_id, CAST(rp.value = 8 AS INTEGER) AS truth, CAST(gc.pred = 8 AS INTEGER) AS p
          FROM gc JOIN rp ON gc.col = rp.col AND gc."row" = rp."row" WHERE gc.pred <> 255),
s AS (SELECT region_id,
             count(*) FILTER (WHERE truth = 1 AND p = 1) AS tp, count(*) FILTER (WHERE truth <> 1 AND p = 1) AS fp,
             count(*) FILTER (WHERE truth = 1 AND p <> 1) AS fn,
             CAST(count(*) FILTER (WHERE truth = p) AS DOUBLE) / count(*) AS accuracy FROM pairs GROUP BY region_id),
sc AS (SELECT CASE WHEN tp + fp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END AS precision,
              CASE WHEN tp + fn = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fn) END AS recall, accuracy FROM s)
SELECT round(avg(precision), 6) AS precision, round(avg(recall), 6) AS recall, round(avg(accuracy), 6) AS accuracy,
       CAST(count(*) AS BIGINT) AS n_groups FROM sc
""")
def evaluate_reprojected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evaluation (E7) of lon/lat predictions against a web Mercator reference of another resolution.

    The regions come in lon/lat; their grids are made in metres (G9; none is large enough to be split here).
    """
    from ..operators.regions import transform_points
    pixels, predict_fn = _map_inputs(spark, sf_dir)
    x, y = transform_points(F.col("x"), F.col("y"), 4326, 3857)
    c, r = raster.to_cell(x, y, 0.0, 0.0, _REF_RES)
    reference = pixels.select(c, r, F.col("label").alias("value"))
    m = jobs.evaluate_predictions(fx.extract_regions(spark, sf_dir, srid=4326), pixels.drop("label"), reference, predict_fn,
                                  bin_size=4.0, x0=0.0, y0=0.0, res=1.0, target=8, positive=8, min_area=1e30,
                                  pixel_srid=4326, ref_lattice=(0.0, 0.0, _REF_RES), ref_srid=3857)
    return m.select(*[F.round(c, 6).alias(c) for c in ("precision", "recall", "accuracy")], "n_groups")


# The forest's map: the class of each pixel is the one its marked bands tell.
_RF_MAP_SQL = re.sub(r"pr AS \(SELECT x, y, CAST\(centre_id.*?WHERE rn = 1\),",
                     "pr AS (SELECT x, y, CAST(label AS SMALLINT) AS pred FROM lp),", _MAP_SQL, count=1, flags=re.S)


@register("rf_map_job", f"""
WITH {_RF_MAP_SQL}
SELECT DISTINCT mo.col, mo."row", mo.pred, mo.grid_id FROM mo JOIN inreg ON mo.col = inreg.col AND mo."row" = inreg."row"
""")
def rf_map_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forest fitted on marked features (M1), saved, loaded (S12) and applied to the unlabelled pixels' bands."""
    f = _t(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("pixel_id"), marked("embedding", "label").alias("features"),
                                               F.col("label").alias("class_"))
    path = scratch_path(spark, "map-model")
    learn.save_model(learn.fit_random_forest(f, 64, num_trees=20, max_depth=8), path)
    model = learn.load_model(path)
    pixels, _ = _map_inputs(spark, sf_dir)
    out = jobs.save_predictions(fx.extract_regions(spark, sf_dir), pixels.withColumn("bands", marked("bands", "label")).drop("label"),
                                lambda df: learn.predict(model, df, "pred", features="bands", on_missing=0),
                                bin_size=4.0, x0=0.0, y0=0.0, res=1.0, min_area=_MAP_MIN_AREA, grid_size=_MAP_GRID,
                                grid_overlap=_MAP_OVERLAP)
    return out.select("col", "row", "pred", "grid_id")


@register("extract_utm", f"""
WITH {fx.SQL_EVENTS_LONLAT}, {fx.sql_utm("ll", "lon", "lat", "43", "event_id", "pu")},
pe AS (SELECT * FROM {fx.sql_edges_values(fx.LONLAT_POLYGONS, "v")}),
{fx.sql_utm("pe", "x1", "y1", "43", "region_id, x1, y1, x2, y2", "a")},
{fx.sql_utm("pe", "x2", "y2", "43", "region_id, x1, y1, x2, y2", "b")},
r AS (SELECT a.region_id, a.e AS x1, a.n AS y1, b.e AS x2, b.n AS y2 FROM a JOIN b USING (region_id, x1, y1, x2, y2)),
ins AS ({fx.sql_ray_inside("pu", "pu.e", "pu.n", "pu.event_id, pu.e, pu.n", "r")})
SELECT DISTINCT region_id, round(e, 2) AS x, round(n, 2) AS y, 3 AS class FROM ins
""")
def extract_utm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions in lon/lat over pixels in UTM 43N: the polygons are brought to the pixels."""
    from ..operators.regions import transform_points
    ev = fx.events_lonlat(spark, sf_dir)
    e, n = transform_points(F.col("lon"), F.col("lat"), 4326, 32643)
    pixels = ev.select(e.alias("x"), n.alias("y"), "t", F.array(F.col("lat").cast("float")).alias("bands"))
    regions = fx.polygons_df(spark, fx.LONLAT_POLYGONS).withColumn("srid", F.lit(4326))
    out = jobs.extract_from_cube(regions, pixels, None, bin_size=50_000.0, composite="latest", cls=3, pixel_srid=32643)
    return out.select("region_id", F.round("x", 2).alias("x"), F.round("y", 2).alias("y"), "class").distinct()


@register("train_from_extract", f"""
WITH {fx.SQL_CUBE_PIXELS},
ins AS ({fx.sql_ray_inside("cpx", "cpx.x", "cpx.y", "cpx.vec_id", _EXTRACT_EDGES)}),
px AS (SELECT DISTINCT ins.region_id, cpx.x, cpx.y FROM ins JOIN cpx ON ins.vec_id = cpx.vec_id)
SELECT CAST(region_id % 2 = 0 AS INTEGER) AS class_, CAST(count(*) AS BIGINT) AS n_rows, 64 AS width FROM px GROUP BY 1, 3
""")
def train_from_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extraction handed over to training (P14 → D1): two classes of regions, one labelled feature table."""
    from ..operators import prep
    regions, pixels = fx.extract_regions(spark, sf_dir), fx.cube_pixels(spark, sf_dir)
    tables_ = {name: jobs.training_rows(jobs.extract_from_cube(regions.where(F.col("region_id") % 2 == odd), pixels, None, 4.0), name)
               for name, odd in (("odd", 1), ("even", 0))}
    data, _ = prep.label_union(tables_)
    return data.groupBy("class_", F.size("features").alias("width")).agg(F.count_distinct("pixel_id").alias("n_rows"))


# ---------------------------------------------------------------------------------------------
# Sources and sinks (S1–S7, S10) — written to a fresh folder under the shared checkpoint folder
# ---------------------------------------------------------------------------------------------

_PARTS_SQL = f"""
WITH {fx.sql_customer_regions()},
ce2 AS (SELECT region_id, 0 AS part, ring, x1, y1, x2, y2 FROM ce
        UNION ALL
        SELECT ce.region_id, 1, ring, x1 + 3.0 * cc.h, y1, x2 + 3.0 * cc.h, y2 FROM ce JOIN cc ON ce.region_id = cc.k
        WHERE cc.k % 5 = 0),
ra AS (SELECT region_id, part, ring, abs(sum(x1 * y2 - x2 * y1) / 2.0) AS a, count(*) + 1 AS nv FROM ce2 GROUP BY ALL)
SELECT region_id, CAST(part AS INTEGER) AS part, CAST(count(*) AS INTEGER) AS n_rings, CAST(sum(nv) AS INTEGER) AS n_vertices,
       round(sum(CASE WHEN ring = 0 THEN a ELSE -a END), 3) AS area
FROM ra GROUP BY region_id, part
"""


def _multipart_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer regions, every fifth with a second part."""
    reg = fx.customer_regions(spark, sf_dir)
    k = F.col("region_id")
    h = F.lit(4000.0) + ((k * 37) % 1000).cast("double") * 10.0
    shifted = F.transform("rings", lambda r: F.transform(r, lambda p: F.struct((p["x"] + 3.0 * h).alias("x"), p["y"].alias("y"))))
    return reg.withColumn("parts", F.when(k % 5 == 0, F.array(F.col("rings"), shifted)).otherwise(F.array(F.col("rings"))))


def _part_rows(regions: DataFrame) -> DataFrame:
    from ..operators import regions as RG
    return RG.area(regions).select(
        "region_id", "part", F.size("rings").alias("n_rings"),
        F.aggregate("rings", F.lit(0), lambda a, r: a + F.size(r)).alias("n_vertices"), F.round("area", 3).alias("area"))


@register("geojson_parts", _PARTS_SQL)
def geojson_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GeoJSON sequence written from customer regions (multi-part every 5th) and read back."""
    path = scratch_path(spark, "regions-geojson")
    geojson.regions_to_geojson_lines(_multipart_regions(spark, sf_dir)).write.mode("overwrite").text(path)
    return _part_rows(geojson.read_geojson(spark, path, sequence=True, srid=3857))


@register("geojson_collection", _PARTS_SQL)
def geojson_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same regions as FeatureCollection documents that name their CRS, with braces and quotes in a property,
    cut at their features when read back (S1)."""
    path = scratch_path(spark, "regions-collections")
    reg = _multipart_regions(spark, sf_dir).withColumn("note", F.concat(F.lit('}"{ \\"features": ['), F.col("region_id")))
    lines = geojson.regions_to_geojson_lines(reg, {"note": "note"}, also=["region_id"])
    lines = lines.withColumn("block", F.floor(F.col("region_id") / 65536))
    geojson.write_collections(lines, path, "block", "region_id", 3857)
    return _part_rows(geojson.read_geojson(spark, path))


@register("geojson_features", """
SELECT vec_id AS region_id, CAST(0 AS INTEGER) AS part, 3857 AS srid, CAST(vec_id % 1000 AS DOUBLE) AS minx,
       CAST(coalesce(label, 0) + 1 AS DOUBLE) * 2.0 AS area,
       concat('"}{ ', vec_id, ' \\"features": [{', coalesce(label, -1)) AS note
FROM embeddings
""")
def geojson_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rectangle for each vector in FeatureCollection documents of 65,536 features, with quotes, braces and backslashes
    in a property, read back by many tasks a document (S1)."""
    from ..operators import regions as RG
    e = _t(spark, sf_dir, "embeddings").select("vec_id", "label")
    x, y = (F.col("vec_id") % 1000).cast("double"), F.floor(F.col("vec_id") / 1000).cast("double")
    w = (F.coalesce("label", F.lit(0)) + 1).cast("double")
    ring = F.array(*[F.struct(a.alias("x"), b.alias("y")) for a, b in ((x, y), (x + w, y), (x + w, y + 2.0), (x, y + 2.0), (x, y))])
    note = F.concat(F.lit('"}{ '), F.col("vec_id"), F.lit(' \\"features": [{'), F.coalesce("label", F.lit(-1)))
    reg = e.select(F.col("vec_id").alias("region_id"), F.array(ring).alias("rings"), note.alias("note"))
    lines = geojson.regions_to_geojson_lines(reg, {"note": "note"}, also=["region_id"])
    path = scratch_path(spark, "features-collections")
    geojson.write_collections(lines.withColumn("block", F.floor(F.col("region_id") / 65536)), path, "block", "region_id", 3857)
    back = RG.area(geojson.read_geojson(spark, path))
    return back.select("region_id", "part", "srid", "minx", F.round("area", 6).alias("area"), F.col("props")["note"].alias("note"))


_ROUNDTRIP_SQL = f"""
WITH {_MISSING_SQL}
SELECT event_id, class_,
       CAST((f0 IS NULL OR isnan(f0)) AS BIGINT) + CAST((f1 IS NULL OR isnan(f1)) AS BIGINT)
       + CAST((f2 IS NULL OR isnan(f2)) AS BIGINT) AS n_missing,
       round(coalesce(f0, 0.0) + CASE WHEN isnan(f1) THEN 0.0 ELSE coalesce(f1, 0.0) END + coalesce(f2, 0.0), 6) AS fsum
FROM ef"""


def _roundtrip_cols(df: DataFrame) -> DataFrame:
    miss = F.aggregate("features", F.lit(0).cast("bigint"),
                       lambda a, b: a + F.when(b.isNull() | F.isnan(b), 1).otherwise(0).cast("bigint"))
    fsum = F.aggregate("features", F.lit(0.0), lambda a, b: a + F.when(b.isNull() | F.isnan(b), 0.0).otherwise(b))
    return df.select("event_id", "class_", miss.alias("n_missing"), F.round(fsum, 6).alias("fsum"))


@register("feature_roundtrip_parquet", _ROUNDTRIP_SQL)
def feature_roundtrip_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature table → parquet partitioned by class (S3) → read back."""
    path = scratch_path(spark, "features-parquet")
    tables.write_features_parquet(fx.events_features(spark, sf_dir), path, partition_by=["class_"])
    return _roundtrip_cols(tables.read_feature_tables(spark, path))


@register("feature_roundtrip_csv", _ROUNDTRIP_SQL)
def feature_roundtrip_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature table → CSV: one class written, the rest appended (S4, S6) → whole folder read back."""
    f = fx.events_features(spark, sf_dir)
    names = ["f0", "f1", "f2"]
    path = scratch_path(spark, "features-csv")
    tables.write_features_csv(f.where(F.col("class_") == "click"), path, names=names, mode="overwrite")
    tables.write_features_csv(f.where(F.col("class_") != "click"), path, names=names, mode="append")
    back = tables.read_features_csv(spark, path, "event_id bigint, class_ string, f0 double, f1 double, f2 double", names)
    return _roundtrip_cols(back)


@register("map_partitioned", f"""
WITH {_RASTER_SQL}
SELECT col, "row", pred, grid_id, CAST(floor(col / 16) AS BIGINT) AS tile_x, CAST(floor("row" / 16) AS BIGINT) AS tile_y FROM mo
""")
def map_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mosaic written as a tile-partitioned pixel table (S10) and read back."""
    mo = raster.mosaic_first(_pred_pixels(spark, sf_dir), ("col", "row"), "pred", ["grid_id", "event_id"])
    path = tables.write_map(mo, scratch_path(spark, "map"), tile_size=16)
    back = spark.read.parquet(path)
    return back.select("col", "row", "pred", "grid_id", F.col("tile_x").cast("bigint"), F.col("tile_y").cast("bigint"))


@register("pixel_source", """
SELECT event_id, event_type AS class FROM events
WHERE CAST(user_id AS DOUBLE) BETWEEN 30.0 AND 90.0 AND value BETWEEN 100.0 AND 200.0
  AND ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts < TIMESTAMP '2024-01-20 00:00:00'
""")
def pixel_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pixel table partitioned by (year, tile_key) (S7): the scan prunes folders by key, then bbox + dates."""
    pts = fx.events_points(spark, sf_dir)
    tile = F.concat_ws("_", F.floor(F.col("x") / 50).cast("string"), F.floor(F.col("y") / 100).cast("string"))
    path = scratch_path(spark, "pixels")
    tables.write_tiled(pts.withColumn("year", F.year("t")).withColumn("tile_key", tile), path, ["year", "tile_key"], "event_id")
    keys = [f"{i}_{j}" for i in range(int(30 // 50), int(90 // 50) + 1) for j in range(int(100 // 100), int(200 // 100) + 1)]
    px = tables.read_pixels(spark, path, year=2024, tile_keys=keys)
    px = cube.between_times(px, "t", "2024-01-05 00:00:00", "2024-01-20 00:00:00")
    return spatial.bbox_filter(px, 30.0, 100.0, 90.0, 200.0).select("event_id", "class")


# ---------------------------------------------------------------------------------------------
# Regions given in EPSG:4326 → processing grids (G9): the customer shapes in degrees,
# 4326 → 3857 → area branch (1e8 m²) → grids of 5000 m with 500 m overlap → back to 4326.
# ---------------------------------------------------------------------------------------------

from .catalog import _sql_grid_cells  # noqa: E402

_R = "6378137.0"
_LAT = "degrees(2.0 * atan(exp({v} / 6378137.0)) - pi() / 2)"


@register("region_grids", f"""
WITH {fx.sql_customer_regions(fx.LONLAT_UNIT)},
cvm AS (SELECT k, ring, i, {_R} * radians(x) AS x, {_R} * ln(tan(pi() / 4 + radians(y) / 2.0)) AS y FROM cv),
cem AS (SELECT a.k AS region_id, a.ring, a.i, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2
        FROM cvm a JOIN cvm b ON a.k = b.k AND a.ring = b.ring AND b.i = (a.i + 1) % 4),
cbm AS (SELECT region_id, min(least(x1, x2)) AS minx, min(least(y1, y2)) AS miny,
               max(greatest(x1, x2)) AS maxx, max(greatest(y1, y2)) AS maxy FROM cem GROUP BY region_id),
ra AS (SELECT region_id, ring, abs(sum(x1 * y2 - x2 * y1) / 2.0) AS a FROM cem GROUP BY region_id, ring),
area AS (SELECT region_id, sum(CASE WHEN ring = 0 THEN a ELSE -a END) AS area FROM ra GROUP BY region_id),
{_sql_grid_cells("region_id IN (SELECT region_id FROM area WHERE area > 1e8)", cb="cbm", ce="cem")},
sb AS (SELECT k AS region_id, min(degrees(x / {_R})) AS minx, min({_LAT.format(v="y")}) AS miny,
              max(degrees(x / {_R})) AS maxx, max({_LAT.format(v="y")}) AS maxy
       FROM cvm GROUP BY k)
SELECT concat(region_id, ':0:', ix, ':', iy) AS grid_id,
       region_id, ix, iy,
       round(degrees(cx0 / {_R}), 6) AS minx, round({_LAT.format(v="cy0")}, 6) AS miny,
       round(degrees(cx1 / {_R}), 6) AS maxx, round({_LAT.format(v="cy1")}, 6) AS maxy
FROM kept
UNION ALL
SELECT concat(sb.region_id, ':0:-1:-1'), sb.region_id, -1, -1, round(sb.minx, 6), round(sb.miny, 6), round(sb.maxx, 6), round(sb.maxy, 6)
FROM sb JOIN area ON sb.region_id = area.region_id WHERE NOT (area.area > 1e8)
""")
def region_grids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions given in lon/lat → 3857 → grids if larger than 1e8 m² → back to lon/lat."""
    from ..operators import grid as G
    ll = fx.customer_regions(spark, sf_dir, unit=fx.LONLAT_UNIT, srid=4326)
    g = G.read_with_grids(ll, 1e8, 5000.0, 500.0)
    return g.select("grid_id", "region_id", "ix", "iy", *[F.round(c, 6).alias(c) for c in ("minx", "miny", "maxx", "maxy")])
@register("tile_source", """
SELECT vec_id // 64 AS tile_id, 10.0 + CAST((vec_id // 64) // 4 AS DOUBLE) * 0.1 AS tile_lat,
       70.0 + CAST((vec_id // 64) % 4 AS DOUBLE) * 0.1 AS tile_lon,
       CAST(count(*) AS BIGINT) AS n_pixels,
       round(sum(list_sum(list_transform(embedding, lambda v: CAST(v AS DOUBLE)))), 4) AS band_sum
FROM embeddings GROUP BY 1, 2, 3
""")
def tile_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense tile table keyed by (tile_lat, tile_lon, year), partitioned by year (S8), read back and unnested."""
    t = _embedding_tiles(spark, sf_dir).withColumn("tile_lat", F.lit(10.0) + F.floor(F.col("tile_id") / 4).cast("double") * 0.1) \
        .withColumn("tile_lon", F.lit(70.0) + (F.col("tile_id") % 4).cast("double") * 0.1).withColumn("year", F.lit(2024))
    path = scratch_path(spark, "tiles")
    t.write.partitionBy("year").parquet(path)
    px = cube.unnest_tiles(tables.read_tiles(spark, path, year=2024), keep=["tile_id", "tile_lat", "tile_lon"])
    px = px.where(F.col("bands").isNotNull())
    return px.groupBy("tile_id", "tile_lat", "tile_lon").agg(
        F.count(F.lit(1)).alias("n_pixels"), F.round(F.sum(fx.band_sum("bands", 12)), 4).alias("band_sum"))


@register("tile_at", """
SELECT vec_id, vec_id // 64 AS tile_id FROM embeddings
WHERE abs(10.0 + CAST((vec_id // 64) // 4 AS DOUBLE) * 0.1 - 10.1) < 1e-9 AND (vec_id // 64) % 4 = 2
""")
def tile_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One dense tile by its lat, lon and year."""
    path = scratch_path(spark, "tile-at")
    e = _t(spark, sf_dir, "embeddings").select("vec_id", F.floor(F.col("vec_id") / 64).alias("tile_id"))
    (e.withColumn("tile_lat", F.lit(10.0) + F.floor(F.col("tile_id") / 4).cast("double") * 0.1)
     .withColumn("tile_lon", F.lit(70.0) + (F.col("tile_id") % 4).cast("double") * 0.1)
     .withColumn("year", F.lit(2024)).write.partitionBy("year").parquet(path))
    return tables.read_tiles(spark, path, 10.1, 70.2, 2024).select("vec_id", "tile_id")


@register("stream_extract", f"""
SELECT ins.event_id, ins.region_id, ev.event_type AS class FROM (
  SELECT ev.event_id, r.region_id
  FROM events ev JOIN {fx.sql_edges_values()}
    ON ((r.y1 > ev.value) <> (r.y2 > ev.value))
   AND ((r.x2 - r.x1) * (ev.value - r.y1) - (CAST(ev.user_id AS DOUBLE) - r.x1) * (r.y2 - r.y1)) * (r.y2 - r.y1) > 0
  GROUP BY ALL HAVING count(*) % 2 = 1) ins
JOIN events ev ON ev.event_id = ins.event_id
""")
def stream_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incremental extraction (S3/S4 append): pixel files arrive as a file-source stream, are clipped to
    the regions by the same bin join (stream–static) and appended to parquet; the sink is read back."""
    from ..streaming import extract_stream
    pts = fx.events_points(spark, sf_dir).withColumn("bands", F.array(F.col("y").cast("float")))
    src = scratch_path(spark, "stream-src")
    pts.repartition(4, "event_id").write.parquet(src)
    out = scratch_path(spark, "stream-out")
    schema = "event_id bigint, x double, y double, t timestamp_ntz, class string, bands array<float>"
    q = extract_stream.start_extraction(spark, src, schema, fx.probe_regions(spark), 25.0, out, year=None,
                                        checkpoint=out + "-ckpt")
    q.awaitTermination()  # until all files are read: a part of them is not the result
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.read.parquet(out).select("event_id", "region_id", "class")


@register("stream_composite", _EXTRACT_CUBE_SQL)
def stream_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extraction with its composite over layers that arrive in any order (P14 with S4, P5): the pixels of the
    cube come as files dealt by a hash, three files a micro-batch; equal to ``extract_cube``."""
    from ..streaming import extract_stream
    src, out = scratch_path(spark, "composite-src"), scratch_path(spark, "composite-out")
    fx.cube_pixels(spark, sf_dir).drop("label").repartition(8, F.xxhash64("vec_id")).write.parquet(src)
    n = cube.array_width(spark.read.parquet(src), "bands")
    q = extract_stream.start_composite(
        spark, src, "vec_id bigint, x double, y double, t timestamp_ntz, bands array<float>", fx.extract_regions(spark, sf_dir),
        4.0, out, n, year=2024, max_files_per_trigger=3, checkpoint=out + "-ckpt")
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    got = extract_stream.read_composite(spark, out, n, cls=1)
    return got.select("region_id", "x", "y", "n_steps", fx.band_sum("bands").alias("band_sum"), "class")
