"""End-to-end plans: dataset extraction (P14, P15), training (§3.2), map (R13) and evaluation.

Each is one lazily built Spark plan; the only driver round trips are scalars (class counts inside
balancing, a size check before a broadcast) and the small outputs (report rows, metric row).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import cube, grid, learn, metrics, prep, raster, spatial
from ..operators import regions as R
from ..operators import tiles as T
from ..session import materialize


def in_pixel_crs(regions: DataFrame, pixel_srid: int | None) -> DataFrame:
    """Regions in the CRS of the pixels (G2, G3); without ``pixel_srid`` both share one plane already."""
    return regions if pixel_srid is None else R.reproject(regions, pixel_srid)


def extract_from_cube(regions: DataFrame, pixels: DataFrame, year: int | None, bin_size: float,
                      composite: str = "max", cls: int | None = None, clip: bool = True,
                      n_bands: int | None = None, region_cols: list[str] | None = None,
                      tiles: tuple[str, str, float] | None = None, pixel_srid: int | None = None,
                      tie: str | None = None) -> DataFrame:
    """Regions → pixels inside → temporal composite → label.

    ``pixels``: ``(x, y, t, bands)`` in the CRS ``pixel_srid``, to which the regions are brought.
    ``clip=False`` keeps the whole bounding box with NULL bands outside the polygon (the masked form).
    Failed/empty regions simply contribute no rows; use :func:`spatial.coverage_report` to list them
    (P13).  With ``tiles`` (tile-partitioned pixel table) only the tile folders some region touches are
    read (dynamic partition pruning).  ``tie`` decides between layers of one time.
    """
    region_cols = list(region_cols or ["region_id"])
    regions = in_pixel_crs(regions, pixel_srid)
    px = cube.filter_dates(pixels, year, "t") if year is not None else pixels
    how = "inner" if clip else "mask"
    joined = spatial.spatial_join(px, regions, bin_size, how=how, region_cols=region_cols, tiles=tiles)
    if not clip:
        joined = joined.withColumn("bands", F.when(F.col("_inside"), F.col("bands"))).drop("_inside")
    out = cube.composite(joined, [*region_cols, "x", "y"], "bands", n_bands, "t", composite, tie)
    return cube.add_class(out, cls)


def extract_from_tiles(tiles: DataFrame, regions: DataFrame, bin_size: float, cls: int | None = None,
                       tile_keys: list[str] | None = None, region_cols: list[str] | None = None,
                       n_bands: int | None = None, pixel_srid: int | None = None,
                       chunk_bin: float | None = None) -> DataFrame:
    """Tiles → pixel rows → clip to each region → drop missing → label.

    Only tiles whose bounds meet some region's are unnested: a first look reads keys and bounds alone.
    One scan of those tiles serves every region (the join shares it).  ``chunk_bin``: ``tiles`` is a table of
    chunks, written with bins of that size; only folders near a region are read.
    """
    keys = list(tile_keys or ["tile_id"])
    regions = in_pixel_crs(regions, pixel_srid)
    under = T.chunks_under(tiles, regions, chunk_bin) if chunk_bin else tiles_under(tiles, regions, bin_size, keys)
    px = cube.unnest_tiles(under, keep=keys)
    clipped = spatial.spatial_join(px, regions, bin_size, how="inner", region_cols=region_cols)
    return cube.add_class(cube.drop_missing(clipped, "bands", n_bands=n_bands), cls)


def tiles_under(tiles: DataFrame, regions: DataFrame, bin_size: float, keys: list[str]) -> DataFrame:
    """The tiles whose bounds meet the bounds of some region (G12, G13), by an equality on bins."""
    a, b = F.col("affine"), F.lit(float(bin_size))
    xs = (a[0], a[0] + F.col("w") * a[1])
    ys = (a[3], a[3] + F.col("h") * a[5])
    box = tiles.select(*keys, F.least(*xs).alias("_x0"), F.least(*ys).alias("_y0"), F.greatest(*xs).alias("_x1"),
                       F.greatest(*ys).alias("_y1"))
    box = (box.withColumn("_tx", F.explode(F.sequence(F.floor(F.col("_x0") / b), F.floor(F.col("_x1") / b))))
           .withColumn("_ty", F.explode(F.sequence(F.floor(F.col("_y0") / b), F.floor(F.col("_y1") / b)))))
    cover = (regions.select("minx", "miny", "maxx", "maxy")
             .withColumn("tile_x", F.explode(F.sequence(F.floor(F.col("minx") / b), F.floor(F.col("maxx") / b))))
             .withColumn("tile_y", F.explode(F.sequence(F.floor(F.col("miny") / b), F.floor(F.col("maxy") / b)))))
    meet = ((F.col("_tx") == F.col("tile_x")) & (F.col("_ty") == F.col("tile_y")) & (F.col("_x0") <= F.col("maxx"))
            & (F.col("_x1") >= F.col("minx")) & (F.col("_y0") <= F.col("maxy")) & (F.col("_y1") >= F.col("miny")))
    hit = box.join(cover, meet, "left_semi").select(*keys).distinct()
    return tiles.join(spatial.checked_broadcast(hit), keys, "left_semi")


def training_rows(extracted: DataFrame, name: str | None = None, region_cols: tuple[str, ...] = ("region_id",)) -> DataFrame:
    """Extracted pixels as training rows: ``pixel_id`` (a hash of region and place) and ``features``; the class
    column as it is, or left to the label union when the table stands for one class."""
    place = [c for c in (*region_cols, "tile_id", "row", "col", "x", "y") if c in extracted.columns]
    cls = ["class"] if name is None and "class" in extracted.columns else []
    return extracted.select(F.xxhash64(*place).alias("pixel_id"), F.col("bands").alias("features"), *cls)


@dataclass
class TrainResult:
    model: PipelineModel
    report: DataFrame
    accuracy: float
    n_train: int


def train_random_forest(tables: dict[str, DataFrame], id_cols: list[str], n_features: int,
                        background: int | None = 5, downsample: bool = True, test_size: float = 0.3,
                        seed: int = 42, num_trees: int = 100, max_depth: int = 15) -> TrainResult:
    """Label union → clean → balance → background → split → validate → fit → report (§3.2)."""
    data, _ = prep.label_union(tables, "class_")
    data = prep.prepare_training(data, id_cols, "features", "class_", background, 50, downsample, seed,
                                 n_features=n_features)
    flag = prep.split_flag(id_cols, test_size, seed)
    # the prepared table feeds validation, training and testing: written once to the checkpoint folder
    data = materialize(data.withColumn("split", F.when(flag, "test").otherwise("train")))
    val = prep.validate_split(data, "split", "features", "class_")
    prep.assert_valid(val)
    n_train = val.where(F.col("split") == "train").first()["n_rows"]
    train = data.where(F.col("split") == "train")
    test = data.where(F.col("split") == "test")
    model = learn.fit_random_forest(train, n_features, "features", "class_", num_trees, max_depth, seed)
    pred = learn.predict(model, test, "pred")
    report = metrics.classification_report(pred, "class_", "pred")
    acc_row = report.where(F.col("label") == "accuracy").first()
    return TrainResult(model, report, float(acc_row["f1_score"]) if acc_row else float("nan"), int(n_train))


def processing_grids(regions: DataFrame, min_area: float, grid_size: float, grid_overlap: float,
                     pixel_srid: int | None, no_grids: int | None, seed: int) -> DataFrame:
    """Grids of the regions in the pixels' CRS: area branch and cells in web Mercator metres (G9) when the
    regions carry a CRS, in the common plane otherwise; then the seeded sample (G15)."""
    if pixel_srid is None:
        grids = grid.add_grids_if_needed(regions, min_area, grid_size, grid_overlap)
    else:
        merc = R.reproject(regions, R.SRID_MERCATOR)
        grids = grid.add_grids_if_needed(merc, min_area, grid_size, grid_overlap).withColumn("srid", F.lit(R.SRID_MERCATOR))
        grids = R.reproject(grids, pixel_srid, from_srids=(R.SRID_MERCATOR,))
    return grid.sample_grids(grids, no_grids, seed)


def grid_pixels(grids: DataFrame, pixels: DataFrame, bin_size: float,
                tiles: tuple[str, str, float] | None = None) -> DataFrame:
    """Pixels of every processing grid (R1/R2): one spatial join over all grids at once; with ``tiles``
    only the pixel tiles under some grid are scanned."""
    return spatial.spatial_join(pixels, grids, bin_size, how="inner", region_cols=["grid_id"], tiles=tiles)


def predict_grids(grids: DataFrame, pixels: DataFrame, predict_fn, bin_size: float, x0: float, y0: float, res: float,
                  tiles: tuple[str, str, float] | None = None) -> DataFrame:
    """``grid_id, col, row, pred, x, y`` of every (grid, pixel).

    The model runs once per pixel under any grid; its small result then meets the overlapping grids.
    """
    under = spatial.spatial_join(pixels, grids, bin_size, how="semi", region_cols=["grid_id"], tiles=tiles)
    c, r = raster.to_cell(F.col("x"), F.col("y"), x0, y0, res)
    preds = raster.cast_pred(predict_fn(under), "pred").select("x", "y", "pred", c, r)
    return grid_pixels(grids, preds, bin_size).select("grid_id", "col", "row", "pred", "x", "y")


def save_predictions(regions: DataFrame, pixels: DataFrame, predict_fn, bin_size: float, x0: float, y0: float,
                     res: float, min_area: float = 1e8, grid_size: float = 5000.0, grid_overlap: float = 500.0,
                     clip: bool = True, no_grids: int | None = None, seed: int = 42,
                     tiles: tuple[str, str, float] | None = None, pixel_srid: int | None = None) -> DataFrame:
    """Full map (R13): grids → sample → pixels → predict → mosaic → clip to the regions' union.

    Returns ``(col, row, pred, grid_id)``; write it with :func:`sources.tables.write_map` (S10).  Of several
    pixels of one grid in a cell the one with the smallest (y, x) counts.
    """
    grids = processing_grids(regions, min_area, grid_size, grid_overlap, pixel_srid, no_grids, seed)
    preds = predict_grids(grids, pixels, predict_fn, bin_size, x0, y0, res, tiles)
    mosaic = raster.mosaic_first(preds, ("col", "row"), "pred", ["grid_id", "y", "x"])
    if not clip:
        return mosaic
    xc, yc = raster.cell_centre(F.col("col"), F.col("row"), x0, y0, res)
    centred = mosaic.withColumn("x", xc).withColumn("y", yc)
    return spatial.spatial_join(centred, in_pixel_crs(regions, pixel_srid), bin_size, how="semi").drop("x", "y")


def evaluate_predictions(regions: DataFrame, pixels: DataFrame, reference: DataFrame, predict_fn,
                         bin_size: float, x0: float, y0: float, res: float, target: int = 8,
                         positive: int = 1, min_area: float = 1e8, grid_size: float = 5000.0,
                         grid_overlap: float = 500.0, no_grids: int | None = None, seed: int = 42,
                         tiles: tuple[str, str, float] | None = None, pixel_srid: int | None = None,
                         ref_lattice: tuple[float, float, float] | None = None,
                         ref_srid: int | None = None, ref_tile: int | None = None) -> DataFrame:
    """Map evaluation (E7): per-grid precision / recall / accuracy against the reference, then the mean.

    ``reference``: ``(col, row, value)`` on the lattice ``ref_lattice = (x0, y0, res)`` in the CRS ``ref_srid``
    (default: those of the predictions).  It is cropped to the grids' bounds (R8; ``ref_tile``: the tile
    size of a reference partitioned by ``tile_x, tile_y``, of which only tiles under grids are read), and each grid's
    predictions are taken at the centres of its cells (R7, R9).  Truth = ``value == target``; the
    prediction is positive when it equals ``positive``.
    """
    grids = processing_grids(regions, min_area, grid_size, grid_overlap, pixel_srid, no_grids, seed)
    preds = predict_grids(grids, pixels, predict_fn, bin_size, x0, y0, res, tiles)
    preds = raster.mosaic_first(preds, ("grid_id", "col", "row"), "pred", ["y", "x"])
    rx0, ry0, rres = ref_lattice or (x0, y0, res)
    to_pred = to_ref = None
    if ref_srid is not None and ref_srid != pixel_srid:
        to_pred = lambda x, y: R.transform_points(x, y, ref_srid, pixel_srid)
        to_ref = lambda x, y: R.transform_points(x, y, pixel_srid, ref_srid)
    reference = raster.crop(reference, grids, rx0, ry0, rres, to_ref, ref_tile)
    pairs = raster.align_nearest(preds, reference, x0, y0, res, rx0, ry0, rres, keys=["grid_id"], ref_to_pred=to_pred)
    pairs = raster.drop_unpaired(raster.mask_sentinels(pairs, "pred"), ("pred", "value"))
    pairs = raster.binarise(pairs, "value", target, "truth").withColumn(
        "p", (F.col("pred") == F.lit(positive)).cast("int"))
    scores = metrics.binary_scores(pairs, "truth", "p", ["grid_id"], positive=1)
    return metrics.macro_mean(scores)
