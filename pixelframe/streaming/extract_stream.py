"""Incremental dataset extraction with Structured Streaming.

The batch extractor's pipelined writing — results appended as each region finishes, CSV appended to
an existing file — becomes a file-source stream: new pixel files are clipped to the (static) regions
with the same bin-keyed stream–static join and appended to a parquet or CSV sink.  Progress lives
in the checkpoint folder that the caller names, so a restarted query resumes where it
stopped and a lost executor only re-runs its micro-batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import cube, spatial


def pixel_stream(spark: SparkSession, path: str, schema: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """New parquet pixel files under ``path`` as a stream (explicit schema, as streams require)."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return r.parquet(path)


def clip_stream(pixels: DataFrame, regions: DataFrame, bin_size: float, year: int | None = None,
                cls: int | None = None, region_cols: list[str] | None = None) -> DataFrame:
    """Date window (P1) → clip to regions (P4) → class (P12), all stateless per micro-batch."""
    px = cube.filter_dates(pixels, year, "t") if year is not None else pixels
    # regions are static: size-check once and broadcast, so each micro-batch is a map-side join
    out = spatial.spatial_join(px, regions, bin_size, how="inner", region_cols=region_cols)
    return cube.add_class(out, cls)


def start_extraction(spark: SparkSession, pixels_path: str, schema: str, regions: DataFrame, bin_size: float,
                     out_path: str, year: int | None = None, cls: int | None = None, fmt: str = "parquet",
                     *, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Run the clip as a stream appending to ``out_path`` (parquet, or CSV with header).

    ``checkpoint`` is a fixed folder on shared storage: a query started again with it goes on where the
    last one stopped, and reads no file twice.
    """
    stream = clip_stream(pixel_stream(spark, pixels_path, schema), regions, bin_size, year, cls)
    if fmt == "csv":
        stream = stream.withColumn("bands", F.to_json("bands"))
    w = (stream.writeStream.format(fmt).outputMode("append")
         .option("checkpointLocation", checkpoint)
         .option("path", out_path))
    if fmt == "csv":
        w = w.option("header", True)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def partial_composite(clipped: DataFrame, keys: list[str], n_bands: int, how: str = "max", tie: str | None = None) -> DataFrame:
    """What a part of the layers adds to a composite: parts merge in any order (:func:`merge_composites`).

    ``max``: per-band maxima and the number of layers.  ``latest``: the last layer and what it was ranked by.
    """
    if how == "max":
        return cube.composite_max(clipped, keys, "bands", n_bands)
    if how != "latest":
        raise ValueError("how must be 'max' or 'latest'")
    rank = F.struct("t", tie) if tie else F.col("t")
    return (clipped.withColumn("bands", cube.of_width("bands", n_bands)).withColumn("_rank", rank).groupBy(*keys)
            .agg(F.max_by("bands", "_rank").alias("bands"), F.max("t").alias("t"), F.max("_rank").alias("_rank")))


def merge_composites(parts: DataFrame, keys: list[str], n_bands: int, how: str = "max") -> DataFrame:
    """The composite of all layers from the partial composites of its parts: one aggregate on the pixel."""
    if how == "latest":
        return parts.groupBy(*keys).agg(F.max_by("bands", "_rank").alias("bands"), F.max("t").alias("t"),
                                        F.max("_rank").alias("_rank"))
    tops = [F.max(F.col("bands")[i]).alias(f"_m{i}") for i in range(n_bands)]
    out = parts.groupBy(*keys).agg(F.sum("n_steps").alias("n_steps"), *tops)
    return out.select(*keys, "n_steps", F.array(*[F.col(f"_m{i}") for i in range(n_bands)]).alias("bands"))


def start_composite(spark: SparkSession, pixels_path: str, schema: str, regions: DataFrame, bin_size: float,
                    out_path: str, n_bands: int, year: int | None = None, how: str = "max", tie: str | None = None,
                    region_cols: list[str] | None = None, max_files_per_trigger: int | None = None,
                    *, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Extraction with its composite (P14) that goes on as layers arrive, late ones included.

    Each micro-batch is clipped, reduced to its partial composite and written to its own folder
    ``out_path/batch=<id>``, replacing what an interrupted attempt at the same batch left: a batch that runs
    twice counts once.  No state is held between batches; :func:`read_composite` merges the folders.
    """
    keys = [*(region_cols or ["region_id"]), "x", "y"]

    def write(batch: DataFrame, batch_id: int) -> None:
        part = partial_composite(clip_stream(batch, regions, bin_size, year, None, region_cols), keys, n_bands, how, tie)
        part.write.mode("overwrite").parquet(f"{out_path}/batch={batch_id}")

    w = (pixel_stream(spark, pixels_path, schema, max_files_per_trigger).writeStream.foreachBatch(write)
         .option("checkpointLocation", checkpoint))
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")).start()


def read_composite(spark: SparkSession, out_path: str, n_bands: int, how: str = "max", cls: int | None = None,
                   region_cols: list[str] | None = None, base: DataFrame | None = None, after: int | None = None) -> DataFrame:
    """The composite of everything that :func:`start_composite` has written so far, with its class.

    A long stream is folded now and then: write this result (without class) elsewhere and pass it as ``base``
    with ``after``, the last batch in it.  Batches up to that one are not read then.
    """
    keys = [*(region_cols or ["region_id"]), "x", "y"]
    parts = spark.read.parquet(out_path)
    if after is not None:
        parts = parts.where(F.col("batch") > after)
    parts = parts.drop("batch")
    if base is not None:
        parts = parts.unionByName(base)
    return cube.add_class(merge_composites(parts, keys, n_bands, how), cls)
