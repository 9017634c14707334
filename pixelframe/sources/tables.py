"""Table sources and sinks (S2–S10): feature tables, pixel/tile sources, reference maps, map sink.

Rasters enter and leave as parquet pixel tables; partition columns (year, tile keys, class) let the
scan prune by equality on the keys, and every write is one part file per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cube import array_width, of_width

# Band names of the 64-band embedding cube (A00 … A63).
N_BANDS = 64


def band_names(n: int = N_BANDS) -> list[str]:
    return [f"A{i:02d}" for i in range(n)]


def read_feature_tables(spark: SparkSession, paths: list[str] | str, schema: str | None = None) -> DataFrame:
    """One or many parquet feature files (S2); an explicit schema skips inference."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(*paths)


def write_features_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None,
                           mode: str = "overwrite") -> None:
    """Feature table → parquet, overwriting (S3); optionally partitioned (e.g. by class)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def spread_features(df: DataFrame, features: str = "features", n: int | None = None,
                    names: list[str] | None = None) -> DataFrame:
    """Array column → one column per band (the wide CSV layout).

    As many columns as ``names``, ``n`` or the first array say; an array of another width raises.
    """
    names = names or band_names(n or array_width(df, features))
    checked = df.withColumn(features, of_width(features, len(names)))
    return checked.select(*[c for c in df.columns if c != features],
                          *[F.col(features)[i].alias(nm) for i, nm in enumerate(names)])


def gather_features(df: DataFrame, names: list[str], features: str = "features") -> DataFrame:
    """Wide band columns → one array column."""
    return df.select(*[c for c in df.columns if c not in names], F.array(*[F.col(n) for n in names]).alias(features))


def write_features_csv(df: DataFrame, path: str, features: str = "features", n: int | None = None,
                       names: list[str] | None = None, mode: str = "append") -> None:
    """Feature table → CSV with header (S4, S6); ``append`` (default) adds part files to the folder."""
    spread_features(df, features, n, names).write.mode(mode).option("header", True).csv(path)


def read_features_csv(spark: SparkSession, path: str, schema: str, names: list[str],
                      features: str = "features") -> DataFrame:
    """CSV read-back of the whole folder (S5) with an explicit schema."""
    df = spark.read.schema(schema).option("header", True).option("nanValue", "NaN").csv(path)
    return gather_features(df, names, features)


def write_tiled(df: DataFrame, path: str, keys: list[str], id_col: str, mode: str = "overwrite") -> None:
    """Pixel table → parquet in folders of ``keys``.

    Rows are dealt by ranges of the keys first, so a folder comes from one task and not from each: about as many
    files as folders and tasks together.  ``id_col`` cuts a folder with very many rows into several ranges.
    """
    df.repartitionByRange(*keys, F.xxhash64(id_col)).write.mode(mode).partitionBy(*keys).parquet(path)


def read_pixels(spark: SparkSession, path: str, year: int | None = None,
                tile_keys: list[str] | None = None) -> DataFrame:
    """Embedding pixel source partitioned by ``year``/``tile_key`` (S7): equality filters prune folders."""
    df = spark.read.parquet(path)
    if year is not None:
        df = df.where(F.col("year") == year)
    if tile_keys:
        df = df.where(F.col("tile_key").isin(tile_keys))
    return df


def read_tiles(spark: SparkSession, path: str, tile_lat: float | None = None, tile_lon: float | None = None,
               year: int | None = None) -> DataFrame:
    """Dense tile source (S8) filtered by (lat, lon, year); lat and lon as narrow ranges, which push down."""
    df = spark.read.parquet(path)
    for c, v in (("tile_lat", tile_lat), ("tile_lon", tile_lon)):
        if v is not None:
            df = df.where(F.col(c).between(v - 1e-9, v + 1e-9))
    return df if year is None else df.where(F.col("year") == year)


def read_reference(spark: SparkSession, path: str) -> DataFrame:
    """Reference land-cover map as a pixel table ``(col, row, value)``."""
    return spark.read.parquet(path)


def write_map(df: DataFrame, path: str | None = None, tile_size: int = 2048, mode: str = "overwrite") -> str:
    """Prediction map sink (S10): pixel rows partitioned by tile keys; default path ``prediction``."""
    path = path or "prediction"
    out = (df.withColumn("tile_x", F.floor(F.col("col") / tile_size))
           .withColumn("tile_y", F.floor(F.col("row") / tile_size)))
    out.repartition("tile_x", "tile_y").write.mode(mode).partitionBy("tile_x", "tile_y").parquet(path)
    return path


def write_report(spark: SparkSession, text: str, path: str) -> None:
    """Text report sink (S11): a handful of lines, one part file."""
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)
