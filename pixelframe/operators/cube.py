"""Pixel-cube operators on long pixel tables.

A cube is a long table ``(keys…, x, y, t, bands array<float>)``: one row per pixel and time step.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_window(year: int) -> tuple[dt.datetime, dt.datetime]:
    """Acquisition window of one map year: ``YEAR-01-01`` through ``(YEAR+1)-08-19`` inclusive."""
    return dt.datetime(year, 1, 1), dt.datetime(year + 1, 8, 20)


def ts_literal(df: DataFrame, t: str, value: dt.datetime | str) -> Column:
    """A timestamp literal typed like column ``t`` (``timestamp_ntz`` stays wall-clock, independent of the
    session time zone; ``timestamp`` is read in the session time zone as Spark reads strings)."""
    text = value.strftime("%Y-%m-%d %H:%M:%S") if isinstance(value, dt.datetime) else str(value)
    return F.lit(text).cast(df.schema[t].dataType)


def between_times(df: DataFrame, t: str, start: dt.datetime | str, end: dt.datetime | str) -> DataFrame:
    """``start <= t < end`` with literals of the column's own type — pushed down to parquet."""
    return df.where((F.col(t) >= ts_literal(df, t, start)) & (F.col(t) < ts_literal(df, t, end)))


def filter_dates(df: DataFrame, year: int, t: str = "t") -> DataFrame:
    """Date-range filter (P1) as a half-open range on ``t`` — a predicate parquet can push down."""
    start, end = date_window(year)
    return between_times(df, t, start, end)


def array_width(df: DataFrame, arr: str) -> int:
    """Width of the first array that is not NULL (0: none); what reads it must check the others."""
    row = df.where(F.col(arr).isNotNull()).select(F.size(arr).alias("n")).first()
    return int(row["n"]) if row else 0


def of_width(arr: Column | str, n: int) -> Column:
    """The array, NULL included; one of another width than ``n`` raises, it is never cut or padded."""
    a = _c(arr)
    wrong = F.concat(F.lit(f"array of width {n} expected, found "), F.size(a).cast("string"))
    return F.when(a.isNull() | (F.size(a) == n), a).otherwise(F.raise_error(wrong))


def composite_max(df: DataFrame, keys: list[str], bands: str = "bands", n_bands: int | None = None,
                  t: str = "t") -> DataFrame:
    """Per-pixel, per-band maximum over time, missing skipped (P5).

    The width is ``n_bands`` or that of the first array; rows of another width raise.

    One hash aggregate with ``n_bands`` partial maxima: map-side combine, one shuffle on the pixel key.
    With a single time step the result is that step (max of one value), which covers P6's branch.
    """
    # NaN → NULL per element inside each aggregate: plain expressions, compiled with the aggregate
    # (an array lambda would run interpreted over every band of every row)
    n_bands = n_bands or array_width(df, bands)
    df = df.withColumn(bands, of_width(bands, n_bands))
    b = F.col(bands)
    aggs = [F.max(F.when(~F.isnan(b[i]), b[i])).alias(f"_m{i}") for i in range(n_bands)]
    out = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_steps"), *aggs)
    return out.select(*keys, "n_steps", F.array(*[F.col(f"_m{i}") for i in range(n_bands)]).alias(bands))


def latest_layer(df: DataFrame, keys: list[str], bands: str = "bands", t: str = "t",
                 tie: str | None = None) -> DataFrame:
    """The last time step per pixel (P6): ``max_by`` on (t, tie) — no sort, one shuffle."""
    order = F.struct(F.col(t), F.col(tie)) if tie else F.col(t)
    return df.groupBy(*keys).agg(F.max_by(F.col(bands), order).alias(bands), F.max(t).alias(t))


def composite(df: DataFrame, keys: list[str], bands: str = "bands", n_bands: int | None = None,
              t: str = "t", how: str = "max", tie: str | None = None) -> DataFrame:
    if how == "max":
        return composite_max(df, keys, bands, n_bands, t)
    if how == "latest":
        return latest_layer(df, keys, bands, t, tie)
    raise ValueError("how must be 'max' or 'latest'")


def unnest_tiles(tiles: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Dense tile → one row per pixel (P8), with coordinates from the affine transform.

    ``data[pos]`` holds the band vector of pixel ``pos`` in row-major order; ``affine`` is
    ``[x0, dx, 0, y0, 0, dy]`` (``dy`` negative for north-up); pixel centres are at +0.5.  A chunk of a tile
    (:mod:`.tiles`) gives the rows, columns and coordinates of its tile.
    """
    keep = list(keep or [])
    r0, c0 = ("row0", "col0") if "row0" in tiles.columns else (F.lit(0).alias("row0"), F.lit(0).alias("col0"))
    out = tiles.select(*keep, "w", "affine", r0, c0, F.posexplode("data").alias("pos", "bands"))
    row = (F.col("row0") + F.floor(F.col("pos") / F.col("w"))).cast("int")
    col = (F.col("col0") + F.col("pos") % F.col("w")).cast("int")
    a = F.col("affine")
    return out.select(
        *keep, row.alias("row"), col.alias("col"),
        (a[0] + (col + 0.5) * a[1] + (row + 0.5) * a[2]).alias("x"),
        (a[3] + (col + 0.5) * a[4] + (row + 0.5) * a[5]).alias("y"),
        "bands",
    )


def any_missing(arr: Column | str) -> Column:
    return F.exists(_c(arr), lambda b: b.isNull() | F.isnan(b))


def all_missing(arr: Column | str) -> Column:
    return F.forall(_c(arr), lambda b: b.isNull() | F.isnan(b))


def drop_missing(df: DataFrame, bands: str = "bands", also: list[str] | None = None,
                 n_bands: int | None = None) -> DataFrame:
    """Drop rows with any missing band (P11 / D3); NULL array counts as missing.

    Arrays of the usual width ``n_bands`` are tested by a flat compiled expression instead of an array
    lambda; arrays of any other width take the lambda, so the result is the same either way.
    """
    b = _c(bands)
    whole = b.isNotNull() & ~any_missing(bands)
    if n_bands:
        missing = F.lit(False)
        for i in range(n_bands):
            missing = missing | b[i].isNull() | F.isnan(b[i])
        cond = F.when(F.size(b) == n_bands, ~missing).otherwise(whole)
    else:
        cond = whole
    for c in also or []:
        cond = cond & F.col(c).isNotNull()
    return df.where(cond)


def fill_missing(df: DataFrame, bands: str = "bands", value: float = 0.0, n_bands: int | None = None) -> DataFrame:
    """Missing bands → ``value`` (D7); arrays of the width ``n_bands`` by a flat compiled expression, others by
    an array lambda.  A NULL array stays NULL."""
    elem = df.schema[bands].dataType.elementType
    fill = F.lit(value).cast(elem)
    each = F.transform(bands, lambda x: F.when(x.isNull() | F.isnan(x), fill).otherwise(x))
    if n_bands:
        b = F.col(bands)
        filled = F.array(*[F.when(b[i].isNull() | F.isnan(b[i]), fill).otherwise(b[i]) for i in range(n_bands)])
        each = F.when(F.size(b) == n_bands, filled).otherwise(each)
    return df.withColumn(bands, each)


def add_class(df: DataFrame, cls: int | None, name: str = "class") -> DataFrame:
    """Constant class column (P12); class 0 is written too, only ``None`` skips it."""
    return df if cls is None else df.withColumn(name, F.lit(int(cls)))


def drop_coords(df: DataFrame, extra: tuple[str, ...] = ("time", "spatial_ref")) -> DataFrame:
    """Drop coordinate columns ``x``, ``y`` and, when present, ``time``/``spatial_ref``."""
    return df.drop(*[c for c in ("x", "y", *extra) if c in df.columns])


def rename_dims(df: DataFrame) -> DataFrame:
    """``X``→``x``, ``Y``→``y`` when present (P10)."""
    mapping = {k: v for k, v in (("X", "x"), ("Y", "y")) if k in df.columns}
    return df.withColumnsRenamed(mapping) if mapping else df

