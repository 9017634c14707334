"""Region tables (data model #1/#2): build, reproject, measure."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo

SRID_LONLAT = 4326
SRID_MERCATOR = 3857


def with_geometry(df: DataFrame, rings: str = "rings") -> DataFrame:
    """Add ``edges`` and bounds from a ``rings`` column (ring 0 outer, then holes)."""
    out = df.withColumn("edges", geo.polygon_edges(F.col(rings)))
    b = geo.edges_bounds(F.col("edges"))
    return out.withColumns({k: v for k, v in b.items()})


def utm_zone_of_srid(srid: int) -> tuple[int, bool] | None:
    """``(zone, south)`` of EPSG:326zz / 327zz, else None."""
    base, zone = divmod(int(srid), 100)
    return (zone, base == 327) if base in (326, 327) and 1 <= zone <= 60 else None


def is_supported(srid: Column) -> Column:
    """Whether an EPSG code is lon/lat, web Mercator or a UTM zone."""
    return F.coalesce(srid.isin(SRID_LONLAT, SRID_MERCATOR) | (srid.between(32601, 32660)) | (srid.between(32701, 32760)),
                      F.lit(False))


def to_lonlat(srid: int):
    """The point transform from ``srid`` to lon/lat."""
    if srid == SRID_LONLAT:
        return lambda x, y: (x, y)
    if srid == SRID_MERCATOR:
        return geo.mercator_to_lonlat
    if utm := utm_zone_of_srid(srid):
        return lambda x, y: geo.utm_to_lonlat(x, y, *utm)
    raise ValueError(f"unsupported CRS EPSG:{srid}")


def from_lonlat(srid: int):
    """The point transform from lon/lat to ``srid``."""
    if srid == SRID_LONLAT:
        return lambda x, y: (x, y)
    if srid == SRID_MERCATOR:
        return geo.lonlat_to_mercator
    if utm := utm_zone_of_srid(srid):
        return lambda x, y: geo.lonlat_to_utm(x, y, *utm)
    raise ValueError(f"unsupported CRS EPSG:{srid}")


def transform_points(x: Column, y: Column, from_srid: int, to_srid: int) -> tuple[Column, Column]:
    """Points between any two of lon/lat, web Mercator and the UTM zones."""
    if from_srid == to_srid:
        return x, y
    return from_lonlat(to_srid)(*to_lonlat(from_srid)(x, y))


def reproject(df: DataFrame, to_srid: int, srid_col: str = "srid", from_srids: tuple[int, ...] | None = None) -> DataFrame:
    """Reproject ``rings``/``edges``/bounds to lon/lat, web Mercator or a UTM zone.

    Rows already in ``to_srid`` pass.  The CRSs in the table are its distinct ``srid`` values (a small
    aggregate) or ``from_srids``; a row of any other, or an unsupported one, raises.
    """
    if from_srids is None:
        from_srids = tuple(r[0] for r in df.select(srid_col).distinct().collect())
    from_lonlat(to_srid)
    for s in from_srids:
        if s is None:
            raise ValueError("rows without a CRS")
        to_lonlat(s)
    srid = F.col(srid_col)
    known = srid.isin(*from_srids, to_srid) if from_srids else srid == to_srid
    wrong = F.raise_error(F.concat(F.lit("CRS not listed: "), F.coalesce(srid.cast("string"), F.lit("null"))))

    def moved(col: str, transform) -> Column:
        out = F.when(~F.coalesce(known, F.lit(False)), wrong.cast(df.schema[col].dataType))
        for s in from_srids:
            if s != to_srid:
                out = out.when(srid == s, transform(col, lambda x, y, s=s: transform_points(x, y, s, to_srid)))
        return out.otherwise(F.col(col))

    cols: dict[str, Column] = {}
    if "rings" in df.columns:
        cols["rings"] = moved("rings", geo.transform_rings)
    cols["edges"] = moved("edges", geo.transform_edges)
    out = df.withColumns(cols)
    b = geo.edges_bounds(F.col("edges"))
    return out.withColumns(b).withColumn(srid_col, F.lit(to_srid))


def area(df: DataFrame, out: str = "area") -> DataFrame:
    """Planar area in the units of the current CRS."""
    if "rings" in df.columns:
        return df.withColumn(out, geo.polygon_area("rings"))
    # edges only: |Σ shoelace| is exact for a single ring
    return df.withColumn(out, F.abs(F.aggregate("edges", F.lit(0.0),
                                                lambda a, e: a + e["x1"] * e["y2"] - e["x2"] * e["y1"]) / 2.0))
