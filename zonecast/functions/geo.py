"""Spatial column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import params as P


def clip_lat(c: Column, lo: float = P.CITY_LAT_MIN, hi: float = P.CITY_LAT_MAX) -> Column:
    """Clamp to the city bounds (B2)."""
    return F.least(F.greatest(c, F.lit(lo)), F.lit(hi))


def clip_lon(c: Column, lo: float = P.CITY_LON_MIN, hi: float = P.CITY_LON_MAX) -> Column:
    return F.least(F.greatest(c, F.lit(lo)), F.lit(hi))


def nearest_zone(lat: Column, lon: Column,
                 centroids: Sequence[tuple[str, float, float]]) -> Column:
    """Label of the centroid with the least squared distance in degrees (C4).

    The k centroids are literals, so this is a narrow projection inside
    whole-stage codegen: no join, no shuffle, no k-fold row blow-up. Use it
    through ``with_nearest_zone``, which evaluates the distance array once
    and keeps the expression tree small (a k-branch CASE repeating the
    minimum makes Catalyst's constraint inference blow up). Ties go to the
    first centroid in the given order.
    """
    if not centroids:
        raise ValueError("no centroids")
    d2 = []
    for _, zlat, zlon in centroids:
        dlat = lat - F.lit(float(zlat))
        dlon = lon - F.lit(float(zlon))
        d2.append(dlat * dlat + dlon * dlon)
    return F.array(*d2)


def zone_of_distances(d2: Column, centroids: Sequence[tuple[str, float, float]]) -> Column:
    """Label at the first position of the least distance."""
    ids = F.array(*[F.lit(str(z)) for z, _, _ in centroids])
    return F.element_at(ids, F.array_position(d2, F.array_min(d2)).cast("int"))


def with_nearest_zone(df, lat: str, lon: str, centroids: Sequence[tuple[str, float, float]],
                      out: str = "zone_id"):
    tmp = "__zone_d2"
    return (df.withColumn(tmp, nearest_zone(F.col(lat), F.col(lon), centroids))
            .withColumn(out, zone_of_distances(F.col(tmp), centroids))
            .drop(tmp))


def cell_index(c: Column, origin: float, size: float) -> Column:
    """Grid cell index along one axis: integer part of the quotient."""
    return ((c - F.lit(origin)) / F.lit(size)).cast("int")


def cell_count(lo: float, hi: float, size: float) -> int:
    """Number of cells along one axis, int() of the float quotient."""
    return int((hi - lo) / size)
