"""Zones: fixed centroids, K-Means fit, assignment, grid cells."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import params as P
from ..session import materialize
from ..sources.tables import path_exists
from . import kmeans
from .zone_index import assign_many
from ..functions.geo import cell_count, cell_index, with_nearest_zone

ZONE_SCHEMA = T.StructType([
    T.StructField("zone_id", T.StringType(), False),
    T.StructField("zone_lat", T.DoubleType(), False),
    T.StructField("zone_lon", T.DoubleType(), False),
])

Centroids = Sequence[tuple[str, float, float]]


def fixed_zones(spark: SparkSession, centroids: Centroids = P.FIXED_ZONES) -> DataFrame:
    """The zone table (zone_id, zone_lat, zone_lon) of a fitted model."""
    return spark.createDataFrame([(str(z), float(a), float(b)) for z, a, b in centroids],
                                 schema=ZONE_SCHEMA)


def zone_centroids(zones: DataFrame | Centroids,
                   max_zones: int = P.MAX_INLINE_ZONES) -> list[tuple[str, float, float]]:
    """Centroid list of a zone table, read only after its size is checked.

    A zone table is model output (k rows); anything larger than
    ``max_zones`` is refused rather than pulled to the driver.
    """
    if not isinstance(zones, DataFrame):
        return [(str(z), float(a), float(b)) for z, a, b in zones]
    rows = zones.select("zone_id", "zone_lat", "zone_lon").limit(max_zones + 1).collect()
    if len(rows) > max_zones:
        raise ValueError(f"zone table has more than {max_zones} rows")
    out = [(str(r[0]), float(r[1]), float(r[2])) for r in rows]
    # assignment order = numeric label order, as a fitted model numbers them
    return sorted(out, key=lambda z: (int(z[0]) if z[0].isdigit() else 1 << 62, z[0]))


def assign_zone(rides: DataFrame, zones: DataFrame | Centroids,
                lat: str = "pickup_lat", lon: str = "pickup_long") -> DataFrame:
    """Nearest-centroid zone per ride (C4, J3): a narrow projection for up to
    ``MAX_INLINE_ZONES`` zones, candidate cells (``zone_index``) beyond; both are
    exact. Ties go to the zone that comes first in zone order."""
    if isinstance(zones, DataFrame) and zones.count() > P.MAX_INLINE_ZONES:
        return assign_many(rides, zones, lat, lon)
    return with_nearest_zone(rides, lat, lon, zone_centroids(zones))


def attach_centroids(df: DataFrame, zones: DataFrame) -> DataFrame:
    """Centroid lookup (C3): a left join on zone_id, so a row whose zone is
    unknown stays, without a centroid. Spark broadcasts the zone table (model
    output of k rows) when its size allows.
    """
    return df.join(zones.select("zone_id", "zone_lat", "zone_lon"), "zone_id", "left")


def fit_kmeans(rides: DataFrame, k: int = P.NUM_CLUSTERS, seed: int = P.SEED,
               n_init: int = 10, max_iter: int = 300, fold_duplicates: bool = True,
               tol: float = 1e-4, rows_per_partition: int = 500_000) -> tuple[kmeans.Centers, float]:
    """Fit zones (J2): K-Means on raw degrees, best of ``n_init`` starts, all starts in
    the same passes (``kmeans.fit``). Returns the model and its cost.

    With ``fold_duplicates`` identical pickup points become one point weighted by its
    count (a count aggregate, combined map-side, so a hot point costs nothing extra):
    the weighted objective and Lloyd steps equal those over the raw points.
    """
    xy = rides.select(F.col("pickup_lat").cast("double").alias("lat"), F.col("pickup_long").cast("double").alias("lon")).where(
        F.col("lat").isNotNull() & F.col("lon").isNotNull())
    if fold_duplicates:
        xy = xy.groupBy("lat", "lon").agg(F.count(F.lit(1)).cast("double").alias("weight"))
    else:
        xy = xy.withColumn("weight", F.lit(1.0))
    points = materialize(xy, "kmeans-points")          # the rides are read once
    model = kmeans.fit(points, k, seed, n_init, max_iter, tol, rows_per_partition)
    return model, model.cost


def kmeans_zone_table(spark: SparkSession, model, cost: float | None = None) -> DataFrame:
    """Centroid table (J4) of a fitted K-Means model, labels '0'..'k-1'."""
    rows = [(str(i), float(c[0]), float(c[1]), cost) for i, c in enumerate(model.clusterCenters())]
    schema = T.StructType(list(ZONE_SCHEMA.fields) + [T.StructField("training_cost", T.DoubleType())])
    return spark.createDataFrame(rows, schema=schema)


def save_kmeans(model: kmeans.Centers, path: str) -> None:
    """Persist the cluster model."""
    model.save(path)


def load_kmeans(path: str) -> kmeans.Centers:
    return kmeans.Centers.load(path)


def zones_of_model(spark: SparkSession, path: str, rides: Callable[[], DataFrame],
                   k: int = P.NUM_CLUSTERS, **fit) -> kmeans.Centers:
    """The stored zones at ``path``; where there are none, zones fitted on ``rides()``
    are stored first (A6, A7). What is returned is always read back."""
    if not path_exists(spark, path):
        save_kmeans(fit_kmeans(rides(), k, **fit)[0], path)
    return load_kmeans(path)


def model_centroids(model: kmeans.Centers) -> list[tuple[str, float, float]]:
    """The zone list of a fitted model, labels '0'..'k-1' (J4)."""
    return [(str(i), float(c[0]), float(c[1])) for i, c in enumerate(model.clusterCenters())]


def grid_dims(lat_min: float = P.CITY_LAT_MIN, lat_max: float = P.CITY_LAT_MAX,
              lon_min: float = P.CITY_LON_MIN, lon_max: float = P.CITY_LON_MAX,
              size_lat: float = P.GRID_SIZE_LAT, size_lon: float = P.GRID_SIZE_LON):
    return cell_count(lat_min, lat_max, size_lat), cell_count(lon_min, lon_max, size_lon)


def grid_cell_table(spark: SparkSession, lat_min: float = P.CITY_LAT_MIN,
                    lat_max: float = P.CITY_LAT_MAX, lon_min: float = P.CITY_LON_MIN,
                    lon_max: float = P.CITY_LON_MAX, size_lat: float = P.GRID_SIZE_LAT,
                    size_lon: float = P.GRID_SIZE_LON) -> DataFrame:
    """All grid cells with their four bounds (C7): ``range`` + projection."""
    n_lat, n_lon = grid_dims(lat_min, lat_max, lon_min, lon_max, size_lat, size_lon)
    i = (F.col("id") / n_lon).cast("int")
    j = (F.col("id") % n_lon).cast("int")
    return spark.range(n_lat * n_lon).select(
        F.concat_ws("_", i.cast("string"), j.cast("string")).alias("cell_id"),
        i.alias("cell_i"), j.alias("cell_j"),
        (F.lit(lat_min) + i * F.lit(size_lat)).alias("lat_start"),
        (F.lit(lat_min) + (i + 1) * F.lit(size_lat)).alias("lat_end"),
        (F.lit(lon_min) + j * F.lit(size_lon)).alias("lon_start"),
        (F.lit(lon_min) + (j + 1) * F.lit(size_lon)).alias("lon_end"),
    )


def point_to_cell(df: DataFrame, lat: str = "pickup_lat", lon: str = "pickup_long",
                  lat_min: float = P.CITY_LAT_MIN, lon_min: float = P.CITY_LON_MIN,
                  size_lat: float = P.GRID_SIZE_LAT, size_lon: float = P.GRID_SIZE_LON) -> DataFrame:
    """Cell (i, j) of each point (C6): arithmetic, an equi-key for later joins."""
    return df.withColumns({
        "cell_i": cell_index(F.col(lat), lat_min, size_lat),
        "cell_j": cell_index(F.col(lon), lon_min, size_lon),
    })
