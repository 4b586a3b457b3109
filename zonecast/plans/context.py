"""Shared inputs of the registered queries.

Each query is ``f(spark, sf_dir) -> DataFrame`` and builds its plan from
the driver's tables. The processed feature table is the one intermediate
that many dashboard-level queries read (the reference writes it once and
every page reads it); ``features_by_date`` materialises it once per
application and state of the source table as a parquet table in the cluster's
checkpoint folder, one folder a date, so those queries do not recompute the grid.
"""

from __future__ import annotations

import os
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import params as P
from ..operators.features import build_features
from ..operators.kmeans import Centers
from ..operators.split import bin_counts
from ..operators.zones import fixed_zones, zones_of_model
from ..session import checkpoint_dir, materialize
from ..sources.rides import load_rides
from ..sources.tables import table_path, table_version

_lock = threading.Lock()
_memo: dict[tuple, tuple[DataFrame, DataFrame]] = {}


def rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_rides(spark, sf_dir)


def zones(spark: SparkSession) -> DataFrame:
    return fixed_zones(spark)


def centroids():
    """The fixed zone list itself (no job needed to read it back)."""
    return list(P.FIXED_ZONES)


def features(spark: SparkSession, sf_dir: str, interval: int = P.INTERVAL_SECONDS,
             method: str = "halo", keep_rank: bool = False) -> DataFrame:
    """The features, built from scratch; two small tables are written on the way."""
    return build_features(rides(spark, sf_dir), zones(spark), interval,
                          method=method, keep_rank=keep_rank, centroids=centroids())


def source_key(spark: SparkSession, sf_dir: str) -> tuple:
    """What results made from the events of a folder are kept under: a changed
    table is another key."""
    return (spark.sparkContext.applicationId, sf_dir.rstrip("/"),
            table_version(spark, table_path(sf_dir, "events")))


def features_by_date(spark: SparkSession, sf_dir: str,
                     interval: int = P.INTERVAL_SECONDS) -> tuple[DataFrame, DataFrame]:
    """The feature table with a folder for each ``date`` (A4), and the rows of each
    bin (time_bin, rows), a table of its own; both are written once. A reader of
    one bin filters on ``date`` too and opens one folder."""
    key = (*source_key(spark, sf_dir), interval)
    with _lock:
        if key not in _memo:
            f = features(spark, sf_dir, interval, keep_rank=True).withColumn("date", F.to_date("time_bin"))
            table = materialize(f.repartition("date"), "features", partition_by=("date",))
            _memo[key] = table, materialize(bin_counts(table), "feature-bins")
        return _memo[key]


def features_table(spark: SparkSession, sf_dir: str,
                   interval: int = P.INTERVAL_SECONDS) -> DataFrame:
    """Materialised feature table (with ``zone_rank``), written once."""
    return features_by_date(spark, sf_dir, interval)[0].drop("date")


def fitted_zones(spark: SparkSession, sf_dir: str, k: int = P.NUM_CLUSTERS) -> Centers:
    """The zones fitted on the rides, from the stored model; fitted and stored
    where there is none (A6, A7)."""
    app, _, version = source_key(spark, sf_dir)
    name = "-".join([app, os.path.basename(sf_dir.rstrip("/")), *map(str, version), str(k)])
    with _lock:
        return zones_of_model(spark, f"{checkpoint_dir(spark).rstrip('/')}/zonecast-models/{name}",
                              lambda: rides(spark, sf_dir), k)


def clear() -> None:
    with _lock:
        _memo.clear()
