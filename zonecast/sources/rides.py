"""Ride and feature sources (A1, A2, A9) and their schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import params as P
from ..functions.geo import clip_lat, clip_lon
from .tables import CSV_TS_FORMAT, read_table, require_path

# Ride request as written by a ride log (CSV header names).
RIDE_CSV_SCHEMA = T.StructType([
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("pickup_lat", T.DoubleType()),
    T.StructField("pickup_long", T.DoubleType()),
    T.StructField("active_drivers", T.IntegerType()),
    T.StructField("is_cancelled", T.IntegerType()),
    T.StructField("ride_id", T.LongType()),
])

# Processed (zone, bin) feature table.
FEATURE_SCHEMA = T.StructType([
    T.StructField("time_bin", T.TimestampNTZType()),
    T.StructField("zone_id", T.StringType()),
    T.StructField("demand", T.LongType()),
    T.StructField("active_drivers", T.DoubleType()),
    T.StructField("is_cancelled", T.LongType()),
    T.StructField("hour", T.IntegerType()),
    T.StructField("minute", T.IntegerType()),
    T.StructField("day_of_week", T.IntegerType()),
    T.StructField("is_weekend", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("hour_sin", T.DoubleType()),
    T.StructField("hour_cos", T.DoubleType()),
    T.StructField("day_sin", T.DoubleType()),
    T.StructField("day_cos", T.DoubleType()),
    T.StructField("lag_1", T.LongType()),
    T.StructField("lag_4", T.LongType()),
    T.StructField("lag_96", T.LongType()),
    T.StructField("rolling_mean_4", T.DoubleType()),
    T.StructField("target_15m", T.LongType()),
    T.StructField("target_30m", T.LongType()),
    T.StructField("target_60m", T.LongType()),
    T.StructField("gap", T.DoubleType()),
    T.StructField("zone_lat", T.DoubleType()),
    T.StructField("zone_lon", T.DoubleType()),
])

RIDE_COLUMNS = ("ride_id", "ride_ts", "pickup_lat", "pickup_long",
                "active_drivers", "is_cancelled")


def read_rides_csv(spark: SparkSession, path: str) -> DataFrame:
    """Ride scan (A1): explicit schema, no inference; ``timestamp`` -> ``ride_ts``."""
    df = (spark.read.schema(RIDE_CSV_SCHEMA).option("header", True)
          .option("timestampNTZFormat", CSV_TS_FORMAT).csv(require_path(path)))
    return df.withColumnRenamed("timestamp", "ride_ts").select(*RIDE_COLUMNS)


def read_features(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Feature scan (A2). zone_id stays a string whatever the file holds."""
    r = spark.read.format(fmt)
    if fmt == "csv":
        r = r.schema(FEATURE_SCHEMA).option("header", True).option("timestampNTZFormat", CSV_TS_FORMAT)
    df = r.load(require_path(path))
    return df.withColumn("zone_id", F.col("zone_id").cast("string"))


def _noise(a: int, b: int) -> Column:
    raw = (F.col("user_id") * a + F.col("event_id") * b) % P.EVENT_NOISE_MOD - (P.EVENT_NOISE_MOD // 2)
    return raw.cast("double") / F.lit(P.EVENT_NOISE_SCALE)


def rides_from_events(events: DataFrame) -> DataFrame:
    """Ride-shaped view over the driver's ``events`` table (A9, FIXTURES F6).

    Deterministic stand-in for the stochastic generator: a hotspot chosen by
    ``event_id % 10``, integer noise, the city clip (B2), a supply figure
    that is constant within each 5-minute window and cancellations from
    error events. Narrow projection only: no shuffle.
    """
    eid = F.col("event_id")
    bucket = eid % 10
    (h0, h1, h2) = P.EVENT_HOTSPOTS
    (c0, c1) = P.EVENT_HOTSPOT_CUTS
    base_lat = F.when(bucket < c0, F.lit(h0[0])).when(bucket < c1, F.lit(h1[0])).otherwise(F.lit(h2[0]))
    base_lon = F.when(bucket < c0, F.lit(h0[1])).when(bucket < c1, F.lit(h1[1])).otherwise(F.lit(h2[1]))
    ts = F.col("ts")
    window_of_day = F.hour(ts).cast("long") * 12 + F.floor(F.minute(ts) / 5)
    return events.select(
        eid.alias("ride_id"),
        ts.alias("ride_ts"),
        clip_lat(base_lat + _noise(*P.EVENT_NOISE_LAT)).alias("pickup_lat"),
        clip_lon(base_lon + _noise(*P.EVENT_NOISE_LON)).alias("pickup_long"),
        (F.lit(1) + (window_of_day * 37) % 9).cast("int").alias("active_drivers"),
        F.when(F.col("event_type") == "error", 1).otherwise(0).cast("int").alias("is_cancelled"),
    )


def load_rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rides of a driver test folder (events -> F6 view)."""
    return rides_from_events(read_table(spark, sf_dir, "events"))
