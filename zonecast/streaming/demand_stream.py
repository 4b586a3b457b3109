"""Structured Streaming jobs that replace the reference's request handlers (L1-L3).

* ``zone_demand_stream`` (L1): events -> rides -> zone -> 15-minute tumbling
  count per zone. With a watermark a live stream drops its state and rows that
  come later than the delay; the replay of a stored table sets none, so files
  in any order count in full.
* ``run_to_table``: the stream in update mode into a keyed sink. Windows that
  are still open when the input ends are in the table like all others.
* ``score_requests`` (L2, in ``plans.catalog``) is a batch/stream-agnostic
  projection + broadcast lookups.
* ``allocate_stream`` (L3): each micro-batch of allocation requests is
  allocated with ``foreachBatch`` against the forecast table; an hour without a
  forecast takes each zone's mean, so no request is lost.

Event time: ``withWatermark`` needs TIMESTAMP, the data is TIMESTAMP_NTZ,
so the stream works on the cast value and casts the window back; both
casts use the session zone, which is a round trip outside DST gaps.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import params as P
from ..operators.zones import assign_zone
from ..session import checkpoint_dir
from ..sources.rides import rides_from_events


def zone_demand_stream(events_stream: DataFrame, centroids, interval_s: int = P.INTERVAL_SECONDS,
                       delay: str | None = "30 minutes") -> DataFrame:
    """L1 as a streaming DataFrame (same columns as batch ``zone_demand``)."""
    rides = assign_zone(rides_from_events(events_stream), centroids)
    rides = rides.withColumn("__et", F.col("ride_ts").cast("timestamp"))
    rides = rides.withWatermark("__et", delay) if delay else rides
    agg = (rides.groupBy(F.window("__et", f"{interval_s} seconds").alias("__w"), "zone_id")
           .agg(F.count("ride_id").alias("demand"), F.avg("active_drivers").alias("active_drivers"),
                F.sum("is_cancelled").cast("long").alias("is_cancelled")))
    return agg.select(F.col("__w.start").cast("timestamp_ntz").alias("time_bin"), "zone_id",
                      "demand", "active_drivers", "is_cancelled")


def run_to_table(spark: SparkSession, stream: DataFrame, name: str = "stream", keys: tuple[str, ...] = (),
                 path: str | None = None) -> DataFrame:
    """Run a stream over all available input (availableNow) into a parquet
    table, then read the table. A job that is given the same ``path`` again
    resumes where it stopped.

    With ``keys`` the stream is an aggregate in update mode: each micro-batch
    writes the rows that changed into a folder of its own (written over when
    the batch is repeated), and the last version of a key counts. Without keys
    rows are appended.
    """
    base = path or f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/out/epoch={epoch}")

    w = stream.writeStream.option("checkpointLocation", f"{base}/_checkpoint").trigger(availableNow=True)
    if keys:
        q = w.outputMode("update").foreachBatch(write).start()
    else:
        q = w.outputMode("append").format("parquet").option("path", f"{base}/out").start()
    q.awaitTermination()
    if not keys:
        return spark.read.schema(stream.schema).parquet(f"{base}/out")
    schema = T.StructType([*stream.schema.fields, T.StructField("epoch", T.LongType())])
    found = spark.read.schema(schema).option("basePath", f"{base}/out").parquet(f"{base}/out")
    rest = [c for c in stream.columns if c not in keys]
    last = found.groupBy(*keys).agg(F.max_by(F.struct(*rest), "epoch").alias("__last"))
    return last.select(*keys, "__last.*").select(*stream.columns)


def events_stream(spark: SparkSession, sf_dir: str, files_per_batch: int = 64) -> DataFrame:
    """The driver's events table, a file or a folder of part files, replayed as
    a file stream."""
    path = f"{sf_dir.rstrip('/')}/events.parquet"
    table = spark.read.parquet(path)
    files = table.inputFiles()
    reader = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", files_per_batch)
    if len(files) == 1 and files[0].rstrip("/").endswith("/events.parquet"):  # the table is one file
        return reader.option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return reader.parquet(path)


def allocate_stream(requests: DataFrame, forecast: DataFrame, sink, capacity: float = P.CAPACITY_PER_DRIVER):
    """L3: requests (request_ts, total_drivers) -> per-zone allocation for the
    request's weekday and hour, one ``foreachBatch`` call per micro-batch.

    ``sink(df, epoch_id)`` receives the allocation rows of the batch.
    """
    from ..operators.fleet import add_revenue, allocate
    from ..operators.scenario import whole_week
    from ..functions.timefn import weekday_mon0

    def handle(batch: DataFrame, epoch_id: int) -> None:
        req = batch.select(
            F.col("request_id"),
            F.coalesce(F.col("request_ts"), F.localtimestamp().cast("timestamp_ntz")).alias("request_ts"),
            F.coalesce(F.col("total_drivers"), F.lit(P.DEFAULT_FLEET)).alias("fleet"))
        req = req.withColumns({"hour": F.hour("request_ts"), "day_of_week": weekday_mon0(F.col("request_ts"))})
        rows = req.join(whole_week(forecast), ["day_of_week", "hour"]).withColumns(
            {"predicted_demand": F.col("pred_15m"), "zone_num": F.col("zone_id").cast("int")})
        out = add_revenue(allocate(rows, ["request_id"], fleet=F.col("fleet"), tie_cols=("zone_num",),
                                   capacity=capacity), capacity=capacity)
        sink(out, epoch_id)

    return requests.writeStream.foreachBatch(handle)
