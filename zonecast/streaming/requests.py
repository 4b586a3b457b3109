"""JSON requests (L2, L3, G13, G19): parsed, checked, answered once.

A request is one line of JSON. All fields are read as text (``from_json`` with a
corrupt-record column) and converted with ``try_cast``, so that one bad field gives
that request an ``error`` and no other request suffers:

* allocation: ``timestamp`` (missing, null or empty: ``now``), ``total_drivers``
  (missing or null: 100; a whole number of 0 or more, as a number or as text);
* prediction: ``timestamp`` and ``zone_id`` (both required), ``active_drivers``
  (missing or null: 10).

Timestamps are ISO strings with a T or a space; a zone suffix is read over (the wall
time counts). ``request_id`` is text; a line without one, or one that is no JSON
object, is named ``raw:`` and the SHA-256 of the line. Null lines are bad JSON.

``allocate_requests`` answers a stream of lines with ``foreachBatch``. Every batch
writes its answers into a folder of its own, over what an earlier try of the batch
left there, and the first batch that answered a request id stands: a batch that is
repeated, or a request that is sent again, changes nothing. Within a batch the least
line of an id counts. A bad request has one answer row, with ``error`` and no zone.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import params as P
from ..functions.timefn import weekday_mon0
from ..operators.fleet import add_revenue, allocate
from ..operators.scenario import whole_week
from ..session import checkpoint_dir

BAD_JSON, BAD_TIME, BAD_DRIVERS, BAD_ZONE = "bad JSON", "bad timestamp", "bad driver count", "no zone_id"
MAX_INT = (1 << 31) - 1


def _fields(lines: DataFrame, names: tuple[str, ...], value_col: str) -> DataFrame:
    """request_id, the named text fields (null in a bad line), __ok, and the line."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("request_id", *names, "_corrupt_record")])
    line = F.col(value_col)
    doc = F.from_json(line, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    rows = lines.select(line.alias("__line"), doc.alias("__d"))
    ok = F.col("__d").isNotNull() & F.col("__d._corrupt_record").isNull() & F.trim("__line").startswith("{")
    rows = rows.withColumn("__ok", F.coalesce(ok, F.lit(False)))
    only = lambda c: F.when(F.col("__ok"), F.col(f"__d.{c}"))
    named = F.concat(F.lit("raw:"), F.sha2(F.coalesce("__line", F.lit("")), 256))
    return rows.select(F.coalesce(only("request_id"), named).alias("request_id"),
                       *[only(c).alias(c) for c in names], "__ok", "__line")


def _whole(text: Column, default: int) -> tuple[Column, Column]:
    """(number, good): a whole number from 0 to the largest int, or the default."""
    x = text.try_cast("double")
    good = text.isNull() | F.coalesce((x == F.floor(x)) & (x >= 0) & (x <= MAX_INT), F.lit(False))
    return F.when(text.isNull(), F.lit(default)).when(good, x.cast("int")), good


def parse_allocation(lines: DataFrame, now: Column | None = None, value_col: str = "value") -> DataFrame:
    """(request_id, request_ts, fleet, error, __line) of allocation requests."""
    r = _fields(lines, ("timestamp", "total_drivers"), value_col)
    text = F.coalesce("timestamp", F.lit(""))
    ts = F.when(text == "", F.localtimestamp().cast("timestamp_ntz") if now is None else now).otherwise(
        text.try_cast("timestamp_ntz"))
    fleet, good = _whole(F.col("total_drivers"), P.DEFAULT_FLEET)
    error = F.when(~F.col("__ok"), BAD_JSON).when(ts.isNull(), BAD_TIME).when(~good, BAD_DRIVERS)
    return r.select("request_id", ts.alias("request_ts"), fleet.alias("fleet"), error.alias("error"), "__line").withColumns(
        {c: F.when(F.col("error").isNull(), F.col(c)) for c in ("request_ts", "fleet")})


def parse_prediction(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """(request_id, request_ts, zone_id, active_drivers, error) of prediction requests,
    what ``request_scoring.score_requests`` takes."""
    r = _fields(lines, ("timestamp", "zone_id", "active_drivers"), value_col)
    ts = F.col("timestamp").try_cast("timestamp_ntz")
    drivers, good = _whole(F.col("active_drivers"), P.DEFAULT_REQUEST_DRIVERS)
    error = (F.when(~F.col("__ok"), BAD_JSON).when(ts.isNull(), BAD_TIME)
             .when(F.col("zone_id").isNull(), BAD_ZONE).when(~good, BAD_DRIVERS))
    r = r.select("request_id", ts.alias("request_ts"), "zone_id", drivers.cast("double").alias("active_drivers"),
                 error.alias("error"))
    return r.withColumns({c: F.when(F.col("error").isNull(), F.col(c)) for c in ("request_ts", "zone_id", "active_drivers")})


def answer(requests: DataFrame, forecast: DataFrame, capacity: float = P.CAPACITY_PER_DRIVER) -> DataFrame:
    """Parsed allocation requests -> one row a request and zone. Requests of the same
    weekday, hour and fleet share one allocation: it is computed once for each such
    situation, and requests meet it by an equi-join, a hot situation included."""
    keys = ["day_of_week", "hour", "fleet"]
    req = requests.withColumns({"hour": F.hour("request_ts"), "day_of_week": weekday_mon0(F.col("request_ts"))})
    cases = req.where("error is null").select(*keys).distinct()
    rows = cases.join(whole_week(forecast), ["day_of_week", "hour"]).withColumns(
        {"predicted_demand": F.col("pred_15m"), "zone_num": F.col("zone_id").cast("int")})
    out = add_revenue(allocate(rows, keys, fleet=F.col("fleet"), tie_cols=("zone_num",), capacity=capacity),
                      capacity=capacity)
    return req.join(out, keys, "left").select(
        "request_id", "request_ts", "fleet", "zone_id", "predicted_demand", "allocated_drivers", "action",
        "surge_multiplier", "revenue", "error")


def answer_batch(lines: DataFrame, epoch: int, forecast: DataFrame, base: str, now: Column | None = None,
                 capacity: float = P.CAPACITY_PER_DRIVER, value_col: str = "value") -> None:
    """One micro-batch: one request an id, answered into the folder of the batch."""
    r = parse_allocation(lines, now, value_col)
    rest = ("request_ts", "fleet", "error")
    one = r.groupBy("request_id").agg(F.min_by(F.struct(*rest), F.coalesce("__line", F.lit(""))).alias("r"))
    answer(one.select("request_id", "r.*"), forecast, capacity).write.mode("overwrite").parquet(f"{base}/out/epoch={epoch}")


def answers(spark: SparkSession, base: str) -> DataFrame:
    """The answers under ``base``: of each request those of its first batch."""
    schema = T.StructType([*T.StructType.fromDDL(ANSWER).fields, T.StructField("epoch", T.LongType())])
    found = spark.read.schema(schema).option("basePath", f"{base}/out").parquet(f"{base}/out")
    first = found.groupBy("request_id").agg(F.min("epoch").alias("epoch"))
    return found.join(first, ["request_id", "epoch"], "left_semi").drop("epoch")


ANSWER = ("request_id string, request_ts timestamp_ntz, fleet int, zone_id string, predicted_demand double, "
          "allocated_drivers int, action string, surge_multiplier double, revenue double, error string")


def allocate_requests(spark: SparkSession, lines: DataFrame, forecast: DataFrame, now: Column | None = None,
                      capacity: float = P.CAPACITY_PER_DRIVER, path: str | None = None) -> DataFrame:
    """L3: a stream of JSON lines (column ``value``) answered over all its available
    input. Given the same ``path`` again it goes on where it stopped. ``forecast`` is a
    written table: every batch reads it."""
    base = path or f"{checkpoint_dir(spark).rstrip('/')}/requests-{uuid.uuid4().hex}"
    q = (lines.writeStream.option("checkpointLocation", f"{base}/_checkpoint").trigger(availableNow=True)
         .foreachBatch(lambda batch, epoch: answer_batch(batch, epoch, forecast, base, now, capacity)).start())
    q.awaitTermination()
    return answers(spark, base)
