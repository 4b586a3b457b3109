"""Request scoring (L2), the same plan for a batch or a stream of requests.

A request is (request_ts, zone_id, active_drivers). Features come from
history, not from random stand-ins: calendar columns of the request time,
the mean lags of (zone, hour, weekday) from the training slice, the zone
centroid (C3) and an expected gap = baseline demand - drivers. The fitted
horizon models then score it (J6) and the point surge (H7) of the
15-minute forecast is attached.

The history lookup has at most zones x 24 x 7 rows and the zone table k
rows; Spark broadcasts either when its size allows (a stream-static join for
a stream);
scoring itself is a per-row projection, no shuffle and no state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.pricing import point_surge
from ..functions.timefn import calendar_columns
from ..operators.zones import attach_centroids

LAG_COLUMNS = ("lag_1", "lag_4", "lag_96", "rolling_mean_4")
LOOKUP_KEYS = ("zone_id", "hour", "day_of_week")


def history_lookup(history: DataFrame) -> DataFrame:
    """Mean lags and mean demand per (zone, hour, weekday) of the history."""
    return history.groupBy(*LOOKUP_KEYS).agg(
        *[F.avg(c).alias(c) for c in LAG_COLUMNS], F.avg("demand").alias("__base"))


def score_requests(requests: DataFrame, forecaster, lookup: DataFrame, zones: DataFrame) -> DataFrame:
    """L2: requests -> pred_15m / pred_30m / pred_60m and surge_multiplier. A
    request for a zone that the zone table lacks is answered too: without
    forecasts, with ``known_zone`` false."""
    req = requests.select("request_ts", "zone_id", "active_drivers")
    req = req.withColumns(calendar_columns(F.col("request_ts")))
    r = (req.join(lookup, list(LOOKUP_KEYS), "left")
         .na.fill(0.0, [*LAG_COLUMNS, "__base"]))
    r = attach_centroids(r, zones).withColumn("gap", F.col("__base") - F.col("active_drivers"))
    r = r.withColumn("known_zone", F.col("zone_lat").isNotNull()).na.fill(0.0, ["zone_lat", "zone_lon"])
    scored = forecaster.predict(r)
    only = lambda c: F.when(F.col("known_zone"), c)
    return scored.select("request_ts", "zone_id", "active_drivers",
                         *[only(F.col(c)).alias(c) for c in ("pred_15m", "pred_30m", "pred_60m")],
                         only(point_surge(F.col("pred_15m"), F.col("active_drivers"))).alias("surge_multiplier"),
                         "known_zone")
