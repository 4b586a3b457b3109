"""What-if scenarios and the baseline forecast.

The reference builds one 20-row frame per slider change, fills random lags
and predicts. Here a scenario table (fleet, fare, weekday, hour) is joined
to a per-(zone, hour, weekday) forecast table on (weekday, hour): an
equi-join that hands every scenario all zones of its hour, then every
scenario is allocated in the same job (windows partitioned by scenario).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import params as P
from ..functions.timefn import cyclic
from .zones import attach_centroids
from .fleet import add_revenue, allocate, fleet_kpis

SCENARIO_KEYS = ("fleet", "fare", "capacity", "day_of_week", "hour")


def baseline_forecast(features: DataFrame, quantum: int = 1024) -> DataFrame:
    """Deterministic fallback forecast: mean demand of (zone, hour,
    weekday), rounded to 1/quantum so that sums are exact in any order;
    30 and 60 minutes are 1.1x and 1.3x of it."""
    m = features.groupBy("zone_id", "hour", "day_of_week").agg(F.avg("demand").alias("__m"))
    p15 = F.rint(F.col("__m") * quantum) / quantum
    return m.select("zone_id", "hour", "day_of_week", p15.alias("pred_15m"),
                    (p15 * F.lit(P.FALLBACK_MULT_30M)).alias("pred_30m"),
                    (p15 * F.lit(P.FALLBACK_MULT_60M)).alias("pred_60m"))


def scenario_grid(features: DataFrame, fleets: Sequence[int] = (P.PIPELINE_FLEET,),
                  fares: Sequence[float] = (P.DEFAULT_FARE,),
                  capacities: Sequence[float] = (P.CAPACITY_PER_DRIVER,)) -> DataFrame:
    """One scenario per observed (weekday, hour) x fleet x fare x rides a
    driver can take."""
    grid = features.select("day_of_week", "hour").distinct()
    for name, values in (("fleet", [int(f) for f in fleets]), ("fare", [float(x) for x in fares]),
                         ("capacity", [float(x) for x in capacities])):
        grid = grid.select("*", F.explode(F.array(*map(F.lit, values))).alias(name))
    return grid


LAG_COLUMNS = ("lag_1", "lag_4", "lag_96", "rolling_mean_4")
WEEK_KEYS = ("zone_id", "hour", "day_of_week")
PREDS = ("pred_15m", "pred_30m", "pred_60m")


def lag_profile(features: DataFrame) -> DataFrame:
    """Per (zone, hour, weekday) the mean lags of the history and the month of its
    last bin: the model inputs of a scenario that names only an hour and a weekday."""
    return features.groupBy(*WEEK_KEYS).agg(
        *[F.avg(c).alias(c) for c in LAG_COLUMNS], F.month(F.max("time_bin")).alias("month"))


def scenario_forecast(profile: DataFrame, forecaster, zones: DataFrame, baseline: DataFrame,
                      quantum: int = 1024) -> DataFrame:
    """The models' forecast of every (zone, hour, weekday) at minute 0, from the lag
    profile; ``source`` is 'model'. Where the profile has no row or the zone table no
    centroid, the baseline (J11) stands in and ``source`` is 'baseline'. Fleet, fare and
    capacity are no inputs, so one prediction serves all scenarios of an hour; models
    that want supply columns are refused. Predictions are rounded to 1/quantum."""
    extra = sorted(set(forecaster.features) - set(P.BASE_FEATURES))
    if extra:
        raise ValueError(f"a scenario has no {', '.join(extra)}: train with with_supply=False")
    x = attach_centroids(profile, zones).where(F.col("zone_lat").isNotNull())
    hour, day = F.col("hour"), F.col("day_of_week")
    x = x.withColumns({"minute": F.lit(0), "is_weekend": (day >= 5).cast("int"),
                       "hour_sin": cyclic(hour, 24, "sin"), "hour_cos": cyclic(hour, 24, "cos"),
                       "day_sin": cyclic(day, 7, "sin"), "day_cos": cyclic(day, 7, "cos")})
    scored = forecaster.predict(x).select(
        *WEEK_KEYS, *[(F.rint(F.col(c) * quantum) / quantum).alias(f"__m_{c}") for c in PREDS])
    both = whole_week(baseline).join(scored, list(WEEK_KEYS), "left")
    return both.select(*WEEK_KEYS, *[F.coalesce(f"__m_{c}", c).alias(c) for c in PREDS],
                       F.when(F.col("__m_pred_15m").isNotNull(), "model").otherwise("baseline").alias("source"))


def whole_week(forecast: DataFrame) -> DataFrame:
    """The forecast with a row for every (zone, hour, weekday): an hour without
    history takes the zone's mean over the hours that have one (at most
    zones x 168 rows)."""
    zones = forecast.groupBy("zone_id").agg(*[F.avg(c).alias(f"__{c}") for c in PREDS])
    more = [c for c in forecast.columns if c not in (*WEEK_KEYS, *PREDS)]
    hours = zones.select("*", F.explode(F.sequence(F.lit(0), F.lit(167))).alias("__h"))
    every = hours.withColumns({"hour": (F.col("__h") % 24).cast("int"),
                               "day_of_week": F.floor(F.col("__h") / 24).cast("int")})
    both = every.join(forecast, ["zone_id", "hour", "day_of_week"], "left")
    return both.select(*WEEK_KEYS, *[F.coalesce(c, f"__{c}").alias(c) for c in PREDS], *more)


def scenario_alloc(scenarios: DataFrame, forecast: DataFrame) -> DataFrame:
    """C8 + H15: allocation and revenue of every zone under every scenario,
    also of hours that the forecast has no row for.

    Zones are ordered by their number for ties (the reference builds its
    scenario frame in centroid order).
    """
    s = scenarios.join(whole_week(forecast), ["day_of_week", "hour"])
    s = s.withColumns({"predicted_demand": F.col("pred_15m"),
                       "zone_num": F.col("zone_id").cast("int")})
    a = allocate(s, SCENARIO_KEYS, fleet=F.col("fleet"), tie_cols=("zone_num",), capacity=F.col("capacity"))
    return add_revenue(a, fare=F.col("fare"), capacity=F.col("capacity"))


def scenario_kpis(alloc: DataFrame) -> DataFrame:
    return fleet_kpis(alloc, SCENARIO_KEYS)


def allocation_records(alloc: DataFrame, group_cols: Sequence[str], ts_col: str | None = None) -> DataFrame:
    """One JSON document per group: timestamp, revenue metrics and the
    allocation list (one record per zone, ordered by zone). The list holds
    one entry per zone of the group, so it is bounded by the zone table."""
    rec = F.struct("zone_id", "predicted_demand", "allocated_drivers", "action", "surge_multiplier")
    g = alloc.groupBy(*group_cols).agg(
        F.round(F.sum("revenue"), 2).alias("Total_Revenue"),
        F.round(F.try_divide(F.sum("fulfilled_rides"), F.sum("predicted_demand")) * 100, 1).alias("Service_Level"),
        F.round(F.avg("surge_multiplier"), 2).alias("Avg_Surge"),
        F.array_sort(F.collect_list(rec)).alias("allocation"))
    ts = (F.date_format(F.col(ts_col), "yyyy-MM-dd'T'HH:mm:ss") if ts_col else F.lit(None).cast("string"))
    doc = F.struct(ts.alias("timestamp"),
                   F.struct("Total_Revenue", "Service_Level", "Avg_Surge").alias("metrics"),
                   F.col("allocation"))
    return g.select(*group_cols, F.to_json(doc).alias("document"))


RECORD = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("metrics", T.StructType([T.StructField(c, T.DoubleType()) for c in (
        "Total_Revenue", "Service_Level", "Avg_Surge")])),
    T.StructField("allocation", T.ArrayType(T.StructType([
        T.StructField("zone_id", T.StringType()), T.StructField("predicted_demand", T.DoubleType()),
        T.StructField("allocated_drivers", T.IntegerType()), T.StructField("action", T.StringType()),
        T.StructField("surge_multiplier", T.DoubleType())]))),
])


def read_records(records: DataFrame, col: str = "document") -> DataFrame:
    """The documents of ``allocation_records`` read back, one row a zone with
    the timestamp and the metrics of its document beside it."""
    doc = records.select(F.from_json(F.col(col), RECORD).alias("d"))
    return doc.select(F.col("d.timestamp").try_cast("timestamp_ntz").alias("time_bin"), "d.metrics.*",
                      F.inline("d.allocation"))
