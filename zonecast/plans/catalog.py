"""Registered queries: name -> f(spark, sf_dir) -> DataFrame.

One entry per operator group of the blueprint; ``oracle.SQL`` holds the
DuckDB statement of each name that has one.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import params as P
from pyspark.sql import Window

from ..functions.pricing import gap_label, gap_sign, point_surge, surge_band, surge_label, trip_price, zone_label
from ..functions.timefn import time_floor
from ..operators.demand import demand_grid, filled_grid, zone_demand
from ..operators.fleet import (action_mix, add_revenue, allocate, fleet_kpis, revenue_share,
                               top_by_demand)
from ..operators.features import FEATURE_ORDER
from ..operators.forecast import importance_table, metrics, model_card, prepare, train
from ..operators.policy import policy, transitions
from ..operators.scenario import (LAG_COLUMNS, allocation_records, baseline_forecast, lag_profile, read_records,
                                  scenario_alloc, scenario_forecast, scenario_grid, scenario_kpis)
from ..operators.zones import fit_kmeans, kmeans_zone_table, model_centroids
from ..streaming.demand_stream import events_stream, run_to_table, zone_demand_stream
from ..streaming.request_scoring import history_lookup, score_requests
from ..streaming.requests import allocate_requests
from ..operators.profiles import (corr_matrix, cumulative_demand, dataset_kpis, describe, describe_time,
                                  dow_profile, head_rows, histogram, histograms, hour_day, hour_day_pivot,
                                  hourly_profile, pickup_density, sample_rides, zone_hourly,
                                  zone_markers, zone_profile)
from ..operators.rates import cancel_by_regime, expected_rate
from ..operators.split import first_test_bin
from ..operators.zones import assign_zone, attach_centroids, grid_cell_table, point_to_cell
from ..session import materialize
from ..sources.tables import read_table
from . import context as C

# Trip quote distance scale (ours): km per degree, and a mean speed.
KM_PER_DEG_LAT = 111.32
KM_PER_DEG_LON = 88.0
SPEED_KMH = 30.0
# Largest per-(bin, zone) table broadcast to the ride side (~24 bytes a row).
MAX_BROADCAST_ROWS = 2_000_000

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def r6(c, name: str | None = None):
    """Round to 6 digits; ``+ 0.0`` turns -0.0 into 0.0 (as the oracle does)."""
    col = F.col(c) if isinstance(c, str) else c
    return (F.round(col, 6) + F.lit(0.0)).alias(name or (c if isinstance(c, str) else None))


# ---------------------------------------------------------------- M1, M2

@register("rides_scan")
def q_rides_scan(spark, sf_dir):
    return C.rides(spark, sf_dir)


@register("assign_zone")
def q_assign_zone(spark, sf_dir):
    return assign_zone(C.rides(spark, sf_dir), C.centroids()) \
        .select("ride_id", "ride_ts", "pickup_lat", "pickup_long", "zone_id")


def _demand(spark, sf_dir):
    return zone_demand(assign_zone(C.rides(spark, sf_dir), C.centroids()), P.INTERVAL_SECONDS)


@register("zone_demand")
def q_zone_demand(spark, sf_dir):
    return _demand(spark, sf_dir)


def _demand_table(spark, sf_dir):
    """The demand aggregate written once: the grid plan reads it three times."""
    return materialize(_demand(spark, sf_dir), "zone-demand")


@register("demand_grid")
def q_demand_grid(spark, sf_dir):
    return demand_grid(_demand_table(spark, sf_dir), P.INTERVAL_SECONDS)


@register("supply_fill")
def q_supply_fill(spark, sf_dir):
    g = filled_grid(_demand_table(spark, sf_dir), P.INTERVAL_SECONDS)
    return g.select("time_bin", "zone_id", "zone_rank", r6("active_drivers"))


FEATURE_OUT = (
    "time_bin", "zone_id", "demand", "active_drivers", "is_cancelled",
    "hour", "minute", "day_of_week", "is_weekend", "month",
)


@register("features")
def q_features(spark, sf_dir):
    f = C.features(spark, sf_dir)
    return f.select(*FEATURE_OUT, r6("hour_sin"), r6("hour_cos"), r6("day_sin"), r6("day_cos"),
                    "lag_1", "lag_4", "lag_96", "rolling_mean_4",
                    "target_15m", "target_30m", "target_60m", "gap", "zone_lat", "zone_lon")


# ---------------------------------------------------------------- M3 fleet

def _bin_alloc(spark, sf_dir, fleet=P.PIPELINE_FLEET, fare=P.DEFAULT_FARE):
    """Allocation of every bin: predicted demand := rolling_mean_4."""
    f = C.features_table(spark, sf_dir).select(
        "time_bin", "zone_id", F.col("rolling_mean_4").alias("predicted_demand"))
    return add_revenue(allocate(f, ["time_bin"], fleet=fleet), fare=fare)


ALLOC_OUT = ("time_bin", "zone_id", "predicted_demand", "prob", "allocated_drivers",
             "optimal_supply", "gap", "dsr")


def _alloc_cols(df):
    return df.select(*ALLOC_OUT, r6("surge_multiplier"), "action")


@register("alloc")
def q_alloc(spark, sf_dir):
    return _alloc_cols(_bin_alloc(spark, sf_dir))


def _sim_bin_alloc(spark, sf_dir):
    """Allocation of the simulation bin: found from the rows per bin, read from the
    folder of its date alone."""
    table, counts = C.features_by_date(spark, sf_dir)
    sim_bin = first_test_bin(counts)
    f = table.where((F.col("date") == sim_bin.cast("date")) & (F.col("time_bin") == sim_bin)).select(
        "time_bin", "zone_id", F.col("rolling_mean_4").alias("predicted_demand"))
    return add_revenue(allocate(f, ["time_bin"], fleet=P.PIPELINE_FLEET), fare=P.DEFAULT_FARE)


DAY_SECONDS = 86400
DAILY_FLEETS = (60, 150, 300, 600)


def _daily_alloc(spark, sf_dir):
    """Whole days as bins and their demand as the prediction, under four fleets:
    demand from far above to far below the fleet, so every surge band and action occurs."""
    rides = assign_zone(C.rides(spark, sf_dir), C.centroids())
    grid = demand_grid(materialize(zone_demand(rides, DAY_SECONDS), "daily-demand"), DAY_SECONDS)
    d = grid.select("time_bin", "zone_id", F.col("demand").cast("double").alias("predicted_demand"),
                    F.explode(F.array(*[F.lit(n) for n in DAILY_FLEETS])).alias("fleet"))
    return add_revenue(allocate(d, ["fleet", "time_bin"], fleet=F.col("fleet")))


@register("alloc_daily")
def q_alloc_daily(spark, sf_dir):
    a = _daily_alloc(spark, sf_dir)
    return a.select("fleet", *ALLOC_OUT[:5], "optimal_supply", "gap", r6("dsr"), r6("surge_multiplier"), "action")


@register("revenue_daily")
def q_revenue_daily(spark, sf_dir):
    a = _daily_alloc(spark, sf_dir)
    return a.select("fleet", "time_bin", "zone_id", r6("conversion_rate"), r6("effective_demand"),
                    r6("fulfilled_rides"), r6("revenue"))


@register("surge_bands_daily")
def q_surge_bands_daily(spark, sf_dir):
    a = _daily_alloc(spark, sf_dir)
    return a.select("fleet", "time_bin", "zone_id", surge_band(F.col("surge_multiplier")).alias("surge_band"),
                    gap_sign(F.col("gap")).alias("gap_sign"))


@register("kpis_daily")
def q_kpis_daily(spark, sf_dir):
    return fleet_kpis(_daily_alloc(spark, sf_dir), ["fleet", "time_bin"])


@register("policy_states_daily")
def q_policy_states_daily(spark, sf_dir):
    a = _daily_alloc(spark, sf_dir).where(F.col("fleet") == DAILY_FLEETS[0])
    t = transitions(a, DAY_SECONDS)
    return t.select("gap_level", "time_of_day", "action", "next_gap_level", "next_time_of_day",
                    "transitions", r6("reward_sum"))


@register("alloc_at_bin")
def q_alloc_at_bin(spark, sf_dir):
    return _alloc_cols(_sim_bin_alloc(spark, sf_dir))


@register("alloc_matrix")
def q_alloc_matrix(spark, sf_dir):
    a = _sim_bin_alloc(spark, sf_dir)
    cols = ["zone_id", "predicted_demand", "allocated_drivers", "gap", "surge_multiplier", "action"]
    present = [c for c in cols if c in a.columns]
    out = a.select(*present).withColumn("surge_multiplier", r6("surge_multiplier"))
    return out.toDF(*["Zone", "Demand", "Drivers", "Gap", "Surge", "Action"][:len(present)])


@register("revenue")
def q_revenue(spark, sf_dir):
    a = _bin_alloc(spark, sf_dir)
    return a.select("time_bin", "zone_id", "predicted_demand", "allocated_drivers",
                    r6("surge_multiplier"), r6("conversion_rate"), r6("effective_demand"),
                    r6("fulfilled_rides"), r6("revenue"))


@register("revenue_share")
def q_revenue_share(spark, sf_dir):
    a = revenue_share(_bin_alloc(spark, sf_dir), ["time_bin"])
    return a.select("time_bin", "zone_id", r6("revenue"), r6("revenue_share"))


@register("fleet_kpis")
def q_fleet_kpis(spark, sf_dir):
    return fleet_kpis(_bin_alloc(spark, sf_dir), ["time_bin"])


@register("surge_bands")
def q_surge_bands(spark, sf_dir):
    a = _bin_alloc(spark, sf_dir)
    w = Window.partitionBy("time_bin").orderBy("surge_multiplier", "zone_id")
    return a.select("time_bin", "zone_id", r6("surge_multiplier"),
                    surge_band(F.col("surge_multiplier")).alias("surge_band"),
                    gap_sign(F.col("gap")).alias("gap_sign"), gap_label(F.col("gap")).alias("gap_label"),
                    surge_label(F.col("surge_multiplier")).alias("surge_label"),
                    F.row_number().over(w).alias("surge_rank"))


@register("action_mix")
def q_action_mix(spark, sf_dir):
    m = action_mix(_bin_alloc(spark, sf_dir))
    return m.select("action", "zones", r6("share"))


@register("top_zones")
def q_top_zones(spark, sf_dir):
    t = top_by_demand(_bin_alloc(spark, sf_dir), ["time_bin"], n=10)
    return t.select("time_bin", "zone_id", "predicted_demand", "demand_rank",
                    zone_label(F.col("zone_id")).alias("zone_label"))


@register("surge_point")
def q_surge_point(spark, sf_dir):
    f = C.features_table(spark, sf_dir)
    return f.select("time_bin", "zone_id", "demand", "active_drivers",
                    point_surge(F.col("demand"), F.col("active_drivers")).alias("surge"))


@register("trip_price")
def q_trip_price(spark, sf_dir):
    """Price quote per ride: distance from pickup to its zone centroid,
    a fixed speed for the duration, point surge of the ride's (bin, zone)."""
    rides = assign_zone(C.rides(spark, sf_dir), C.centroids())
    rides = attach_centroids(rides, C.zones(spark))
    rides = rides.withColumn("time_bin", time_floor(F.col("ride_ts"), P.INTERVAL_SECONDS))
    dlat = (F.col("pickup_lat") - F.col("zone_lat")) * F.lit(KM_PER_DEG_LAT)
    dlon = (F.col("pickup_long") - F.col("zone_lon")) * F.lit(KM_PER_DEG_LON)
    km = F.sqrt(dlat * dlat + dlon * dlon)
    # the filled grid has every (bin, zone) a ride can fall in, so every ride gets
    # its price; one surge row per (bin, zone): broadcast it when its checked size
    # allows (a written table: the count reads parquet footers), else a shuffle
    # join that AQE splits if one (bin, zone) holds many of the rides
    grid = materialize(filled_grid(_demand_table(spark, sf_dir), P.INTERVAL_SECONDS), "surge-grid")
    f = grid.select("time_bin", "zone_id", point_surge(F.col("demand"), F.col("active_drivers")).alias("surge"))
    if grid.count() <= MAX_BROADCAST_ROWS:
        f = F.broadcast(f)
    q = rides.withColumn("distance_km", km).withColumn("duration_min", F.col("distance_km") * F.lit(60.0 / SPEED_KMH))
    q = q.join(f, ["time_bin", "zone_id"], "left")
    return q.select("ride_id", "time_bin", "zone_id", r6("distance_km"), r6("duration_min"), "surge",
                    trip_price(F.col("distance_km"), F.col("duration_min"), F.col("surge")).alias("price"))


# ---------------------------------------------------------------- M4 summaries

def _ft(spark, sf_dir):
    return C.features_table(spark, sf_dir)


@register("hourly_profile")
def q_hourly_profile(spark, sf_dir):
    return hourly_profile(_ft(spark, sf_dir)).select("hour", r6("avg_demand"), "is_peak")


@register("dow_profile")
def q_dow_profile(spark, sf_dir):
    return dow_profile(_ft(spark, sf_dir)).select("day_of_week", "day_name", r6("avg_demand"))


@register("hour_day")
def q_hour_day(spark, sf_dir):
    return hour_day(_ft(spark, sf_dir)).select("day_of_week", "hour", r6("avg_demand"))


@register("hour_day_pivot")
def q_hour_day_pivot(spark, sf_dir):
    return hour_day_pivot(_ft(spark, sf_dir))


@register("zone_profile")
def q_zone_profile(spark, sf_dir):
    return zone_profile(_ft(spark, sf_dir)).select("zone_id", r6("avg_demand"), "demand_rank", "zone_order")


@register("zone_hourly")
def q_zone_hourly(spark, sf_dir):
    return zone_hourly(_ft(spark, sf_dir))


@register("cumulative_demand")
def q_cumulative_demand(spark, sf_dir):
    return cumulative_demand(_ft(spark, sf_dir))


@register("dataset_kpis")
def q_dataset_kpis(spark, sf_dir):
    f = _ft(spark, sf_dir).select(*FEATURE_ORDER)
    return dataset_kpis(f, C.rides(spark, sf_dir))


DESCRIBE_COLUMNS = tuple(c for c in FEATURE_ORDER if c not in ("time_bin", "zone_id")) + ("zone_num",)


@register("describe")
def q_describe(spark, sf_dir):
    f = _ft(spark, sf_dir).withColumn("zone_num", F.col("zone_id").cast("int"))
    d = describe(f, DESCRIBE_COLUMNS)
    return d.select("column_name", "count", *[r6(c) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")])


@register("describe_time")
def q_describe_time(spark, sf_dir):
    """The time_bin row of D13 (timestamps, no std)."""
    return describe_time(_ft(spark, sf_dir), "time_bin")


def _hist_out(h):
    return h.select("bin", r6("bin_start"), r6("bin_end"), "count")


@register("demand_hist")
def q_demand_hist(spark, sf_dir):
    return _hist_out(histogram(_ft(spark, sf_dir), "demand", 60))


@register("lat_hist")
def q_lat_hist(spark, sf_dir):
    # both axes in two passes over the rides (bounds, then counts)
    h = histograms(C.rides(spark, sf_dir), ["pickup_lat", "pickup_long"], 60)
    return h.select("bin", r6("bin_start"), r6("bin_end"), "count", "axis")


@register("corr_matrix")
def q_corr_matrix(spark, sf_dir):
    return corr_matrix(_ft(spark, sf_dir)).select("x", "y", r6("corr"))


@register("head_rows")
def q_head_rows(spark, sf_dir):
    h = head_rows(_ft(spark, sf_dir), ["zone_id", "time_bin"], 200)
    return h.select(*FEATURE_OUT, r6("hour_sin"), r6("hour_cos"), r6("day_sin"), r6("day_cos"),
                    "lag_1", "lag_4", "lag_96", "rolling_mean_4",
                    "target_15m", "target_30m", "target_60m", "gap", "zone_lat", "zone_lon")


@register("ride_sample")
def q_ride_sample(spark, sf_dir):
    return sample_rides(C.rides(spark, sf_dir), 1000).select("ride_id", "sample_key", "pickup_lat", "pickup_long")


# ---------------------------------------------------------------- M5 spatial, rates

@register("pickup_density")
def q_pickup_density(spark, sf_dir):
    return pickup_density(C.rides(spark, sf_dir))


@register("zone_markers")
def q_zone_markers(spark, sf_dir):
    a = attach_centroids(_sim_bin_alloc(spark, sf_dir), C.zones(spark))
    return zone_markers(a, "predicted_demand")


@register("grid_cells")
def q_grid_cells(spark, sf_dir):
    counts = point_to_cell(C.rides(spark, sf_dir)).groupBy("cell_i", "cell_j") \
        .agg(F.count(F.lit(1)).alias("rides"))
    cells = grid_cell_table(spark)
    return cells.join(counts, ["cell_i", "cell_j"], "left") \
        .withColumn("rides", F.coalesce(F.col("rides"), F.lit(0)))


@register("expected_rate")
def q_expected_rate(spark, sf_dir):
    e = expected_rate(C.rides(spark, sf_dir))
    return e.select("day_of_week", "hour", "windows", r6("expected_rides"), "observed_rides", r6("ratio"))


@register("cancel_by_regime")
def q_cancel_by_regime(spark, sf_dir):
    c = cancel_by_regime(C.rides(spark, sf_dir))
    return c.select("regime", "windows", "rides", "cancelled", r6("cancel_rate"), "model_cancel_p")


# ---------------------------------------------------------------- M6 scenarios

def _baseline(spark, sf_dir):
    return baseline_forecast(_ft(spark, sf_dir))


@register("baseline_forecast")
def q_baseline_forecast(spark, sf_dir):
    b = _baseline(spark, sf_dir)
    return b.select("zone_id", "hour", "day_of_week", "pred_15m", r6("pred_30m"), r6("pred_60m"))


WHAT_IF_FLEETS = (20, 150, 1000)
WHAT_IF_FARES = (5.0, 15.0, 100.0)
WHAT_IF_CAPACITIES = (1.0, 3.0, 10.0)


def _scenario_alloc(spark, sf_dir):
    f = _ft(spark, sf_dir)
    grid = scenario_grid(f, WHAT_IF_FLEETS, WHAT_IF_FARES, WHAT_IF_CAPACITIES)
    return scenario_alloc(grid, materialize(_baseline(spark, sf_dir), "baseline"))


@register("scenario_alloc")
def q_scenario_alloc(spark, sf_dir):
    a = _scenario_alloc(spark, sf_dir)
    return a.select("fleet", "fare", "capacity", "day_of_week", "hour", "zone_id", "predicted_demand",
                    r6("pred_30m"), r6("pred_60m"), "prob", "allocated_drivers", "gap", r6("dsr"),
                    r6("surge_multiplier"), "action", r6("revenue"))


@register("scenario_kpis")
def q_scenario_kpis(spark, sf_dir):
    return scenario_kpis(_scenario_alloc(spark, sf_dir))


@register("alloc_json")
def q_alloc_json(spark, sf_dir):
    return allocation_records(_bin_alloc(spark, sf_dir), ["time_bin"], ts_col="time_bin")


@register("alloc_json_fields")
def q_alloc_json_fields(spark, sf_dir):
    """The JSON records of ``alloc_json`` parsed again."""
    d = read_records(q_alloc_json(spark, sf_dir))
    return d.select("time_bin", F.col("Total_Revenue").alias("total_revenue"), F.col("Service_Level").alias("service_level"),
                    F.col("Avg_Surge").alias("avg_surge"), "zone_id", "predicted_demand", "allocated_drivers", "action",
                    r6("surge_multiplier"))


@register("lag_profile")
def q_lag_profile(spark, sf_dir):
    p = lag_profile(_ft(spark, sf_dir))
    return p.select("zone_id", "hour", "day_of_week", *[r6(c) for c in LAG_COLUMNS], "month")


def _scenario_forecast(spark, sf_dir):
    fc, data = _forecaster(spark, sf_dir, with_supply=False)
    f = _ft(spark, sf_dir)
    return materialize(scenario_forecast(lag_profile(f), fc, C.zones(spark), baseline_forecast(f)), "scenario-forecast")


@register("scenario_forecast_alloc")
def q_scenario_forecast_alloc(spark, sf_dir):
    """The scenarios of ``scenario_alloc`` under the models' forecast."""
    grid = scenario_grid(_ft(spark, sf_dir), WHAT_IF_FLEETS, WHAT_IF_FARES, WHAT_IF_CAPACITIES)
    a = scenario_alloc(grid, _scenario_forecast(spark, sf_dir))
    return a.select("fleet", "fare", "capacity", "day_of_week", "hour", "zone_id", "predicted_demand", "pred_30m",
                    "pred_60m", "source", "prob", "allocated_drivers", "gap", r6("dsr"), r6("surge_multiplier"),
                    "action", r6("revenue"))


# ---------------------------------------------------------------- M7 ML

_models: dict = {}
_models_lock = threading.Lock()


_splits: dict = {}
_splits_lock = threading.Lock()


def _split(spark, sf_dir):
    """The split rows of the feature table, written once for all their readers."""
    key = C.source_key(spark, sf_dir)
    with _splits_lock:
        if key not in _splits:
            _splits[key] = prepare(_ft(spark, sf_dir))
        return _splits[key]


def _forecaster(spark, sf_dir, learner="gbt", max_iter=None, with_supply=True):
    iters = max_iter or (ML_ITER if learner == "gbt" else RF_TREES)
    key = (*C.source_key(spark, sf_dir), learner, iters, with_supply)
    with _models_lock:
        if key not in _models:
            _models[key] = train(_ft(spark, sf_dir), max_iter=iters, learner=learner, with_supply=with_supply,
                                 data=_split(spark, sf_dir))
        return _models[key]


ML_ITER = 500
RF_TREES = 100


@register("kmeans_zones")
def q_kmeans_zones(spark, sf_dir):
    model, cost = fit_kmeans(C.rides(spark, sf_dir), k=P.NUM_CLUSTERS)
    return kmeans_zone_table(spark, model, cost)


@register("kmeans_assign")
def q_kmeans_assign(spark, sf_dir):
    """Rides with the nearest of the fitted zones, fitted and stored if absent."""
    return assign_zone(C.rides(spark, sf_dir), model_centroids(C.fitted_zones(spark, sf_dir))) \
        .select("ride_id", "ride_ts", "pickup_lat", "pickup_long", "zone_id")


@register("kmeans_demand")
def q_kmeans_demand(spark, sf_dir):
    """Demand per bin and fitted zone."""
    rides = assign_zone(C.rides(spark, sf_dir), model_centroids(C.fitted_zones(spark, sf_dir)))
    return zone_demand(rides, P.INTERVAL_SECONDS)


# ------------------------------------------------- forecast -> allocation -> revenue

def _baseline_test(spark, sf_dir):
    """The test slice with the forecast of J11 fitted on the training slice:
    an exact predictor on the models' path to the allocation."""
    data = _split(spark, sf_dir)
    keys = ["zone_id", "hour", "day_of_week"]
    fit = baseline_forecast(data.where(F.col("split") == "train"))
    test = data.where(F.col("split") == "test").join(fit, keys, "left")
    return test.fillna(0.0, ["pred_15m", "pred_30m", "pred_60m"])


def _forecast_alloc(scored):
    """Allocation and revenue per bin from the 15-minute forecast, rounded to
    1/1024 so that sums are exact in any order."""
    d = scored.select("time_bin", "zone_id", (F.rint(F.col("pred_15m") * 1024) / 1024).alias("predicted_demand"))
    return add_revenue(allocate(d, ["time_bin"], fleet=P.PIPELINE_FLEET))


@register("baseline_test_alloc")
def q_baseline_test_alloc(spark, sf_dir):
    a = _forecast_alloc(_baseline_test(spark, sf_dir))
    return a.select(*[c for c in ALLOC_OUT if c not in ("prob", "dsr")], r6("prob"), r6("dsr"),
                    r6("surge_multiplier"), "action", r6("revenue"))


@register("baseline_test_metrics")
def q_baseline_test_metrics(spark, sf_dir):
    m = metrics(_baseline_test(spark, sf_dir))
    return m.select("horizon", r6("rmse"), r6("mae"), r6("r2"), "n_test")


def _model_test_alloc(spark, sf_dir):
    fc, data = _forecaster(spark, sf_dir)
    return _forecast_alloc(fc.predict(data.where(F.col("split") == "test")))


@register("forecast_alloc")
def q_forecast_alloc(spark, sf_dir):
    return _model_test_alloc(spark, sf_dir).select(*ALLOC_OUT, r6("surge_multiplier"), "action", r6("revenue"))


@register("forecast_kpis")
def q_forecast_kpis(spark, sf_dir):
    return fleet_kpis(_model_test_alloc(spark, sf_dir), ["time_bin"])


@register("time_split")
def q_time_split(spark, sf_dir):
    s = _split(spark, sf_dir)
    return s.select("time_bin", "zone_id", "row_idx", "split")


@register("forecast")
def q_forecast(spark, sf_dir):
    fc, data = _forecaster(spark, sf_dir)
    return fc.predict(data).select("time_bin", "zone_id", "split", "pred_15m", "pred_30m", "pred_60m")


@register("forecast_metrics")
def q_forecast_metrics(spark, sf_dir):
    fc, data = _forecaster(spark, sf_dir)
    return metrics(fc.predict(data.where(F.col("split") == "test")))


@register("feature_importance")
def q_feature_importance(spark, sf_dir):
    fc, _ = _forecaster(spark, sf_dir)
    return importance_table(spark, fc, top=15)


@register("model_card")
def q_model_card(spark, sf_dir):
    fc, _ = _forecaster(spark, sf_dir)
    return model_card(spark, fc)


@register("model_compare")
def q_model_compare(spark, sf_dir):
    out = None
    for learner in ("gbt", "rf"):
        fc, data = _forecaster(spark, sf_dir, learner)
        m = metrics(fc.predict(data.where(F.col("split") == "test"))).withColumn("learner", F.lit(learner))
        out = m if out is None else out.unionByName(m)
    return out


@register("score_requests")
def q_score_requests(spark, sf_dir):
    """L2 over a batch of requests (ts, zone, active drivers) from the test
    slice, scored with features looked up from the training slice (see
    ``streaming.request_scoring``; a stream of requests takes the same plan)."""
    fc, data = _forecaster(spark, sf_dir)
    req = data.where(F.col("split") == "test").select(
        F.col("time_bin").alias("request_ts"), "zone_id", "active_drivers")
    lookup = history_lookup(data.where(F.col("split") == "train"))
    return score_requests(req, fc, lookup, C.zones(spark))


# ---------------------------------------------------------------- M8 policy, streaming

@register("policy_states")
def q_policy_states(spark, sf_dir):
    t = transitions(_bin_alloc(spark, sf_dir))
    return t.select("gap_level", "time_of_day", "action", "next_gap_level", "next_time_of_day",
                    "transitions", r6("reward_sum"))


def _history_transitions(spark, sf_dir):
    """States from the historical gap (H13), actions and rewards from the allocation."""
    f = C.features_table(spark, sf_dir).select(
        "time_bin", "zone_id", F.col("rolling_mean_4").alias("predicted_demand"), F.col("gap").alias("history_gap"))
    a = add_revenue(allocate(f, ["time_bin"], fleet=P.PIPELINE_FLEET))
    return transitions(a, gap_col="history_gap")


@register("policy_states_history")
def q_policy_states_history(spark, sf_dir):
    return _history_transitions(spark, sf_dir).select(
        "gap_level", "time_of_day", "action", "next_gap_level", "next_time_of_day", "transitions", r6("reward_sum"))


@register("policy_q")
def q_policy_q(spark, sf_dir):
    q = policy(_history_transitions(spark, sf_dir))
    return q.select("gap_level", "time_of_day", "action", (F.round("q", 4) + F.lit(0.0)).alias("q"), "greedy_action", "is_greedy")


@register("stream_zone_demand")
def q_stream_zone_demand(spark, sf_dir):
    s = zone_demand_stream(events_stream(spark, sf_dir), C.centroids(), delay=None)
    return run_to_table(spark, s, "zone-demand", keys=("time_bin", "zone_id"))


def allocation_lines(events):
    """Events as allocation requests, one JSON line each: eight kinds by event id,
    three of them bad (cut off, a timestamp that is none, a driver count that is none)."""
    eid = F.col("event_id")
    name = F.concat(F.lit('{"request_id": "'), eid.cast("string"), F.lit('"'))
    at = lambda pattern: F.concat(F.lit(', "timestamp": "'), F.date_format("ts", pattern), F.lit('"'))
    iso, plain = at("yyyy-MM-dd'T'HH:mm:ss"), at("yyyy-MM-dd HH:mm:ss")
    fleet = ((eid % 5 + 1) * 60).cast("string")
    number, text = F.concat(F.lit(', "total_drivers": '), fleet), F.concat(F.lit(', "total_drivers": "'), fleet, F.lit('"'))
    end = F.lit("}")
    kinds = [F.concat(name, end), F.concat(name, number, end), F.concat(name, iso, end), F.concat(name, iso),
             F.concat(name, F.lit(', "timestamp": "noon"'), number, end),
             F.concat(name, plain, F.lit(', "total_drivers": "many"'), end),
             F.concat(name, plain, text, end), F.concat(name, iso, number, end)]
    return events.select(F.get(F.array(*kinds), F.pmod(eid, F.lit(8)).cast("int")).alias("value"))


@register("allocate_requests")
def q_allocate_requests(spark, sf_dir):
    """L3 over the events replayed as a stream of JSON requests; a request without a
    time is of the last event's."""
    now = read_table(spark, sf_dir, "events").agg(F.max("ts")).first()[0]
    a = allocate_requests(spark, allocation_lines(events_stream(spark, sf_dir)), materialize(_baseline(spark, sf_dir), "baseline"),
                          now=F.lit(now).cast("timestamp_ntz"))
    return a.select("request_id", "request_ts", "fleet", "zone_id", r6("predicted_demand"), "allocated_drivers", "action",
                    r6("surge_multiplier"), r6("revenue"), "error")


# ---------------------------------------------------------------- flagship

def pipeline_kpis(spark, sf_dir, fleet=P.PIPELINE_FLEET, fare=P.DEFAULT_FARE):
    """The whole chain (``build_features`` writes the demand and the filled grid
    to the checkpoint folder while it is planned): events ->
    rides -> zones -> 15-min demand -> dense grid -> features -> allocate
    ``fleet`` drivers per bin (predicted demand := rolling_mean_4) ->
    revenue -> one KPI row per bin."""
    f = C.features(spark, sf_dir).select(
        "time_bin", "zone_id", F.col("rolling_mean_4").alias("predicted_demand"))
    return fleet_kpis(add_revenue(allocate(f, ["time_bin"], fleet=fleet), fare=fare), ["time_bin"])


register("pipeline_kpis")(pipeline_kpis)
