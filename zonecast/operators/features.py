"""Demand features per (zone, bin): calendar, lags, rolling mean, targets.

E1-E3 G1-G3 H13 B7 B13 C3 F1.

The default ``method="halo"`` cuts each zone's history into blocks of ``BLOCK`` bins
and copies into every block the 96 bins before it and the 4 bins after it, so that the
ordinary window functions find all they need inside (zone, block). About 1.15 rows are
shuffled a grid row, and work spreads over the blocks whatever the number of zones or
the length of the history. Two other forms are kept as cross-checks (tests assert that
all agree): ``method="shift"``, where every grid row emits shifted copies of its demand
(9 rows shuffled a grid row), and ``method="window"``, the textbook ``lag/lead over
partitionBy(zone)``, which puts a whole zone history into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import params as P
from ..session import materialize
from ..functions.timefn import add_seconds, calendar_columns, interval_seconds
from .demand import filled_grid, zone_demand
from .zones import assign_zone, attach_centroids

LAGS = (1, 4, 96)
LEADS = ((1, "target_15m"), (2, "target_30m"), (4, "target_60m"))
ROLL = 4
#: Bins of a block: a week of quarter hours.
BLOCK = 672


def _shift_columns(grid: DataFrame, step: int) -> DataFrame:
    offsets = sorted(set(LAGS) | set(range(1, ROLL)) | {-k for k, _ in LEADS})
    copies = grid.select(
        "zone_id", "demand",
        F.explode(F.array(*[F.lit(o) for o in offsets])).alias("_off"),
        "time_bin",
    ).select("zone_id", add_seconds(F.col("time_bin"), F.col("_off") * step).alias("time_bin"),
             "_off", "demand")
    own = [c for c in grid.columns if c not in ("time_bin", "zone_id")]
    selfs = grid.select("time_bin", "zone_id", F.lit(0).alias("_off"), *own)
    rows = selfs.unionByName(copies, allowMissingColumns=True)

    def at(off):
        return F.max(F.when(F.col("_off") == off, F.col("demand")))

    aggs = [F.max(F.when(F.col("_off") == 0, F.lit(1))).alias("_self")]
    aggs += [F.max(F.when(F.col("_off") == 0, F.col(c))).alias(c) for c in own]
    aggs += [at(k).alias(f"lag_{k}") for k in LAGS]
    aggs += [at(k).alias(f"_l{k}") for k in range(1, ROLL) if k not in LAGS]
    aggs += [at(-k).alias(name) for k, name in LEADS]
    g = rows.groupBy("time_bin", "zone_id").agg(*aggs).where(F.col("_self").isNotNull())
    parts = [F.col("demand")] + [F.col(f"lag_{k}" if k in LAGS else f"_l{k}") for k in range(1, ROLL)]
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    roll = total.cast("double") / F.lit(float(ROLL))   # null if any part is null
    return g.withColumn("rolling_mean_4", roll).drop("_self", *[f"_l{k}" for k in range(1, ROLL) if k not in LAGS])


def _over(window) -> dict:
    """Lags, rolling mean and leads of ``demand`` as columns over ``window``."""
    w4 = window.rowsBetween(-(ROLL - 1), Window.currentRow)
    d = F.col("demand")
    cols = {f"lag_{k}": F.lag(d, k).over(window) for k in LAGS}
    cols["rolling_mean_4"] = F.when(F.count(d).over(w4) == ROLL, F.avg(d).over(w4))
    cols.update({name: F.lead(d, k).over(window) for k, name in LEADS})
    return cols


def _window_columns(grid: DataFrame) -> DataFrame:
    return grid.withColumns(_over(Window.partitionBy("zone_id").orderBy("time_bin")))


def _halo_columns(grid: DataFrame, step: int, block: int = BLOCK) -> DataFrame:
    head, tail = max(*LAGS, ROLL - 1), max(k for k, _ in LEADS)
    if block < max(head, tail):
        raise ValueError(f"a block needs {max(head, tail)} bins at least")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    number = F.floor(F.timestamp_diff("SECOND", epoch, F.col("time_bin")) / step)
    own, place = F.floor(number / block), F.pmod(number, F.lit(block))

    def at(b, is_own):
        return F.struct(b.alias("_block"), F.lit(is_own).alias("_own"))

    homes = F.array_compact(F.array(at(own, True), F.when(place >= block - head, at(own + 1, False)),
                                    F.when(place < tail, at(own - 1, False))))
    rows = grid.select("*", F.inline(homes))
    w = Window.partitionBy("zone_id", "_block").orderBy("time_bin")
    return rows.withColumns(_over(w)).where("_own").drop("_block", "_own")


FEATURE_ORDER = (
    "time_bin", "zone_id", "demand", "active_drivers", "is_cancelled",
    "hour", "minute", "day_of_week", "is_weekend", "month",
    "hour_sin", "hour_cos", "day_sin", "day_cos",
    "lag_1", "lag_4", "lag_96", "rolling_mean_4",
    "target_15m", "target_30m", "target_60m", "gap", "zone_lat", "zone_lon",
)


def add_features(grid: DataFrame, zones: DataFrame, interval: str | int = P.INTERVAL_SECONDS,
                 method: str = "halo", keep_rank: bool = False) -> DataFrame:
    """Features of a filled grid (F2 schema); rows with any null dropped
    after the final projection (B7), as the reference does."""
    step = interval_seconds(interval)
    if method == "halo":
        g = _halo_columns(grid, step)
    elif method == "shift":
        g = _shift_columns(grid, step)
    elif method == "window":
        g = _window_columns(grid)
    else:
        raise ValueError(method)
    g = g.withColumns(calendar_columns(F.col("time_bin")))
    if "active_drivers" in g.columns:
        g = g.withColumn("gap", F.col("demand") - F.col("active_drivers"))
    g = attach_centroids(g, zones)
    # A zone that the zone table lacks is an error, not a row that dropna hides
    unknown = F.raise_error(F.concat(F.lit("unknown zone "), F.coalesce("zone_id", F.lit("null")))).cast("double")
    g = g.withColumn("zone_lat", F.coalesce(F.col("zone_lat"), unknown))
    cols = [c for c in FEATURE_ORDER if c in g.columns]
    out = g.select(*cols, *(["zone_rank"] if keep_rank else []))
    return out.dropna(subset=cols)


def build_features(rides: DataFrame, zones: DataFrame, interval: str | int = P.INTERVAL_SECONDS,
                   method: str = "halo", keep_rank: bool = False,
                   centroids=None, cut: bool = True) -> DataFrame:
    """Whole processing chain: rides -> zones -> demand -> grid -> fill -> features.

    ``centroids`` (the zone list) saves reading a zone table back when the
    caller already has it. With ``cut`` (default) the two small
    intermediates are written once to the checkpoint folder: the demand
    aggregate (the only step that reads the rides, which are read exactly
    once) and the filled grid (bins x zones), which several branches of
    the feature plan read; without it Catalyst re-plans the ride scan in
    every branch.
    """
    demand = zone_demand(assign_zone(rides, centroids if centroids is not None else zones), interval)
    if cut:
        demand = materialize(demand, "zone-demand")
    grid = filled_grid(demand, interval)
    if cut:
        grid = materialize(grid, "demand-grid")
    return add_features(grid, zones, interval, method=method, keep_rank=keep_rank)
